"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows beyond this many bytes of text are handled in a pass of their own inside a task.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or the first variant of it that no column of ``df`` bears."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def text_bytes(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column, without decoding them."""
    return column.cast(pa.binary()).to_pylist()


def per_row(
    fields: list[tuple[str, pa.DataType]], work: Callable[[list[list]], list[list]]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow`` that keeps the first column and turns the second into ``fields``.

    ``work`` gets a list of UTF-8 values and returns one list for each field.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = work(text_bytes(batch.column(1)))
            arrays = [pa.array(values, type=kind) for values, (_, kind) in zip(made, fields, strict=True)]
            names = [batch.schema.names[0], *[name for name, _ in fields]]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=names)

    return run


def utf8_length(column: str) -> Column:
    return F.coalesce(F.octet_length(F.col(column)), F.lit(0)).cast("bigint")
