"""Reading and writing transaction files."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronlens.schema import CUSTOMER, LOADED
from patronlens.sources.records import has_long_records, long_record_rows

ENCODING = "ISO-8859-1"
# Date patterns of retail exports next to ISO dates.
DATE_PATTERNS = ("M/d/yyyy H:mm", "M/d/yy H:mm", "d-M-yyyy H:mm")

log = logging.getLogger(__name__)


def _date_from(text: Column, patterns: Sequence[str]) -> Column:
    """Local time without a zone, so that no clock change moves it."""
    parsed = [text.try_cast("timestamp_ntz")]
    for pattern in patterns:
        options = {"timestampNTZFormat": pattern, "sep": "\x01"}
        parsed.append(F.from_csv(text, F.lit("v timestamp_ntz"), options)["v"])
    return F.coalesce(*parsed)


def _typed(name: str, kind: T.DataType, patterns: Sequence[str]) -> Column:
    """A text column as ``kind``; null where it cannot be read."""
    text = F.trim(F.col(f"`{name}`"))
    if isinstance(kind, T.StringType):
        return F.col(f"`{name}`")
    if isinstance(kind, T.TimestampNTZType):
        return _date_from(text, patterns)
    if isinstance(kind, T.IntegralType):
        # Whole numbers may be written with a fraction of zeros.
        number = text.try_cast(T.DecimalType(38, 10))
        return F.when(number == F.floor(number), number.try_cast(kind))
    return text.try_cast(kind)


def _text_rows(spark: SparkSession, path: str) -> DataFrame:
    """All cells as text. A file whose header names other columns than the first one's is an error.

    Files without line breaks inside cells go through Spark's own reader, which splits
    them at lines; one pass over the lines tells. Others are cut into records by ``records``.
    """
    if has_long_records(spark, path, ENCODING):
        return long_record_rows(spark, path, ENCODING)
    reader = spark.read.option("header", True).option("encoding", ENCODING).option("enforceSchema", False)
    return reader.option("escape", '"').csv(path)


def _format_of(path: str, format: str | None) -> str:
    kind = format or ("parquet" if path.rstrip("/").endswith(".parquet") else "csv")
    if kind not in ("csv", "parquet"):
        raise ValueError(f"format must be 'csv' or 'parquet', not {kind!r}")
    return kind


def load_transactions(
    spark: SparkSession,
    path: str,
    schema: T.StructType = LOADED,
    date_patterns: Sequence[str] = DATE_PATTERNS,
    count_rows: bool = False,
    format: str | None = None,
) -> DataFrame:
    """Transactions from a Latin-1 CSV with a header, or from a parquet path.

    Without ``format`` (csv or parquet) the end of the path decides. Columns are taken
    by the name in the header, in any order; columns the schema does not know are
    ignored and columns the file lacks are null. Every column is read as text and then
    typed: prices keep ten decimals, quantities may end in ``.0``, and a cell that cannot
    be read is null, which ``unreadable_cells`` counts. ``count_rows`` logs the
    number of rows, at the price of one scan.

    Quoted cells may hold separators, doubled quotes and line breaks. A file with line breaks in
    cells is read by many tasks all the same, and its rows are a written table.
    """
    if _format_of(path, format) == "parquet":
        df = spark.read.parquet(path)
    else:
        raw = _text_rows(spark, path)
        df = raw.select(
            *[
                (_typed(f.name, f.dataType, date_patterns) if f.name in raw.columns else F.lit(None).cast(f.dataType)).alias(f.name)
                for f in schema.fields
            ]
        )
    if count_rows:
        log.info("Loaded %s rows from %s", f"{df.count():,}", path)
    return df


def unreadable_cells(
    spark: SparkSession, path: str, schema: T.StructType = LOADED, date_patterns: Sequence[str] = DATE_PATTERNS
) -> DataFrame:
    """Per typed column of a CSV: cells that hold text, and those of them that cannot be read."""
    raw = _text_rows(spark, path)
    kinds = [f for f in schema.fields if f.name in raw.columns and not isinstance(f.dataType, T.StringType)]
    filled = {f.name: F.coalesce(F.trim(f"`{f.name}`") != "", F.lit(False)) for f in kinds}
    counts = raw.agg(
        *[F.count_if(filled[f.name]).alias(f"_filled_{f.name}") for f in kinds],
        *[F.count_if(filled[f.name] & _typed(f.name, f.dataType, date_patterns).isNull()).alias(f"_bad_{f.name}") for f in kinds],
    )
    rows = [
        F.struct(F.lit(f.name).alias("column"), F.col(f"_filled_{f.name}").alias("filled"), F.col(f"_bad_{f.name}").alias("unreadable"))
        for f in kinds
    ]
    return counts.select(F.inline(F.array(*rows)))


def write_transactions(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with a header and no row numbers, in as many files as there are partitions.

    Cells with separators, quotes or line breaks are quoted and their quotes doubled; blanks at their ends stay.
    """
    writer = df.write.mode(mode).option("header", True).option("encoding", ENCODING).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def dataset_profile(df: DataFrame, name: str = "transactions") -> DataFrame:
    """Rows, columns and, where the column exists, distinct customers."""
    unique = F.count_distinct(CUSTOMER) if CUSTOMER in df.columns else F.lit(None).cast("bigint")
    return df.agg(F.count(F.lit(1)).alias("rows"), unique.alias("unique_customers")).select(
        F.lit(name).alias("dataset"), "rows", F.lit(len(df.columns)).alias("cols"), "unique_customers"
    )
