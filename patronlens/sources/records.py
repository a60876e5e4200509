"""Records of CSV files whose quoted cells may hold line breaks, found by many tasks at once.

A line can start outside of quotes or inside of them, and takes each of the two to one of the
two: a map of two states. The lines of one file split (a chunk) compose to such a map, and the
maps of a file's chunks, composed from its beginning, tell in which state each chunk starts. Then
every task cuts its own chunk into records. Only a record that a chunk's end cuts is put together
from its pieces afterwards.

Quotes count as readers of spreadsheets' files count them: a quote opens a cell only at its
beginning, two quotes inside stand for one, and what follows a closing quote up to the
separator belongs to the cell.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlens.session import materialize

#: Possessive throughout, so that matching neither goes back nor nests calls however long a line is.
_INSIDE = r'(?:[^"]++|"")*+'
_CELL = rf'"{_INSIDE}"[^,]*+|[^",][^,]*+|'
_OPEN = rf'"{_INSIDE}\z'
#: A line that starts outside of quotes and ends inside.
OPENS = rf"\A(?:(?:{_CELL}),)*+{_OPEN}"
#: A line that starts inside of quotes and ends inside.
STAYS = rf'\A{_INSIDE}(?:\z|"[^,]*+,(?:(?:{_CELL}),)*+{_OPEN})'


def _lines(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """(file, chunk, line, opens, stays), lines of a chunk in the order of the file."""
    raw = spark.read.option("lineSep", "\n").text(path)
    text = F.decode(F.col("value").cast("binary"), encoding)
    quoted = F.contains("line", F.lit('"'))
    return raw.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("chunk"), text.alias("line")
    ).select(
        "file",
        "chunk",
        "line",
        (quoted & F.col("line").rlike(OPENS)).alias("opens"),
        (~quoted | F.col("line").rlike(STAYS)).alias("stays"),
    )


def has_long_records(spark: SparkSession, path: str, encoding: str) -> bool:
    """Whether any quoted cell holds a line break (or a carriage return stands inside a line)."""
    lines = _lines(spark, path, encoding)
    return not lines.filter(F.col("opens") | F.col("line").rlike(r"\r(?!\z)")).isEmpty()


def _chunk_maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per chunk: the states in which it ends, and whether a record starts in it, from either state."""
    maps: dict[tuple[str, int], list[bool]] = {}
    for batch in batches:
        for file, chunk, opens, stays in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
            # Ends inside when begun outside, when begun inside; starts a record when begun inside.
            held = maps.setdefault((file, chunk), [False, True, False])
            held[2] |= not held[1]
            held[0] = stays if held[0] else opens
            held[1] = stays if held[1] else opens
    rows = [(*key, *held) for key, held in maps.items()]
    names = ["file", "chunk", "from_outside", "from_inside", "starts"]
    kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_()]
    columns = list(zip(*rows, strict=True)) or [()] * 5
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def entry_states(maps: list[tuple[str, int, bool, bool, bool]]) -> dict[tuple[str, int], tuple[bool, int]]:
    """For each chunk whether it starts inside of quotes, and the chunk in which the record begun there started."""
    states, file, inside, owner = {}, None, False, 0
    for name, chunk, from_outside, from_inside, starts in sorted(maps):
        if name != file:
            file, inside, owner = name, False, chunk
        states[name, chunk] = (inside, owner)
        if not inside or starts:
            owner = chunk
        inside = from_inside if inside else from_outside
    return states


def records(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """(file, first, record): the records of all files, without line ends; ``first`` marks the header of each file.

    Blank lines outside of quotes are left out. The result is a written table. The driver sees
    one row per file split. A quote that is never closed takes the rest of its file into one record.
    """
    lines = _lines(spark, path, encoding)
    found = lines.select("file", "chunk", "opens", "stays").mapInArrow(
        _chunk_maps, "file string, chunk bigint, from_outside boolean, from_inside boolean, starts boolean"
    )
    states = entry_states([tuple(r) for r in found.collect()])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, pieces, out = None, [], []
        inside = whole = False

        def close(ended: bool) -> None:
            # A piece that lacks its beginning or its end waits for the others under the chunk it started in.
            if pieces:
                owner = None if whole and ended else key[1] if whole else states[key][1]
                first = whole and key[1] == 0 and not seen
                out.append((key[0], owner, key[1], first, "\n".join(pieces)))

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        seen = False
        for batch in batches:
            for file, chunk, line, opens, stays in zip(*(batch.column(c).to_pylist() for c in range(5)), strict=True):
                if (file, chunk) != key:
                    close(not inside)
                    key, pieces, seen = (file, chunk), [], False
                    if key not in states:
                        raise RuntimeError("the splits of the files changed between two passes; read again")
                    inside = states[key][0]
                    whole = False
                if not inside:
                    if pieces:
                        close(True)
                        seen = seen or whole
                    pieces, whole = [], True
                pieces.append(line)
                inside = stays if inside else opens
            yield batch_of()
            out.clear()
        close(not inside)
        yield batch_of()

    names = ["file", "owner", "chunk", "first", "record"]
    made = materialize(lines.mapInArrow(cut, "file string, owner bigint, chunk bigint, first boolean, record string"))
    pieces = made.filter(F.col("owner").isNotNull()).groupBy("file", "owner").agg(
        F.bool_or("first").alias("first"), F.sort_array(F.collect_list(F.struct("chunk", "record"))).alias("_pieces")
    )
    joined = pieces.select("file", "first", F.array_join(F.col("_pieces.record"), "\n").alias("record"))
    whole = made.filter(F.col("owner").isNull()).select("file", "first", "record").unionByName(joined)
    # The carriage return before a line end is part of the line end.
    whole = whole.withColumn("record", F.regexp_replace("record", r"\r\z", ""))
    return whole.filter(F.trim("record") != "")


def cells(record: Column) -> Column:
    """The cells of a record as text; null where a cell is empty and not quoted.

    An empty cell may follow the last one, and a quote that is not closed reaches to the end.
    """
    raw = F.regexp_extract_all(record, F.lit(rf"({_OPEN}|{_CELL})(?:,|\z)"), F.lit(1))

    def plain(cell: Column) -> Column:
        inner = F.regexp_extract(cell, rf'\A"({_INSIDE})"?', 1)
        tail = F.regexp_extract(cell, rf'(?s)\A"{_INSIDE}"?(.*)\z', 1)
        unquoted = F.when(cell != "", cell)
        return F.when(F.startswith(cell, F.lit('"')), F.concat(F.replace(inner, F.lit('""'), F.lit('"')), tail)).otherwise(unquoted)

    return F.transform(raw, plain)


def long_record_rows(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """All cells as text columns named by the header, which must be the same in all files.

    A record with fewer cells than the header has nulls for the rest; cells beyond it are ignored.
    """
    parsed = records(spark, path, encoding).select("first", cells(F.col("record")).alias("_cells"))
    headers = [r["_cells"] for r in parsed.filter("first").select("_cells").distinct().limit(2).collect()]
    if len(headers) > 1:
        raise ValueError(f"the files of {path} have different headers: {headers}")
    names = [name or "" for name in headers[0]] if headers else []
    return parsed.filter(~F.col("first")).select(*[F.get("_cells", F.lit(n)).alias(name) for n, name in enumerate(names) if name])
