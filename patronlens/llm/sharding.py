"""Shards cut from a Hilbert-curve order of several metadata dimensions.

Each dimension is quantised to a few bits, a row gets its place on the Hilbert curve
through the grid of cells, and runs of the sorted rows are the shards. Rows near each
other on the curve agree in all dimensions, so the least and greatest values that a file
keeps of its columns rule out most files for a filter on any of them. Everything
is a column expression or a sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlens.llm.common import free_name, utf8_length
from patronlens.operators.ranking import global_rank, running_totals

#: The law that the shards keep: their row counts differ by one at most.
LAW = "rows"


def hilbert_steps(dims: int) -> tuple[list[int], list[int]]:
    """Tables of the curve through a grid of ``dims`` dimensions, by state and cell: digit of the index, next state.

    A state is an entry corner and a direction (Hamilton's form of the curve). A cell is
    named by one bit per dimension. States are numbered as they are reached from (0, 0).
    """
    size, full = 1 << dims, (1 << dims) - 1

    def turned(bits: int, by: int) -> int:
        by %= dims
        return (bits << by | bits >> (dims - by)) & full

    def gray(i: int) -> int:
        return i ^ i >> 1

    def entry(i: int) -> int:
        return 0 if i == 0 else gray(2 * ((i - 1) // 2))

    def direction(i: int) -> int:
        if i == 0:
            return 0
        j = i - 1 if i % 2 == 0 else i
        return ((~j & (j + 1)).bit_length() - 1) % dims

    place = {gray(i): i for i in range(size)}
    states, digits, following = [(0, 0)], [], []
    for corner, axis in states:
        for cell in range(size):
            i = place[turned(cell ^ corner, -(axis + 1))]
            then = (corner ^ turned(entry(i), axis + 1), (axis + direction(i) + 1) % dims)
            if then not in states:
                states.append(then)
            digits.append(i)
            following.append(states.index(then))
    return digits, following


def hilbert_index(coordinates: Sequence[Column], bits: int) -> Column:
    """Place on the Hilbert curve of a cell, given by whole numbers below ``2 ** bits``."""
    dims = len(coordinates)
    digits, following = hilbert_steps(dims)
    digit, then = F.array(*map(F.lit, digits)), F.array(*map(F.lit, following))
    # One step per bit, highest first; a step's cell has one bit of each coordinate.
    cells = F.array(*[
        sum((F.shiftright(c.cast("int"), level).bitwiseAND(F.lit(1)) * (1 << d) for d, c in enumerate(coordinates)), F.lit(0))
        for level in range(bits - 1, -1, -1)
    ])
    start = F.struct(F.lit(0).cast("bigint").alias("index"), F.lit(0).alias("state"))

    def step(at: Column, cell: Column) -> Column:
        entry = at["state"] * (1 << dims) + cell
        return F.struct(
            (at["index"] * (1 << dims) + F.get(digit, entry)).alias("index"), F.get(then, entry).alias("state")
        )

    return F.aggregate(cells, start, step, lambda s: s["index"])


def number_cells(df: DataFrame, columns: Sequence[str], bits: int) -> list[Column]:
    """Cells of number columns with about equally many rows each.

    The edges are approximate quantiles over all rows, one bounded sketch per
    column. Nulls take the lowest cell.
    """
    if not columns:
        return []
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    edges = df.agg(*[F.percentile_approx(c, shares, 20_000).alias(f"_{i}") for i, c in enumerate(columns)]).first()
    cells = []
    for found, column in zip(edges, columns, strict=True):
        listed = F.array(*[F.lit(e) for e in sorted(set(found or []))]) if found else F.array().cast("array<double>")
        cells.append(F.when(F.col(column).isNull(), 0).otherwise(_below(listed, F.col(column))))
    return cells


def _below(edges: Column, value: Column) -> Column:
    return F.size(F.filter(edges, lambda e: e < value))


def name_cells(df: DataFrame, columns: Sequence[str], bits: int) -> list[Column]:
    """Cells of columns of names, in the order of the names, so that a name fills a run of the curve's cells.

    A name's cell is that of its middle row in this order: frequent names lie far apart,
    rare ones share a cell with their neighbours. Nulls take the lowest cell. The driver sees the
    first name of each cell.
    """
    cells = []
    for column in columns:
        name = F.col(column).cast("string")
        counted = df.filter(name.isNotNull()).groupBy(name.alias("name")).agg(F.count(F.lit(1)).alias("n"))
        summed = running_totals(counted, ["name"], {"upto": "n"}, totals={"all": "n"})
        middle = F.expr(f"((2 * upto - n) << {bits - 1}) div all").cast("int")
        edges = summed.groupBy(middle.alias("cell")).agg(F.min("name").alias("name")).orderBy("cell").collect()
        cell = F.lit(0)
        for edge in edges:
            cell = F.when(name >= F.lit(edge["name"]), edge["cell"]).otherwise(cell)
        cells.append(cell)
    return cells


def shard(
    docs: DataFrame,
    shards: int = 16,
    numbers: Sequence[str] = ("doc_id", "size"),
    names: Sequence[str] = ("source", "lang"),
    bits: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, size, text_crc32, curve, shard, slot) of each row; ``slot`` is its place in the shard, from 0.

    ``size`` is the number of bytes of the text plus one, 1 for a null text, whose CRC-32
    is 0 like that of an empty one. Rows of one cell are sorted by text checksum and
    id, so equal texts of a cell lie side by side. Shard sizes in rows differ by one
    at most, whatever the keys; repeated rows are dealt one by one. With fewer rows than
    shards the last shards are empty. Columns named here that ``docs`` lacks
    are an error; others are ignored.
    """
    text = F.col(text_col).cast("string")
    crc = F.coalesce(F.crc32(text.cast("binary")), F.lit(0).cast("bigint"))
    rows = docs.withColumns({"size": utf8_length(text_col) + 1, "text_crc32": crc})
    cells = number_cells(rows, numbers, bits) + name_cells(docs, names, bits)
    placed = rows.select(id_col, "size", "text_crc32", hilbert_index(cells, bits).alias("curve"))
    rank, total = free_name(placed, "rank"), free_name(placed, "total")
    ranked = global_rank(placed, ["curve", "text_crc32", id_col], rank, total)
    # The first ``longer`` shards have one row more than the others.
    place = F.col(rank) - 1
    each, longer = F.expr(f"{total} div {shards}"), F.col(total) % shards
    head = longer * (each + 1)
    number = F.when(place < head, F.expr(f"({rank} - 1) div ({total} div {shards} + 1)")).otherwise(
        longer + F.floor((place - head) / F.greatest(each, F.lit(1)))
    )
    first = F.when(number <= longer, number * (each + 1)).otherwise(head + (number - longer) * each)
    return ranked.select(
        id_col, "size", "text_crc32", "curve", number.cast("int").alias("shard"), (place - first).cast("bigint").alias("slot")
    )


def write_shards(docs: DataFrame, sharded: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Write ``docs`` with one folder per shard, rows in slot order; ids must be unique and not null.

    Tasks take runs of slots, so a large shard is written as several files by several tasks.
    """
    placed = docs.join(sharded.select(id_col, "shard", "slot"), id_col)
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
