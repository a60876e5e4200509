"""Global order primitives: ranks, running totals and exact quantiles.

A window without partition keys would pull the whole table into one task. Here
the rows are range-sorted by a unique composite key, so a value shared by a
third of the rows is still spread over many partitions; each row's position
inside its partition is then frozen in a written table, and only one count per
partition is needed to make the positions global. The table matters: range
bounds are sampled again whenever a plan is run again, so positions from two
runs must never be mixed.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronlens.session import materialize

_POSITION_BITS = 33


def global_rank(
    df: DataFrame,
    order: Sequence[str | Column],
    rank: str = "rank",
    total: str | None = None,
) -> DataFrame:
    """Add the 1-based position of each row in the total order ``order``.

    ``order`` must end in a unique column. ``total`` names an optional column
    for the number of rows.
    """
    placed = materialize(df.orderBy(*order).withColumn("_slot", F.monotonically_increasing_id()))
    chunk = F.shiftrightunsigned("_slot", _POSITION_BITS)
    inside = F.col("_slot").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))

    # One row per partition of the sorted table.
    sizes = placed.groupBy(chunk.alias("_chunk")).agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_chunk",
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_size").over(Window.partitionBy()).alias("_total"),
    )
    ranked = placed.withColumn("_chunk", chunk).join(F.broadcast(offsets), "_chunk")
    added = [(F.col("_before") + inside + 1).alias(rank)]
    if total is not None:
        added.append(F.col("_total").alias(total))
    return ranked.select(*df.columns, *added)


def running_totals(
    df: DataFrame,
    order: Sequence[str],
    sums: dict[str, str],
    by: Sequence[str] = (),
    totals: dict[str, str] | None = None,
) -> DataFrame:
    """Inclusive running sums of columns in ascending ``order``.

    ``sums`` maps new column names to summed columns; ``totals`` likewise for
    whole sums. The rows must be unique in ``(*by, *order)``; both kinds of sum
    start afresh for each value of ``by``.
    """
    totals = totals or {}
    placed = materialize(df.orderBy(*by, *order).withColumn("_chunk", F.spark_partition_id()))
    inside = (
        Window.partitionBy("_chunk", *by)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # One row per partition and group held by it.
    summed = sorted(set(sums.values()) | set(totals.values()))
    parts = placed.groupBy("_chunk", *by).agg(*[F.sum(c).alias(f"_sum_{c}") for c in summed])
    earlier = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        "_chunk",
        *by,
        *[F.coalesce(F.sum(f"_sum_{c}").over(earlier), F.lit(0)).alias(f"_before_{c}") for c in set(sums.values())],
        *[F.sum(f"_sum_{c}").over(Window.partitionBy(*by)).alias(name) for name, c in totals.items()],
    )
    local = placed.select(
        "_chunk", *df.columns, *[F.sum(c).over(inside).alias(f"_run_{name}") for name, c in sums.items()]
    )
    return local.join(offsets, ["_chunk", *by]).select(
        *df.columns,
        *[(F.col(f"_run_{name}") + F.col(f"_before_{c}")).alias(name) for name, c in sums.items()],
        *totals,
    )


def is_number(df: DataFrame, value: str) -> Column:
    """Neither null nor NaN."""
    known = F.col(value).isNotNull()
    if isinstance(df.schema[value].dataType, (T.DoubleType, T.FloatType)):
        known = known & ~F.isnan(value)
    return known


def global_ranks(df: DataFrame, ranks: dict[str, str], unique: str, total: str | None = None) -> DataFrame:
    """Several positions of each row: ``ranks`` maps new columns to the columns that order them, ties by ``unique``.

    All orders go through one range exchange and one written table, as rows (order, value,
    unique id) of which those of the first order carry the row itself. ``unique`` must be unique and not null.
    """
    rest = [c for c in df.columns if c != unique]
    kinds = {v: df.schema[v].dataType for v in ranks.values()}
    orders = []
    for n, value in enumerate(ranks.values()):
        # One column for each value, so that every type keeps its own order.
        values = [(F.col(v) if v == value else F.lit(None)).cast(k).alias(f"_value{i}") for i, (v, k) in enumerate(kinds.items())]
        row = F.struct(*rest) if n == 0 else F.lit(None).cast(df.select(F.struct(*rest)).schema[0].dataType)
        orders.append(F.struct(F.lit(n).alias("_order"), *values, row.alias("_row")))
    stacked = df.select(F.col(unique), F.inline(F.array(*orders)))
    names = [f"_value{i}" for i in range(len(kinds))]
    ranked = global_rank(stacked, ["_order", *names, unique], "_rank", "_total")
    # Every order has a row of each id, so the places of an order start after those of all before.
    size = F.col("_total") / len(ranks)
    place = F.col("_rank") - F.col("_order") * size.cast("bigint")
    picked = [F.max(F.when(F.col("_order") == n, place)).alias(name) for n, name in enumerate(ranks)]
    sizes = [F.max(size.cast("bigint")).alias(total)] if total is not None else []
    joined = ranked.groupBy(unique).agg(F.first("_row", ignorenulls=True).alias("_row"), *picked, *sizes)
    kept = [F.col(unique) if c == unique else F.col(f"_row.`{c}`").alias(c) for c in df.columns]
    return joined.select(*kept, *ranks, *([total] if total is not None else []))


#: Bins into which a pass of a selection cuts each range of values.
SELECTION_BINS = 1024


def _selected(kept: DataFrame, brackets: dict[tuple[tuple, float, float], list[int]], by: Sequence[str]) -> dict:
    """Per bracket (group, low, high): (bin, rows, least, greatest) of its values, by bin."""
    keys = list(brackets)
    schema = T.StructType([*(kept.schema[c] for c in by), T.StructField("_one", T.IntegerType()), T.StructField("_b", T.IntegerType()),
                           T.StructField("_low", T.DoubleType()), T.StructField("_high", T.DoubleType())])
    table = kept.sparkSession.createDataFrame([(*g, 1, n, low, high) for n, (g, low, high) in enumerate(keys)], schema)
    # A row per group and range still open.
    joined = kept.join(F.broadcast(table), [*by, "_one"]).filter(F.col("_v").between(F.col("_low"), F.col("_high")))
    share = F.try_divide(F.col("_v") / 2 - F.col("_low") / 2, F.col("_high") / 2 - F.col("_low") / 2)
    middle = F.floor(F.nanvl(F.coalesce(share, F.lit(0.5)), F.lit(0.5)) * SELECTION_BINS)
    inner = F.greatest(F.lit(0), F.least(F.lit(SELECTION_BINS - 1), middle))
    cell = F.when(F.col("_v") == F.col("_high"), SELECTION_BINS - 1).when(F.col("_v") == F.col("_low"), 0).otherwise(inner)
    counted = joined.groupBy("_b", cell.alias("_cell")).agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("low"), F.max("_v").alias("high"))
    found: dict[tuple, list] = {key: [] for key in keys}
    for row in counted.orderBy("_b", "_cell").collect():
        found[keys[row["_b"]]].append((row["n"], row["low"], row["high"]))
    return found


def order_statistics(kept: DataFrame, by: Sequence[str], wanted: Callable[[int], Iterable[int]]) -> dict[tuple, tuple[int, dict[int, float]]]:
    """Per group its number of rows and the values (column ``_v``) at the 0-based places that ``wanted`` names for that number.

    By selection: each pass counts the values of every open range in bins, and the bin with the place
    becomes the next range, from its least to its greatest value. It ends when the place is at an end of a
    range, and must, as the least and the greatest value never share a bin. Values that are equal need no further pass.
    """
    sizes = kept.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("low"), F.max("_v").alias("high")).collect()
    found = {tuple(r[c] for c in by): (r["n"], {}) for r in sizes}
    open_places: dict[tuple, list[tuple[int, int, int]]] = {}

    def settle(group: tuple, low: float, high: float, rows: int, places: list[tuple[int, int]]) -> None:
        for place, inside in places:
            if inside == 0 or inside == rows - 1 or low == high:
                found[group][1][place] = low if inside == 0 or low == high else high
            else:
                open_places.setdefault((group, low, high), []).append((place, inside))

    for r in sizes:
        if r["n"]:
            settle(tuple(r[c] for c in by), r["low"], r["high"], r["n"], [(k, k) for k in sorted(set(wanted(r["n"])))])
    while open_places:
        asked, open_places = open_places, {}
        for key, bins in _selected(kept, asked, by).items():
            before = 0
            for rows, low, high in bins:
                settle(key[0], low, high, rows, [(k, i - before) for k, i in asked[key] if before <= i < before + rows])
                before += rows
    return found


def exact_quantiles(
    df: DataFrame,
    value: str,
    probabilities: dict[str, float],
    unique: str,
    by: Sequence[str] = (),
    few_groups: bool = False,
) -> DataFrame:
    """Exact linearly interpolated quantiles, one row per group (one row without ``by``).

    NaN counts as missing. Without groups, or with groups that are few by their nature, such as
    segments (``few_groups``), the order statistics are selected by a few counting passes over the stored
    values. Otherwise they are read off the ranked table, where ``unique`` breaks ties so that
    equal values spread. Neither keeps all values of a group in one task.
    """
    selected = not by or few_groups
    wanted = df.select(*by, value, *([] if selected else [unique])).filter(is_number(df, value))
    for key in by:
        wanted = wanted.filter(F.col(key).isNotNull())
    if selected:
        return _selected_quantiles(wanted, value, probabilities, by)
    ranked = global_rank(wanted, [*by, value, unique], "_rank")
    groups = ranked.groupBy(*by).agg(F.min("_rank").alias("_first"), F.count(F.lit(1)).alias("_n"))
    ranked = ranked.join(groups, list(by))
    position = F.col("_rank") - F.col("_first")

    picks, finals = [], []
    last = (F.col("_n") - 1).cast("double")
    number = F.col(value).cast("double")
    for name, p in probabilities.items():
        at = last * F.lit(p)
        picks += [
            F.max(F.when(position == F.floor(at), number)).alias(f"_lo_{name}"),
            F.max(F.when(position == F.ceil(at), number)).alias(f"_hi_{name}"),
            F.max(at - F.floor(at)).alias(f"_t_{name}"),
        ]
        lo, hi, t = F.col(f"_lo_{name}"), F.col(f"_hi_{name}"), F.col(f"_t_{name}")
        finals.append((lo + (hi - lo) * t).alias(name))
    return ranked.groupBy(*by).agg(*picks).select(*by, *finals)


def _selected_quantiles(wanted: DataFrame, value: str, probabilities: dict[str, float], by: Sequence[str]) -> DataFrame:
    kept = wanted.select(*by, F.lit(1).alias("_one"), F.col(value).cast("double").alias("_v")).persist(StorageLevel.MEMORY_AND_DISK)

    def places(rows: int) -> list[int]:
        return [end(p * (rows - 1)) for p in probabilities.values() for end in (math.floor, math.ceil)]

    rows = []
    for group, (n, at) in order_statistics(kept, by, places).items():
        spots = [p * (n - 1) for p in probabilities.values()]
        values = [at[math.floor(x)] + (at[math.ceil(x)] - at[math.floor(x)]) * (x - math.floor(x)) if n else None for x in spots]
        rows.append((*group, *values))
    kept.unpersist()
    fields = [wanted.schema[c] for c in by] + [T.StructField(name, T.DoubleType()) for name in probabilities]
    return wanted.sparkSession.createDataFrame(rows, T.StructType(fields))
