"""Exact, repeatable train/test splits.

Rows are ordered by a seeded hash of their id, so the same rows land on the
same side however the data are partitioned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronlens.operators.ranking import global_rank
from patronlens.schema import CUSTOMER

SEED = 42


def _turn(unique: str, seed: int) -> Column:
    """Seeded order of the rows: the MD5 of id and seed, which other engines compute alike."""
    return F.md5(F.concat(F.col(unique).cast("string"), F.lit(f":{seed}")).cast("binary"))


def random_split(
    df: DataFrame, test_size: float = 0.2, seed: int = SEED, unique: str = CUSTOMER
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows; the test side has ceil(test_size * n) rows."""
    keyed = df.withColumn("_hash", _turn(unique, seed))
    ranked = global_rank(keyed, ["_hash", unique], "_rank", "_n")
    tested = F.col("_rank") <= F.ceil(F.lit(test_size) * F.col("_n"))
    return ranked.filter(~tested).select(df.columns), ranked.filter(tested).select(df.columns)


def stratified_split(
    df: DataFrame, label: str, test_size: float = 0.2, seed: int = SEED, unique: str = CUSTOMER
) -> tuple[DataFrame, DataFrame]:
    """The same, sharing the test rows among labels by largest remainder."""
    keyed = df.withColumn("_hash", _turn(unique, seed))
    ranked = global_rank(keyed, [label, "_hash", unique], "_rank", "_n")
    # From here one row per label.
    labels = ranked.groupBy(label, "_n").agg(F.count(F.lit(1)).alias("_size"), F.min("_rank").alias("_first"))
    wanted = F.ceil(F.lit(test_size) * F.col("_n"))
    shares = labels.withColumn("_share", wanted * F.col("_size") / F.col("_n")).withColumn(
        "_base", F.floor("_share")
    )
    spare = wanted - F.sum("_base").over(Window.partitionBy())
    turn = F.row_number().over(Window.orderBy(F.desc(F.col("_share") - F.col("_base")), label))
    quotas = shares.select(label, "_first", (F.col("_base") + (turn <= spare).cast("int")).alias("_quota"))
    # A label of a classifier has few values; a bounded side, and the rows stay where they are.
    placed = ranked.join(F.broadcast(quotas), label)
    tested = F.col("_rank") - F.col("_first") < F.col("_quota")
    return placed.filter(~tested).select(df.columns), placed.filter(tested).select(df.columns)
