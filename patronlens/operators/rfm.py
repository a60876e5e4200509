"""Recency, frequency, monetary value: metrics, scores and named segments."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlens.functions.binning import bin_of_rank, bin_of_value, even_probabilities
from patronlens.functions.timing import plus_days, whole_days
from patronlens.operators.ranking import exact_quantiles, global_rank, global_ranks
from patronlens.schema import CUSTOMER, DATE, INVOICE, REVENUE
from patronlens.session import materialize

# Segment of each (R_Score, F_Score) pair.
SEGMENTS = {
    (5, 5): "Champions",
    (5, 4): "Champions",
    (4, 5): "Champions",
    (4, 4): "Loyal Customers",
    (3, 5): "Loyal Customers",
    (5, 3): "Potential Loyalists",
    (4, 3): "Potential Loyalists",
    (5, 2): "Potential Loyalists",
    (3, 3): "Need Attention",
    (4, 2): "Need Attention",
    (3, 2): "About to Sleep",
    (2, 3): "At Risk",
    (2, 4): "At Risk",
    (2, 5): "At Risk",
    (1, 5): "Can't Lose Them",
    (1, 4): "Can't Lose Them",
    (1, 3): "Hibernating",
    (1, 2): "Hibernating",
    (2, 2): "Hibernating",
    (1, 1): "Lost",
    (2, 1): "Lost",
    (3, 1): "Lost",
}
OTHER_SEGMENT = "Need Attention"


def latest(customers: DataFrame, column: str = "_last") -> Column:
    """Latest date over a customer table, as a scalar subquery."""
    return customers.agg(F.max(column).alias("latest")).scalar()


def compute_rfm(df: DataFrame, snapshot: datetime | None = None) -> DataFrame:
    """Per customer: whole days since the last purchase, distinct invoices, revenue.

    The default snapshot, one day after the last transaction of all, is read
    off the customer table, which is written for that: the lines are scanned
    once. With a given snapshot nothing is written.
    """
    customers = df.groupBy(CUSTOMER).agg(
        F.max(DATE).alias("_last"),
        F.count_distinct(INVOICE).alias("Frequency"),
        F.coalesce(F.sum(REVENUE).cast("double"), F.lit(0.0)).alias("Monetary"),
    )
    if snapshot is None:
        customers = materialize(customers)
        moment = plus_days(latest(customers), 1)
    else:
        moment = F.lit(snapshot).cast(df.schema[DATE].dataType)
    return customers.filter(F.col(CUSTOMER).isNotNull()).select(
        CUSTOMER, whole_days(F.col("_last"), moment).alias("Recency"), "Frequency", "Monetary"
    )


def quantile_bin_rank(df: DataFrame, value: str, score: str, bins: int = 5, unique: str = CUSTOMER) -> DataFrame:
    """Quantile bin of the row's rank by value, ties in order of ``unique``."""
    ranked = global_rank(df, [value, unique], "_rank", "_total")
    return ranked.withColumn(score, bin_of_rank(F.col("_rank"), F.col("_total"), bins)).drop("_rank", "_total")


def quantile_bin_value(
    df: DataFrame,
    value: str,
    score: str,
    bins: int = 5,
    reverse: bool = False,
    duplicates: str = "raise",
    unique: str = CUSTOMER,
) -> DataFrame:
    """Quantile bin of the raw value: equal values share a bin.

    The edges are selected by counting passes, without a sort. Equal edges raise when a row
    is scored, or with ``duplicates='collapse'`` merge into one.
    """
    if duplicates not in ("raise", "collapse"):
        raise ValueError("duplicates must be 'raise' or 'collapse'")
    probabilities = [0.0, *even_probabilities(bins), 1.0]
    names = {f"_q{i}": p for i, p in enumerate(probabilities)}
    edges = exact_quantiles(df, value, names, unique).select(F.array(*names).alias("edges")).scalar()
    number = F.col(value).cast("double")
    if duplicates == "collapse":
        above = [((edges[i] > edges[i - 1]) & (number > edges[i])).cast("int") for i in range(1, bins)]
        low = sum(above, F.lit(1))
    else:
        repeated = F.size(F.array_distinct(edges)) < bins + 1
        error = F.raise_error(F.lit(f"quantile edges of {value} are not distinct"))
        low = F.when(repeated, error.cast("int")).otherwise(
            bin_of_value(number, [edges[i] for i in range(1, bins)])
        )
    return df.withColumn(score, ((bins + 1) - low if reverse else low).cast("int"))


def score_rfm(rfm: DataFrame, quantiles: int = 5, duplicates: str = "raise") -> DataFrame:
    """Scores 1..quantiles per dimension (higher is better), their sum and their digits."""
    scored = quantile_bin_value(rfm, "Recency", "R_Score", quantiles, reverse=True, duplicates=duplicates)
    scored = global_ranks(scored, {"_F": "Frequency", "_M": "Monetary"}, CUSTOMER, "_total")
    scored = scored.withColumns({f"{c}_Score": bin_of_rank(F.col(f"_{c}"), F.col("_total"), quantiles) for c in "FM"})
    parts = [F.col(c) for c in ("R_Score", "F_Score", "M_Score")]
    return scored.select(
        *rfm.columns,
        *parts,
        (parts[0] + parts[1] + parts[2]).alias("RFM_Score"),
        F.concat(*[p.cast("string") for p in parts]).alias("RFM_String"),
    )


def segment_label(r_score: Column, f_score: Column) -> Column:
    """Segment name of a score pair; pairs outside the table need attention."""
    table = F.create_map(*[F.lit(x) for (r, f), name in SEGMENTS.items() for x in (r * 100 + f, name)])
    return F.coalesce(F.try_element_at(table, (r_score * 100 + f_score).cast("int")), F.lit(OTHER_SEGMENT))


def assign_segments(scored: DataFrame) -> DataFrame:
    return scored.withColumn("Segment", segment_label(F.col("R_Score"), F.col("F_Score")))
