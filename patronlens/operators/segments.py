"""Summaries per segment."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patronlens.functions.rounding import round_even
from patronlens.operators.ranking import exact_quantiles
from patronlens.schema import CUSTOMER


def _known(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def summarize_segments(
    customers: DataFrame,
    segment: str = "Segment",
    digits: int = 2,
    count_name: str = "Customer_Count",
    share_name: str = "Revenue_Share_%",
) -> DataFrame:
    """Customers, mean metrics, revenue and share of revenue, by revenue descending.

    The share is taken from the rounded totals. Its window runs over one row
    per segment, after the aggregation.
    """
    rows = (
        _known(customers, segment)
        .groupBy(segment)
        .agg(
            F.count(CUSTOMER).alias(count_name),
            round_even(F.avg("Recency"), digits).alias("Avg_Recency"),
            round_even(F.avg("Frequency"), digits).alias("Avg_Frequency"),
            round_even(F.avg("Monetary"), digits).alias("Avg_Monetary"),
            round_even(F.sum("Monetary"), digits).alias("Total_Revenue"),
        )
    )
    share = F.col("Total_Revenue") / F.sum("Total_Revenue").over(Window.partitionBy()) * 100
    return rows.withColumn(share_name, round_even(share, 1)).orderBy(F.desc("Total_Revenue"), segment)


def dashboard_segment_table(customers: DataFrame, segment: str = "Segment") -> DataFrame:
    """The same table to one digit."""
    return summarize_segments(customers, segment, 1, "Customers", "Revenue_Share")


def segment_counts(customers: DataFrame, segment: str = "Segment") -> DataFrame:
    return (
        _known(customers, segment)
        .groupBy(segment)
        .agg(F.count(F.lit(1)).alias("Count"))
        .orderBy(F.desc("Count"), segment)
    )


def segment_revenue(customers: DataFrame, segment: str = "Segment") -> DataFrame:
    return (
        _known(customers, segment)
        .groupBy(segment)
        .agg(F.coalesce(F.sum("Monetary"), F.lit(0.0)).alias("Monetary"))
        .orderBy(F.desc("Monetary"), segment)
    )


def ltv_by_segment(customers: DataFrame, segment: str = "Segment") -> DataFrame:
    """Mean, exact median and sum of the predicted value, by mean descending."""
    known = _known(customers, segment)
    # Added as decimals the sum does not depend on the order of the rows, which could move a mean that ends in half a cent.
    value, exact = F.col("Predicted_LTV"), F.col("Predicted_LTV").try_cast("decimal(28,12)")
    whole = F.count(exact) == F.count(value)
    total = F.when(whole, F.sum(exact).cast("double")).otherwise(F.sum(value))
    sums = known.groupBy(segment).agg((total / F.nullif(F.count(value), F.lit(0))).alias("_avg"), total.alias("_sum"))
    medians = exact_quantiles(known, "Predicted_LTV", {"_median": 0.5}, CUSTOMER, [segment], few_groups=True)
    return (
        sums.join(medians, segment, "left")
        .select(
            segment,
            round_even(F.col("_avg"), 2).alias("Avg_LTV"),
            round_even(F.col("_median"), 2).alias("Median_LTV"),
            round_even(F.coalesce("_sum", F.lit(0.0)), 2).alias("Total_LTV"),
        )
        .orderBy(F.desc("Avg_LTV"), segment)
    )


def rfm_heatmap(scored: DataFrame, quantiles: int = 5) -> DataFrame:
    """Mean monetary value by recency score (rows) and frequency score (columns)."""
    pivoted = (
        scored.groupBy("R_Score").pivot("F_Score", list(range(1, quantiles + 1))).agg(F.avg("Monetary"))
    )
    return pivoted.select(
        "R_Score", *[F.col(str(f)).alias(f"F{f}") for f in range(1, quantiles + 1)]
    ).orderBy("R_Score")


def share_of_total(customers: DataFrame, group: str, value: str) -> DataFrame:
    """Each group's percentage of the whole sum; the window holds one row per group."""
    sums = _known(customers, group).groupBy(group).agg(F.sum(value).alias("_sum"))
    return sums.select(group, (F.col("_sum") / F.sum("_sum").over(Window.partitionBy()) * 100).alias("share"))
