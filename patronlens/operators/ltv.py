"""Lifetime-value targets, tiers and their summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens.functions.binning import order_of
from patronlens.functions.rounding import round_even
from patronlens.operators.churn import _counts_in_order
from patronlens.operators.features import feature_matrix
from patronlens.operators.ranking import exact_quantiles, is_number
from patronlens.schema import CUSTOMER

# Model inputs and tier order.
LTV_FEATURES = (
    "total_orders",
    "total_items",
    "unique_products",
    "unique_categories",
    "avg_order_value",
    "std_order_value",
    "avg_unit_price",
    "max_unit_price",
    "customer_age_days",
    "recency_days",
    "purchase_span_days",
    "avg_days_between_orders",
    "purchase_frequency_per_month",
    "revenue_per_item",
    "product_diversity_ratio",
    "is_multi_country",
    "log_total_revenue",
    "log_avg_order_value",
    "log_total_items",
)
LEAKY_LTV_FEATURES = ("log_total_revenue",)
LTV_TIERS = ("Bronze", "Silver", "Gold", "Platinum")
LTV_TIERS_DESCENDING = ("Platinum", "Gold", "Silver", "Bronze")


def ltv_dataset(features: DataFrame, target: str = "total_revenue", exclude_leaky: bool = False) -> DataFrame:
    """Customer, model inputs and ``y`` = log(1 + target), before the split.

    The log of total revenue is among the inputs; ``exclude_leaky`` leaves it out.
    """
    wanted = [c for c in LTV_FEATURES if not (exclude_leaky and c in LEAKY_LTV_FEATURES)]
    labelled = features.withColumn("y", F.log1p(F.col(target).cast("double")))
    return feature_matrix(labelled, wanted, (CUSTOMER, "y"))


def quantile_tiers(
    df: DataFrame,
    value: str = "Predicted_LTV",
    tier: str = "LTV_Tier",
    duplicates: str = "raise",
) -> DataFrame:
    """Quartile tier of a value, edges closed on the right.

    Equal edges raise when a row is labelled; ``duplicates='collapse'`` keeps
    them, so that the tiers between equal edges stay empty.
    """
    if duplicates not in ("raise", "collapse"):
        raise ValueError("duplicates must be 'raise' or 'collapse'")
    quartiles = exact_quantiles(df, value, {"q1": 0.25, "q2": 0.5, "q3": 0.75}, CUSTOMER)
    edges = quartiles.select(F.array("q1", "q2", "q3").alias("edges")).scalar()
    number = F.col(value).cast("double")
    label = F.when(number.isNull() | F.isnan(number), F.lit(None).cast("string"))
    if duplicates == "raise":
        repeated = F.size(F.array_distinct(edges)) < 3
        label = label.when(repeated, F.raise_error(F.lit(f"quartiles of {value} are not distinct")).cast("string"))
    for i, name in enumerate(LTV_TIERS[:-1]):
        label = label.when(number <= edges[i], F.lit(name))
    return df.withColumn(tier, label.otherwise(F.lit(LTV_TIERS[-1])))


def with_ltv_scores(scored: DataFrame, duplicates: str = "raise") -> DataFrame:
    """Add the predicted value and its tier to ``Predicted_LTV_Log``."""
    valued = scored.withColumn("Predicted_LTV", F.expm1("Predicted_LTV_Log"))
    return quantile_tiers(valued, duplicates=duplicates)


def ltv_tier_summary(scored: DataFrame) -> DataFrame:
    """Count, mean and sum of the predicted value per tier, in tier order."""
    return (
        scored.filter(F.col("LTV_Tier").isNotNull())
        .groupBy("LTV_Tier")
        .agg(
            F.count("Predicted_LTV").alias("count"),
            round_even(F.avg("Predicted_LTV"), 2).alias("mean"),
            round_even(F.sum("Predicted_LTV"), 2).alias("sum"),
        )
        .withColumn("tier_order", order_of(F.col("LTV_Tier"), LTV_TIERS))
        .orderBy("tier_order")
    )


def ltv_tier_counts(scored: DataFrame) -> DataFrame:
    """Customers per tier from platinum to bronze, null for an empty tier."""
    return _counts_in_order(scored, "LTV_Tier", LTV_TIERS_DESCENDING, "Customers").orderBy("tier_order")


def ltv_describe(df: DataFrame, value: str = "LTV_12m") -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum, to 2 digits, without NaN."""
    quartiles = exact_quantiles(df, value, {"p25": 0.25, "p50": 0.5, "p75": 0.75}, CUSTOMER)
    row = quartiles.select(F.struct("p25", "p50", "p75").alias("q")).scalar()
    stats = df.filter(is_number(df, value)).agg(
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    return stats.select(
        "count",
        *[round_even(F.col(c), 2).alias(c) for c in ("mean", "std", "min")],
        *[round_even(row[c], 2).alias(c) for c in ("p25", "p50", "p75")],
        round_even(F.col("max"), 2).alias("max"),
    )
