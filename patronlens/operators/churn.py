"""Churn labels, risk tiers and their summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlens.functions.binning import fixed_bins
from patronlens.functions.timing import plus_days
from patronlens.operators.features import feature_matrix
from patronlens.operators.rfm import latest
from patronlens.schema import CUSTOMER, DATE
from patronlens.session import materialize

# Model inputs, tier edges and tier order.
CHURN_FEATURES = (
    "Recency",
    "Frequency",
    "Monetary",
    "total_orders",
    "unique_products",
    "unique_categories",
    "avg_order_value",
    "std_order_value",
    "customer_age_days",
    "purchase_span_days",
    "avg_days_between_orders",
    "purchase_frequency_per_month",
    "product_diversity_ratio",
    "is_multi_country",
)
LEAKY_CHURN_FEATURES = ("Recency",)
RISK_EDGES = (0.0, 0.3, 0.6, 0.8, 1.0)
RISK_TIERS = ("Low", "Medium", "High", "Critical")
RISK_ORDER = ("Critical", "High", "Medium", "Low")


def churn_labels(df: DataFrame, churn_days: int = 90) -> DataFrame:
    """1 when the last purchase lies strictly before the cutoff, ``churn_days`` before the last date."""
    customers = materialize(df.groupBy(CUSTOMER).agg(F.max(DATE).alias("_last")))
    cutoff = plus_days(latest(customers), -churn_days)
    return customers.filter(F.col(CUSTOMER).isNotNull()).select(
        CUSTOMER, (F.col("_last") < cutoff).cast("int").alias("Churned")
    )


def churn_rate(labels: DataFrame) -> DataFrame:
    return labels.agg(
        F.avg("Churned").alias("churn_rate"),
        F.sum("Churned").alias("churned"),
        F.count(F.lit(1)).alias("customers"),
    )


def features_with_labels(features: DataFrame, labels: DataFrame) -> DataFrame:
    return features.join(labels, CUSTOMER, "inner")


def churn_dataset(features: DataFrame, labels: DataFrame | None = None, exclude_leaky: bool = False) -> DataFrame:
    """Customer, model inputs and label, before the split.

    Without ``labels`` the features must hold ``Churned`` themselves. Recency decides the
    label; ``exclude_leaky`` leaves it out.
    """
    wanted = [c for c in CHURN_FEATURES if not (exclude_leaky and c in LEAKY_CHURN_FEATURES)]
    labelled = features if labels is None else features_with_labels(features, labels)
    return feature_matrix(labelled, wanted, (CUSTOMER, "Churned"))


def risk_tier(probability: Column, include_lowest: bool = False) -> Column:
    """Tier of a probability, edges closed on the right; exactly 0 has none by default."""
    return fixed_bins(probability, RISK_EDGES, RISK_TIERS, include_lowest)


def with_churn_scores(scored: DataFrame, threshold: float = 0.5, include_lowest: bool = False) -> DataFrame:
    """Add the predicted class and the risk tier to ``Churn_Probability``."""
    probability = F.col("Churn_Probability")
    return scored.select(
        "*",
        (probability >= threshold).cast("int").alias("Churn_Predicted"),
        risk_tier(probability, include_lowest).alias("Churn_Risk_Tier"),
    )


def _counts_in_order(df: DataFrame, column: str, labels, name: str) -> DataFrame:
    spark = df.sparkSession
    order = spark.range(1).select(F.posexplode(F.array(*map(F.lit, labels))).alias("tier_order", column))
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(name))
    return order.join(counts, column, "left").select(column, "tier_order", name)


def churn_tier_counts(scored: DataFrame) -> DataFrame:
    """Customers per risk tier from critical to low, 0 for an empty tier."""
    counts = _counts_in_order(scored, "Churn_Risk_Tier", RISK_ORDER, "Customers")
    return counts.select(
        "Churn_Risk_Tier", "tier_order", F.coalesce("Customers", F.lit(0)).alias("Customers")
    ).orderBy("tier_order")


def top_at_risk(customers: DataFrame, limit: int = 20) -> DataFrame:
    """The customers most likely to leave among the two highest tiers."""
    return (
        customers.filter(F.col("Churn_Risk_Tier").isin("Critical", "High"))
        .orderBy(F.desc("Churn_Probability"), CUSTOMER)
        .select(CUSTOMER, "Segment", "Monetary", "Predicted_LTV", "Churn_Probability", "Churn_Risk_Tier")
        .limit(limit)
    )

