"""Inputs shared by the registered queries.

Models cannot be repeated in SQL, so queries that only need scores take them
from two fixed rules on the customer table; the model queries score for real.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlens.operators import churn, cleaning, dashboard, features, ltv, rfm
from patronlens.schema import CUSTOMER
from patronlens.sources.star import star_transactions


def clean(spark: SparkSession, folder: str, **options) -> DataFrame:
    return cleaning.clean_transactions(star_transactions(spark, folder, **options))


def customer_rfm(spark: SparkSession, folder: str) -> DataFrame:
    return rfm.compute_rfm(clean(spark, folder))


def segmented(spark: SparkSession, folder: str) -> DataFrame:
    return rfm.assign_segments(rfm.score_rfm(customer_rfm(spark, folder)))


def with_rule_scores(customers: DataFrame) -> DataFrame:
    """Stand-ins for model output from recency, frequency and monetary value."""
    recency, frequency = F.col("Recency").cast("double"), F.col("Frequency").cast("double")
    risk = F.lit(0.7) * recency / (recency + 150.0) + F.lit(0.3) / (frequency + 1.0)
    value = F.col("Monetary") * 365.0 / (recency + 365.0)
    return customers.select(
        "*",
        (F.floor(risk * 1000.0) / 1000.0).alias("Churn_Probability"),
        (F.floor(value * 100.0) / 100.0).alias("Predicted_LTV"),
    )


def rule_scores(spark: SparkSession, folder: str) -> DataFrame:
    return with_rule_scores(customer_rfm(spark, folder))


def customer_360(spark: SparkSession, folder: str) -> DataFrame:
    lines = clean(spark, folder)
    seg = rfm.assign_segments(rfm.score_rfm(rfm.compute_rfm(lines)))
    scores = with_rule_scores(seg)
    tiers = ltv.quantile_tiers(scores)
    return dashboard.customer_360(seg, lines, tiers, churn.with_churn_scores(scores))


def labelled_scores(spark: SparkSession, folder: str) -> DataFrame:
    """True churn label next to the rule's probability and class."""
    lines = clean(spark, folder)
    scores = with_rule_scores(rfm.compute_rfm(lines))
    joined = churn.features_with_labels(scores, churn.churn_labels(lines))
    probability = F.col("Churn_Probability")
    return joined.select(
        CUSTOMER,
        F.col("Churned").alias("label"),
        probability.alias("probability"),
        (probability >= 0.5).cast("int").alias("prediction"),
    )


def value_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """True log revenue next to the log of the rule's value."""
    scores = rule_scores(spark, folder)
    return scores.select(
        CUSTOMER, F.log1p("Monetary").alias("y"), F.log1p("Predicted_LTV").alias("prediction")
    )


def all_features(spark: SparkSession, folder: str) -> DataFrame:
    return features.customer_features(clean(spark, folder))
