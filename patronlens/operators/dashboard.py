"""The customer table behind the dashboard and its aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens.operators.ranking import is_number
from patronlens.schema import CUSTOMER, DATE


def home_country(df: DataFrame) -> DataFrame:
    """Most frequent country per customer (ties: smallest) and date of first purchase."""
    counts = (
        df.filter(F.col(CUSTOMER).isNotNull())
        .groupBy(CUSTOMER, "Country")
        .agg(F.count(F.lit(1)).alias("_lines"), F.min(DATE).alias("_first"))
    )
    best = F.min(F.when(F.col("Country").isNotNull(), F.struct((-F.col("_lines")).alias("less"), "Country")))
    return (
        counts.groupBy(CUSTOMER)
        .agg(best.alias("_best"), F.min("_first").alias("JoinDate"))
        .select(CUSTOMER, F.col("_best.Country").alias("Country"), "JoinDate")
    )


def customer_360(
    segmented: DataFrame, transactions: DataFrame, ltv_scores: DataFrame, churn_scores: DataFrame
) -> DataFrame:
    """One row per segmented customer with value tier, churn tier, country and join date."""
    return (
        segmented.select(CUSTOMER, "Recency", "Frequency", "Monetary", "Segment")
        .join(ltv_scores.select(CUSTOMER, "LTV_Tier", "Predicted_LTV"), CUSTOMER, "left")
        .join(churn_scores.select(CUSTOMER, "Churn_Probability", "Churn_Risk_Tier"), CUSTOMER, "left")
        .join(home_country(transactions), CUSTOMER, "left")
    )


def segment_country_filter(
    customers: DataFrame, segments: Sequence[str] | None = None, countries: Sequence[str] | None = None
) -> DataFrame:
    """Customers in any of the segments and any of the countries (None: all)."""
    if segments is not None:
        customers = customers.filter(F.col("Segment").isin(*segments))
    if countries is not None:
        customers = customers.filter(F.col("Country").isin(*countries))
    return customers


def overview_kpis(customers: DataFrame) -> DataFrame:
    return customers.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.coalesce(F.sum("Monetary"), F.lit(0.0)).alias("total_revenue"),
        F.avg("Predicted_LTV").alias("avg_ltv"),
        F.avg("Churn_Probability").alias("avg_churn"),
        F.count_if(F.col("Segment") == "Champions").alias("champions"),
    )


def histogram(customers: DataFrame, value: str, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Counts in equal-width bins over the whole range, the last bin closed on both sides.

    Bins are 0-based; empty bins are left out. A single distinct value falls
    into bin 0.
    """
    known = customers.filter(is_number(customers, value))
    span = known.agg(
        F.struct(F.min(value).cast("double").alias("low"), F.max(value).cast("double").alias("high")).alias("span")
    ).scalar()
    low, high = span["low"], span["high"]
    number = F.col(value).cast("double")
    at = F.floor((number - low) * bins / F.when(high > low, high - low).otherwise(F.lit(1.0)))
    return (
        known.select(*by, F.least(at, F.lit(bins - 1)).cast("int").alias("bin"))
        .groupBy(*by, "bin")
        .agg(F.count(F.lit(1)).alias("customers"))
        .select(
            *by,
            "bin",
            (low + F.col("bin") * ((high - low) / bins)).alias("bin_start"),
            "customers",
        )
        .orderBy(*by, "bin")
    )
