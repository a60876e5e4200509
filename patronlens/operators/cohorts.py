"""Monthly acquisition cohorts.

Lines are first reduced to one row per customer and month. Everything after
that works on at most one row per customer and calendar month, then on one row
per cohort and period.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patronlens.functions.timing import month_of, months_between_starts
from patronlens.schema import CUSTOMER, DATE, INVOICE, REVENUE

PERIODS = 12


def _customer_months(df: DataFrame) -> DataFrame:
    months = (
        df.filter(F.col(CUSTOMER).isNotNull() & F.col(DATE).isNotNull())
        .groupBy(CUSTOMER, month_of(F.col(DATE)).alias("_month"))
        .agg(F.sum(REVENUE).alias("Revenue"), F.count_distinct(INVOICE).alias("Orders"))
    )
    cohort = F.min("_month").over(Window.partitionBy(CUSTOMER))
    return months.withColumn("CohortMonth", cohort).withColumn(
        "Period", months_between_starts(F.col("CohortMonth"), F.col("_month"))
    )


def cohort_assign(df: DataFrame, periods: int = PERIODS) -> DataFrame:
    """Per customer and active month: cohort (month of first purchase), period, revenue, orders."""
    return (
        _customer_months(df)
        .filter(F.col("Period") < periods)
        .select(CUSTOMER, "CohortMonth", "Period", F.col("Revenue").cast("double").alias("Revenue"), "Orders")
    )


def _cohort_periods(df: DataFrame, periods: int) -> DataFrame:
    """One row per cohort and observable period, zero where nobody bought.

    A period is observable when its month is not after the last month in the
    data; a last month that is only partly covered counts in full.
    """
    activity = (
        _customer_months(df)
        .groupBy("CohortMonth", "Period", "_month")
        .agg(
            F.count(F.lit(1)).alias("_active"),
            F.sum("Revenue").alias("_revenue"),
            F.sum("Orders").alias("_orders"),
        )
    )
    # From here on: one row per cohort and month.
    cohort = Window.partitionBy("CohortMonth")
    sized = activity.select(
        "*",
        F.max("_month").over(Window.partitionBy()).alias("_end"),
        F.max(F.when(F.col("Period") == 0, F.col("_active"))).over(cohort).alias("CohortSize"),
    )
    last_period = F.least(F.lit(periods - 1), months_between_starts(F.col("CohortMonth"), F.col("_end")))
    packed = sized.groupBy("CohortMonth", "CohortSize", last_period.alias("_last_period")).agg(
        F.map_from_entries(
            F.collect_list(F.struct("Period", F.struct("_active", "_revenue", "_orders")))
        ).alias("_by_period")
    )
    grid = packed.select(
        "CohortMonth",
        "CohortSize",
        F.explode(F.sequence(F.lit(0), F.col("_last_period"))).alias("Period"),
        "_by_period",
    ).withColumn("_cell", F.try_element_at("_by_period", F.col("Period")))
    return grid.select(
        "CohortMonth",
        "Period",
        "CohortSize",
        F.coalesce("_cell._active", F.lit(0)).alias("Active"),
        F.coalesce("_cell._revenue", F.lit(0)).alias("Revenue"),
        F.coalesce("_cell._orders", F.lit(0)).alias("Orders"),
    )


def cohort_retention(df: DataFrame, periods: int = PERIODS) -> DataFrame:
    """Active customers over cohort size, per cohort and observable period."""
    return (
        _cohort_periods(df, periods)
        .select(
            "CohortMonth",
            "Period",
            "CohortSize",
            "Active",
            (F.col("Active") / F.col("CohortSize")).alias("Retention"),
        )
        .orderBy("CohortMonth", "Period")
    )


def retention_matrix(df: DataFrame, periods: int = PERIODS) -> DataFrame:
    """Retention with one column per period; periods not yet observable are null."""
    wide = (
        cohort_retention(df, periods)
        .groupBy("CohortMonth")
        .pivot("Period", list(range(periods)))
        .agg(F.first("Retention"))
    )
    return wide.select(
        F.date_format("CohortMonth", "MMM yyyy").alias("Cohort"),
        "CohortMonth",
        *[F.col(str(p)).alias(f"Month_{p}") for p in range(periods)],
    ).orderBy("CohortMonth")


def cohort_revenue(df: DataFrame, periods: int = PERIODS) -> DataFrame:
    """Revenue per cohort and period, cumulative, and per original customer."""
    so_far = (
        Window.partitionBy("CohortMonth")
        .orderBy("Period")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # Money keeps its own type until the end, so decimal sums are exact.
    cumulative = F.sum("Revenue").over(so_far).cast("double")
    return (
        _cohort_periods(df, periods)
        .select(
            "CohortMonth",
            "Period",
            "CohortSize",
            F.col("Revenue").cast("double").alias("Revenue"),
            cumulative.alias("CumulativeRevenue"),
            (cumulative / F.col("CohortSize")).alias("CumulativePerCustomer"),
        )
        .orderBy("CohortMonth", "Period")
    )


def engagement_curve(df: DataFrame, periods: int = PERIODS) -> DataFrame:
    """Per period, over the cohorts observable then: retention by size, orders per active customer."""
    return (
        _cohort_periods(df, periods)
        .groupBy("Period")
        .agg(
            F.count(F.lit(1)).alias("Cohorts"),
            F.sum("CohortSize").alias("Customers"),
            F.sum("Active").alias("Active"),
            (F.sum("Active") / F.sum("CohortSize")).alias("Retention"),
            F.try_divide(F.sum("Orders").cast("double"), F.sum("Active").cast("double")).alias("OrdersPerActive"),
        )
        .orderBy("Period")
    )
