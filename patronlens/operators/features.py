"""Behavioural features per customer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patronlens.functions.rounding import at_least, zero_if_missing
from patronlens.functions.timing import plus_days, whole_days
from patronlens.operators.rfm import latest
from patronlens.schema import CUSTOMER, DATE, INVOICE, REVENUE, STOCK
from patronlens.session import discard, materialize

BEHAVIORAL_FEATURES = (
    "total_revenue",
    "total_orders",
    "total_items",
    "avg_order_value",
    "std_order_value",
    "unique_products",
    "unique_categories",
    "avg_unit_price",
    "max_unit_price",
    "total_countries",
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


def _grain(df: DataFrame) -> DataFrame:
    """One row per customer, invoice, product and country: all that the features read of the lines."""
    return df.groupBy(CUSTOMER, INVOICE, STOCK, "Country").agg(
        F.sum(REVENUE).alias("_revenue"),
        F.sum("Quantity").alias("_items"),
        F.sum("UnitPrice").alias("_price_sum"),
        F.count("UnitPrice").alias("_price_count"),
        F.max("UnitPrice").alias("_price_max"),
        F.min(DATE).alias("_first"),
        F.max(DATE).alias("_last"),
    )


def _orders(grain: DataFrame) -> DataFrame:
    """One row per customer and invoice; lines without an invoice share a null one."""
    sums = [F.sum(c).alias(c) for c in ("_revenue", "_items", "_price_sum", "_price_count")]
    return grain.groupBy(CUSTOMER, INVOICE).agg(
        *sums, F.max("_price_max").alias("_price_max"), F.min("_first").alias("_first"), F.max("_last").alias("_last")
    )


def _distinct_counts(grain: DataFrame) -> DataFrame:
    """Distinct products, product categories and countries per customer, rolled up step by step."""
    products = grain.select(CUSTOMER, STOCK, F.substring(STOCK, 1, 2).alias("_category")).distinct()
    categories = products.groupBy(CUSTOMER, "_category").agg(F.count(STOCK).alias("_products"))
    counted = categories.groupBy(CUSTOMER).agg(
        F.sum("_products").alias("unique_products"), F.count("_category").alias("unique_categories")
    )
    countries = grain.select(CUSTOMER, "Country").distinct().groupBy(CUSTOMER)
    return counted.join(countries.agg(F.count("Country").alias("total_countries")), CUSTOMER)


def _order_value_aggregates() -> list:
    """Mean from the sum in its own type, so that decimal money does not depend on the order of rows."""
    has_invoice = F.col(INVOICE).isNotNull()
    total = F.coalesce(F.sum(F.when(has_invoice, F.col("_revenue"))).cast("double"), F.lit(0.0))
    order_value = F.when(has_invoice, F.coalesce(F.col("_revenue").cast("double"), F.lit(0.0)))
    return [
        F.try_divide(total, F.count(INVOICE).cast("double")).alias("avg_order_value"),
        F.coalesce(F.stddev_samp(order_value), F.lit(0.0)).alias("std_order_value"),
    ]


def order_values(df: DataFrame) -> DataFrame:
    """Mean and sample deviation of the revenue per invoice (deviation 0 for one invoice)."""
    known = df.filter(F.col(CUSTOMER).isNotNull())
    orders = known.groupBy(CUSTOMER, INVOICE).agg(F.sum(REVENUE).alias("_revenue"))
    return orders.groupBy(CUSTOMER).agg(*_order_value_aggregates())


def behavioral_features(df: DataFrame, churn_days: int | None = None) -> DataFrame:
    """The 21 features per customer, and ``Churned`` if ``churn_days`` is given.

    The lines are read once, into a written grain from which every count and sum is
    rolled up. The result per customer is written too, because the snapshot, one day
    after the last transaction of all, and the cutoff are read off it.
    """
    grain = materialize(_grain(df))
    through_orders = (
        _orders(grain)
        .groupBy(CUSTOMER)
        .agg(
            F.coalesce(F.sum("_revenue").cast("double"), F.lit(0.0)).alias("total_revenue"),
            F.count(INVOICE).alias("total_orders"),
            F.coalesce(F.sum("_items"), F.lit(0)).alias("total_items"),
            *_order_value_aggregates(),
            F.try_divide(F.sum("_price_sum").cast("double"), F.sum("_price_count").cast("double")).alias(
                "avg_unit_price"
            ),
            F.max("_price_max").cast("double").alias("max_unit_price"),
            F.min("_first").alias("_first"),
            F.max("_last").alias("_last"),
        )
    )
    # A null customer only matters to the last date.
    joined = materialize(through_orders.join(_distinct_counts(grain), CUSTOMER, "left"))
    discard(grain)  # about as many rows as lines
    snapshot = plus_days(latest(joined), 1)
    spans = joined.filter(F.col(CUSTOMER).isNotNull()).select(
        "*",
        whole_days(F.col("_first"), snapshot).alias("customer_age_days"),
        whole_days(F.col("_last"), snapshot).alias("recency_days"),
        whole_days(F.col("_first"), F.col("_last")).alias("purchase_span_days"),
    )
    orders, items = F.col("total_orders"), at_least(F.col("total_items"), 1)
    months = at_least(F.col("customer_age_days") / F.lit(30), 0.1)
    derived = spans.select(
        "*",
        (F.col("purchase_span_days") / at_least(orders - 1, 1)).alias("avg_days_between_orders"),
        (orders / months).alias("purchase_frequency_per_month"),
        (F.col("total_revenue") / items).alias("revenue_per_item"),
        (F.col("unique_products") / items).alias("product_diversity_ratio"),
        (F.col("total_countries") > 1).cast("int").alias("is_multi_country"),
        F.log1p("total_revenue").alias("log_total_revenue"),
        F.log1p("avg_order_value").alias("log_avg_order_value"),
        F.log1p("total_items").alias("log_total_items"),
    )
    label = []
    if churn_days is not None:
        label = [(F.col("_last") < plus_days(latest(joined), -churn_days)).cast("int").alias("Churned")]
    return derived.select(CUSTOMER, *BEHAVIORAL_FEATURES, *label)


def customer_features(df: DataFrame, churn_days: int | None = None) -> DataFrame:
    """Recency, frequency and monetary value next to the behavioural features.

    Everything but the recency clock is already in the features: the snapshot
    is the same, so the three are column renames and no second aggregation.
    """
    features = behavioral_features(df, churn_days)
    label = [] if churn_days is None else ["Churned"]
    return features.select(
        CUSTOMER,
        F.col("recency_days").alias("Recency"),
        F.col("total_orders").alias("Frequency"),
        F.col("total_revenue").alias("Monetary"),
        *BEHAVIORAL_FEATURES,
        *label,
    )


def feature_matrix(df: DataFrame, wanted: Sequence[str], keep: Sequence[str] = (CUSTOMER,)) -> DataFrame:
    """The wanted features that exist, as doubles with gaps set to 0."""
    present = [c for c in wanted if c in df.columns]
    return df.select(*keep, *[zero_if_missing(F.col(c)).alias(c) for c in present])


def interpurchase_variance(df: DataFrame) -> DataFrame:
    """Mean, sample variance and coefficient of variation of the days between purchase days.

    Lines are first reduced to distinct days, so a customer's window holds at
    most one row per calendar day.
    """
    days = (
        df.filter(F.col(CUSTOMER).isNotNull()).select(CUSTOMER, F.col(DATE).cast("date").alias("_day")).distinct()
    )
    by_customer = Window.partitionBy(CUSTOMER).orderBy("_day")
    gap = F.date_diff(F.col("_day"), F.lag("_day").over(by_customer)).cast("double")
    stats = days.select(CUSTOMER, gap.alias("_gap")).groupBy(CUSTOMER).agg(
        (F.count(F.lit(1))).alias("purchase_days"),
        F.avg("_gap").alias("mean_gap_days"),
        F.var_samp("_gap").alias("var_gap_days"),
    )
    return stats.withColumn("cv_gap_days", F.try_divide(F.sqrt("var_gap_days"), F.col("mean_gap_days")))


def basket_stats(df: DataFrame) -> DataFrame:
    """Items and lines per invoice: mean, deviation, minimum, median, maximum per customer.

    The exact median keeps one count per distinct basket size of a customer.
    """
    baskets = (
        df.filter(F.col(CUSTOMER).isNotNull() & F.col(INVOICE).isNotNull())
        .groupBy(CUSTOMER, INVOICE)
        .agg(F.sum("Quantity").alias("items"), F.count(F.lit(1)).alias("lines"))
    )
    measures = []
    for name in ("items", "lines"):
        measures += [
            F.avg(name).alias(f"avg_{name}"),
            F.coalesce(F.stddev_samp(name), F.lit(0.0)).alias(f"std_{name}"),
            F.min(name).alias(f"min_{name}"),
            F.median(name).alias(f"median_{name}"),
            F.max(name).alias(f"max_{name}"),
        ]
    return baskets.groupBy(CUSTOMER).agg(F.count(F.lit(1)).alias("baskets"), *measures)


def category_affinity(df: DataFrame) -> DataFrame:
    """Top category by revenue (ties: smallest), its share, and the entropy of the shares.

    Entropy in nats from sums alone: ln T - sum(r ln r) / T, so the totals need
    no join back.
    """
    per_category = (
        df.filter(F.col(CUSTOMER).isNotNull() & F.col(STOCK).isNotNull())
        .groupBy(CUSTOMER, F.substring(STOCK, 1, 2).alias("_category"))
        .agg(F.sum(REVENUE).alias("_revenue"))
    )
    revenue = F.col("_revenue").cast("double")
    best = F.min(F.struct((-F.col("_revenue")).alias("less"), F.col("_category").alias("category")))
    sums = per_category.groupBy(CUSTOMER).agg(
        F.count(F.lit(1)).alias("categories"),
        best.alias("_best"),
        F.sum("_revenue").cast("double").alias("_total"),
        F.sum(revenue * F.ln(revenue)).alias("_rlogr"),
    )
    total = F.col("_total")
    return sums.select(
        CUSTOMER,
        "categories",
        F.col("_best.category").alias("top_category"),
        (-F.col("_best.less").cast("double") / total).alias("top_share"),
        F.greatest(F.ln(total) - F.col("_rlogr") / total, F.lit(0.0)).alias("category_entropy"),
    )


def group_mix(df: DataFrame, column: str) -> DataFrame:
    """Share of each customer's revenue and orders per value of ``column``.

    An order counts once for each value on its lines. The window holds one row
    per value of the column, after the aggregation.
    """
    parts = (
        df.filter(F.col(CUSTOMER).isNotNull() & F.col(column).isNotNull())
        .groupBy(CUSTOMER, column)
        .agg(F.sum(REVENUE).cast("double").alias("_revenue"), F.count_distinct(INVOICE).alias("_orders"))
    )
    whole = Window.partitionBy(CUSTOMER)
    return parts.select(
        CUSTOMER,
        column,
        (F.col("_revenue") / F.sum("_revenue").over(whole)).alias("revenue_share"),
        (F.col("_orders") / F.sum("_orders").over(whole)).alias("order_share"),
    )


def channel_mix(df: DataFrame, channel: str) -> DataFrame:
    """Mix over a sales-channel column the caller names."""
    return group_mix(df, channel)


def promo_sensitivity(df: DataFrame, promotion: str) -> DataFrame:
    """Mix over a promotion column the caller names."""
    return group_mix(df, promotion)
