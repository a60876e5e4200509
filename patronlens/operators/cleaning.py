"""Row rules that turn raw transaction lines into sales."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronlens.schema import CUSTOMER, INVOICE, REVENUE, STOCK

# Stock codes that are not products.
NON_PRODUCT_CODES = ("POST", "D", "M", "BANK CHARGES", "PADS", "DOT")
CANCELLATION_PREFIX = "C"
NUMERIC_ID = r"^\s*([+-]?)(\d+)(?:\.\d*)?\s*$"


def _is_cancelled() -> Column:
    return F.coalesce(F.col(INVOICE).cast("string").startswith(CANCELLATION_PREFIX), F.lit(False))


def _has_no_customer(df: DataFrame) -> Column:
    missing = F.col(CUSTOMER).isNull()
    if isinstance(df.schema[CUSTOMER].dataType, (T.DoubleType, T.FloatType)):
        missing = missing | F.isnan(CUSTOMER)
    return missing


def _is_positive(df: DataFrame, name: str) -> Column:
    """Above zero; null and NaN are not (Spark alone would rank NaN above zero)."""
    ok = F.col(name) > 0
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        ok = ok & ~F.isnan(name)
    return F.coalesce(ok, F.lit(False))


def _is_non_product(codes: Sequence[str]) -> Column:
    return F.coalesce(F.col(STOCK).isin(*codes), F.lit(False))


def drop_cancellations(df: DataFrame) -> DataFrame:
    """Keep invoices that do not start with a capital C; a null invoice stays."""
    return df.filter(~_is_cancelled())


def drop_null_customers(df: DataFrame) -> DataFrame:
    return df.filter(~_has_no_customer(df))


def normalize_customer_id(df: DataFrame) -> DataFrame:
    """Ids written as plain decimal numbers become integer text, all others stay as they are.

    The fraction is cut as text, so nothing is rounded; an exponent is not a plain number.
    """
    text = F.col(CUSTOMER).cast("string")
    sign = F.when(F.regexp_extract(text, NUMERIC_ID, 1) == "-", "-").otherwise("")
    digits = F.regexp_replace(F.regexp_extract(text, NUMERIC_ID, 2), r"^0+(?=\d)", "")
    whole = F.when(digits == "0", "0").otherwise(F.concat(sign, digits))
    return df.withColumn(CUSTOMER, F.when(text.rlike(NUMERIC_ID), whole).otherwise(text))


def positive_lines(df: DataFrame) -> DataFrame:
    return df.filter(_is_positive(df, "Quantity") & _is_positive(df, "UnitPrice"))


def drop_non_product(df: DataFrame, codes: Sequence[str] = NON_PRODUCT_CODES) -> DataFrame:
    """Drop exact code matches; a null code stays."""
    return df.filter(~_is_non_product(codes))


def line_revenue(df: DataFrame) -> DataFrame:
    return df.withColumn(REVENUE, F.col("Quantity") * F.col("UnitPrice"))


def clean_transactions(df: DataFrame) -> DataFrame:
    """All row rules in order: one narrow chain without a shuffle."""
    return (
        df.transform(drop_cancellations)
        .transform(drop_null_customers)
        .transform(normalize_customer_id)
        .transform(positive_lines)
        .transform(drop_non_product)
        .transform(line_revenue)
    )


def cleaning_audit(df: DataFrame) -> DataFrame:
    """Rows in, rows removed by the first rule that fails, rows kept: one pass."""
    rule = (
        F.when(_is_cancelled(), "cancelled")
        .when(_has_no_customer(df), "no_customer")
        .when(~(_is_positive(df, "Quantity") & _is_positive(df, "UnitPrice")), "not_positive")
        .when(_is_non_product(NON_PRODUCT_CODES), "non_product")
        .otherwise("kept")
    )
    return (
        df.select(rule.alias("rule"))
        .agg(
            F.count(F.lit(1)).alias("rows_in"),
            F.count_if(F.col("rule") == "cancelled").alias("removed_cancelled"),
            F.count_if(F.col("rule") == "no_customer").alias("removed_no_customer"),
            F.count_if(F.col("rule") == "not_positive").alias("removed_not_positive"),
            F.count_if(F.col("rule") == "non_product").alias("removed_non_product"),
            F.count_if(F.col("rule") == "kept").alias("rows_kept"),
        )
        .withColumn("rows_removed", F.col("rows_in") - F.col("rows_kept"))
    )
