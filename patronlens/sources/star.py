"""Transaction views over star-schema parquet tables (orders, lines, parts, suppliers)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlens.schema import MONEY


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def star_transactions(spark: SparkSession, folder: str, *, marketing: bool = False) -> DataFrame:
    """Order lines as raw retail transactions, with cancellations, gaps and non-products.

    ``marketing`` keeps the order priority as sales channel and a discount flag.
    """
    joined = (
        table(spark, folder, "lineitem")
        .join(table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, folder, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    )
    returned = F.col("l_returnflag") == "R"
    quantity = F.col("l_quantity").cast("int")
    columns = [
        F.when(F.col("o_orderkey") % 97 != 0, F.col("o_custkey").cast("string")).alias("CustomerID"),
        F.concat(F.when(returned, "C").otherwise(""), F.col("o_orderkey").cast("string")).alias("InvoiceNo"),
        F.when(F.col("p_partkey") % 50 == 7, "POST")
        .otherwise(F.concat(F.substring("p_type", 1, 2), F.col("p_partkey").cast("string")))
        .alias("StockCode"),
        F.col("p_name").alias("Description"),
        F.when((F.col("l_linenumber") == 7) & (F.col("l_quantity") > 48), -quantity)
        .otherwise(quantity)
        .alias("Quantity"),
        F.col("o_orderdate").alias("InvoiceDate"),
        F.col("p_retailprice").cast(MONEY).alias("UnitPrice"),
        F.col("n_name").alias("Country"),
    ]
    if marketing:
        columns += [
            F.col("o_orderpriority").alias("Channel"),
            F.when(F.col("l_discount") > 0, "Discounted").otherwise("Full price").alias("Offer"),
        ]
    return joined.select(*columns)


def event_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Purchase events as transactions with a time of day."""
    return (
        table(spark, folder, "events")
        .filter(F.col("event_type") == "purchase")
        .select(
            F.col("user_id").cast("string").alias("CustomerID"),
            F.col("event_id").cast("string").alias("InvoiceNo"),
            F.col("event_type").alias("StockCode"),
            F.lit(None).cast("string").alias("Description"),
            F.lit(1).alias("Quantity"),
            F.col("ts").alias("InvoiceDate"),
            F.col("value").cast(MONEY).alias("UnitPrice"),
            F.lit(None).cast("string").alias("Country"),
        )
    )
