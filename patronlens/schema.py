"""Column names and table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

CUSTOMER = "CustomerID"
INVOICE = "InvoiceNo"
STOCK = "StockCode"
DATE = "InvoiceDate"
REVENUE = "Revenue"
RFM = ("Recency", "Frequency", "Monetary")

MONEY = T.DecimalType(12, 2)

TRANSACTIONS = T.StructType(
    [
        T.StructField(INVOICE, T.StringType()),
        T.StructField(STOCK, T.StringType()),
        T.StructField("Description", T.StringType()),
        T.StructField("Quantity", T.IntegerType()),
        T.StructField(DATE, T.TimestampNTZType()),
        T.StructField("UnitPrice", MONEY),
        T.StructField(CUSTOMER, T.StringType()),
        T.StructField("Country", T.StringType()),
    ]
)

#: Types of columns read from text: wide enough for fractions of a cent and for very large orders.
LOADED = T.StructType(
    [
        T.StructField(f.name, {"Quantity": T.LongType(), "UnitPrice": T.DecimalType(28, 10)}.get(f.name, f.dataType))
        for f in TRANSACTIONS.fields
    ]
)

RUN_LOG = T.StructType(
    [
        T.StructField("experiment", T.StringType(), False),
        T.StructField("run", T.StringType(), False),
        T.StructField("kind", T.StringType(), False),
        T.StructField("key", T.StringType(), False),
        T.StructField("value", T.StringType()),
    ]
)
