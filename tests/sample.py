"""Small hand-written transactions. Customer, invoice, stock, quantity, date, price, country."""

from datetime import datetime
from decimal import Decimal

from patronlens.schema import TRANSACTIONS

SAMPLE = """
C0001,INV10001,SKU101,3,2023-01-05,4.50,India
C0002,INV10002,SKU202,2,2023-01-07,18.99,India
C0001,INV10003,SKU303,1,2023-01-15,22.00,India
C0003,INV10004,SKU101,5,2023-01-20,4.50,UK
C0004,INV10005,SKU404,3,2023-01-22,8.75,India
C0002,INV10006,SKU505,2,2023-02-01,12.00,India
C0005,INV10007,SKU202,1,2023-02-10,18.99,UAE
C0001,INV10008,SKU606,4,2023-02-14,6.50,India
C0006,INV10009,SKU707,2,2023-02-18,15.00,India
C0003,INV10010,SKU808,3,2023-02-25,9.50,UK
C0007,INV10011,SKU101,6,2023-03-02,4.50,India
C0004,INV10012,SKU404,2,2023-03-10,8.75,India
C0005,INV10013,SKU909,5,2023-03-15,5.25,UAE
C0008,INV10014,SKU303,2,2023-03-20,22.00,India
C0002,INV10015,SKU606,3,2023-03-28,6.50,India
C0009,INV10016,SKU202,1,2023-04-01,18.99,India
C0006,INV10017,SKU707,1,2023-04-05,15.00,India
C0001,INV10018,SKU404,4,2023-04-12,8.75,India
C0010,INV10019,SKU505,3,2023-04-18,12.00,USA
C0003,INV10020,SKU101,2,2023-04-22,4.50,UK
"""


def line(customer, invoice, stock="SKU1", quantity=1, date="2023-01-01", price="1.00", country="UK"):
    when = datetime.fromisoformat(date) if isinstance(date, str) else date
    money = None if price is None else Decimal(price)
    return (invoice, stock, "x", quantity, when, money, customer, country)


def sample_rows():
    rows = []
    for text in SAMPLE.strip().splitlines():
        customer, invoice, stock, quantity, date, price, country = text.split(",")
        rows.append(line(customer, invoice, stock, int(quantity), date, price, country))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, TRANSACTIONS)
