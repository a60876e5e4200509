"""Tables that no step reads any more leave the disk."""

import os

from pyspark.sql import functions as F

from patronlens.operators import cleaning, features
from patronlens.session import discard, materialize, shared_folder
from tests.sample import frame, sample_rows


def tables(spark):
    folder = shared_folder(spark).removeprefix("file:")
    return {d for d in os.listdir(folder) if d.startswith("table-")}


def test_discard_takes_its_own_table_only(spark, tmp_path):
    before = tables(spark)
    kept, gone = materialize(spark.range(3)), materialize(spark.range(4))
    other = str(tmp_path / "table-other")
    spark.range(5).write.parquet(other)
    discard(gone)
    discard(spark.read.parquet(other))
    assert len(tables(spark) - before) == 1 and kept.count() == 3 and spark.read.parquet(other).count() == 5


def test_lines_of_the_features_leave_the_disk(spark):
    lines = cleaning.clean_transactions(frame(spark, sample_rows()))
    before = tables(spark)
    made = features.behavioral_features(lines, 90)
    left = tables(spark) - before
    folder = shared_folder(spark)
    assert left and not any("_revenue" in spark.read.parquet(f"{folder}/{t}").columns for t in left)
    assert made.agg(F.sum("total_orders")).first()[0] == lines.select("CustomerID", "InvoiceNo").distinct().count()
