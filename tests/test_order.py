"""Ranks, running totals, quantiles and splits against brute force, with heavy ties."""

import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from patronlens.operators import ranking, rfm, segments, splits


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one value; groups of very different size."""
    rng = np.random.default_rng(3)
    n = 3000
    value = np.where(rng.random(n) < 0.34, 7.0, np.round(rng.normal(0, 5, n), 1))
    group = rng.choice(["a", "b", "c"], n, p=[0.7, 0.29, 0.01])
    pdf = pd.DataFrame({"CustomerID": [f"C{i:05d}" for i in range(n)], "value": value, "grp": group})
    return pdf.sample(frac=1, random_state=1), spark.createDataFrame(pdf).repartition(8).cache()


@pytest.fixture
def many_partitions(spark):
    """Small advisory size, so that sorted data keep several partitions."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, before)


def test_global_rank(skewed, many_partitions):
    pdf, df = skewed
    expected = pdf.sort_values(["value", "CustomerID"]).reset_index(drop=True)
    got = ranking.global_rank(df, ["value", "CustomerID"], "r", "n").toPandas().sort_values("r")
    assert got.CustomerID.tolist() == expected.CustomerID.tolist()
    assert got.r.tolist() == list(range(1, len(pdf) + 1))
    assert set(got.n) == {len(pdf)}


def test_tied_values_spread_over_partitions(skewed, many_partitions):
    _, df = skewed
    tied = df.orderBy("value", "CustomerID").withColumn("p", F.spark_partition_id()).filter("value = 7.0")
    assert tied.select("p").distinct().count() > 1


@pytest.mark.parametrize("by", [[], ["grp"]])
def test_running_totals(skewed, many_partitions, by):
    pdf, df = skewed
    counts = df.groupBy(*by, "value").agg(F.count(F.lit(1)).alias("n"))
    got = ranking.running_totals(counts, ["value"], {"cum": "n"}, by, {"all": "n"}).toPandas()
    expected = pdf.groupby([*by, "value"]).size().rename("n").reset_index().sort_values([*by, "value"])
    expected["cum"] = expected.groupby(by)["n"].cumsum() if by else expected["n"].cumsum()
    expected["all"] = expected.groupby(by)["n"].transform("sum") if by else expected["n"].sum()
    got = got.sort_values([*by, "value"])[expected.columns].reset_index(drop=True)
    pd.testing.assert_frame_equal(got, expected.reset_index(drop=True), check_dtype=False)


@pytest.mark.parametrize("by", [[], ["grp"]])
def test_exact_quantiles(skewed, many_partitions, by):
    pdf, df = skewed
    wanted = {"q10": 0.1, "q50": 0.5, "q75": 0.75, "q100": 1.0}
    got = ranking.exact_quantiles(df, "value", wanted, "CustomerID", by).toPandas()
    for _, row in got.iterrows():
        part = pdf if not by else pdf[pdf.grp == row.grp]
        for name, p in wanted.items():
            assert row[name] == pytest.approx(part.value.quantile(p), abs=1e-12)
    assert len(got) == (3 if by else 1)


def test_several_ranks_take_one_exchange_and_one_write(skewed, many_partitions, monkeypatch):
    pdf, df = skewed
    rows = df.withColumns({"whole": F.hash("CustomerID") % 7, "kept": F.array("value")}).withColumn(
        "value", F.when(F.col("value") != 7.0, F.col("value"))
    )
    written = []
    store = ranking.materialize
    monkeypatch.setattr(ranking, "materialize", lambda d: written.append(d) or store(d))
    got = ranking.global_ranks(rows, {"v": "value", "w": "whole", "v2": "value"}, "CustomerID", "n")
    assert got.columns == [*rows.columns, "v", "w", "v2", "n"] and len(written) == 1
    assert written[0]._jdf.queryExecution().toString().count("Sort [_order") >= 1
    for column, rank in (("value", "v"), ("whole", "w"), ("value", "v2")):
        want = ranking.global_rank(rows, [column, "CustomerID"], "r").select("CustomerID", "r")
        assert got.join(want, "CustomerID").filter(F.col("r") != F.col(rank)).isEmpty()
    assert got.join(rows, rows.columns).count() == got.filter("value IS NOT NULL").count() and got.filter("n <> 3000").isEmpty()
    assert ranking.global_ranks(rows.limit(0), {"v": "value"}, "CustomerID").collect() == []


@pytest.mark.parametrize("bins", [2, 5, 1024])
def test_selection_of_difficult_values(spark, monkeypatch, bins):
    """Infinite, tiny, huge and equal values; every order statistic of each group."""
    monkeypatch.setattr(ranking, "SELECTION_BINS", bins)
    inf, rng = float("inf"), np.random.default_rng(5)
    groups = {
        "wide": [*(10.0 ** rng.uniform(-300, 300, 40)), *(-(10.0 ** rng.uniform(-300, 300, 40))), 1.7e308, -1.7e308],
        "ends": [-inf, -inf, inf, 1.0, 2.0, 5e-324, 0.0, 1e-323],
        "same": [3.5] * 50,
        "two": [1.0] * 30 + [1.0000000000000002] * 20,
        "one": [9.0],
    }
    rows = [(g, float(v)) for g, values in groups.items() for v in values] + [(None, 1.0)]
    kept = spark.createDataFrame(rows, "g string, _v double").withColumn("_one", F.lit(1)).filter("g IS NOT NULL").repartition(3)
    got = ranking.order_statistics(kept, ["g"], range)
    assert {g: [at[k] for k in range(n)] for (g,), (n, at) in got.items()} == {g: sorted(v) for g, v in groups.items()}


def test_selection_neither_sorts_nor_writes(spark, skewed, monkeypatch):
    _, df = skewed
    monkeypatch.setattr(ranking, "materialize", lambda d: pytest.fail("a table was written"))
    got = ranking.exact_quantiles(df, "value", {"m": 0.5}, "CustomerID", ["grp"], few_groups=True)
    assert got.count() == 3 and got.columns == ["grp", "m"]
    empty = ranking.exact_quantiles(df.limit(0), "value", {"m": 0.5}, "CustomerID")
    assert [tuple(r) for r in empty.collect()] == [(None,)]
    assert ranking.exact_quantiles(df.limit(0), "value", {"m": 0.5}, "CustomerID", ["grp"], few_groups=True).collect() == []


def test_random_split_is_exact_and_repeatable(skewed):
    pdf, df = skewed
    train, test = splits.random_split(df)
    again = splits.random_split(df.repartition(3))[1]
    assert test.count() == 600 and train.count() == 2400
    assert train.join(test, "CustomerID").count() == 0
    assert test.exceptAll(again).count() == 0
    assert test.exceptAll(splits.random_split(df, seed=1)[1]).count() > 0


def test_stratified_split_shares_by_label(skewed):
    pdf, df = skewed
    train, test = splits.stratified_split(df, "grp")
    assert test.count() == 600
    assert train.join(test, "CustomerID").count() == 0
    sizes, tested = pdf.groupby("grp").size(), test.toPandas().groupby("grp").size()
    for label, size in sizes.items():
        assert abs(tested.get(label, 0) - 0.2 * size) < 1


def test_few_groups_meet_without_a_shuffle_on_the_group(spark):
    """With automatic broadcasts off, no exchange on label or segment carries the customers."""
    rows = [(str(i), f"s{i % 3}", i % 2, float(i)) for i in range(300)]
    df = spark.createDataFrame(rows, "CustomerID string, Segment string, Churned int, Predicted_LTV double")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # The medians come from counting passes; what is joined by segment then has one row for each.
        for made, joins in ((segments.ltv_by_segment(df), False), *((side, True) for side in splits.stratified_split(df, "Churned"))):
            made.collect()
            plan = made._jdf.queryExecution().executedPlan().toString()
            assert ("BroadcastHashJoin" in plan) == joins
            assert not re.search(r"SortMergeJoin \\[(Churned|Segment)#\\d+\\], \\[\\w+#\\d+\\], Inner", plan)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_value_bins_of_fractions(spark):
    values = [0.5, 0.5, 0.5, 1.5, 2.5, 3.5, 4.5, 5.5, 6.5, 7.5]
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "CustomerID string, v double")
    got = {r.CustomerID: r.s for r in rfm.quantile_bin_value(df, "v", "s", 5, duplicates="collapse").collect()}
    edges = np.quantile(values, [0.2, 0.4, 0.6, 0.8])
    assert all(got[str(i)] == 1 + sum(v > e for e in edges if e > values[0]) for i, v in enumerate(values))
