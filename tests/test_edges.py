"""Null, boundary and tie rules."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from patronlens.functions.binning import bin_of_rank
from patronlens.functions import hypergeometric
from patronlens.functions.hypergeometric import hyp2f1, purchases_until
from patronlens.functions.rounding import round_even
from patronlens.functions.timing import whole_days
from patronlens.operators import buytilldie, churn, cleaning, clustering, dashboard, ltv, rfm, segments
from patronlens.sources import transactions
from tests.sample import frame, line


def ids(df, column="InvoiceNo"):
    return [r[0] for r in df.select(column).collect()]


def test_cancellations_are_case_sensitive_and_keep_null(spark):
    df = frame(spark, [line("1", i) for i in ("C123", "c123", None, "123")])
    assert ids(cleaning.drop_cancellations(df)) == ["c123", None, "123"]


def test_non_products_match_exactly_and_keep_null(spark):
    df = frame(spark, [line("1", "1", s) for s in ("D", "DOT", "DOTX", None, "d")])
    assert ids(cleaning.drop_non_product(df), "StockCode") == ["DOTX", None, "d"]


def test_ids(spark):
    df = frame(spark, [line(i, "1") for i in ("12345.0", "C0001", "12345", "-7.9", "")])
    assert ids(cleaning.normalize_customer_id(df), "CustomerID") == ["12345", "C0001", "12345", "-7", ""]


def test_ids_are_cut_as_text_and_never_merged(spark):
    long = "1234567890123456789012345678901234567890"
    given = ("1E5", "100000", "12.9999999", "-0.5", "007", " 5 ", "+3.", long, "1,5", None)
    df = frame(spark, [line(i, "1") for i in given])
    want = ["1E5", "100000", "12", "0", "7", "5", "3", long, "1,5", None]
    assert ids(cleaning.normalize_customer_id(df), "CustomerID") == want


def test_nan_is_missing(spark):
    nan = float("nan")
    rows = [(str(i), v) for i, v in enumerate([1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, nan])]
    df = spark.createDataFrame(rows, "CustomerID string, Predicted_LTV double")
    assert ltv.ltv_describe(df, "Predicted_LTV").first()[:4] == (7, 4.0, 2.16, 1.0)
    tiers = {r.CustomerID: r.LTV_Tier for r in ltv.quantile_tiers(df).collect()}
    assert tiers["7"] is None and tiers["3"] == "Silver"
    assert sum(r.customers for r in dashboard.histogram(df, "Predicted_LTV", 3).collect()) == 7


def test_profit_is_null_where_there_is_no_mean(spark):
    df = spark.createDataFrame([(0, 0.0), (1, 10.0)], "x int, m double")
    params = {"p": 2.0, "q": 0.5, "v": 3.0}
    got = [r[0] for r in df.select(buytilldie.expected_avg_profit(F.col("x"), F.col("m"), params)).collect()]
    assert got[0] is None and got[1] > 0


def test_hypergeometric_near_one():
    assert hyp2f1(1.2, -0.2, np.array([0.3]), np.array([0.9999]))[0] == pytest.approx(-457.66620979, rel=1e-9)
    params = dict(r=0.2, alpha=0.01, a=0.5, b=1.0)
    alone = purchases_until(params, [365], [0], [0], [0])[0, 0]
    assert alone == pytest.approx(94.83369461, rel=1e-8)
    assert purchases_until(params, [365], [0, 40], [0, 100], [0, 3000])[0, 0] == alone


@pytest.mark.parametrize("near", [0.0, 1e-12, -5e-4, 9e-4])
@pytest.mark.parametrize("whole", [-3, -1, 0, 2, 7])
def test_hypergeometric_where_the_gap_is_whole(whole, near):
    # Closed form: F(1, 1; 2; z) = -log(1 - z) / z.
    for z in (0.95, 0.99999, 1.0 - 1e-9):
        assert hyp2f1(1.0, 1.0, np.array([2.0]), np.array([z]))[0] == pytest.approx(-np.log1p(-z) / z, rel=1e-11)
    for a, b in ((1.2, -0.2), (2.3, 1.6), (0.7, -0.35)):
        c = a + b + whole + near
        if c > 0.1:
            for z in (0.91, 0.9995):
                slow = hypergeometric._series(*(np.array([v]) for v in (a, b, c, z)))[0]
                assert hyp2f1(a, b, np.array([c]), np.array([z]))[0] == pytest.approx(slow, rel=1e-10)


def test_parquet_by_format_and_csv_columns_by_name(spark, tmp_path):
    df = frame(spark, [line("1", "5")])
    df.write.parquet(f"{tmp_path}/plain")
    assert transactions.load_transactions(spark, f"{tmp_path}/plain", format="parquet").collect() == df.collect()
    with pytest.raises(ValueError, match="format"):
        transactions.load_transactions(spark, f"{tmp_path}/plain", format="orc")


def test_positive_lines_drop_null_and_nan(spark):
    df = spark.createDataFrame(
        [(0, 1.0), (-1, 1.0), (None, 1.0), (1, float("nan")), (1, 0.0), (2, 3.0)], "Quantity int, UnitPrice double"
    )
    assert [tuple(r) for r in cleaning.positive_lines(df).collect()] == [(2, 3.0)]


def test_audit_adds_up(spark):
    df = frame(
        spark,
        [line("1", "C1"), line(None, "2"), line("1", "3", quantity=0), line("1", "4", "POST"), line("1", "5")],
    )
    assert list(cleaning.cleaning_audit(df).first()) == [5, 1, 1, 1, 1, 1, 4]


@pytest.mark.parametrize("hours, days", [(23, 0), (24, 1), (25, 1), (-1, -1), (-24, -1), (-25, -2), (0, 0)])
def test_whole_days_floor(spark, hours, days):
    start = datetime(2024, 3, 30, 12)
    df = spark.createDataFrame([(start, start + timedelta(hours=hours))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(whole_days(F.col("a"), F.col("b")).alias("d")).first()["d"] == days


def test_snapshot_may_lie_before_the_last_purchase(spark):
    df = cleaning.line_revenue(frame(spark, [line("1", "1", date="2023-01-10T12:00:00")]))
    assert rfm.compute_rfm(df, datetime(2023, 1, 10)).first()["Recency"] == -1


@pytest.mark.parametrize("n", [2, 3, 4, 7, 11, 23, 50, 101])
@pytest.mark.parametrize("q", [4, 5, 7])
def test_rank_bins_equal_quantile_bins(spark, n, q):
    if q == 7:
        # Sevenths are not exact in binary, and pandas then misplaces a rank that lies on an edge.
        expected = [next(b for b in range(1, q + 1) if (r - 1) * q <= b * (n - 1)) for r in range(1, n + 1)]
    else:
        expected = (pd.qcut(pd.Series(range(1, n + 1), dtype=float), q, labels=False) + 1).tolist()
    df = spark.range(1, n + 1).select("id", bin_of_rank(F.col("id"), F.lit(n), q).alias("b")).orderBy("id")
    assert [r.b for r in df.collect()] == expected


def test_one_customer_cannot_be_scored(spark):
    df = spark.createDataFrame([("a", 1, 1, 1.0)], "CustomerID string, Recency bigint, Frequency bigint, Monetary double")
    with pytest.raises(Exception, match="at least two rows"):
        rfm.quantile_bin_rank(df, "Frequency", "F_Score").collect()


def test_value_bins_equal_quantile_bins(spark):
    rng = np.random.default_rng(7)
    for n in (6, 11, 36, 101, 250):
        values = rng.choice(np.arange(1, 4 * n), size=n, replace=False)
        expected = (pd.qcut(pd.Series(values), 5, labels=False) + 1).tolist()
        df = spark.createDataFrame([(i, int(v)) for i, v in enumerate(values)], "id int, v bigint")
        got = rfm.quantile_bin_value(df, "v", "b").orderBy("id").collect()
        assert [r.b for r in got] == expected


def test_equal_edges_raise_or_collapse(spark):
    df = spark.createDataFrame([(v,) for v in (1, 1, 1, 1, 1, 1, 5, 9)], "Recency bigint")
    with pytest.raises(Exception, match="not distinct"):
        rfm.quantile_bin_value(df, "Recency", "R").collect()
    collapsed = rfm.quantile_bin_value(df, "Recency", "R", duplicates="collapse").orderBy("Recency").collect()
    assert [r.R for r in collapsed] == [1, 1, 1, 1, 1, 1, 2, 2]


def test_risk_tiers(spark):
    values = [0.0, 0.3, 0.30001, 0.6, 0.8, 1.0, None, float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "Churn_Probability double")
    tiers = [r.Churn_Risk_Tier for r in churn.with_churn_scores(df).collect()]
    assert tiers == [None, "Low", "Medium", "Medium", "High", "Critical", None, None]
    assert churn.with_churn_scores(df, include_lowest=True).first()["Churn_Risk_Tier"] == "Low"


def test_all_equal_values_have_no_tiers(spark):
    df = spark.createDataFrame([(str(i), 2.0) for i in range(5)], "CustomerID string, Predicted_LTV double")
    with pytest.raises(Exception, match="not distinct"):
        ltv.quantile_tiers(df).collect()
    assert {r.LTV_Tier for r in ltv.quantile_tiers(df, duplicates="collapse").collect()} == {"Bronze"}


def test_segment_of_every_pair(spark):
    df = spark.createDataFrame([(r, f) for r in range(1, 6) for f in range(1, 6)], "R_Score int, F_Score int")
    got = {(r.R_Score, r.F_Score): r.Segment for r in rfm.assign_segments(df).collect()}
    assert len(got) == 25
    for pair, name in got.items():
        assert name == rfm.SEGMENTS.get(pair, "Need Attention")
    assert [got[p] for p in ((5, 1), (4, 1), (3, 4))] == ["Need Attention"] * 3


def test_tied_clusters_share_the_truncated_rank(spark):
    df = spark.createDataFrame([(0, 5.0), (1, 9.0), (2, 9.0), (3, 1.0)], "KMeans_Cluster int, Monetary double")
    got = {r.KMeans_Cluster: r.Cluster_Rank for r in clustering.cluster_rank(df).collect()}
    assert got == {1: 1, 2: 1, 0: 3, 3: 4}


def test_missing_tiers(spark):
    df = spark.createDataFrame([("1", "Gold"), ("2", None)], "CustomerID string, LTV_Tier string")
    counts = [(r.LTV_Tier, r.Customers) for r in ltv.ltv_tier_counts(df).collect()]
    assert counts == [("Platinum", None), ("Gold", 1), ("Silver", None), ("Bronze", None)]
    risks = df.withColumn("Churn_Risk_Tier", F.lit("High"))
    assert [r.Customers for r in churn.churn_tier_counts(risks).collect()] == [0, 2, 0, 0]


def test_rounding_is_half_even_on_scaled_binary(spark):
    df = spark.createDataFrame([(v,) for v in (0.125, 0.375, 1.015, -0.125)], "v double")
    got = [r[0] for r in df.select(round_even(F.col("v"), 2)).collect()]
    assert got == [float(np.round(v, 2)) for v in (0.125, 0.375, 1.015, -0.125)]


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 2, 3, 4)], "v double")
    assert [(r.bin, r.customers) for r in dashboard.histogram(df, "v", 2).collect()] == [(0, 2), (1, 3)]
    flat = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert [(r.bin, r.customers) for r in dashboard.histogram(flat, "v", 4).collect()] == [(0, 2)]


def test_home_country_ties_go_to_the_smallest(spark):
    df = frame(spark, [line("1", "1", country=c) for c in ("UK", "India", "UK", "India", None, None, None)])
    assert dashboard.home_country(df).first()["Country"] == "India"


def test_summary_leaves_out_missing_segments(spark):
    df = spark.createDataFrame(
        [("1", 1, 1, 2.0, "A"), ("2", 1, 1, 2.0, None)],
        "CustomerID string, Recency int, Frequency int, Monetary double, Segment string",
    )
    assert [r.Segment for r in segments.segment_counts(df).collect()] == ["A"]
    assert segments.summarize_segments(df).first()["Revenue_Share_%"] == 100.0
