"""Golden values on the hand-written sample."""

import pytest
from pyspark.sql import functions as F

from patronlens.operators import buytilldie, churn, cleaning, cohorts, features, rfm
from tests.sample import frame, sample_rows


@pytest.fixture(scope="module")
def lines(spark):
    return cleaning.clean_transactions(frame(spark, sample_rows())).cache()


def test_segments(lines):
    rows = rfm.assign_segments(rfm.score_rfm(rfm.compute_rfm(lines))).orderBy("CustomerID").collect()
    got = [
        (r.CustomerID, r.Recency, r.Frequency, round(r.Monetary, 2), r.RFM_String, r.RFM_Score, r.Segment) for r in rows
    ]
    assert got == [
        ("C0001", 11, 4, 96.50, "455", 14, "Champions"),
        ("C0002", 26, 3, 81.48, "345", 12, "Need Attention"),
        ("C0003", 1, 3, 60.00, "554", 14, "Champions"),
        ("C0004", 44, 2, 43.75, "132", 6, "Hibernating"),
        ("C0005", 39, 2, 45.24, "234", 9, "At Risk"),
        ("C0006", 18, 2, 45.00, "443", 11, "Loyal Customers"),
        ("C0007", 52, 1, 27.00, "111", 3, "Lost"),
        ("C0008", 34, 1, 44.00, "213", 6, "Lost"),
        ("C0009", 22, 1, 18.99, "321", 6, "About to Sleep"),
        ("C0010", 5, 1, 36.00, "522", 9, "Potential Loyalists"),
    ]


def test_order_values(lines):
    got = {r.CustomerID: (round(r.avg_order_value, 4), round(r.std_order_value, 4)) for r in features.order_values(lines).collect()}
    assert got["C0001"] == (24.125, 8.9291)
    assert got["C0006"] == (22.5, 10.6066)
    assert got["C0010"] == (36.0, 0.0)


def test_churn_labels(lines):
    assert churn.churn_rate(churn.churn_labels(lines)).first()["churned"] == 0
    churned = {r.CustomerID for r in churn.churn_labels(lines, 30).filter("Churned = 1").collect()}
    assert churned == {"C0004", "C0005", "C0007", "C0008"}


def test_last_purchase_at_the_cutoff_is_active(lines):
    # C0004 last bought on 2023-03-10, 43 days before the end.
    at = {r.CustomerID: r.Churned for r in churn.churn_labels(lines, 43).collect()}
    assert at["C0004"] == 0
    after = {r.CustomerID: r.Churned for r in churn.churn_labels(lines, 42).collect()}
    assert after["C0004"] == 1


def test_cohorts(lines):
    active, revenue = {}, {}
    for r in cohorts.cohort_retention(lines).collect():
        active.setdefault(str(r.CohortMonth)[:7], []).append(r.Active)
    for r in cohorts.cohort_revenue(lines).collect():
        revenue.setdefault(str(r.CohortMonth)[:7], []).append(round(r.Revenue, 2))
    assert active == {"2023-01": [4, 3, 2, 2], "2023-02": [2, 1, 1], "2023-03": [2, 0], "2023-04": [2]}
    assert revenue == {
        "2023-01": [122.23, 78.50, 37.00, 44.00],
        "2023-02": [48.99, 26.25, 15.00],
        "2023-03": [71.00, 0.0],
        "2023-04": [54.99],
    }


def test_retention_matrix_is_null_after_the_last_month(lines):
    row = cohorts.retention_matrix(lines).filter("Cohort = 'Mar 2023'").first()
    assert (row["Month_0"], row["Month_1"], row["Month_2"]) == (1.0, 0.0, None)


def test_purchase_summary(lines):
    got = {
        r.CustomerID: (r.frequency, r.recency, r["T"], round(r.monetary_value, 4))
        for r in buytilldie.rfm_t_summary(lines).collect()
    }
    assert got["C0001"] == (3, 97, 107, 27.6667)
    assert got["C0003"] == (2, 92, 92, 18.75)
    assert got["C0006"] == (1, 46, 63, 15.0)
    assert got["C0010"] == (0, 0, 4, 0.0)


def test_customer_features_agree_with_rfm(lines):
    left = rfm.compute_rfm(lines)
    right = features.customer_features(lines).select("CustomerID", "Recency", "Frequency", "Monetary")
    assert left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0
    assert len(features.customer_features(lines).columns) == 1 + 3 + 21


def test_leaky_inputs_can_be_left_out(lines):
    made = features.customer_features(lines)
    labels = churn.churn_labels(lines, 30)
    assert "Recency" in churn.churn_dataset(made, labels).columns
    assert "Recency" not in churn.churn_dataset(made, labels, exclude_leaky=True).columns
    assert made.filter(F.col("is_multi_country") == 1).count() == 0
