"""Silhouette on plain distance against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from patronlens.operators import clustering, silhouette
from patronlens.operators.silhouette import euclidean_silhouette, euclidean_silhouettes


def brute(points, labels):
    apart = np.sqrt(((points[:, None] - points[None]) ** 2).sum(2))
    scores = []
    for i, own in enumerate(labels):
        mates = labels == own
        if mates.sum() < 2:
            scores.append(0.0)
            continue
        a = apart[i][mates].sum() / (mates.sum() - 1)
        b = min(apart[i][labels == c].mean() for c in set(labels.tolist()) - {own})
        scores.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return float(np.mean(scores))


def clustered(spark, points, labels):
    rows = [(f"C{i}", [float(v) for v in p], int(c)) for i, (p, c) in enumerate(zip(points, labels))]
    return spark.createDataFrame(rows, "CustomerID string, p array<double>, c int").repartition(5)


def blobs(seed=8, n=700):
    rng = np.random.default_rng(seed)
    labels = rng.choice([0, 1, 2, 5], n, p=[0.6, 0.3, 0.09, 0.01])
    points = rng.normal(0, 1, (n, 3)) + labels[:, None] * 1.5
    points[:40] = points[0]  # copies
    labels[:40] = 0
    labels[-1] = 9  # the only row of its cluster
    return points, labels


def score(df, **options):
    return euclidean_silhouette(df, F.col("p"), "c", "CustomerID", **options)


def test_small_clusters_are_exact(spark):
    points, labels = blobs()
    found = score(clustered(spark, points, labels))
    assert found.value == pytest.approx(brute(points, labels), abs=1e-12) and found.error == 0.0


@pytest.mark.parametrize("seed", range(3))
def test_large_clusters_are_within_the_error(spark, seed):
    points, labels = blobs(n=1500)
    exact = brute(points, labels)
    found = score(clustered(spark, points, labels), members=80, seed=seed)
    assert 0 < found.error < 0.2
    assert abs(found.value - exact) <= found.error


def test_edge_tables(spark):
    points, labels = blobs(n=60)
    df = clustered(spark, points, labels)
    assert score(df.limit(0)) == (None, None)
    assert score(df.filter("c = 0")) == (None, None)
    unassigned = df.unionByName(df.limit(3).withColumns({"c": F.lit(None).cast("int"), "CustomerID": F.lit("none")}))
    assert score(unassigned) == pytest.approx(score(df))
    same = spark.createDataFrame([(str(i), [1.0], i % 2) for i in range(6)], "CustomerID string, p array<double>, c int")
    assert score(same) == (0.0, 0.0)


def test_every_member_counts(spark):
    """More than 1,000 members a cluster, once the size of a sample."""
    rng = np.random.default_rng(3)
    labels = np.repeat([0, 1], [2600, 1400])
    points = rng.normal(0, 1, (4000, 3)) + labels[:, None]
    found = score(clustered(spark, points, labels))
    assert found.value == pytest.approx(brute(points, labels), abs=1e-12) and found.error == 0.0


def test_rows_in_many_shares_and_clusterings(spark, monkeypatch):
    monkeypatch.setattr(silhouette, "_SHARE", 300)
    monkeypatch.setattr(silhouette, "_BLOCK_ROWS", 90)
    points, labels = blobs(n=1100)
    other = np.arange(1100) % 7
    rows = [
        ([float(v) for v in p], int(a), None if i < 50 else int(b), 3)
        for i, (p, a, b) in enumerate(zip(points + 1000.0, labels, other))
    ]
    df = spark.createDataFrame(rows, "p array<double>, a int, b int, one int")
    first, second, third = euclidean_silhouettes(df, F.col("p"), ["a", "b", "one"])
    assert first == (pytest.approx(brute(points, labels), abs=1e-10), 0.0)
    assert second == (pytest.approx(brute(points[50:], other[50:]), abs=1e-10), 0.0)
    assert third == (None, None)


def test_near_rows_are_told_apart():
    """Distances far below the rows' norms keep their digits."""
    rng = np.random.default_rng(4)
    left = rng.normal(0, 1, (40, 3))
    right = np.vstack([left, left + 1e-7, left + 1e-12])
    exact = np.sqrt(((left[:, None] - right[None]) ** 2).sum(2))
    np.testing.assert_allclose(silhouette._distances(left, right), exact, rtol=1e-9)


def test_choice_of_k_scores_every_customer(spark):
    rng = np.random.default_rng(5)
    rows = [(str(i), *(float(v) for v in rng.normal(i % 3 * 4.0, 1.0, 3))) for i in range(3600)]
    customers = spark.createDataFrame(rows, "CustomerID string, Recency double, Frequency double, Monetary double")
    scores = clustering.silhouette_by_k(customers, [2, 3], starts=2).collect()
    assert [r.error for r in scores] == [0.0, 0.0]
    found, _ = clustering.kmeans_segments(customers, 3, starts=2)
    pdf = found.toPandas()
    z = pdf[["Recency", "Frequency", "Monetary"]]
    exact = brute(((z - z.mean()) / z.std(ddof=0)).to_numpy(), pdf.KMeans_Cluster.to_numpy())
    assert scores[1].silhouette == pytest.approx(exact, abs=1e-9)
