"""Rounds of many k-means models at once against Spark's own fits."""

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from patronlens.operators import kmeans
from patronlens.operators.kmeans import fit_rounds


def vectors(spark, points):
    rows = [([float(v) for v in p],) for p in points]
    return spark.createDataFrame(rows, "p array<double>").select(array_to_vector("p").alias("_scaled")).repartition(3).cache()


def test_ends_where_spark_ends(spark):
    rng = np.random.default_rng(1)
    df = vectors(spark, rng.normal(0, 1, (900, 3)) + rng.integers(0, 3, 900)[:, None] * 2.0)

    def fit(k, seed, rounds):
        return KMeans(k=k, seed=seed, maxIter=rounds, tol=1e-4, solver="block", featuresCol="_scaled").fit(df)

    tasks = [(k, seed) for k in (2, 3, 5) for seed in (1, 2)]
    starts = {task: np.array(fit(*task, 0).clusterCenters()) for task in tasks}
    for rounds in (300, 4):
        found = fit_rounds(df, "_scaled", starts, rounds, 1e-4)
        for task in tasks:
            theirs = fit(*task, rounds)
            np.testing.assert_allclose(found[task].clusterCenters(), theirs.clusterCenters(), atol=1e-9)
            assert found[task].cost == pytest.approx(theirs.summary.trainingCost, rel=1e-9)
    ours = found[5, 1].transform(df).select("KMeans_Cluster").collect()
    assert ours == fit(5, 1, 4).transform(df).select(F.col("prediction").alias("KMeans_Cluster")).collect()


def test_one_pass_a_round(spark, monkeypatch):
    """Ninety models take one job a round, not ninety."""
    df = vectors(spark, np.random.default_rng(2).normal(0, 1, (60, 2)))
    starts = {i: np.array([[0.0, 0.0], [1.0, i / 90.0]]) for i in range(90)}
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("rounds", "")
    fit_rounds(df, "_scaled", starts, 3, 0.0)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(tracker.getJobIdsForGroup("rounds")) <= 6


def test_ties_and_centres_without_rows(spark):
    df = vectors(spark, [[0.0], [2.0], [1.0]])
    found = fit_rounds(df, "_scaled", {"a": np.array([[0.0], [2.0], [50.0]])}, 1, 0.0)["a"]
    assert [c[0] for c in found.clusterCenters()] == [0.5, 2.0, 50.0] and found.cost == 1.0
    placed = kmeans.Clusters(np.array([[0.0], [2.0]]), 0.0, "_scaled").transform(df)
    assert {r._scaled[0]: r.KMeans_Cluster for r in placed.collect()} == {0.0: 0, 2.0: 1, 1.0: 0}


def test_rows_are_placed_by_all_models_at_once(spark):
    df = vectors(spark, np.random.default_rng(3).normal(0, 1, (500, 3)))
    models = {str(k): kmeans.Clusters(np.random.default_rng(k).normal(0, 1, (k, 3)), 0.0, "_scaled") for k in (2, 7)}
    together = kmeans.placed_by_all(df, "_scaled", models).collect()
    for name, model in models.items():
        alone = {tuple(r._scaled): r.KMeans_Cluster for r in model.transform(df).collect()}
        assert {tuple(r.point): r[name] for r in together} == alone
