"""Standardisation, clusters and projection of customer metrics."""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronlens.functions.rounding import zero_if_missing
from patronlens.operators import mixture
from patronlens.operators.estimators import partitions_for
from patronlens.operators.kmeans import Clusters, fit_rounds, placed_by_all
from patronlens.operators.silhouette import euclidean_silhouette, euclidean_silhouettes
from patronlens.schema import CUSTOMER, RFM
from patronlens.session import for_iteration

SEED = 42
#: A start of k-means ends when no centre moves by more deviations than this.
TOLERANCE = 1e-4
_VECTOR = "_scaled"


def standardize(df: DataFrame, features: Sequence[str] = RFM, suffix: str = "") -> DataFrame:
    """Centre and divide by the population deviation (a constant column only centres).

    Mean and deviation come from one aggregation, read as a scalar subquery.
    """
    stats = df.agg(
        F.struct(
            *[F.avg(c).alias(f"mean_{c}") for c in features],
            *[F.stddev_pop(c).alias(f"std_{c}") for c in features],
        ).alias("stats")
    ).scalar()

    def scaled(name: str) -> Column:
        deviation = stats[f"std_{name}"]
        return (F.col(name) - stats[f"mean_{name}"]) / F.when(deviation > 0, deviation).otherwise(F.lit(1.0))

    return df.withColumns({f"{c}{suffix}": scaled(c) for c in features})


def _vectors(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows with a standardised vector column, kept in storage for the iterations of a fit."""
    names = [f"{c}_z" for c in features]
    rows = standardize(df, features, "_z").withColumns({c: zero_if_missing(F.col(c)) for c in names})
    assembled = VectorAssembler(inputCols=names, outputCol=_VECTOR).transform(rows).drop(*names)
    return for_iteration(assembled)


def _fit_starts(
    vectors: DataFrame, ks: Sequence[int], starts: int, seed: int, max_iter: int, parallelism: int, tol: float
) -> dict[int, Clusters]:
    """Per k, the model of lowest cost among several seeded starts.

    Spark's k-means draws the first centres, several fits at a time because one on little
    data leaves a cluster idle. All models then take their rounds together; one ends
    when no centre moves by more than ``tol`` deviations.
    """

    def first(task: tuple[int, int]) -> list[np.ndarray]:
        k, start = task
        estimator = KMeans(k=k, seed=seed + start, maxIter=0, solver="block", featuresCol=_VECTOR)
        return estimator.fit(vectors).clusterCenters()

    rows = vectors.count()  # fill the storage once, not in every thread
    tasks = [(k, start) for k in ks for start in range(starts)]
    with ThreadPool(max(1, min(parallelism, len(tasks)))) as pool:
        centres = pool.map(inheritable_thread_target(vectors.sparkSession)(first), tasks)
    dealt = vectors.select(_VECTOR).repartition(partitions_for(rows))
    fitted = fit_rounds(dealt, _VECTOR, dict(zip(tasks, map(np.array, centres), strict=True)), max_iter, tol)
    best: dict[int, Clusters] = {}
    for k, start in tasks:
        if k not in best or fitted[k, start].cost < best[k].cost:
            best[k] = fitted[k, start]
    return best


def cluster_summary(
    clustered: DataFrame, features: Sequence[str] = RFM, cluster: str = "KMeans_Cluster"
) -> DataFrame:
    """Mean of each feature per cluster."""
    return clustered.groupBy(cluster).agg(*[F.avg(c).alias(c) for c in features])


def cluster_rank(summary: DataFrame, cluster: str = "KMeans_Cluster", measure: str = "Monetary") -> DataFrame:
    """Rank of each cluster by descending measure; ties take the truncated mean rank.

    The windows run over one row per cluster.
    """
    rank = F.rank().over(Window.orderBy(F.desc(measure)))
    ties = F.count(F.lit(1)).over(Window.partitionBy(measure))
    return summary.select(cluster, F.floor(rank + (ties - 1) / 2).cast("int").alias("Cluster_Rank"))


def with_cluster_rank(clustered: DataFrame, ranks: DataFrame, cluster: str = "KMeans_Cluster") -> DataFrame:
    """Each customer with the rank of its cluster, null where ``ranks`` lacks the cluster."""
    # One rank per cluster: k rows.
    return clustered.join(F.broadcast(ranks), cluster, "left")


def kmeans_segments(
    customers: DataFrame,
    clusters: int = 5,
    features: Sequence[str] = RFM,
    starts: int = 10,
    seed: int = SEED,
    max_iter: int = 300,
    parallelism: int = 8,
    tol: float = TOLERANCE,
) -> tuple[DataFrame, Clusters]:
    """Cluster and cluster rank (1 = highest mean monetary value) per customer, and the model."""
    vectors = _vectors(customers, features)
    model = _fit_starts(vectors, [clusters], starts, seed, max_iter, parallelism, tol)[clusters]
    assigned = model.transform(vectors).drop(_VECTOR)
    ranked = with_cluster_rank(assigned, cluster_rank(cluster_summary(assigned, features)))
    return ranked.select(*customers.columns, "KMeans_Cluster", "Cluster_Rank"), model


def silhouette_by_k(
    customers: DataFrame,
    ks: Sequence[int] = range(2, 11),
    features: Sequence[str] = RFM,
    starts: int = 10,
    seed: int = SEED,
    max_iter: int = 300,
    parallelism: int = 8,
    tol: float = TOLERANCE,
    squared: bool = False,
    unique: str = CUSTOMER,
    members: int | None = None,
) -> DataFrame:
    """Silhouette per number of clusters and the error that sampling can add to it.

    On plain Euclidean distance each customer is compared with all others, or with at most
    ``members`` of each cluster where that is given. ``squared`` takes squared distances instead,
    which need only the sums of the clusters.
    """
    vectors = _vectors(customers, features)
    models = _fit_starts(vectors, list(ks), starts, seed, max_iter, parallelism, tol)
    if squared:
        evaluator = ClusteringEvaluator(featuresCol=_VECTOR, predictionCol="KMeans_Cluster")
        scores = [(k, float(evaluator.evaluate(models[k].transform(vectors))), 0.0) for k in ks]
    elif members is None:
        named = placed_by_all(vectors, _VECTOR, {f"k{k}": models[k] for k in ks})
        found = euclidean_silhouettes(named, F.col("point"), [f"k{k}" for k in ks])
        scores = [(k, *score) for k, score in zip(ks, found, strict=True)]
    else:
        point = vector_to_array(_VECTOR)
        scores = [
            (k, *euclidean_silhouette(models[k].transform(vectors), point, "KMeans_Cluster", unique, members, seed)) for k in ks
        ]
    vectors.unpersist()
    return customers.sparkSession.createDataFrame(scores, "k int, silhouette double, error double")


def optimal_k(scores: DataFrame) -> DataFrame:
    """The number of clusters of highest silhouette, the smallest on ties."""
    return scores.orderBy(F.desc_nulls_last("silhouette"), "k").limit(1)


def gmm_model(
    customers: DataFrame,
    components: int = 5,
    features: Sequence[str] = RFM,
    seed: int = SEED,
    max_iter: int = 100,
    tol: float = mixture.TOLERANCE,
) -> tuple[DataFrame, mixture.Mixture]:
    """Most likely component and its probability per customer, and the mixture of the standardised features.

    The fit starts from one start of k-means; components beyond the number of distinct customers are left out.
    """
    vectors = _vectors(customers, features)
    start = _fit_starts(vectors, [components], 1, seed, 300, 1, TOLERANCE)[components]
    assigned = start.transform(vectors).select(*customers.columns, "KMeans_Cluster", vector_to_array(_VECTOR).alias(_VECTOR))
    rows = for_iteration(assigned)
    centres = np.array([c for c in start.clusterCenters()], np.float64)
    model = mixture.fit_mixture(rows, _VECTOR, "KMeans_Cluster", centres, max_iter, tol)
    vectors.unpersist()
    found = rows.withColumn("_found", mixture.membership(model, F.col(_VECTOR)))
    scored = found.select(
        *customers.columns, F.col("_found.component").alias("GMM_Cluster"), F.col("_found.probability").alias("GMM_Max_Prob")
    )
    return scored, model


def gmm_soft(
    customers: DataFrame,
    components: int = 5,
    features: Sequence[str] = RFM,
    seed: int = SEED,
    max_iter: int = 100,
) -> tuple[DataFrame, dict[str, float]]:
    """Most likely component and its probability per customer, and log-likelihood, BIC, AIC."""
    scored, model = gmm_model(customers, components, features, seed, max_iter)
    return scored, {"log_likelihood": model.log_likelihood, "bic": model.bic, "aic": model.aic, "converged": model.converged}


def pca_projection(
    customers: DataFrame, features: Sequence[str] = RFM, components: int = 2
) -> tuple[DataFrame, list[float]]:
    """Principal components of the standardised metrics and their shares of variance.

    Each component's sign is fixed so that its largest loading is positive.
    """
    vectors = _vectors(customers, features)
    model = PCA(k=components, inputCol=_VECTOR, outputCol="_projected").fit(vectors)
    loadings = model.pc.toArray()
    signs = [1.0 if loadings[abs(loadings[:, j]).argmax(), j] > 0 else -1.0 for j in range(components)]
    projected = vector_to_array("_projected")
    columns = [(projected[j] * signs[j]).alias(f"PC{j + 1}") for j in range(components)]
    shares = [float(x) for x in model.explainedVariance.toArray()]
    return model.transform(vectors).select(*customers.columns, *columns), shares


def dbscan_counts(clustered: DataFrame, cluster: str = "DBSCAN_Cluster") -> DataFrame:
    """Number of clusters and of noise points (-1)."""
    return clustered.agg(
        F.count_distinct(F.when(F.col(cluster) != -1, F.col(cluster))).alias("clusters"),
        F.count_if(F.col(cluster) == -1).alias("noise"),
    )
