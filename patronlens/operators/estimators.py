"""Value regressors and churn classifiers on Spark ML."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from math import ceil, sqrt
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import ElementwiseProduct, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens.functions.binning import order_of
from patronlens.functions.rounding import zero_if_missing
from patronlens.operators import metrics
from patronlens.operators.churn import with_churn_scores
from patronlens.operators.ltv import with_ltv_scores
from patronlens.schema import CUSTOMER
from patronlens.session import materialize
from patronlens.sources.runlog import RunLog, save_model

SEED = 42
LTV_LABEL, CHURN_LABEL = "y", "Churned"
#: Rows that one partition of a fit holds before there is a second; four partitions hold sixteen times as many.
ROWS_OF_ONE = 4096


@dataclass(frozen=True)
class TreeSizes:
    """Sizes of the tree models; the defaults are the full ones."""

    forest_trees: int = 200
    forest_depth: int = 8
    ltv_boost_rounds: int = 200
    ltv_boost_depth: int = 5
    ltv_sampled_rounds: int = 300
    ltv_sampled_depth: int = 6
    churn_boost_rounds: int = 300
    churn_boost_depth: int = 5


def _assembled(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="error")


def ltv_pipelines(
    train: DataFrame, features: Sequence[str], seed: int = SEED, sizes: TreeSizes | None = None
) -> dict[str, Pipeline]:
    """Ridge, random forest, gradient boosting and boosting on samples of rows and columns.

    The ridge penalty is stated on the raw features (alpha 1); the library
    divides its penalty by the label's deviation and the number of rows.
    """
    sizes = sizes or TreeSizes()
    stats = train.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(LTV_LABEL).alias("s")).first()
    common = {"featuresCol": "_features", "labelCol": LTV_LABEL}
    ridge = LinearRegression(
        solver="normal",
        elasticNetParam=0.0,
        standardization=False,
        regParam=float(stats["s"] or 0.0) / stats["n"],
        **common,
    )
    forest = RandomForestRegressor(
        numTrees=sizes.forest_trees,
        maxDepth=sizes.forest_depth,
        featureSubsetStrategy="all",
        seed=seed,
        **common,
    )
    boosted = GBTRegressor(
        maxIter=sizes.ltv_boost_rounds, maxDepth=sizes.ltv_boost_depth, stepSize=0.05, seed=seed, **common
    )
    sampled = GBTRegressor(
        maxIter=sizes.ltv_sampled_rounds,
        maxDepth=sizes.ltv_sampled_depth,
        stepSize=0.05,
        subsamplingRate=0.8,
        featureSubsetStrategy="0.8",
        seed=seed,
        **common,
    )
    models = {"Ridge": ridge, "RandomForest": forest, "GradientBoosting": boosted, "SampledBoosting": sampled}
    return {name: Pipeline(stages=[_assembled(features), model]) for name, model in models.items()}


def churn_pipelines(
    train: DataFrame, features: Sequence[str], seed: int = SEED, sizes: TreeSizes | None = None
) -> dict[str, Pipeline]:
    """Logistic regression on scaled features, random forest and boosting on samples."""
    sizes = sizes or TreeSizes()
    rows = train.count()
    scale = sqrt(rows / (rows - 1.0)) if rows > 1 else 1.0
    logistic = LogisticRegression(
        featuresCol="_population_scaled",
        labelCol=CHURN_LABEL,
        regParam=1.0 / rows,
        elasticNetParam=0.0,
        standardization=False,
        maxIter=500,
    )
    scaled = [
        _assembled(features),
        StandardScaler(inputCol="_features", outputCol="_sample_scaled", withMean=True, withStd=True),
        # The scaler divides by the sample deviation; this makes it the population one.
        ElementwiseProduct(
            scalingVec=Vectors.dense([scale] * len(features)),
            inputCol="_sample_scaled",
            outputCol="_population_scaled",
        ),
        logistic,
    ]
    forest = RandomForestClassifier(
        featuresCol="_features",
        labelCol=CHURN_LABEL,
        numTrees=sizes.forest_trees,
        maxDepth=sizes.forest_depth,
        featureSubsetStrategy="sqrt",
        seed=seed,
    )
    sampled = GBTClassifier(
        featuresCol="_features",
        labelCol=CHURN_LABEL,
        maxIter=sizes.churn_boost_rounds,
        maxDepth=sizes.churn_boost_depth,
        stepSize=0.05,
        subsamplingRate=0.8,
        featureSubsetStrategy="0.8",
        seed=seed,
    )
    return {
        "LogisticRegression": Pipeline(stages=scaled),
        "RandomForest": Pipeline(stages=[_assembled(features), forest]),
        "SampledBoosting": Pipeline(stages=[_assembled(features), sampled]),
    }


@dataclass
class Training:
    """Fitted models, their test predictions, the leaderboard and its best model."""

    models: dict[str, PipelineModel]
    predictions: DataFrame
    leaderboard: DataFrame
    best: str


def partitions_for(rows: int) -> int:
    """Partitions of the rows of a fit: their number and the rows of each grow with the square root of ``rows``.

    Each level of each tree is a job of one task a partition, and each task of a forest hands over the
    counts of every node it has seen. So more partitions than the rows need cost time and shuffle alike.
    """
    return max(1, ceil(sqrt(rows / ROWS_OF_ONE)))


def _fit_all(pipelines: dict[str, Pipeline], train: DataFrame) -> dict[str, PipelineModel]:
    """Fit every pipeline on the same partitions.

    Tree models draw their samples by partition, so rows are dealt by the hash of their id into
    ``partitions_for`` their number, in order of the id: a model depends on the rows, not on how they were
    read or on the session's settings.
    """
    rows = materialize(train)
    parts = partitions_for(rows.count())
    kept = rows.repartition(parts, CUSTOMER).sortWithinPartitions(CUSTOMER).persist(StorageLevel.MEMORY_AND_DISK)
    kept.count()  # fill the storage once, not in every thread

    # A boosted fit is a row of small jobs that leave a cluster idle, so the others run beside it.
    with ThreadPool(max(1, len(pipelines))) as pool:
        fitted = pool.map(inheritable_thread_target(kept.sparkSession)(lambda p: p.fit(kept)), pipelines.values(), chunksize=1)
    kept.unpersist()
    return dict(zip(pipelines, fitted, strict=True))


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _log_runs(
    log: RunLog | None, models: dict[str, PipelineModel], board: list, names: Sequence[str], experiment: str
) -> None:
    if log is None:
        return
    for row in board:
        last = models[row["model"]].stages[-1]
        params = {p.name: v for p, v in last.extractParamMap().items()}
        # A run of its own for each training, so that later ones never touch it.
        run = log.append(experiment, None, {"model": row["model"], **params}, {m: row[m] for m in names})
        save_model(models[row["model"]], f"{log.path.rstrip('/')}-models/{experiment}/{run}")


def train_ltv_models(
    train: DataFrame,
    test: DataFrame,
    pipelines: dict[str, Pipeline],
    log: RunLog | None = None,
    experiment: str = "LTV_Modeling",
) -> Training:
    """Fit each model, measure it on the test rows, log it; the lowest error is best."""
    models = _fit_all(pipelines, train)
    predictions = _stack(
        [
            m.transform(test).select(F.lit(name).alias("model"), CUSTOMER, LTV_LABEL, "prediction")
            for name, m in models.items()
        ]
    )
    scored = metrics.regression_metrics(predictions, LTV_LABEL, by=["model"])
    board = scored.withColumn("position", order_of(F.col("model"), list(models))).collect()
    return _finish(train, models, predictions, board, ("rmse", "mae", "r2"), False, log, experiment)


def train_churn_models(
    train: DataFrame,
    test: DataFrame,
    pipelines: dict[str, Pipeline],
    log: RunLog | None = None,
    experiment: str = "Churn_Modeling",
) -> Training:
    """Fit each model, measure it on the test rows, log it; the largest area under the curve is best."""
    models = _fit_all(pipelines, train)
    predictions = _stack(
        [
            m.transform(test).select(
                F.lit(name).alias("model"),
                CUSTOMER,
                F.col(CHURN_LABEL).alias("label"),
                vector_to_array("probability")[1].alias("probability"),
                F.col("prediction").cast("int").alias("prediction"),
            )
            for name, m in models.items()
        ]
    )
    scored = metrics.ranking_metrics(predictions, by=["model"])
    board = scored.withColumn("position", order_of(F.col("model"), list(models))).collect()
    return _finish(train, models, predictions, board, ("auc_roc", "avg_precision"), True, log, experiment)


def _finish(train, models, predictions, board, names, higher_is_better, log, experiment) -> Training:
    """One leaderboard row per model is all that passes through the driver."""
    schema = "model string, position int, " + ", ".join(f"{n} double" for n in names)
    rows = [(r["model"], r["position"], *[r[n] for n in names]) for r in board]
    leaderboard = train.sparkSession.createDataFrame(rows, schema)
    _log_runs(log, models, board, names, experiment)
    best = metrics.best_model(leaderboard, names[0], higher_is_better).first()
    return Training(models, predictions, leaderboard, best["model"] if best else "")


def model_features(model: PipelineModel) -> list[str]:
    return model.stages[0].getInputCols()


def _apply(customers: DataFrame, model: PipelineModel) -> DataFrame:
    """Run the model on inputs without gaps, with the caller's own columns kept aside in a struct."""
    inputs = [zero_if_missing(F.col(c)).alias(c) for c in model_features(model)]
    return model.transform(customers.select(F.struct(*customers.columns).alias("_customer"), *inputs))


def score_all_customers(
    customers: DataFrame, model: PipelineModel, threshold: float = 0.5, include_lowest: bool = False
) -> DataFrame:
    """Churn probability, predicted class and risk tier for every customer."""
    probability = vector_to_array("probability")[1].alias("Churn_Probability")
    scored = _apply(customers, model).select("_customer.*", probability)
    return with_churn_scores(scored, threshold, include_lowest)


def predict_ltv_segments(customers: DataFrame, model: PipelineModel, duplicates: str = "raise") -> DataFrame:
    """Predicted log value, value and tier for every customer."""
    scored = _apply(customers, model).select("_customer.*", F.col("prediction").alias("Predicted_LTV_Log"))
    return with_ltv_scores(scored, duplicates)
