"""From cleaned transactions to churn risk tiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens.operators.churn import CHURN_FEATURES, churn_dataset
from patronlens.operators.estimators import (
    CHURN_LABEL,
    Training,
    TreeSizes,
    churn_pipelines,
    score_all_customers,
    train_churn_models,
)
from patronlens.operators.features import customer_features
from patronlens.operators.metrics import tune_threshold
from patronlens.operators.splits import stratified_split
from patronlens.sources.runlog import RunLog


def fit_churn_models(
    lines: DataFrame,
    churn_days: int = 90,
    names: tuple[str, ...] | None = None,
    sizes: TreeSizes | None = None,
    exclude_leaky: bool = False,
    log: RunLog | None = None,
) -> Training:
    """Label, split, fit the named models (all by default) and rank them."""
    data = churn_dataset(customer_features(lines, churn_days), exclude_leaky=exclude_leaky)
    train, test = stratified_split(data, CHURN_LABEL)
    wanted = [c for c in CHURN_FEATURES if c in data.columns]
    made = churn_pipelines(train, wanted, sizes=sizes)
    return train_churn_models(train, test, {n: p for n, p in made.items() if names is None or n in names}, log)


def risk_tiers(features: DataFrame, training: Training, target_recall: float = 0.75) -> DataFrame:
    """Score every customer with the best model at its tuned threshold."""
    best = training.predictions.filter(F.col("model") == training.best)
    threshold = tune_threshold(best, target_recall).first()["threshold"]
    return score_all_customers(features, training.models[training.best], threshold)
