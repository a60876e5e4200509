"""From cleaned transactions to value tiers."""

from __future__ import annotations

from pyspark.sql import DataFrame

from patronlens.operators.estimators import (
    Training,
    TreeSizes,
    ltv_pipelines,
    predict_ltv_segments,
    train_ltv_models,
)
from patronlens.operators.ltv import LTV_FEATURES, ltv_dataset
from patronlens.operators.splits import random_split
from patronlens.sources.runlog import RunLog


def fit_value_models(
    features: DataFrame,
    names: tuple[str, ...] | None = None,
    sizes: TreeSizes | None = None,
    exclude_leaky: bool = False,
    log: RunLog | None = None,
) -> Training:
    """Split the features, fit the named models (all by default) and rank them."""
    data = ltv_dataset(features, exclude_leaky=exclude_leaky)
    train, test = random_split(data)
    wanted = [c for c in LTV_FEATURES if c in data.columns]
    made = ltv_pipelines(train, wanted, sizes=sizes)
    return train_ltv_models(train, test, {n: p for n, p in made.items() if names is None or n in names}, log)


def value_tiers(features: DataFrame, training: Training, duplicates: str = "raise") -> DataFrame:
    return predict_ltv_segments(features, training.models[training.best], duplicates)
