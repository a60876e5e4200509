"""Which inputs a model relies on."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlens.operators import permutation
from patronlens.operators.estimators import model_features
from patronlens.operators.metrics import roc_auc
from patronlens.operators.ranking import global_rank
from patronlens.schema import CUSTOMER

SEED = 42


def feature_importance(spark: SparkSession, model: PipelineModel, top: int = 20) -> DataFrame:
    """Importance per feature of a tree model, largest first; no rows for other models."""
    fitted = model.stages[-1]
    values = fitted.featureImportances.toArray() if hasattr(fitted, "featureImportances") else []
    rows = [(name, float(v)) for name, v in zip(model_features(model), values)]
    frame = spark.createDataFrame(rows, "feature string, importance double")
    return frame.orderBy(F.desc("importance"), "feature").limit(top)


def feature_attribution(
    data: DataFrame,
    model: PipelineModel,
    label: str = "Churned",
    repeats: int = 5,
    top: int = 15,
    seed: int = SEED,
    unique: str = CUSTOMER,
) -> DataFrame:
    """Mean drop of the area under the ROC curve when one input is shuffled.

    Permutation importance, not Shapley values. In each repeat every row gets a
    donor row: the row whose position by id equals the receiver's position by a
    seeded hash, so the shuffle is one equi-join on unique positions. A forest for two classes
    scores a row with each of its inputs exchanged in turn (``permutation``). For other models
    each row appears once per feature, with that feature taken from its donor.
    Either way all areas come from a single pass.
    """
    features = model_features(model)
    rows = data.select(unique, F.col(label).alias("label"), *features)
    forest = permutation.forest_of(model)
    if forest is None:
        areas = _areas_of_variants(rows, model, features, repeats, seed, unique)
    else:
        areas = permutation.exchanged_areas(rows, model, forest, features, repeats, seed, unique)
    intact = roc_auc(model.transform(rows).select("label", vector_to_array("probability")[1].alias("probability"))).scalar()
    drop = intact - F.col("roc_auc")
    return (
        areas.groupBy("feature")
        .agg(F.avg(drop).alias("auc_drop"), F.coalesce(F.stddev_samp(drop), F.lit(0.0)).alias("auc_drop_std"))
        .orderBy(F.desc("auc_drop"), "feature")
        .limit(top)
    )


def _areas_of_variants(
    rows: DataFrame, model: PipelineModel, features: Sequence[str], repeats: int, seed: int, unique: str
) -> DataFrame:
    """(repeat, feature, roc_auc) for any model: each row once per feature and repeat, scored as a row of its own."""
    donors = global_rank(rows.select(unique, *features), [unique], "_position").select(
        "_position", F.struct(*features).alias("_donor")
    )

    def shuffled(repeat: int) -> DataFrame:
        keyed = rows.withColumn("_hash", F.xxhash64(F.col(unique), F.lit(seed + repeat)))
        paired = global_rank(keyed, ["_hash", unique], "_position").join(donors, "_position")
        variants = F.array(
            *[
                F.struct(
                    F.lit(changed).alias("feature"),
                    *[(F.col(f"_donor.{c}") if c == changed else F.col(c)).alias(c) for c in features],
                )
                for changed in features
            ]
        )
        return paired.select(F.lit(repeat).alias("repeat"), "label", F.inline(variants))

    variants = model.transform(reduce(DataFrame.unionByName, [shuffled(i) for i in range(repeats)]))
    return roc_auc(variants.select("repeat", "feature", "label", vector_to_array("probability")[1].alias("probability")), by=["repeat", "feature"])
