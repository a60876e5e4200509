"""Experiment runs as an append-only table, and fitted models on storage."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlens.schema import RUN_LOG

# Experiment names.
EXPERIMENTS = {"ltv": "LTV_Modeling", "churn": "Churn_Modeling", "segmentation": "Customer_Segmentation"}
DEFAULT_EXPERIMENT = "Default"


def experiment_name(key: str) -> str:
    return EXPERIMENTS.get(key, DEFAULT_EXPERIMENT)


class RunLog:
    """Rows (experiment, run, kind, key, value) in a parquet table."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def append(
        self,
        experiment: str,
        run: str | None = None,
        params: Mapping[str, object] | None = None,
        metrics: Mapping[str, float] | None = None,
    ) -> str:
        """Log one run in one write; returns its name."""
        run = run or uuid.uuid4().hex
        rows = [(experiment, run, "param", k, str(v)) for k, v in (params or {}).items()]
        rows += [(experiment, run, "metric", k, repr(float(v))) for k, v in (metrics or {}).items()]
        if rows:
            self.spark.createDataFrame(rows, RUN_LOG).coalesce(1).write.mode("append").parquet(self.path)
        return run

    def append_frame(self, experiment: str, run: str, kind: str, row: DataFrame) -> None:
        """Log every column of a small result as text, without passing through the driver."""
        pairs = F.array(
            *[
                F.struct(F.lit(c).alias("key"), F.col(f"`{c}`").cast("string").alias("value"))
                for c in row.columns
            ]
        )
        logged = row.select(F.inline(pairs)).select(
            F.lit(experiment).alias("experiment"), F.lit(run).alias("run"), F.lit(kind).alias("kind"), "key", "value"
        )
        logged.write.mode("append").parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(RUN_LOG).parquet(self.path)

    def metric_table(self, experiment: str) -> DataFrame:
        """One row per run and metric, as numbers."""
        return (
            self.read()
            .filter((F.col("experiment") == experiment) & (F.col("kind") == "metric"))
            .select("run", "key", F.col("value").cast("double").alias("value"))
        )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
