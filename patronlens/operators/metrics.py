"""Model metrics as aggregations over a table of predictions.

Curves are built from one row per distinct score, so a score shared by many
rows is a single row before anything is sorted. ``by`` computes the metric for
several models, or several shuffles of a column, in one pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens.functions.rounding import ratio
from patronlens.operators.ranking import running_totals

ACTIVE, CHURNED = "Active", "Churned"


def regression_metrics(
    predictions: DataFrame, label: str = "y", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """Root mean squared error, mean absolute error and R squared."""
    y = F.col(label).cast("double")
    error = y - F.col(prediction).cast("double")
    return (
        predictions.groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.sum(error * error).alias("_sse"),
            F.avg(F.abs(error)).alias("mae"),
            F.var_pop(y).alias("_var"),
        )
        .select(
            *by,
            F.sqrt(F.col("_sse") / F.col("_n")).alias("rmse"),
            "mae",
            (1 - F.try_divide(F.col("_sse"), F.col("_var") * F.col("_n"))).alias("r2"),
        )
    )


def classification_report(
    predictions: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy and both averages; 0 for 0/0."""

    def cell(actual: int, predicted: int):
        return F.count_if((F.col(label) == actual) & (F.col(prediction) == predicted))

    counts = predictions.groupBy(*by).agg(
        cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp")
    )
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def scores(hit, wrong, missed):
        precision, recall = ratio(hit, hit + wrong), ratio(hit, hit + missed)
        return precision, recall, ratio(2 * precision * recall, precision + recall), hit + missed

    active, churned = scores(tn, fn, fp), scores(tp, fp, fn)
    total = active[3] + churned[3]
    accuracy = ratio(tn + tp, total)
    macro = [(a + c) / 2 for a, c in zip(active[:3], churned[:3], strict=True)]
    weighted = [ratio(a * active[3] + c * churned[3], total) for a, c in zip(active[:3], churned[:3], strict=True)]

    def row(name, precision, recall, f1, support):
        return F.struct(
            F.lit(name).alias("class"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1_score"),
            support.alias("support"),
        )

    rows = F.array(
        row(ACTIVE, *active),
        row(CHURNED, *churned),
        row("accuracy", accuracy, accuracy, accuracy, total),
        row("macro avg", *macro, total),
        row("weighted avg", *weighted, total),
    )
    return counts.select(*by, F.inline(rows))


def _curve(predictions: DataFrame, label: str, score: str, by: Sequence[str]) -> DataFrame:
    """Per distinct score: hits and false alarms when all scores at or above it are called positive."""
    positive = F.col(label).cast("bigint")
    distinct = (
        predictions.select(*by, F.col(score).cast("double").alias("threshold"), positive.alias("_label"))
        .groupBy(*by, "threshold")
        .agg(F.sum("_label").alias("_pos"), F.sum(1 - F.col("_label")).alias("_neg"))
    )
    summed = running_totals(
        distinct,
        ["threshold"],
        {"_cum_pos": "_pos", "_cum_neg": "_neg"},
        by,
        {"_all_pos": "_pos", "_all_neg": "_neg"},
    )
    return summed.select(
        "*",
        (F.col("_all_pos") - F.col("_cum_pos") + F.col("_pos")).alias("_tp"),
        (F.col("_all_neg") - F.col("_cum_neg") + F.col("_neg")).alias("_fp"),
    )


def roc_auc(
    predictions: DataFrame, label: str = "label", score: str = "probability", by: Sequence[str] = ()
) -> DataFrame:
    """Area under the ROC curve; equal scores count half."""
    below = F.col("_cum_neg") - F.col("_neg")
    wins = F.col("_pos") * (below + F.col("_neg") / 2)
    return (
        _curve(predictions, label, score, by)
        .groupBy(*by)
        .agg(
            F.try_divide(F.sum(wins), (F.max("_all_pos") * F.max("_all_neg")).cast("double")).alias("roc_auc")
        )
    )


def average_precision(
    predictions: DataFrame, label: str = "label", score: str = "probability", by: Sequence[str] = ()
) -> DataFrame:
    """Sum over thresholds of the recall step times the precision, without interpolation."""
    step = ratio(F.col("_pos"), F.col("_all_pos")) * ratio(F.col("_tp"), F.col("_tp") + F.col("_fp"))
    return _curve(predictions, label, score, by).groupBy(*by).agg(F.sum(step).alias("avg_precision"))


def ranking_metrics(
    predictions: DataFrame, label: str = "label", score: str = "probability", by: Sequence[str] = ()
) -> DataFrame:
    """Both areas from one pass over the curve."""
    below = F.col("_cum_neg") - F.col("_neg")
    wins = F.col("_pos") * (below + F.col("_neg") / 2)
    step = ratio(F.col("_pos"), F.col("_all_pos")) * ratio(F.col("_tp"), F.col("_tp") + F.col("_fp"))
    return (
        _curve(predictions, label, score, by)
        .groupBy(*by)
        .agg(
            F.try_divide(F.sum(wins), (F.max("_all_pos") * F.max("_all_neg")).cast("double")).alias("auc_roc"),
            F.sum(step).alias("avg_precision"),
        )
    )


def roc_points(
    predictions: DataFrame, label: str = "label", score: str = "probability", by: Sequence[str] = ()
) -> DataFrame:
    """False- and true-positive rate per threshold, from (0, 0) at an infinite threshold."""
    curve = _curve(predictions, label, score, by).select(
        *by,
        ratio(F.col("_fp"), F.col("_all_neg")).alias("fpr"),
        ratio(F.col("_tp"), F.col("_all_pos")).alias("tpr"),
        "threshold",
    )
    corner = [F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"), F.lit(float("inf")).alias("threshold")]
    models = curve.select(*by).distinct() if by else predictions.sparkSession.range(1)
    return curve.unionByName(models.select(*by, *corner))


def pr_points(
    predictions: DataFrame, label: str = "label", score: str = "probability", by: Sequence[str] = ()
) -> DataFrame:
    """Precision and recall per threshold, with the end point (1, 0) that has none."""
    curve = _pr_curve(predictions, label, score, by)
    end = [F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"), F.lit(None).cast("double").alias("threshold")]
    models = curve.select(*by).distinct() if by else predictions.sparkSession.range(1)
    return curve.unionByName(models.select(*by, *end))


def _pr_curve(predictions: DataFrame, label: str, score: str, by: Sequence[str]) -> DataFrame:
    return _curve(predictions, label, score, by).select(
        *by,
        ratio(F.col("_tp"), F.col("_tp") + F.col("_fp")).alias("precision"),
        ratio(F.col("_tp"), F.col("_all_pos")).alias("recall"),
        "threshold",
    )


def tune_threshold(
    predictions: DataFrame,
    target_recall: float = 0.75,
    label: str = "label",
    score: str = "probability",
    by: Sequence[str] = (),
) -> DataFrame:
    """The threshold of highest precision among those that reach the recall (ties: lowest).

    0.5 with null precision and recall when none reaches it.
    """
    reached = F.col("recall") >= target_recall
    best = F.min(
        F.when(reached, F.struct((-F.col("precision")).alias("less"), F.col("threshold"), F.col("recall")))
    )
    return (
        _pr_curve(predictions, label, score, by)
        .groupBy(*by)
        .agg(best.alias("_best"))
        .select(
            *by,
            F.coalesce("_best.threshold", F.lit(0.5)).alias("threshold"),
            (-F.col("_best.less")).alias("precision"),
            F.col("_best.recall").alias("recall"),
        )
    )


def best_model(leaderboard: DataFrame, metric: str, higher_is_better: bool) -> DataFrame:
    """The best row of a leaderboard with a ``position`` column; the first wins ties.

    For a metric where higher is better a model must beat 0.
    """
    if higher_is_better:
        return leaderboard.filter(F.col(metric) > 0).orderBy(F.desc(metric), "position").limit(1)
    return leaderboard.filter(F.col(metric).isNotNull()).orderBy(metric, "position").limit(1)
