"""Gaussian mixture with full covariances, fitted by expectation and maximisation from given groups.

A round is one pass and one small aggregation: each task weighs its rows by the
components' current densities and hands on weighted counts, sums and products about the
current means; the sums over all tasks give the next parameters. The driver sees these
sums only, some numbers per component whatever the number of rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Added to the variances, so that a component of equal rows keeps a density.
VARIANCE_FLOOR = 1e-6
#: A fit ends when the mean log-likelihood of a row gains less than this.
TOLERANCE = 1e-3


@dataclass(frozen=True)
class Mixture:
    """Weights (k), means (k, d) and covariances (k, d, d), with the course of the fit."""

    weights: np.ndarray
    means: np.ndarray
    covariances: np.ndarray
    rows: int = 0
    #: Log-likelihood of all rows under the parameters before each round and, last, under the final ones.
    course: tuple[float, ...] = ()
    converged: bool = False

    @property
    def log_likelihood(self) -> float:
        return self.course[-1]

    @property
    def free_parameters(self) -> int:
        k, d = self.means.shape
        return k * d + k * d * (d + 1) // 2 + k - 1

    @property
    def bic(self) -> float:
        return self.free_parameters * math.log(max(self.rows, 1)) - 2 * self.log_likelihood

    @property
    def aic(self) -> float:
        return 2 * self.free_parameters - 2 * self.log_likelihood

    def whiteners(self) -> tuple[np.ndarray, np.ndarray]:
        """Upper factors U of the inverse covariances (U U' = inverse), and the logs of weight times scale."""
        lower = np.linalg.cholesky(self.covariances)
        factors = np.linalg.inv(lower).transpose(0, 2, 1)
        with np.errstate(divide="ignore"):
            logs = np.log(self.weights) + np.log(np.diagonal(factors, axis1=1, axis2=2)).sum(axis=1)
        return factors, logs - 0.5 * self.means.shape[1] * math.log(2 * math.pi)

    def log_densities(self, rows: np.ndarray) -> np.ndarray:
        """(rows, k): log of weight times density."""
        factors, logs = self.whiteners()
        return np.stack([logs[c] - 0.5 * (((rows - self.means[c]) @ factors[c]) ** 2).sum(axis=1) for c in range(len(logs))], axis=1)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _sums(rows: np.ndarray, shares: np.ndarray, about: np.ndarray) -> np.ndarray:
    """(k, 1 + d + d * d): count, sum and products about ``about`` of the rows, by the shares of each component."""
    out = []
    for c, centre in enumerate(about):
        off = rows - centre
        weighed = off * shares[:, c, None]
        out.append(np.concatenate([[shares[:, c].sum()], weighed.sum(axis=0), (weighed.T @ off).ravel()]))
    return np.array(out)


def _pass(rows: DataFrame, vector: str, label: str | None, model: Mixture) -> tuple[np.ndarray, float, int]:
    """Sums of one pass over all rows, their log-likelihood and number. With ``label`` rows belong to that group alone."""
    k, d = model.means.shape
    width = 1 + d + d * d

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, likelihood, count = np.zeros((k, width)), 0.0, 0
        for batch in batches:
            points = _matrix(batch.column(0), d)
            if label is not None:
                shares = (batch.column(1).to_numpy()[:, None] == np.arange(k)).astype(float)
            else:
                logs = model.log_densities(points)
                top = logs.max(axis=1, keepdims=True) if len(logs) else logs[:, :1]
                shares = np.exp(logs - top)
                whole = shares.sum(axis=1, keepdims=True)
                likelihood += float((top + np.log(whole)).sum())
                shares /= whole
            sums += _sums(points, shares, model.means)
            count += len(points)
        values = np.concatenate([sums.ravel(), [likelihood, count]])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], ["place", "value"])

    columns = [vector] if label is None else [vector, label]
    parts = rows.select(*columns).mapInArrow(work, "place bigint, value double")
    found = parts.groupBy("place").agg(F.sum("value").alias("value")).orderBy("place").collect()
    values = np.array([r["value"] for r in found]) if found else np.zeros(k * width + 2)
    return values[:-2].reshape(k, width), float(values[-2]), int(values[-1])


def _maximised(sums: np.ndarray, about: np.ndarray, floor: float) -> Mixture:
    k, d = about.shape
    # An empty component keeps a vanishing weight.
    counts = sums[:, 0] + 10 * np.finfo(float).eps
    shift = sums[:, 1 : 1 + d] / counts[:, None]
    products = sums[:, 1 + d :].reshape(k, d, d) / counts[:, None, None]
    covariances = products - shift[:, :, None] * shift[:, None, :]
    covariances = (covariances + covariances.transpose(0, 2, 1)) / 2 + floor * np.eye(d)
    return Mixture(counts / counts.sum(), about + shift, covariances)


def fit_mixture(
    rows: DataFrame,
    vector: str,
    label: str,
    centres: np.ndarray,
    max_iter: int = 100,
    tol: float = TOLERANCE,
    floor: float = VARIANCE_FLOOR,
) -> Mixture:
    """The mixture that starts from the groups ``label`` (0 to k - 1) around ``centres``.

    ``vector`` is an array of doubles without nulls. ``rows`` are read once a round and
    should be stored. Each round's likelihood is at least that of the round before, up to the
    effect of ``floor``. A table without rows gives the given centres.
    """
    start = Mixture(np.full(len(centres), 1 / len(centres)), np.asarray(centres, float), np.tile(np.eye(np.shape(centres)[1]), (len(centres), 1, 1)))
    sums, _, count = _pass(rows, vector, label, start)
    model = _maximised(sums, start.means, floor) if count else start
    course: list[float] = []
    converged = count == 0
    for _ in range(max_iter if count else 0):
        sums, likelihood, _ = _pass(rows, vector, None, model)
        model = _maximised(sums, model.means, floor)
        course.append(likelihood)
        if len(course) > 1 and abs(course[-1] - course[-2]) < tol * count:
            converged = True
            break
    last = _pass(rows, vector, None, model)[1]
    return Mixture(model.weights, model.means, model.covariances, count, (*course, last), converged)


def membership(model: Mixture, vector: Column) -> Column:
    """Struct of a row's likeliest component, the smallest in ties, and its probability."""
    factors, logs = model.whiteners()
    d = model.means.shape[1]
    values = []
    for c, mean in enumerate(model.means):
        off = [F.get(vector, F.lit(i)) - float(mean[i]) for i in range(d)]
        lengths = [sum((off[i] * float(factors[c, i, j]) for i in range(j + 1)), F.lit(0.0)) for j in range(d)]
        values.append(F.lit(float(logs[c])) - 0.5 * sum((x * x for x in lengths), F.lit(0.0)))

    def answer(all_: Column) -> Column:
        top = F.array_max(all_)
        whole = F.aggregate(all_, F.lit(0.0), lambda total, x: total + F.exp(x - top))
        return F.struct((F.array_position(all_, top) - 1).cast("int").alias("component"), (1 / whole).alias("probability"))

    return F.transform(F.array(F.array(*values)), answer)[0]


def parameter_table(model: Mixture, df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(component, weight, row, mean, column, covariance): the parameters as rows, for use in SQL."""
    cells = [
        (c, float(model.weights[c]), a, float(model.means[c, i]), b, float(model.covariances[c, i, j]))
        for c in range(len(model.weights))
        for i, a in enumerate(names)
        for j, b in enumerate(names)
    ]
    schema = "component int, weight double, row string, mean double, column string, covariance double"
    return df.sparkSession.createDataFrame(cells, schema)
