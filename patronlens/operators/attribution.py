"""Shapley values of tree models, row by row.

What a tree gives for a set of known inputs follows the known ones and averages over both sides of a
split on an unknown one, by the training rows that went either way. For one leaf this is its value
times a factor for each input on its path: 1 or 0 for a known one, as the row meets
all of the path's conditions on it or not, and for an unknown one the share of rows that do. The
Shapley values of such a product need only the coefficients of one polynomial, and they depend on
a row by which inputs it meets alone. So each leaf has a small table, by pattern, and rows look theirs up.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from patronlens.functions.rounding import zero_if_missing
from patronlens.operators.estimators import model_features
from patronlens.schema import CUSTOMER
from patronlens.session import scratch_path

#: Rows that are worked on at once. The table of a leaf is made once for each block and costs as much as some 10,000 look-ups.
BLOCK = 1 << 15


@dataclass(frozen=True)
class Tree:
    """One tree as arrays by node, the root first. A leaf has feature -1. ``cover`` is the weight of training rows."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    cover: np.ndarray

    @classmethod
    def of(cls, nodes: Sequence[tuple[int, float, int, int, float, float]]) -> Tree:
        columns = list(zip(*nodes, strict=True))
        kinds = (np.int64, np.float64, np.int64, np.int64, np.float64, np.float64)
        return cls(*(np.array(c, k) for c, k in zip(columns, kinds, strict=True)))

    def predict(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        while (inner := self.feature[node] >= 0).any():
            row = np.flatnonzero(inner)
            at = node[row]
            goes_left = x[row, self.feature[at]] <= self.threshold[at]
            node[row] = np.where(goes_left, self.left[at], self.right[at])
        return self.value[node]

    def expected(self) -> float:
        """Mean over the training rows."""
        leaf = self.feature < 0
        return float((self.value * self.cover)[leaf].sum() / self.cover[0])


def leaf_table(shares: np.ndarray, patterns: np.ndarray) -> np.ndarray:
    """Shapley values of a leaf of value 1, by pattern (rows) and input on its path (columns).

    ``shares`` are the factors of unknown inputs, ``patterns`` the factors, 1 or 0, of known ones.
    """
    m = len(shares)
    poly = np.zeros((len(patterns), m + 1))
    poly[:, 0] = 1.0
    for j in range(m):
        shifted = np.zeros_like(poly)
        shifted[:, 1:] = poly[:, :-1] * patterns[:, j : j + 1]
        poly = poly * shares[j] + shifted
    weight = np.array([factorial(k) * factorial(m - 1 - k) / factorial(m) for k in range(m)])
    out = np.empty((len(patterns), m))
    for i in range(m):
        # The polynomial without input i: divided by (share + y) where it is met, else by the share.
        rest = np.zeros((len(patterns), m))
        carry = np.zeros(len(patterns))
        for k in range(m - 1, -1, -1):
            carry = poly[:, k + 1] - shares[i] * carry
            rest[:, k] = carry
        rest = np.where(patterns[:, i : i + 1] > 0, rest, poly[:, :m] / shares[i])
        out[:, i] = (patterns[:, i] - shares[i]) * (rest @ weight)
    return out


def shapley(tree: Tree, x: np.ndarray) -> np.ndarray:
    """Shapley values (rows, inputs) of one tree; with the expected value they add up to the prediction."""
    columns = np.ascontiguousarray(x.T)
    out = np.zeros(columns.shape)
    # By node: the share of unknown rows by input on its path, and a bit by input for the conditions that a row meets.
    stack: list[tuple[int, dict[int, float], np.ndarray]] = [(0, {}, np.zeros(len(x), np.int64))]
    while stack:
        node, path, code = stack.pop()
        f = int(tree.feature[node])
        if f >= 0:
            goes_left = columns[f] <= tree.threshold[node]
            bit = list(path).index(f) if f in path else len(path)
            for child, goes in ((int(tree.left[node]), goes_left), (int(tree.right[node]), ~goes_left)):
                if tree.cover[child] > 0:
                    part = tree.cover[child] / tree.cover[node]
                    met = goes.astype(np.int64) << bit
                    met = code & (met | ~(1 << bit)) if f in path else code | met
                    stack.append((child, {**path, f: path.get(f, 1.0) * part}, met))
        elif path and tree.value[node] != 0:
            shares = np.array(list(path.values()))
            if 1 << len(path) <= len(x):
                used, at = np.arange(1 << len(path)), code
            else:
                used, at = np.unique(code, return_inverse=True)
            patterns = (used[:, None] >> np.arange(len(path)) & 1).astype(np.float64)
            values = np.ascontiguousarray((tree.value[node] * leaf_table(shares, patterns)).T)
            for i, value in zip(path, values, strict=True):
                out[i] += value.take(at)
    return out.T


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of ``BLOCK`` and a last one."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, BLOCK - sum(b.num_rows for b in held))
            held.append(part)
            batch = batch.slice(part.num_rows)
            if sum(b.num_rows for b in held) == BLOCK:
                yield pa.concat_batches(held)
                held = []
    if held:
        yield pa.concat_batches(held)


def saved_trees(stage) -> list[list[Row]]:
    """The nodes of each tree of a fitted stage, by number, read from a saved copy; the driver holds as many as the model has."""
    spark = SparkSession.getActiveSession()
    path = scratch_path(spark, "trees")
    stage.write().save(path)
    trees: list[list[Row]] = [[] for _ in stage.treeWeights]
    for n in spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").orderBy("treeID", "id").collect():
        trees[n["treeID"]].append(n)
    return trees


def trees_of(model: PipelineModel) -> list[Tree]:
    """The trees of the last stage of ``model``, their values scaled so that they add up to its margin.

    The margin is the prediction of a regressor, the probability of class 1 of a forest of
    classifiers, and the raw score of boosted classifiers.
    """
    stage = model.stages[-1]
    kind = type(stage).__name__
    if not hasattr(stage, "treeWeights"):
        raise ValueError(f"{kind} has no trees")
    forest = "RandomForest" in kind
    classes = kind == "RandomForestClassificationModel"
    weights = stage.treeWeights
    rows: list[list[tuple]] = [[] for _ in weights]
    for n in (n for nodes in saved_trees(stage) for n in nodes):
        stats, split = n["impurityStats"], n["split"]
        inner = n["leftChild"] >= 0
        if inner and split["numCategories"] >= 0:
            raise ValueError("splits on categories are not supported")
        weight = 1.0 / len(weights) if forest else weights[n["treeID"]]
        value = stats[1] / sum(stats) if classes else n["prediction"]
        feature, threshold = (split["featureIndex"], split["leftCategoriesOrThreshold"][0]) if inner else (-1, 0.0)
        # Nodes are numbered from the root of each tree, parents before children.
        rows[n["treeID"]].append(
            (feature, threshold, n["leftChild"], n["rightChild"], weight * value, sum(stats) if classes else stats[0])
        )
    return [Tree.of(r) for r in rows]


def shap_of_trees(data: DataFrame, trees: Sequence[Tree], features: Sequence[str], unique: str = CUSTOMER) -> DataFrame:
    """(unique, base_value, margin, one column ``shap_`` per feature) for each row of ``data``.

    Missing inputs count as 0. ``base_value`` plus the row's Shapley values is its ``margin``. An empty table gives none.
    """
    base = sum(tree.expected() for tree in trees)
    names = [unique, "base_value", "margin", *[f"shap_{f}" for f in features]]

    def explain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks_of(batches):
            x = np.stack([batch.column(n + 1).to_numpy(zero_copy_only=False) for n in range(len(features))], axis=1)
            values, margin = np.zeros(x.shape), np.zeros(len(x))
            for tree in trees:
                values += shapley(tree, x)
                margin += tree.predict(x)
            columns = [pa.array(np.full(len(x), base)), pa.array(margin), *map(pa.array, values.T.copy())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    kind = data.schema[unique].dataType.simpleString()
    schema = ", ".join([f"`{unique}` {kind}", *[f"`{n}` double" for n in names[1:]]])
    inputs = [zero_if_missing(F.col(c).cast("double")).alias(c) for c in features]
    return data.select(unique, *inputs).mapInArrow(explain, schema)


def shap_values(data: DataFrame, model: PipelineModel, unique: str = CUSTOMER) -> DataFrame:
    """``shap_of_trees`` for a fitted pipeline whose last stage is a forest or boosted trees on its first stage's inputs."""
    return shap_of_trees(data, trees_of(model), model_features(model), unique)


def shap_importance(values: DataFrame, top: int = 15) -> DataFrame:
    """(feature, mean_abs_shap): the inputs that move the margin most, largest first, in one pass."""
    names = [c for c in values.columns if c.startswith("shap_")]
    means = values.agg(*[F.avg(F.abs(F.col(f"`{c}`"))).alias(c) for c in names])
    rows = [F.struct(F.lit(c.removeprefix("shap_")).alias("feature"), F.col(f"`{c}`").alias("mean_abs_shap")) for c in names]
    return means.select(F.inline(F.array(*rows))).orderBy(F.desc("mean_abs_shap"), "feature").limit(top)
