from itertools import combinations
from math import factorial

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from patronlens.operators import attribution, estimators
from patronlens.operators.attribution import Tree, shap_importance, shap_of_trees, shap_values, shapley, trees_of


def random_tree(rng, width, depth):
    nodes = []

    def grow(level, cover):
        at = len(nodes)
        nodes.append(None)
        if level == depth or rng.random() < 0.2:
            nodes[at] = (-1, 0.0, -1, -1, float(rng.normal()), cover)
            return at
        part = rng.uniform(0.1, 0.9)
        left = grow(level + 1, cover * part)
        right = grow(level + 1, cover * (1 - part))
        nodes[at] = (int(rng.integers(width)), float(rng.normal()), left, right, 9.0, cover)
        return at

    grow(0, 100.0)
    return Tree.of(nodes)


def known(tree, row, inputs, node=0):
    """The tree's value when only ``inputs`` of the row are known."""
    f = int(tree.feature[node])
    if f < 0:
        return float(tree.value[node])
    left, right = int(tree.left[node]), int(tree.right[node])
    if f in inputs:
        return known(tree, row, inputs, left if row[f] <= tree.threshold[node] else right)
    both = [tree.cover[c] * known(tree, row, inputs, c) for c in (left, right)]
    return sum(both) / tree.cover[node]


def subsets(tree, row, width):
    """Shapley values over all sets of inputs."""
    out = []
    for i in range(width):
        others = [j for j in range(width) if j != i]
        total = 0.0
        for k in range(width):
            for some in combinations(others, k):
                weight = factorial(k) * factorial(width - 1 - k) / factorial(width)
                total += weight * (known(tree, row, {*some, i}) - known(tree, row, set(some)))
        out.append(total)
    return out


@pytest.mark.parametrize("rows", [1, 40])
def test_values_equal_all_subsets(rows):
    rng = np.random.default_rng(rows)
    for _ in range(15):
        tree = random_tree(rng, 4, 5)
        x = rng.normal(size=(rows, 4))
        values = shapley(tree, x)
        np.testing.assert_allclose(values, [subsets(tree, row, 4) for row in x], atol=1e-12)
        np.testing.assert_allclose(values.sum(axis=1) + tree.expected(), tree.predict(x), atol=1e-12)


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 5))
    y = (x[:, 0] + 2 * x[:, 1] * (x[:, 2] > 0) + rng.normal(scale=0.3, size=600)).round(6)
    rows = [(f"c{i}", *map(float, r), float(v), int(v > 0)) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "CustomerID string, a double, b double, c double, d double, e double, y double, Churned int")


SMALL = estimators.TreeSizes(5, 4, 6, 3, 6, 3, 6, 3)


def test_values_add_up_to_the_models_own_margin(spark, table, monkeypatch):
    monkeypatch.setattr(attribution, "BLOCK", 100)
    value = estimators.ltv_pipelines(table, "abcde", sizes=SMALL)
    churn = estimators.churn_pipelines(table, "abcde", sizes=SMALL)
    probability = vector_to_array("probability")[1]
    cases = [
        (value["RandomForest"], F.col("prediction")), (value["GradientBoosting"], F.col("prediction")),
        (churn["RandomForest"], probability),
    ]
    for pipeline, margin in cases:
        model = pipeline.fit(table)
        got = shap_values(table, model)
        total = sum((F.col(f"shap_{c}") for c in "abcde"), F.col("base_value"))
        both = got.join(model.transform(table).select("CustomerID", margin.alias("own")), "CustomerID")
        gaps = both.agg(F.max(F.abs(total - F.col("margin"))), F.max(F.abs(F.col("own") - F.col("margin"))), F.count("*")).first()
        assert gaps[0] < 1e-9 and gaps[1] < 1e-9 and gaps[2] == 600
    top = shap_importance(got, 3).collect()
    assert {r.feature for r in top} == {"a", "b", "c"} and top[0].mean_abs_shap >= top[1].mean_abs_shap


def test_missing_inputs_and_empty_tables(spark, table):
    model = estimators.churn_pipelines(table, "abcde", sizes=SMALL)["RandomForest"].fit(table)
    holes = table.limit(3).withColumn("a", F.lit(None).cast("double")).withColumn("b", F.lit(float("nan")))
    zeros = table.limit(3).withColumn("a", F.lit(0.0)).withColumn("b", F.lit(0.0))
    assert sorted(shap_values(holes, model).collect()) == sorted(shap_values(zeros, model).collect())
    assert shap_values(table.limit(0), model).collect() == []
    logistic = estimators.churn_pipelines(table, "abcde", sizes=SMALL)["LogisticRegression"].fit(table)
    with pytest.raises(ValueError, match="no trees"):
        trees_of(logistic)


def test_one_leaf_has_no_attribution(spark, table):
    got = shap_of_trees(table, [Tree.of([(-1, 0.0, -1, -1, 2.5, 10.0)])], ["a", "b"]).first()
    assert (got.base_value, got.margin, got.shap_a, got.shap_b) == (2.5, 2.5, 0.0, 0.0)


def test_rows_of_small_batches_share_one_block(monkeypatch):
    """The table of a leaf is made once for each block, so small Arrow batches are worked on together."""
    monkeypatch.setattr(attribution, "BLOCK", 100)
    batches = [pa.RecordBatch.from_pydict({"n": list(range(a, b))}) for a, b in ((0, 30), (30, 30), (30, 95), (95, 330), (330, 340))]
    blocks = list(attribution.blocks_of(iter(batches)))
    assert [b.num_rows for b in blocks] == [100, 100, 100, 40]
    assert [n for b in blocks for n in b.column(0).to_pylist()] == list(range(340))
    assert list(attribution.blocks_of(iter(batches[1:2]))) == []
