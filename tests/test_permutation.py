import numpy as np
import pytest
from pyspark.sql import functions as F

from patronlens.operators import estimators, importance, permutation

INPUTS = "abcd"


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(900, 4)).round(1)  # coarse, so that rows share scores and lie on thresholds
    x[:, 3] = 7.0
    y = (x[:, 0] + x[:, 1] * (x[:, 2] > 0) + rng.normal(scale=0.4, size=900) > 0).astype(int)
    rows = [(f"c{i}", *map(float, r), int(v)) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "CustomerID string, a double, b double, c double, d double, Churned int")


@pytest.fixture(scope="module")
def pipelines(table):
    return estimators.churn_pipelines(table, INPUTS, sizes=estimators.TreeSizes(7, 8, 1, 1, 1, 1, 2, 2))


@pytest.fixture(scope="module")
def model(table, pipelines):
    return pipelines["RandomForest"].fit(table)


def test_scores_are_the_models_own(spark, table, model):
    forest = permutation.forest_of(model)
    assert forest.words > 1
    pdf = table.toPandas()
    x = pdf[list(INPUTS)].to_numpy().T
    donor = np.roll(x, 13, axis=1)
    got = permutation.Scorer(forest).exchanged(forest.codes(x), forest.codes(donor))
    for i, name in enumerate(INPUTS):
        changed = spark.createDataFrame(pdf.assign(**{name: donor[i]}))
        own = {r.CustomerID: r.probability[1] for r in model.transform(changed).collect()}
        assert [own[c] for c in pdf.CustomerID] == got[i].tolist()


@pytest.mark.parametrize("size", [64, 1 << 16])
def test_areas_equal_those_of_a_row_for_each_variant(table, model, monkeypatch, size):
    """No row for each variant is made, and however many ranges the scores meet in, the areas are the same."""
    monkeypatch.setattr(permutation, "RANGE", size)
    monkeypatch.setattr(permutation, "BOUNDS_FROM", 200)
    label = F.when(F.col("CustomerID") != "c5", F.col("Churned")).alias("label")
    rows = table.select("CustomerID", label, *INPUTS)
    args = (list(INPUTS), 3, 11, "CustomerID")
    areas = permutation.exchanged_areas(rows, model, permutation.forest_of(model), *args)
    plain = importance._areas_of_variants(rows, model, *args)
    found = {(r.repeat, r.feature): r.roc_auc for r in areas.collect()}
    assert found == {(r.repeat, r.feature): r.roc_auc for r in plain.collect()} and len(found) == 12
    plan = areas._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate inline" not in plan


def test_no_rows_one_class_and_gaps(table, model):
    forest = permutation.forest_of(model)
    rows = table.withColumnRenamed("Churned", "label")
    areas = lambda data: permutation.exchanged_areas(data, model, forest, list(INPUTS), 2, 1).collect()
    assert areas(rows.limit(0)) == []
    assert [r.roc_auc for r in areas(rows.filter("label = 1"))] == [None] * 8
    with pytest.raises(Exception, match="(?i)null|nan"):
        importance.feature_attribution(table.withColumn("a", F.lit(None).cast("double")), model).collect()


def test_other_models_score_each_variant(table, pipelines, model, monkeypatch):
    logistic = pipelines["LogisticRegression"].fit(table)
    boosted = pipelines["SampledBoosting"].fit(table)
    assert permutation.forest_of(logistic) is None and permutation.forest_of(boosted) is None
    assert importance.feature_attribution(table, logistic, repeats=1).first().feature == "a"
    usual = importance.feature_attribution(table, model, repeats=2).collect()
    monkeypatch.setattr(permutation, "MOST_LEAVES", 1)
    assert permutation.forest_of(model) is None
    plain = importance.feature_attribution(table, model, repeats=2).collect()
    assert [r.feature for r in usual] == [r.feature for r in plain]
    assert [r.auc_drop for r in usual] == pytest.approx([r.auc_drop for r in plain], abs=1e-12)
