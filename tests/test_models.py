"""Properties of fitted models, metrics, scores and plans."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from patronlens.functions.gamma import digamma, ln_gamma, trigamma
from patronlens.functions.hypergeometric import hyp2f1
from patronlens.operators import buytilldie, clustering, estimators, features, importance, metrics, ranking, rfm
from patronlens.plans import lifetime, retention
from patronlens.session import scratch_path
from patronlens.sources import runlog
from workload import inputs

SMALL = estimators.TreeSizes(10, 4, 5, 3, 5, 3, 5, 3)


@pytest.fixture(scope="module")
def lines(spark, tiny):
    return inputs.clean(spark, tiny).cache()


@pytest.fixture(scope="module")
def made(lines):
    return features.customer_features(lines).cache()


def test_metrics_on_ties(spark):
    rows = list(zip([1, 1, 0, 1, 0, 1, 0], [0.9, 0.8, 0.8, 0.6, 0.5, 0.4, 0.3]))
    df = spark.createDataFrame(rows, "label int, probability double")
    both = metrics.ranking_metrics(df).first()
    assert (round(both.auc_roc, 6), round(both.avg_precision, 6)) == (0.708333, 0.770833)
    assert metrics.tune_threshold(df, 1.1).first()["threshold"] == 0.5
    assert metrics.tune_threshold(df, 0.25).first()["threshold"] == 0.9
    assert metrics.roc_points(df).filter("threshold = double('Infinity')").first()["tpr"] == 0.0


def test_best_model_takes_the_first_of_equals(spark):
    board = spark.createDataFrame([("a", 0, 0.7), ("b", 1, 0.7), ("c", 2, 0.0)], "model string, position int, m double")
    assert metrics.best_model(board, "m", True).first()["model"] == "a"
    assert metrics.best_model(board, "m", False).first()["model"] == "c"


def test_log_gamma(spark):
    values = [0.001, 0.3, 1.0, 2.5, 40.0, 5000.0]
    df = spark.createDataFrame([(v,) for v in values], "z double").select(ln_gamma("z").alias("g"))
    for value, row in zip(values, df.collect()):
        assert row.g == pytest.approx(math.lgamma(value), abs=1e-10)


def test_hypergeometric_series():
    z = np.array([0.0, 0.3, 0.9])
    # 2F1(1, 1; 2; z) = -ln(1 - z) / z
    got = hyp2f1(1.0, 1.0, np.full(3, 2.0), z)
    assert got[0] == 1.0
    assert got[1:] == pytest.approx(-np.log(1 - z[1:]) / z[1:], rel=1e-11)


def test_purchase_model_recovers_parameters(spark):
    rng = np.random.default_rng(8)
    r, alpha, a, b, n = 1.5, 30.0, 0.9, 2.5, 4000
    rate, drop, age = rng.gamma(r, 1 / alpha, n), rng.beta(a, b, n), rng.integers(200, 400, n)
    rows = []
    for lam, p, end in zip(rate, drop, age):
        t, last, count = 0.0, 0.0, 0
        while True:
            t += rng.exponential(1 / lam)
            if t > end:
                break
            last, count = t, count + 1
            if rng.random() < p:
                break
        rows.append((count, float(last), float(end)))
    df = spark.createDataFrame(rows, "frequency bigint, recency double, T double")
    fit = buytilldie.fit_bgnbd(df, penalty=0.0)
    assert max(map(abs, fit.gradient)) < 1e-8 and fit.converged
    assert fit.params["r"] == pytest.approx(r, rel=0.2)
    assert fit.params["alpha"] == pytest.approx(alpha, rel=0.25)
    mean_drop = fit.params["a"] / (fit.params["a"] + fit.params["b"])
    assert mean_drop == pytest.approx(a / (a + b), rel=0.25)


def test_derivatives_equal_differences(spark, lines):
    """Gradient and the whole curvature, mixed terms too, against differences of the mean log-likelihood."""
    summary = buytilldie.rfm_t_summary(lines)
    cases = [
        (buytilldie.bgnbd_input(summary, 1e-3), buytilldie.bgnbd_loglik, buytilldie.bgnbd_derivatives, dict(r=0.7, alpha=0.3, a=0.6, b=1.9)),
        (buytilldie.gamma_gamma_input(summary).withColumn("m", F.col("m") / 1e5), buytilldie.gamma_gamma_loglik,
         buytilldie.gamma_gamma_derivatives, dict(p=2.5, q=3.5, v=0.4)),
    ]
    for data, loglik, derivatives, params in cases:
        names, h = list(params), 1e-3
        each = derivatives(data, params)
        got = each.agg(*[F.avg(c).alias(c) for c in each.columns]).first()
        shifts = [(i, j, a, b) for i in range(len(names)) for j in range(i, len(names)) for a in (-1, 1) for b in (-1, 1)]
        moved = [{n: v * (1 + h * (a * (k == i) + b * (k == j))) for k, (n, v) in enumerate(params.items())} for i, j, a, b in shifts]
        means = {r.candidate: r.m for r in loglik(data, [params, *moved]).groupBy("candidate").agg(F.avg("loglik").alias("m")).collect()}
        assert got["loglik"] == pytest.approx(means[0], abs=1e-10)
        for i, one in enumerate(names):
            for j, two in enumerate(names[i:], i):
                value = sum(a * b * means[1 + n] for n, (x, y, a, b) in enumerate(shifts) if (x, y) == (i, j))
                value /= 4 * h * h * params[one] * params[two]
                assert got[f"h_{one}_{two}"] == pytest.approx(value, rel=1e-3, abs=1e-4)
            both = {a: means[1 + n] for n, (x, y, a, b) in enumerate(shifts) if (x, y, a) == (i, i, b)}
            assert got[f"g_{one}"] == pytest.approx((both[1] - both[-1]) / (4 * h * params[one]), rel=1e-3, abs=1e-5)


def test_derivatives_of_log_gamma(spark):
    x = [1e-3, 0.1, 0.5, 1.0, 1.5, 7.3, 100.0, 1e6]
    df = spark.createDataFrame([(v,) for v in x], "x double").coalesce(1)
    got = df.select(digamma("x").alias("d"), trigamma("x").alias("t"), digamma("x + 1D").alias("d1"), trigamma("x + 1D").alias("t1")).collect()
    assert got[3].d == pytest.approx(-0.5772156649015329, abs=1e-12) and got[3].t == pytest.approx(math.pi**2 / 6, abs=1e-12)
    assert got[2].d == pytest.approx(-0.5772156649015329 - 2 * math.log(2), abs=1e-12) and got[2].t == pytest.approx(math.pi**2 / 2, abs=1e-12)
    for v, row in zip(x, got):
        assert row.d1 - row.d == pytest.approx(1 / v, rel=1e-9) and row.t - row.t1 == pytest.approx(1 / v**2, rel=1e-9, abs=1e-13)


def test_ridge_equals_normal_equations(spark, made):
    training = lifetime.fit_value_models(made, ("Ridge",), exclude_leaky=True)
    model = training.models["Ridge"]
    names = estimators.model_features(model)
    from patronlens.operators.ltv import ltv_dataset
    from patronlens.operators.splits import random_split

    train, _ = random_split(ltv_dataset(made, exclude_leaky=True))
    pdf = train.toPandas()
    x, y = pdf[names].to_numpy(float), pdf.y.to_numpy(float)
    xc, yc = x - x.mean(0), y - y.mean()
    weights = np.linalg.solve(xc.T @ xc + np.eye(len(names)), xc.T @ yc)
    assert model.stages[-1].coefficients.toArray() == pytest.approx(weights, rel=1e-4, abs=1e-7)


def test_value_models_log_save_and_score(spark, made):
    log = runlog.RunLog(spark, scratch_path(spark, "runs"))
    training = lifetime.fit_value_models(made, sizes=SMALL, log=log)
    board = {r.model: r.rmse for r in training.leaderboard.collect()}
    assert set(board) == {"Ridge", "RandomForest", "GradientBoosting", "SampledBoosting"}
    assert board[training.best] == min(board.values())
    logged = log.metric_table("LTV_Modeling").filter("key = 'rmse'").collect()
    names = {r.run: r.value for r in log.read().filter("kind = 'param' AND key = 'model'").collect()}
    assert {names[r.run]: r.value for r in logged} == pytest.approx(board)
    run_of = {name: run for run, name in names.items()}
    again = runlog.load_model(f"{log.path}-models/LTV_Modeling/{run_of[training.best]}")
    one = estimators.predict_ltv_segments(made, training.models[training.best]).orderBy("CustomerID")
    two = estimators.predict_ltv_segments(made, again).orderBy("CustomerID")
    assert one.select("Predicted_LTV", "LTV_Tier").collect() == two.select("Predicted_LTV", "LTV_Tier").collect()
    shares = importance.feature_importance(spark, training.models["RandomForest"], 100)
    assert shares.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    assert importance.feature_importance(spark, training.models["Ridge"]).count() == 0


def test_a_second_training_leaves_the_first_run_alone(spark, made):
    log = runlog.RunLog(spark, scratch_path(spark, "runs"))
    for _ in range(2):
        lifetime.fit_value_models(made, ("Ridge",), log=log)
    runs = [r.run for r in log.read().filter("key = 'model'").collect()]
    assert len(set(runs)) == 2
    assert log.metric_table("LTV_Modeling").filter("key = 'rmse'").count() == 2
    assert all(runlog.load_model(f"{log.path}-models/LTV_Modeling/{run}") for run in runs)


def test_fits_say_whether_they_converged(spark, lines):
    summary = buytilldie.rfm_t_summary(lines)
    whole, cut = buytilldie.fit_bgnbd(summary), buytilldie.fit_bgnbd(summary, max_iter=1)
    assert whole.converged and max(map(abs, whole.gradient)) < 1e-8
    assert not cut.converged


def test_churn_models_and_attribution(spark, lines, made):
    training = retention.fit_churn_models(lines, sizes=SMALL)
    board = {r.model: r.auc_roc for r in training.leaderboard.collect()}
    assert set(board) == {"LogisticRegression", "RandomForest", "SampledBoosting"}
    assert all(0.5 < v <= 1.0 for v in board.values())
    scored = retention.risk_tiers(made, training)
    assert scored.count() == made.count() and scored.columns[: len(made.columns)] == made.columns
    from patronlens.operators.churn import churn_dataset, churn_labels

    data = churn_dataset(made, churn_labels(lines)).withColumn("is_multi_country", F.lit(1.0))
    drops = importance.feature_attribution(data, training.models["RandomForest"], repeats=2).collect()
    found = {r.feature: r.auc_drop for r in drops}
    assert found["is_multi_country"] == pytest.approx(0.0, abs=1e-12)
    assert max(found, key=found.get) == "Recency"


def test_clusters(spark, made):
    customers = made.select("CustomerID", "Recency", "Frequency", "Monetary")
    clustered, model = clustering.kmeans_segments(customers, 3, starts=2)
    pdf = clustered.toPandas()
    z = pdf[["Recency", "Frequency", "Monetary"]].astype(float)
    z = ((z - z.mean()) / z.std(ddof=0)).to_numpy()
    centres = np.array(model.clusterCenters())
    assert (((z[:, None] - centres) ** 2).sum(2).argmin(1) == pdf.KMeans_Cluster).all()
    means = pdf.groupby("Cluster_Rank").Monetary.mean()
    assert means.is_monotonic_decreasing and list(means.index) == [1, 2, 3]
    soft, quality = clustering.gmm_soft(customers, 2)
    low, high = soft.agg(F.min("GMM_Max_Prob"), F.max("GMM_Max_Prob")).first()
    assert 0.5 <= low <= high <= 1.0 + 1e-9 and quality["bic"] > quality["aic"]
    projected, shares = clustering.pca_projection(customers)
    assert projected.agg(F.avg("PC1")).first()[0] == pytest.approx(0.0, abs=1e-9)
    assert shares[0] >= shares[1] and sum(shares) <= 1.0 + 1e-9
    squared = clustering.silhouette_by_k(customers, [2, 3], starts=1, squared=True).collect()
    assert [r.error for r in squared] == [0.0, 0.0]
    scores = clustering.silhouette_by_k(customers, [2, 3], starts=1)
    best = clustering.optimal_k(scores).first()
    assert best.k == max(scores.collect(), key=lambda r: r.silhouette).k


def test_customer_tables_never_meet_in_one_partition(spark, tiny):
    """The only single-partition exchanges hold one row per partition or segment, or partial sums."""
    scored = rfm.score_rfm(inputs.customer_rfm(spark, tiny))
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    for node in plan.split("\n"):
        if "Window" in node and "PARTITION" not in node.upper():
            assert "_size" in node, node
    ranked = ranking.global_rank(spark.range(10), ["id"], "r")
    assert isinstance(ranked.toPandas(), pd.DataFrame)


def test_fits_do_not_depend_on_the_partitions_of_the_session(spark, made):
    """Small tables are fitted in few partitions, however many the session shuffles to."""
    assert [estimators.partitions_for(n) for n in (0, 1, 4096, 4097, 65536, 6_553_600)] == [1, 1, 1, 2, 4, 40]
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    found = {}
    for parts in (usual, "3"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            training = lifetime.fit_value_models(made, ("RandomForest", "SampledBoosting"), sizes=SMALL)
            found[parts] = training.predictions.orderBy("model", "CustomerID").collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", usual)
    assert list(training.models) == ["RandomForest", "SampledBoosting"]
    assert [tuple(r)[:3] for r in found[usual]] == [tuple(r)[:3] for r in found["3"]]
    assert [r.prediction for r in found[usual]] == pytest.approx([r.prediction for r in found["3"]], rel=1e-9)
