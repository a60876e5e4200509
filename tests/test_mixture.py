"""The mixture against a plain implementation in numpy, and its measures recomputed in SQL."""

import duckdb
import numpy as np
import pytest

from patronlens.operators import clustering, mixture
from workload import inputs


def plain_fit(x, labels, k, max_iter=100, tol=1e-3, floor=1e-6):
    """Rounds over all rows at once, densities by the textbook formula."""
    shares = np.eye(k)[labels]
    course = []
    while True:
        n = shares.sum(axis=0) + 10 * np.finfo(float).eps
        means = shares.T @ x / n[:, None]
        covs = np.array([((x - m).T * s) @ (x - m) / c + floor * np.eye(x.shape[1]) for m, s, c in zip(means, shares.T, n)])
        dens = np.array([
            w * np.exp(-0.5 * np.einsum("ni,ij,nj->n", x - m, np.linalg.inv(c), x - m)) / np.sqrt(np.linalg.det(2 * np.pi * c))
            for w, m, c in zip(n / n.sum(), means, covs)
        ]).T
        course.append(np.log(dens.sum(axis=1)).sum())
        shares = dens / dens.sum(axis=1, keepdims=True)
        if len(course) > max_iter or len(course) > 2 and abs(course[-2] - course[-3]) < tol * len(x):
            return n / n.sum(), means, covs, course, shares


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.normal([0, 0, 0], 1, (300, 3)), rng.normal([3, 1, 0], [0.5, 2, 1], (200, 3)), rng.normal([-2, 4, 3], 0.7, (100, 3))])
    labels = ((x - x.mean(axis=0)) @ [1, 1, 0.5] > 0).astype(int) + (x[:, 1] > 3)
    rows = [(i, p.tolist(), int(c)) for i, (p, c) in enumerate(zip(x, labels))]
    return x, labels, spark.createDataFrame(rows, "id int, v array<double>, c int").repartition(5)


def test_equals_the_plain_fit(points):
    x, labels, df = points
    centres = np.array([x[labels == c].mean(axis=0) for c in range(3)]) + 0.1  # only the point about which sums are taken
    model = mixture.fit_mixture(df, "v", "c", centres)
    weights, means, covs, course, shares = plain_fit(x, labels, 3)
    assert model.converged and model.rows == 600
    assert np.allclose(model.weights, weights, atol=1e-9) and np.allclose(model.means, means, atol=1e-9)
    assert np.allclose(model.covariances, covs, atol=1e-9) and np.allclose(model.course, course, rtol=1e-10)
    assert all(b >= a - 1e-6 for a, b in zip(model.course, model.course[1:]))
    got = {r.id: r.m for r in df.select("id", mixture.membership(model, df["v"]).alias("m")).collect()}
    assert all(got[i].component == s.argmax() and got[i].probability == pytest.approx(s.max(), abs=1e-9) for i, s in enumerate(shares))


def test_odd_tables(spark, points):
    _, _, df = points
    empty = mixture.fit_mixture(df.limit(0), "v", "c", np.zeros((2, 3)))
    assert empty.rows == 0 and empty.converged
    same = spark.createDataFrame([(i, [1.0, 2.0], 0) for i in range(20)], "id int, v array<double>, c int")
    model = mixture.fit_mixture(same, "v", "c", np.array([[1.0, 2.0], [0.0, 0.0]]))
    assert model.weights[0] == pytest.approx(1.0) and np.allclose(model.covariances[0], 1e-6 * np.eye(2))
    assert np.isfinite(model.log_likelihood)


def test_customers_measures_recomputed_in_sql(spark, tiny):
    customers = inputs.customer_rfm(spark, tiny)
    scored, model = clustering.gmm_model(customers, 2)
    assert all(b >= a - 1e-3 for a, b in zip(model.course, model.course[1:]))
    names = ["Recency", "Frequency", "Monetary"]
    z = clustering.standardize(customers, names).select(*names).toPandas().astype(float)  # noqa: F841
    p = mixture.parameter_table(model, customers, names).toPandas()  # noqa: F841
    # Inverse and determinant by cofactors, three features.
    x = ["Recency", "Frequency", "Monetary"]
    cell = lambda i, j: f"max(covariance) FILTER (row = '{x[i]}' AND \"column\" = '{x[j]}')"
    covs = ", ".join(f"{cell(i, j)} AS s{i}{j}" for i in range(3) for j in range(3))
    means = ", ".join(f"max(mean) FILTER (row = '{x[i]}') AS m{i}" for i in range(3))
    minor = lambda i, j: "(s{0}{2}*s{1}{3}-s{0}{3}*s{1}{2})".format((i + 1) % 3, (i + 2) % 3, (j + 1) % 3, (j + 2) % 3)
    det = "(" + "+".join(f"s0{j}*{minor(0, j)}" for j in range(3)) + ")"
    form = "+".join(f"({x[i]}-m{i})*({x[j]}-m{j})*{minor(i, j)}/{det}" for i in range(3) for j in range(3))
    ((likelihood,),) = duckdb.sql(f"""
        WITH c AS (SELECT component, max(weight) AS w, {means}, {covs} FROM p GROUP BY component),
             r AS (SELECT row_number() OVER () AS id, * FROM z)
        SELECT sum(l) FROM (SELECT ln(sum(w * exp(-0.5 * ({form})) / sqrt(power(2 * pi(), 3) * {det}))) AS l
                            FROM r CROSS JOIN c GROUP BY id)""").fetchall()
    assert model.log_likelihood == pytest.approx(likelihood, rel=1e-8)
    parameters = 2 * 3 + 2 * 6 + 1
    assert model.bic == pytest.approx(parameters * np.log(len(z)) - 2 * likelihood, rel=1e-8)
    assert model.aic == pytest.approx(2 * parameters - 2 * likelihood, rel=1e-8)
    assert scored.count() == len(z)
