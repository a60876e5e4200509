"""Density clusters against brute force, including crowded cells and copies."""

import numpy as np
import pandas as pd
import pytest

from patronlens.operators import density


def brute(pdf, features, eps, min_samples):
    """Clusters by id order over all pairs."""
    pdf = pdf.sort_values("CustomerID").reset_index(drop=True)
    x = pdf[features].to_numpy(float)
    std = x.std(axis=0)
    x = (x - x.mean(axis=0)) / np.where(std > 0, std, 1)
    near = ((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2) <= eps * eps
    core = near.sum(axis=1) >= min_samples
    labels = np.full(len(x), -1)
    cluster = 0
    for i in range(len(x)):
        if labels[i] != -1 or not core[i]:
            continue
        stack = [i]
        while stack:
            j = stack.pop()
            if labels[j] != -1:
                continue
            labels[j] = cluster
            if core[j]:
                stack.extend(np.flatnonzero(near[j] & (labels == -1)))
        cluster += 1
    return dict(zip(pdf.CustomerID, labels.tolist(), strict=True)), dict(zip(pdf.CustomerID, core.tolist(), strict=True))


def blobs(kind):
    rng = np.random.default_rng(11)
    if kind == "crowded":
        # One cell holds most points; a ring of others lies about eps away.
        tight = rng.normal(0, 0.02, (500, 2))
        angle = rng.uniform(0, 2 * np.pi, 150)
        ring = np.c_[np.cos(angle), np.sin(angle)] * rng.uniform(0.6, 1.4, (150, 1))
        far = rng.uniform(-6, 6, (60, 2))
        points = np.r_[tight, ring, far]
    elif kind == "copies":
        points = np.r_[np.tile([[1.0, 2.0]], (300, 1)), rng.normal(0, 2, (300, 2)), np.tile([[5.0, 5.0]], (4, 1))]
    else:
        points = np.c_[np.linspace(0, 60, 400), np.zeros(400)] + rng.normal(0, 0.01, (400, 2))
    order = rng.permutation(len(points))
    return pd.DataFrame({"CustomerID": [f"C{i:04d}" for i in order], "a": points[:, 0], "b": points[:, 1]})


@pytest.mark.parametrize(
    "kind, eps, min_samples", [("crowded", 0.5, 5), ("crowded", 0.12, 5), ("copies", 0.3, 5), ("chain", 0.02, 3)]
)
def test_labels_equal_brute_force(spark, kind, eps, min_samples, monkeypatch):
    monkeypatch.setattr(density, "LEAF", 8)
    pdf = blobs(kind)
    labels, core = brute(pdf, ["a", "b"], eps, min_samples)
    df = spark.createDataFrame(pdf).repartition(4)
    got = density.dbscan_outliers(df, eps, min_samples, ["a", "b"]).collect()
    assert {r.CustomerID: r.DBSCAN_Cluster for r in got} == labels
    flags = density.dbscan_core(df, eps, min_samples, ["a", "b"]).collect()
    assert {r.CustomerID: r.Is_Core for r in flags} == core


def many_axes(axes, seed=3):
    """A crowd, a thin bridge, copies, far points and one axis without any spread."""
    rng = np.random.default_rng(seed)
    crowd = rng.normal(0, 0.05, (60, axes))
    bridge = np.linspace(0, 3, 40)[:, None] * np.ones(axes) + rng.normal(0, 0.01, (40, axes))
    copies = np.tile(rng.uniform(-3, 3, axes), (9, 1))
    points = np.r_[crowd, bridge, copies, rng.uniform(-4, 4, (60, axes))]
    points[:, -1] = 1.0
    names = [f"f{i}" for i in range(axes)]
    pdf = pd.DataFrame(points, columns=names)
    pdf["CustomerID"] = [f"C{i:04d}" for i in rng.permutation(len(points))]
    return pdf, names


@pytest.mark.parametrize("axes, eps", [(6, 0.5), (8, 0.3)])
def test_many_axes_equal_brute_force(spark, axes, eps, monkeypatch):
    monkeypatch.setattr(density, "LEAF", 8)
    pdf, names = many_axes(axes)
    labels, core = brute(pdf, names, eps, 5)
    assert len(set(labels.values())) >= 3
    got = density.dbscan_outliers(spark.createDataFrame(pdf).repartition(4), eps, 5, names).collect()
    assert {r.CustomerID: r.DBSCAN_Cluster for r in got} == labels


def test_walk_finds_the_pairs_of_listed_offsets(spark, monkeypatch):
    grid = density._Grid(0.5, 3)
    rng = np.random.default_rng(4)
    places = sorted({tuple(int(v) for v in p) for p in rng.integers(-9, 9, (300, 3))})
    cells = spark.createDataFrame([(list(p),) for p in places[::2]], "cell array<bigint>")
    others = spark.createDataFrame([(list(p), 1, 1, *[0.0] * 6) for p in places],
        "node array<bigint>, k bigint, weight bigint, " + ", ".join(f"{c} double" for c in grid.box_columns()))
    listed = {(tuple(r.cell), tuple(r.node)) for r in grid.neighbours(cells, others).collect()}
    monkeypatch.setattr(density, "LISTED_AXES", 0)
    walked = [(tuple(r.cell), tuple(r.node)) for r in grid.neighbours(cells, others).collect()]
    assert len(walked) == len(set(walked)) and set(walked) == listed
    assert grid.neighbours(cells.limit(0), others).isEmpty() and grid.neighbours(cells, others.limit(0)).isEmpty()
    assert grid.neighbours(cells.limit(1), others.limit(1)).count() == 1


def test_far_pairs_are_walked_only_where_they_matter(spark, monkeypatch):
    """In one dense crowd of six axes nearly all pairs of cells are in reach; few of them are ever written."""
    rng = np.random.default_rng(12)
    names = [f"f{i}" for i in range(6)]
    pdf = pd.DataFrame(np.r_[rng.normal(0, 1, (600, 6)) * 0.05, np.eye(6) * 3, -np.eye(6) * 3], columns=names)
    pdf["CustomerID"] = [f"C{i:04d}" for i in rng.permutation(len(pdf))]
    eps = 0.55
    labels, core = brute(pdf, names, eps, 5)
    assert 500 < sum(core.values()) < len(pdf)
    x = pdf[names].to_numpy()
    cells = len(np.unique(np.floor((x - x.mean(0)) / x.std(0) / (eps / 6**0.5)), axis=0))
    sizes = []
    write = density.materialize

    def counted(df):
        made = write(df)
        sizes.append(made.count())
        return made

    monkeypatch.setattr(density, "materialize", counted)
    got = density.dbscan_outliers(spark.createDataFrame(pdf).repartition(4), eps, 5, names).collect()
    assert {r.CustomerID: r.DBSCAN_Cluster for r in got} == labels
    assert cells > 150 and max(sizes) < 60 * cells, (cells, max(sizes))


def test_labels_are_not_broadcast(spark):
    """Labels grow with the customers, so their joins do not pass through the driver, however small a table is."""
    df = spark.createDataFrame(blobs("copies"))
    for found in (density.dbscan_outliers(df, 0.3, 5, ["a", "b"]), density.dbscan_core(df, 0.3, 5, ["a", "b"])):
        assert found.count() == 604
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_components_of_a_long_chain(spark):
    n = 200
    names = [f"v{i:04d}" for i in np.random.default_rng(5).permutation(n)]
    vertices = spark.createDataFrame([(v,) for v in [*names, "z"]], "v string")
    edges = spark.createDataFrame(list(zip(names, names[1:])), "u string, v string")
    got = {r.v: r.label for r in density.connected_components(vertices, edges).collect()}
    assert got.pop("z") == "z"
    assert set(got.values()) == {"v0000"}
