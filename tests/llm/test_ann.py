import numpy as np
import pytest

from patronlens.llm import ann
from patronlens.llm.queries import op1_rp_forest_neighbours


def brute(rows, is_query, k=5):
    """{query: [(id, score)]} over all rows."""
    rows = sorted({(i, tuple(v)) for i, v in rows})
    out = {}
    for q, qv in rows:
        if is_query(q):
            scores = [(-round(float(ann.cosines(np.array([qv]), np.array([v]))[0]), 12), i) for i, v in rows if i != q]
            out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def test_recall(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    want = brute(rows, lambda i: i % 20 == 0)
    # Few probes of small leaves, so that the search has something to miss.
    got = ann.nearest(df, "id % 20 = 0", leaf=16, probes=128, sample_rows=100).collect()
    found = {(r.query_id, r.vec_id) for r in got}
    wanted = {(q, i) for q, near in want.items() for i, _ in near}
    assert len(found & wanted) >= 0.9 * len(wanted)
    scores = {(q, i): s for q, near in want.items() for i, s in near}
    assert all(abs(r.score - scores[r.query_id, r.vec_id]) < 1e-11 for r in got if (r.query_id, r.vec_id) in scores)


def test_ties_copies_and_rows_that_take_no_part(spark):
    inf, nan = float("inf"), float("nan")
    copies = [(i, [1.0, 2.0, 3.0]) for i in range(0, 60)]
    others = [(100, [1.0, 2.0, 3.1]), (101, [-1.0, 0.0, 0.0]), (150, [3.0, 2.0, 1.0]), (150, [3.0, 2.0, 1.0])]
    out = [(200, None), (201, [0.0, 0.0, 0.0]), (202, [nan, 1.0, 1.0]), (203, [inf, 1.0, 1.0]), (204, [None, 1.0, 1.0]), (205, [1.0]), (None, [1.0, 1.0, 1.0]), (250, [])]
    df = spark.createDataFrame([(*r, 0, 0.0) for r in copies + others + out], "vec_id long, embedding array<double>, rank int, score double")
    got = {}
    for r in ann.nearest(df, "id % 50 = 0").orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {0: [1, 2, 3, 4, 5], 50: [0, 1, 2, 3, 4], 100: [0, 1, 2, 3, 4], 150: [0, 1, 2, 3, 4]}
    assert [r["rank"] for r in ann.nearest(df, "id = 0").orderBy("rank").collect()] == [1, 2, 3, 4, 5]


def test_of_several_vectors_with_one_id_the_least_counts(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (50, [0.1, 1.0]), (1, [1.0, 0.1]), (1, [1.0, 0.3]), (2, [-1.0, 0.2])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.nearest(df, "id % 50 = 0").orderBy("query_id", "rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in got] == [
        (0, 1, 50), (0, 2, 2), (0, 3, 1), (50, 1, 0), (50, 2, 1), (50, 3, 2)
    ]


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01", "sf0.1"])
def test_the_forest_answers_the_registered_query(spark, monkeypatch, folder):
    """On the given tables the trees are walked, not all rows read, and most neighbours found."""
    made = []
    fit = ann.Forest.fit.__func__
    monkeypatch.setattr(ann.Forest, "fit", classmethod(lambda cls, *a, **k: made.append(fit(cls, *a, **k)) or made[-1]))
    folder = f"/root/testdata/{folder}"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    ids = np.array([r.vec_id for r in rows])
    units = ann.units_of(np.array([r.embedding for r in rows], np.float64))
    found = {}
    for r in op1_rp_forest_neighbours(spark, folder).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert len(made) == 1 and len(made[0].directions) == 8 and made[0].depth >= 6
    asked = np.flatnonzero(ids % 50 == 0)
    hits = [len(found[ids[q]] & set(ids[np.argsort(-(units @ units[q]))[1:6]].tolist())) for q in asked]
    assert sum(hits) >= 0.9 * 5 * len(asked)


@pytest.mark.parametrize("n", [0, 1, 3])
def test_few_rows(spark, n):
    df = spark.createDataFrame([(50 * i, [1.0, float(i)]) for i in range(n)], "vec_id long, embedding array<float>")
    assert ann.nearest(df, "id % 50 = 0").count() == n * (n - 1)


def test_deeper_trees_than_the_sample(spark):
    rng = np.random.default_rng(0)
    units = ann.units_of(rng.standard_normal((4000, 8)))
    forest = ann.Forest.fit(units[:64], 4000, 3, 8)
    assert forest.fitted < forest.depth == 9
    leaves = forest.leaves(units)
    for i in range(20):  # the first visit of each tree is the row's own leaf
        visits = forest.visits(units[i], 10_000)
        assert set(enumerate(leaves[i].tolist())) <= set(visits[: len(visits)])
        assert visits[0] in set(enumerate(leaves[i].tolist()))
        assert len(visits) == len(set(visits)) == 3 * 2**9


def test_visits_follow_the_table(spark):
    """Many leaves a query: a fixed number of visits would miss the neighbours."""
    rng = np.random.default_rng(4)
    rows = [(i, v) for i, v in enumerate(rng.standard_normal((6000, 32)).tolist())]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    units = np.array([v for _, v in rows])
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    found = {}
    for r in ann.nearest(df, "vec_id % 100 = 0", leaf=4).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = [len(found[q] & set(np.argsort(-(units @ units[q]))[1:6].tolist())) for q in range(0, 6000, 100)]
    assert sum(hits) >= 0.9 * 5 * len(hits)


def test_the_forest_meets_its_target_where_it_reads_less_than_all():
    rng = np.random.default_rng(5)
    points = ann.units_of(rng.standard_normal((60, 16))[rng.integers(0, 60, 8000)] + 0.3 * rng.standard_normal((8000, 16)))
    forest = ann.Forest.fit(points[:4000], len(points), 8, 16)
    close = points @ points.T
    near = [points[np.argsort(-close[q])[1:6]] for q in range(200)]
    probes = forest.visits_for(0.95, list(points[:100]), near[:100])
    assert probes < 1 << forest.depth
    met = [
        any((t, n) in seen for t, n in enumerate(of.tolist()))
        for q in range(100, 200)
        for seen in [set(forest.visits(points[q], probes))]
        for of in forest.leaves(near[q])
    ]
    assert np.mean(met) >= 0.9


def test_queue_and_sorted_costs_agree():
    rng = np.random.default_rng(6)
    points = ann.units_of(rng.standard_normal((2000, 8)))
    forest = ann.Forest.fit(points[:300], 2000, 4, 8)
    costs = forest.costs(points[0])
    few = forest.visits(points[0], 30)
    assert [costs[v] for v in few] == sorted(costs.ravel())[:30]
    assert len(set(forest.visits(points[0], 900))) == 900
