import math

import numpy as np
import pytest

from patronlens.llm import hardneg, queries
from patronlens.llm.hardneg import mine

COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def brute(rows, is_anchor, positives=5, negatives=10, low=30, high=90, scale=256):
    """By all products, in whole numbers of any size."""
    real = [(i, n, v) for i, n, v in rows if i is not None and n is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    sizes = sorted({len(v) for _, _, v in real}, key=lambda s: (-sum(len(v) == s for _, _, v in real), -s))
    cut = {}
    for i, n, v in real:
        if len(v) == sizes[0]:
            scaled = (n, [math.floor(scale * x) for x in v])
            cut[i] = min(cut.get(i, scaled), scaled)
    out = []
    for a, (label, vector) in cut.items():
        if not is_anchor(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(vector, v)), i, n) for i, (n, v) in cut.items() if i != a)
        for minus, p, _ in [s for s in scored if s[2] == label][:positives]:
            fit = [(i, -m) for m, i, n in scored if n != label and -low * minus <= -100 * m <= -high * minus]
            out += [(a, p, r, i, -minus, score) for r, (i, score) in enumerate(fit[:negatives], 1)]
    return sorted(out)


def shifted(rows):
    return [(i, None if n is None else (n + 1) % 10 if i % 7 == 0 else n, v) for i, n, v in rows]


def mined(df, anchors, **options):
    return sorted(tuple(r) for r in mine(df, anchors, **options).select(*COLUMNS).collect())


def test_embeddings_match_brute_force(spark, tiny):
    rows = [(r.vec_id, r.label, r.embedding) for r in spark.read.parquet(f"{tiny}/embeddings.parquet").collect()]
    got = sorted(tuple(r) for r in queries.op12_hard_negatives(spark, tiny).select(*COLUMNS).collect())
    assert got == brute(shifted(rows), lambda i: i % 100 == 0)
    assert len(got) > 50


@pytest.fixture(scope="module")
def clustered(spark):
    """Vectors of many lengths around a few centres, with copies and a label that holds a third of all rows."""
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((5, 12))
    vectors = centres[rng.integers(0, 5, 900)] + 0.4 * rng.standard_normal((900, 12))
    vectors *= rng.lognormal(0, 1, (900, 1))
    vectors[rng.integers(0, 900, 300)] = vectors[0]
    vectors[5:8] = 0
    labels = np.where(rng.random(900) < 0.33, 0, rng.integers(0, 40, 900))
    return [(n, int(x), v.tolist()) for n, (x, v) in enumerate(zip(labels, vectors))]


@pytest.mark.parametrize("options", [{}, {"bucket_rows": 16, "block_anchors": 9}, {"low_percent": -50, "high_percent": 200}])
def test_copies_ties_and_lengths(spark, clustered, options):
    df = spark.createDataFrame(clustered, "vec_id long, label int, embedding array<double>").repartition(4)
    spans = {"low": options.get("low_percent", 30), "high": options.get("high_percent", 90)}
    assert mined(df, "id % 20 = 0", **options) == brute(clustered, lambda i: i % 20 == 0, **spans)


def test_products_beyond_doubles_are_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(n, n % 3, (rng.standard_normal(6) * 3e5).tolist()) for n in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = mined(df, "id % 10 = 0")
    assert got == brute(rows, lambda i: i % 10 == 0)
    assert max(abs(r[4]) for r in got) > 1 << 53


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(n, n % 2, [1.0 + n % 5, 0.5 * (n % 3), -0.25 * (n % 4)]) for n in range(30)]
    odd = [
        (None, 1, [1.0, 1.0, 1.0]), (40, None, [1.0, 1.0, 1.0]), (41, 1, None), (42, 1, [1.0, None, 1.0]), (43, 1, [nan, 1.0, 1.0]),
        (44, 0, [inf, 1.0, 1.0]), (45, 1, []), (46, 1, [1.0]), (47, 1, [0.0, 0.0, 0.0]), (3, 1, [9.0, 9.0, 9.0]), (4, 0, good[4][2]),
    ]
    rows = good + odd + good[:5]
    kind = "vec_id long, label int, embedding array<double>, n string, id string, v string, _hash string"
    df = spark.createDataFrame([(*r, *["clash"] * 4) for r in rows], kind)
    assert mined(df, "id % 3 = 0") == brute(rows, lambda i: i % 3 == 0)
    assert mined(df.limit(0), "id % 3 = 0") == []
    huge = [(50, 1, [1e300, 0.0, 0.0])]
    assert mined(df.union(spark.createDataFrame([(*r, *["x"] * 4) for r in huge], kind)), "id % 3 = 0") == mined(df, "id % 3 = 0")


def test_most_products_are_pruned(clustered):
    ids, labels, vectors = (np.array(c) for c in zip(*clustered))
    whole = np.floor(vectors * 256).astype(np.int64)
    order = np.argsort(-(whole.astype(float) ** 2).sum(axis=1), kind="stable")
    buckets = [hardneg.Bucket(ids[o], labels[o], whole[o]) for o in np.array_split(order, 30)]
    anchors = hardneg.Anchors(ids[::20], labels[::20], whole[::20])
    asked = passed = 0
    for n in range(len(anchors.ids)):
        top = max(int(b.products(anchors.vectors[n], None).max()) for b in buckets)
        for b in buckets:
            cosine = b.cosine_needed(top * 0.8, anchors.lengths[n])
            kept = np.zeros(0) if cosine > 1 else b.candidates(anchors.units[n], anchors.focus[n], cosine)
            asked += len(b.ids)
            passed += len(b.ids) if kept is None else len(kept)
    assert passed < asked / 4
