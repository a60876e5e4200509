import zlib

import numpy as np
import pytest

from patronlens.llm import quality
from patronlens.llm.quality import STATISTICS, fit_boosted, fit_quality, score_quality, statistics


def walk(model, row):
    """One row through each tree, node by node."""
    bins = model.bins(row[None, :])[0]
    total = model.base
    for feature, cut, leaf in zip(model.feature, model.cut, model.leaf):
        node = 0
        while node < len(feature):
            node = 2 * node + 1 + int(bins[feature[node]] > cut[node])
        total += leaf[node - len(feature)]
    return 1 / (1 + np.exp(-total))


@pytest.fixture(scope="module")
def tables(spark):
    folder = "/root/testdata/sf0.01"
    return [spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels")]


def test_held_out_accuracy_and_flat_trees(tables):
    docs, labels = tables
    model = fit_quality(docs, labels)
    rows = score_quality(docs.join(labels, "doc_id"), model).collect()
    for r in rows[:60]:
        assert abs(walk(model, statistics(r.text.encode())) - r.score) < 1e-9
        assert r.predicted == int(r.score >= 0.3)
    apart = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(apart) > 50
    assert np.mean([r.predicted == r.quality for r in apart]) >= 0.95


def test_held_out_labels_are_not_used(spark, tables):
    docs, labels = tables
    changed = labels.withColumn("quality", quality.F.when(quality.held_out(), 1 - quality.F.col("quality")).otherwise(quality.F.col("quality")))
    one, two = fit_quality(docs, labels), fit_quality(docs, changed)
    assert np.array_equal(one.leaf, two.leaf) and np.array_equal(one.cut, two.cut)


def test_boosting_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((2000, 3))
    y = ((x[:, 0] > 0.5) != (x[:, 1] > 0.5)).astype(float)
    model = fit_boosted(x[:1000], y[:1000])
    assert np.mean((model.score(x[1000:]) > 0.5) == y[1000:]) > 0.95


def test_slices_agree_on_counts(monkeypatch):
    text = ("Some WORDS of a text! 12 | x\n" * 40).encode()
    whole = dict(zip(STATISTICS, statistics(text)))
    monkeypatch.setattr(quality, "SLICE_BYTES", 29)
    sliced = dict(zip(STATISTICS, statistics(text)))
    for name in ("bytes", "words", "upper", "digit", "mark_21", "word_bytes", "capital_words"):
        assert whole[name] == pytest.approx(sliced[name])


def test_odd_rows(odd, spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (5, 1), (None, 1), (9, None)], "doc_id long, quality int")
    for known in (labels, labels.limit(0), labels.filter("quality = 1")):
        rows = score_quality(odd, fit_quality(odd, known)).collect()
        assert len(rows) == odd.count()
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
        assert len({r.score for r in rows if r.doc_id in (2, 3)}) == 1
    assert score_quality(odd.limit(0), fit_quality(odd, labels)).collect() == []
