import hashlib
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from patronlens.llm import periodic, queries
from patronlens.llm.periodic import periodic_runs, runs_of


def smallest_period(words):
    return next(q for q in range(1, len(words) + 1) if words[q:] == words[: len(words) - q])


def brute_runs(words, least=6, exponent=4):
    """All maximal stretches, period by period."""
    n, found = len(words), set()
    for q in range(1, n // exponent + 1):
        at = 0
        while at + q < n:
            end = at
            while end + q < n and words[end] == words[end + q]:
                end += 1
            size = end - at + q
            if size >= max(least, exponent * q) and smallest_period(words[at : at + size]) == q:
                found.add((at, size, q))
            at = end + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapse(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def split(text):
    return [w.decode() for w in (text or "").encode().split()]


def planted(doc_id, words):
    if doc_id is None or not words:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_row(doc_id, text):
    words = planted(doc_id, split(text))
    runs = brute_runs(words)
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    best = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (doc_id, len(runs), *best, digest(lines), digest(collapse(words, runs)))


COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_runs_of_many_small_texts_match_all_periods():
    rng = random.Random(4)
    texts = []
    for _ in range(1500):
        n, letters = rng.randrange(60), rng.choice((1, 2, 3, 5))
        text = [rng.randrange(letters) for _ in range(n)]
        if rng.random() < 0.6 and n > 8:
            base = [rng.randrange(letters) for _ in range(rng.randrange(1, 9))]
            at = rng.randrange(n)
            text[at:at] = (base * 9)[: rng.randrange(len(base) * 9)]
        texts.append(text)
    for least, exponent in ((6, 4), (1, 4), (6, 5)):
        words = np.array([t * 10 + w for t, text in enumerate(texts) for w in text], np.int64)
        counts = np.array([len(t) for t in texts])
        got = runs_of(words, np.repeat(counts, counts), least, exponent)
        starts = np.concatenate([[0], np.cumsum(counts)])
        want = [(starts[t] + s, n, q) for t, text in enumerate(texts) for s, n, q in brute_runs(text, least, exponent)]
        assert [tuple(r) for r in got.tolist()] == sorted(want, key=lambda r: (r[0], r[2]))


def test_names_too_large_for_one_number_are_sorted_in_two(monkeypatch):
    rng = random.Random(5)
    text = [rng.randrange(3) for _ in range(300)] + [7, 8, 9, 7] * 30
    words, sizes = np.array(text) + (1 << 61), np.full(len(text), len(text))
    assert [tuple(r) for r in runs_of(words, sizes).tolist()] == brute_runs(text)


def test_documents_match_brute_force(spark, tiny, documents):
    got = {tuple(r) for r in queries.op11_periodic_runs(spark, tiny).select(*COLUMNS).collect()}
    assert got == {brute_row(r.doc_id, r.text) for r in documents.collect()}
    assert sum(r[1] for r in got) > 10


def test_odd_rows(odd, spark, monkeypatch):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    for limit in (periodic.SLICE_BYTES, 20):
        monkeypatch.setattr(periodic, "SLICE_BYTES", limit)
        got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs(odd).collect()]
        want = [(i, len(split(t)), brute_runs(split(t)), collapse(split(t), brute_runs(split(t)))) for i, t in rows if len(t or "") < 9999]
        long = [(i, t) for i, t in rows if len(t or "") >= 9999]
        key = lambda r: (r[0] is None, r[0], r[1], r[3])
        assert sorted((g for g in got if g[0] not in {i for i, _ in long}), key=key) == sorted(want, key=key)
        for i, t in long:
            n = len(t.split())
            assert (i, n, [(0, n, 6)], "lorem ipsum dolor sit amet consectetur") in got
    assert periodic_runs(odd.limit(0)).collect() == []
    assert periodic_runs(odd.withColumn("text", F.lit(None).cast("string"))).filter("size(runs) > 0 OR collapsed <> ''").isEmpty()


def test_a_very_long_text_of_nested_runs(spark):
    inner = ["a"] * 9 + ["b", "c"] * 8
    words = (inner + ["d"]) * 3000 + [str(i) for i in range(20_000)] + ["z"] * 100_000
    df = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    row = periodic_runs(df).first()
    runs = [tuple(r) for r in row.runs]
    assert (0, 26 * 3000, 26) in runs and (26 * 3000 + 20_000, 100_000, 1) in runs
    assert sum(q == 1 for _, _, q in runs) == 3001 and sum(q == 2 for _, _, q in runs) == 3000
    assert len(runs) == 6002
