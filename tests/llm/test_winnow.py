import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from patronlens.llm import queries, winnow
from patronlens.llm.winnow import GRAM, WINDOW, compare_with_edits, fingerprints, likeness, printed

M = (1 << 64) - 1


def mixed(x):
    x = ((x ^ x >> 30) * winnow.MIX[0]) & M
    x = ((x ^ x >> 27) * winnow.MIX[1]) & M
    return x ^ x >> 31


def plain(text, k=GRAM, window=WINDOW):
    """[(position, hash)] gram by gram and window by window."""
    kept = [(n, ord(c) + 32 if "A" <= c <= "Z" else ord(c)) for n, c in enumerate(text or "") if c not in " \t\n\v\f\r"]
    if not kept:
        return []
    if len(kept) < k:
        return [(kept[0][0], mixed((sum((c + 1) * pow(winnow.BASE, j, M + 1) for j, (_, c) in enumerate(kept)) + len(kept)) & M))]
    power = [pow(winnow.BASE, j, M + 1) for j in range(k)]
    grams = [mixed(sum((c + 1) * b for (_, c), b in zip(kept[n : n + k], power)) & M) for n in range(len(kept) - k + 1)]
    chosen = set()
    for at in range(max(1, len(grams) - window + 1)):
        part = grams[at : at + window][::-1]
        chosen.add(at + len(part) - 1 - part.index(min(part)))
    return [(kept[n][0], grams[n]) for n in sorted(chosen)]


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    out = []
    for n, (doc_id, text) in enumerate(order):
        text, after = text or "", order[(n + 1) % len(order)][1] or ""
        cut = len(text) // 4
        changed = text[: len(text) - cut] + after[:cut]
        own, other, following = plain(text), plain(changed), plain(after)
        show = lambda p: "".join(f"{at:08x}{h:016x}" for at, h in p)
        share = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
        sets = [{h for _, h in p} for p in (own, other, following)]
        out.append(
            (doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), show(own), show(other), share(sets[0], sets[1]), share(sets[0], sets[2]))
        )
    return out


def random_text(rng, n, letters="ab AB\n"):
    return "".join(rng.choice(letters) for _ in range(n))


@pytest.mark.parametrize("k,window", [(1, 1), (3, 4), (5, 1), (4, 7), (GRAM, WINDOW)])
def test_winnow_follows_its_definition(k, window, monkeypatch):
    rng = random.Random(k * window)
    texts = [random_text(rng, rng.randrange(150), rng.choice(("a", "ab ", "abc dé日🙂\x1c\x85\t"))) for _ in range(200)]
    got = [list(zip(p.tolist(), h.tolist())) for p, h in winnow.winnow(texts, k, window)]
    assert got == [plain(t, k, window) for t in texts]
    for size in (1, 30, 90):  # pieces of long texts give the same
        monkeypatch.setattr(winnow, "AT_ONCE", size)
        assert [list(zip(p.tolist(), h.tolist())) for p, h in winnow.winnow(texts, k, window)] == got


def test_shared_stretches_are_never_missed():
    rng = random.Random(8)
    for _ in range(200):
        shared = random_text(rng, GRAM + WINDOW - 1, "abcdefgh")
        a, b = (random_text(rng, rng.randrange(200), "ijkl") + shared + random_text(rng, rng.randrange(200), "mnop") for _ in "ab")
        (pa, ha), (pb, hb) = winnow.winnow([a, b])
        both = np.intersect1d(ha, hb)
        assert len(both)
        at, to = a.index(shared), b.index(shared)
        inside = [(p - at) for p, h in zip(pa.tolist(), ha.tolist()) if h in both]
        assert any(d in {p - to for p, h in zip(pb.tolist(), hb.tolist()) if h in both} for d in inside)


def test_documents_match_brute_force(spark, tiny, documents):
    got = sorted(tuple(r) for r in queries.op13_winnowed_fingerprints(spark, tiny).collect())
    assert got == sorted(brute([(r.doc_id, r.text) for r in documents.collect()]))
    near = [r[5] for r in got if r[1] > 400]
    assert 0.45 < np.mean(near) < 0.75 and np.mean([r[6] for r in got]) < 0.1


def test_order_does_not_depend_on_parts_or_partitions(spark, documents):
    rows = documents.select("doc_id", "text").repartition(5)
    want = sorted((n, t) for n, t in rows.collect())
    for parts in (1, 3, 40):
        got = {}
        for n, part in enumerate(winnow.with_next(rows, parts=parts).withColumn("at", F.spark_partition_id()).collect()):
            got.setdefault((part.at, part.part), []).append((part.extra, part.doc_id, part.text))
        stretches = [got[key] for key in sorted(got, key=lambda key: got[key][0][1])]
        assert [(n, t) for s in stretches for extra, n, t in s if not extra] == want
        for one, after in zip(stretches, stretches[1:] + stretches[:1]):
            assert one[-1] == (1, *after[0][1:])


def test_odd_rows(odd, spark, monkeypatch):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    alone = [r for r in rows if r[0] is not None and len(r[1] or "") < 9999]
    one_of_each = odd.filter("doc_id < 5 OR doc_id = 7")
    for limit in (winnow.AT_ONCE, 10):
        monkeypatch.setattr(winnow, "AT_ONCE", limit)
        got = sorted(tuple(r) for r in compare_with_edits(one_of_each).collect())
        assert got == sorted(brute(alone))
        assert compare_with_edits(odd).count() == len(rows)
        prints = {(r.doc_id, r.n_chars, tuple((x.position, x.hash & M) for x in r.fingerprint)) for r in fingerprints(one_of_each).collect()}
        assert prints == {(n, len(t or ""), tuple(plain(t))) for n, t in alone}
    assert compare_with_edits(odd.limit(0)).collect() == []
    single = compare_with_edits(odd.filter("doc_id = 7")).first()
    assert single.near_next == 1.0
    nothing = compare_with_edits(odd.select("doc_id", F.lit(None).cast("string").alias("text")))
    assert {r.fingerprint for r in nothing.collect()} == {""} and {r.near_next for r in nothing.collect()} == {1.0}


def test_likeness_and_print():
    assert likeness(np.array([1, 1, 2]), np.array([2, 3])) == 1 / 3
    assert likeness(np.array([]), np.array([])) == 1.0 and likeness(np.array([]), np.array([1])) == 0.0
    assert printed(np.array([1]), np.array([M], np.uint64)) == "00000001" + "f" * 16
