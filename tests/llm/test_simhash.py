import random

import numpy as np
import xxhash

from patronlens.llm import simhash
from patronlens.llm.simhash import Golay, fingerprint, fingerprint_links, near_duplicates, spanning_links


def plain_fingerprint(text, width=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [words[i : i + width] for i in range(len(words) - width + 1)] or [words]
    hashes = [xxhash.xxh64_intdigest(b" ".join(g), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(pairs, nodes):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        parent[root(a)] = root(b)
    return {n: root(n) for n in nodes}


def close_pairs(values, limit=4):
    return [(a, b) for i, a in enumerate(values) for b in values[i + 1 :] if ((a ^ b) & (2**64 - 1)).bit_count() <= limit]


def brute(rows):
    """{row index: component} by all pairs."""
    fps = [plain_fingerprint(t) for _, t in rows]
    of = components(close_pairs(sorted(set(fps))), set(fps))
    least = {}
    for (i, _), fp in zip(rows, fps):
        if i is not None:
            least[of[fp]] = min(i, least.get(of[fp], i))
    return [(i, fp, least.get(of[fp])) for (i, _), fp in zip(rows, fps)]


def test_golay_is_perfect_and_near_sets_meet():
    code, rng = Golay(), np.random.default_rng(0)
    words = rng.integers(0, 1 << 23, 500)
    assert len(np.unique(code.index(np.arange(1 << 23)))) == 4096
    for word in words.tolist():
        for other in (word ^ 1 << 5, word ^ 1 << 3 ^ 1 << 22):
            near = [set(code.near(np.array([w]))[0].tolist()) - {-1} for w in (word, other)]
            assert near[0] & near[1]
        assert code.index(np.array([word]))[0] in near[0]


def test_keys_cover_every_pair_within_four_bits():
    rng, code = random.Random(1), Golay()
    left = [rng.getrandbits(63) for _ in range(3000)]
    right = []
    for n, value in enumerate(left):
        for bit in rng.sample(range(64), n % 5):
            value ^= 1 << bit
        right.append(value - (1 << 64) if value >> 63 else value)
    sets = []
    for values in (left, right):
        keys, owners = simhash.link_keys(np.array(values, np.int64), code)
        found = {}
        for key, owner in zip(keys.tolist(), owners.tolist()):
            found.setdefault(owner, set()).add(key)
        sets.append(found)
    assert all(sets[0][a] & sets[1][b] for a, b in zip(left, right))


def test_fingerprint_follows_its_definition(monkeypatch):
    texts = ["", " \n", "One", "one two three", "A b c D", "Ünï CODE e f g\x0bh\x1ci", "x y " * 500]
    assert [fingerprint(t.encode()) for t in texts] == [plain_fingerprint(t) for t in texts]
    monkeypatch.setattr(simhash, "SLICE_BYTES", 7)
    assert [fingerprint(t.encode()) for t in texts] == [plain_fingerprint(t) for t in texts]


def test_links_join_as_all_pairs_do(spark):
    rng = random.Random(2)
    values = set()
    for _ in range(20):
        base = rng.getrandbits(63)
        for _ in range(40):
            value = base
            for bit in rng.sample(range(63), rng.randrange(6)):
                value ^= 1 << bit
            values.add(value)
    values = sorted(values)
    want = components(close_pairs(values), values)
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    for run in (2048, 4):  # the small one sends nearly every key to the tasks for crowded keys
        got = components([(r.u, r.v) for r in fingerprint_links(df, run=run).collect()], values)
        assert len({(want[v], got[v]) for v in values}) == len(set(want.values())) == len(set(got.values()))


def test_spanning_links_are_few():
    fps = np.unique(np.arange(256, dtype=np.int64))
    u, v = spanning_links(fps, 4)
    assert len(u) == len(fps) - 1 and len(set(v.tolist())) == len(v)


def test_documents_match_brute_force(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = {(r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in near_duplicates(documents).collect()}
    assert got == set(brute(rows))


def test_odd_rows(odd, spark):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = [(r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in near_duplicates(odd).collect()]
    order = lambda r: tuple((x is None, x) for x in r)
    assert sorted(got, key=order) == sorted(brute(rows), key=order)
    assert near_duplicates(odd.limit(0)).collect() == []
