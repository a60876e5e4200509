import hashlib
import random
import re

import numpy as np
import pytest

from pyspark.sql import functions as F

from patronlens.llm.secrets import (
    CONTENT,
    FEATURES,
    Language,
    candidates_of,
    count_language,
    distant_labels,
    features,
    find_candidates,
    fit_forest,
    measure,
    scan,
    score_candidates,
)
from patronlens.operators.attribution import trees_of

QUOTED = re.compile(r'token = "([0-9a-f]{40})"')


def test_planted_secrets_and_little_else(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    want = {(i, hashlib.sha256(m.encode()).hexdigest()) for i, t in texts.items() for m in QUOTED.findall(t)}
    got = {(r.doc_id, r.sha256) for r in scan(docs, path_col="source").collect()}
    assert want <= got
    all_of = sum(len(candidates_of(t)) for t in texts.values())
    assert len(got - want) <= 0.02 * all_of


def brute_candidates(text):
    """Sign by sign: runs of token signs and single dots between them."""
    token = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")
    found, at = [], 0
    while at < len(text):
        end = at
        while end < len(text) and (text[end] in token or (text[end] == "." and end > at and text[end + 1 : end + 2] and text[end + 1] in token)):
            end += 1
        if end - at >= 16:
            found.append((at, end))
        at = max(end, at + 1)
    return found


def test_candidates_and_scores_match_brute_force(spark):
    """Runs sign by sign, values by their place, and probabilities by walking the forest's trees node by node."""
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: (r.text, r.source) for r in documents.collect()}
    language = count_language(documents)
    found = find_candidates(documents, language, "source")
    rows = {(r.doc_id, r.start, r.length): r.x for r in found.collect()}
    values = {(i, m.start(1), 40) for i, (t, _) in texts.items() for m in QUOTED.finditer(t)}
    runs = {(i, a, b - a) for i, (t, _) in texts.items() for a, b in brute_candidates(t)}
    assert values <= rows.keys() and runs <= rows.keys() and len(rows) - len(runs) <= 5
    for (i, a, n), x in rows.items():
        hit = next(c for c in candidates_of(texts[i][0]) if c[0] == a)
        assert x == features(texts[i][0], a, a + n, hit[2], hit[3], texts[i][1], language) and len(x) == len(FEATURES)
    labelled = distant_labels(found)
    model = fit_forest(labelled, names=CONTENT)

    class Stages:
        stages = [model]

    trees = trees_of(Stages)
    for r in score_candidates(found, model, CONTENT).collect():
        x = np.array([rows[r.doc_id, r.start, r.length][: len(CONTENT)]])
        assert r.score == pytest.approx(sum(t.predict(x)[0] for t in trees), abs=1e-12)


def test_short_and_punctuated_passwords_are_candidates():
    cases = {
        'password = "Tr0ub4dor&3"': "Tr0ub4dor&3",
        "pwd: hunter2hunter2!x9 and": "hunter2hunter2!x9",
        "postgres://app:s3cr.t!9@db.internal/x": "s3cr.t!9",
        "api_key='abc123def456ghi'": "abc123def456ghi",
        "Authorization token: eyJhbGciOi.eyJzdWIi.SflKxwRJ": "eyJhbGciOi.eyJzdWIi.SflKxwRJ",
        "see eyJhbGciOiJI.eyJzdWIiOiIx.SflKxwRJSM now": "eyJhbGciOiJI.eyJzdWIiOiIx.SflKxwRJSM",
        '{"secret": "a b c d e!"}': "a b c d e!",
    }
    for text, value in cases.items():
        assert value in [text[a:b] for a, b, _, _ in candidates_of(text)], text
    assert candidates_of("password: short") == []
    assert candidates_of("the token of my affection is not a value") == []


def planted(n, seed=0):
    """Documents with a secret each, or a decoy: commit hashes, digests, uuids, base64 images, long words."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(3, 9))) for _ in range(400)]
    words = lambda k: " ".join(rng.choices(vocabulary, k=k))
    some = lambda letters, k: "".join(rng.choice(letters) for _ in range(k))
    hexa, base = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    mixed = base + "!$&%#*"
    secrets_of = [lambda: some(mixed, rng.randrange(10, 20)), lambda: "sk_" + some(base[:62], 24), lambda: some(base[:62], 32)]
    decoys = [
        lambda: f"commit {some(hexa, 40)}", lambda: f"digest {some(hexa, 64)}", lambda: "-".join(some(hexa, k) for k in (8, 4, 4, 4, 12)),
        lambda: f"image data {some('A', 12)}{some('ABCDEFGH', 90)}", lambda: "".join(rng.choices(vocabulary, k=5)),
    ]
    rows = []
    for i in range(n):
        value = rng.choice(secrets_of)() if i % 2 else None
        way = rng.choice(['password = "{}"', "api_key: '{}'", "password={}"] if i % 10 != 1 else ["token: {}", "pwd: {}"])
        rows.append((i, f"{words(20)} {way.format(value) if value else rng.choice(decoys)()} {words(20)}", value))
    return rows


def test_held_out_precision_and_recall_with_decoys(spark):
    rows = planted(1500)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labelled = distant_labels(find_candidates(docs, count_language(docs)))
    counts = {(r.label, r.kept): r.findings for r in measure(labelled).collect()}
    caught, lost, wrong = (counts.get(k, 0) for k in ((1.0, True), (1.0, False), (0.0, True)))
    assert caught > 50 and caught / (caught + lost) >= 0.9 and caught / (caught + wrong) >= 0.9
    # Bare values are open: no label says anything of them, the forest finds them.
    kept = {(r.doc_id, r.sha256) for r in scan(docs).collect()}
    opened = {(i, hashlib.sha256(v.encode()).hexdigest()) for i, _, v in rows if v and i % 10 == 1}
    assert len(kept & opened) >= 0.9 * len(opened)
    assert len({i for i, _ in kept if i % 2 == 0}) <= 0.1 * len(rows) / 2


def test_labelled_findings_decide(spark):
    rng = random.Random(0)
    word = lambda: "".join(rng.choice("etaoinshr") for _ in range(rng.randrange(3, 8)))
    key = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40))
    rows = [(n, " ".join(word() for _ in range(30)) + (f' commit {key()} ' if n % 2 else f' password: {key()} ') + word()) for n in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    language = count_language(docs)
    known = find_candidates(docs, language).withColumn("label", (F.col("doc_id") % 2 == 0).cast("double"))
    got = {r.doc_id for r in scan(docs, known.filter("doc_id < 200")).filter("doc_id >= 200").collect()}
    assert got == {n for n in range(200, 300) if n % 2 == 0}


def test_language_counts_all_documents(spark):
    docs = spark.createDataFrame([(1, "alpha beta"), (2, "alpha GAMMA x"), (3, None)], "doc_id long, text string")
    language = count_language(docs, max_words=2)
    assert language.words == {"alpha", "beta"}
    assert language.covered("alphaXbeta") == 0.9 and language.covered("zzzz") == 0
    assert language.transitions("qq") == [language.floor]
    assert Language().covered("word") == 0


def test_positions(spark):
    text = "é" * 10 + ' api_key: "abcdefghij0123456789" and ' + "x" * 200_000
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    rows = find_candidates(docs, Language()).orderBy("start").collect()
    assert [text[r.start : r.start + r.length][:10] for r in rows] == ["abcdefghij", "x" * 10]
    assert distant_labels(find_candidates(docs, Language())).orderBy("start").first().label == 1.0


def test_odd_rows(odd):
    assert scan(odd).collect() == []
    assert scan(odd.limit(0)).collect() == []
