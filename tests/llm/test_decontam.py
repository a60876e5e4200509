import random

import numpy as np

from patronlens.llm import decontam
from patronlens.llm.decontam import Walks, edit_distance, find_leaks, leaked_documents, normal_form, without_leaks


def plain_distance(item, text):
    """Sellers' table: distance of the item to the best part of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def edited(rng, text, edits):
    signs = list(text)
    for _ in range(edits):
        at = rng.randrange(len(signs))
        kind = rng.randrange(3)
        if kind == 0:
            signs[at] = rng.choice("abcde ")
        elif kind == 1:
            signs.insert(at, rng.choice("abcde "))
        elif len(signs) > 1:
            signs.pop(at)
    return "".join(signs)


def test_bit_parallel_distance():
    rng = random.Random(0)
    for _ in range(200):
        item = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 80)))
        text = edited(rng, "".join(rng.choice("abc") for _ in range(20)) + item + "cab", rng.randrange(6))
        want = plain_distance(item, text)
        assert edit_distance(item, text, 200) == want
        assert edit_distance(item, text, want - 1) is None


def test_recall_of_edited_passages_and_no_others(spark, tiny):
    rng = random.Random(1)
    docs = [r.text for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()]
    bench = spark.read.parquet(f"{tiny}/benchmark.parquet")
    items = {r.item_id: r.text for r in bench.collect()}
    rows, want = [], set()
    for n, (i, text) in enumerate(items.items()):
        for share in (0.0, 0.03, 0.06):
            leak = edited(rng, text.upper() if share == 0 else text, int(share * len(text)))
            rows.append((len(rows), docs[n][:700] + " ..\n" + leak + "\n" + docs[n + 50][:700]))
            want.add((rows[-1][0], i))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = find_leaks(df, bench).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    assert len(got & want) >= 0.98 * len(want)
    texts = dict(rows)
    for r in found:
        item = normal_form(items[r.item_id])
        assert plain_distance(item, normal_form(texts[r.doc_id])) <= r.distance <= 0.1 * len(item)
    # In blocks of the benchmark the result is the same.
    assert {(r.doc_id, r.item_id) for r in find_leaks(df, bench, block_bytes=2000).collect()} == got
    kept = {r.doc_id for r in without_leaks(df, bench, block_bytes=2000).collect()}
    assert kept == set(texts) - {i for i, _ in got}


def test_tables_follow_the_target():
    few, many = Walks.for_recall(0.8), Walks.for_recall(0.999)
    assert few.tables < many.tables and few.recall(0.2, 4) >= 0.8 and many.recall(0.2, 4) >= 0.999
    assert Walks.for_recall(0.98) == Walks()


def test_documents_match_exact_search(spark, tiny):
    docs, bench = (spark.read.parquet(f"{tiny}/{n}.parquet") for n in ("documents", "benchmark"))
    texts = {r.doc_id: normal_form(r.text) for r in docs.collect()}
    items = {r.item_id: normal_form(r.text) for r in bench.collect()}
    want = {d for d, t in texts.items() if any(i in t for i in items.values())}
    assert {r.doc_id for r in leaked_documents(find_leaks(docs, bench)).collect()} == want


def test_long_texts_are_read_in_slices(spark, monkeypatch):
    item = "the quick brown fox jumps over thirteen lazy dogs beside a silent river at dawn while nobody watches"
    text = "filler words of no meaning " * 200 + item + " more filler words follow " * 200
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    batch = docs.toArrow().to_batches()
    monkeypatch.setattr(decontam, "SLICE", 512)
    items = decontam.Items.of([(9, item)], decontam.Walks(), 0.9)
    out = [r for b in decontam._leaks_of(iter(batch), items, "doc_id", "item_id") for r in b.to_pylist()]
    assert [(r["doc_id"], r["item_id"], r["distance"]) for r in out] == [(1, 9, 0)]


def test_odd_rows(odd, spark):
    bench = spark.createDataFrame(
        [(1, "lorem ipsum dolor sit amet consectetur lorem ipsum dolor"), (2, None), (3, "..."), (4, ""), (None, "no such words here")],
        "item_id long, text string",
    )
    assert {(r.doc_id, r.item_id) for r in find_leaks(odd, bench).collect()} == {(5, 1), (6, 1)}
    kept = without_leaks(odd, bench)
    assert kept.schema == odd.schema
    assert sorted(map(str, kept.collect())) == sorted(str(r) for r in odd.collect() if r.doc_id not in (5, 6))
    assert find_leaks(odd.limit(0), bench).collect() == []
    assert find_leaks(odd, bench.limit(0)).collect() == []


def test_short_and_unspaced_quotes_are_found(spark):
    rng = np.random.default_rng(12)
    words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(2, 9))) for _ in range(400)]
    spaced = lambda size: " ".join(rng.choice(words, size))[:size].strip()
    unspaced = lambda size: "".join(map(chr, rng.integers(0x4E00, 0x9FA0, size)))
    items = ["What is the capital of France?"]
    items += [make(size) for make in (spaced, unspaced) for size in (10, 15, 20, 25, 30, 35, 40, 50, 60, 120) for _ in range(4)]
    docs = []
    for i, item in enumerate(items):
        make, glue = (unspaced, "") if ord(item[1]) > 0x4E00 else (spaced, " ")
        changed = item[: len(item) // 2] + "x" + item[len(item) // 2 + 1 :] if len(item) > 20 else item
        docs += [(i, glue.join([make(300), quote, make(300)])) for quote in (item, changed)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = [(r.doc_id, r.item_id) for r in decontam.find_leaks(df, bench).collect()]
    assert sum(found.count((i, i)) for i in range(len(items))) >= 2 * len(items) - 1
    assert decontam.without_leaks(df, bench).count() <= 1
