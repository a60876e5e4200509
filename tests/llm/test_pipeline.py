import re

import corpus_pipeline
from patronlens.llm import quality
from patronlens.llm.decontam import normal_form
from tests.llm.test_packing import check_packed
from tests.llm.test_pii import PLAIN
from tests.llm.test_simhash import brute


def test_stages_against_brute_force(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    labels, bench = (spark.read.parquet(f"{tiny}/{n}.parquet") for n in ("labels", "benchmark"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    model = quality.fit_quality(docs, labels)
    kept = {i for i, t in texts.items() if model.score(quality.statistics(t.encode())[None, :])[0] >= 0.3}
    kept = {c for i, _, c in brute([(i, texts[i]) for i in sorted(kept)])}
    items = [normal_form(r.text) for r in bench.collect()]
    kept = {i for i in kept if not any(x in normal_form(texts[i]) for x in items)}

    frame, names = docs, [n for n, _ in corpus_pipeline.STAGES]
    assert names[:2] == ["quality_classifier", "simhash_near_dedup"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, tiny)
        assert frame.columns == docs.columns and frame.dtypes == docs.dtypes
    rows = {r.doc_id: r for r in frame.collect()}
    assert rows.keys() == kept
    for i, r in rows.items():
        assert PLAIN.sub("#", r.text) == PLAIN.sub("#", texts[i]) and r.n_chars == len(r.text)
        assert not set(PLAIN.findall(r.text)) & set(PLAIN.findall(texts[i]))
    packed = corpus_pipeline.run(spark, tiny).collect()
    assert {r.doc_id for r in packed} == kept
    check_packed(packed, 2048)


def test_odd_documents(spark, tiny, odd):
    docs = odd.select("doc_id", "text", "lang", "source").selectExpr("*", "length(text) AS n_chars").selectExpr(
        "doc_id", "text", "lang", "source", "CAST(n_chars AS BIGINT) AS n_chars"
    )
    frame = docs
    for _, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, tiny)
    frame.collect()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), tiny).collect() == []


def test_texts_of_one_id_are_documents_of_their_own(spark, tiny):
    a, b = "one text about rivers and the stones in them", "quite another text on ships that sail far"
    rows = [(1, a, 1), (1, b, 2), (2, b, 3), (3, a, 4), (1, a, 1), (None, a, 5), (4, "", 6), (5, None, 7), (6, None, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _hash int")
    kept = sorted(corpus_pipeline.keep_one_of_each(spark, docs, tiny).collect(), key=lambda r: r._hash)
    assert [tuple(r) for r in kept] == [(1, a, 1), (1, b, 2), (None, a, 5), (4, "", 6)]


def test_columns_named_like_the_models_own_stay(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet").drop("n_chars")
    clashing = docs.selectExpr("*", "doc_id AS score", "'mine' AS predicted", "'x' AS _score", "1 AS _hash")
    frame = clashing
    for _, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, tiny)
        assert frame.columns == clashing.columns
    rows = frame.collect()
    assert rows and all((r.score, r.predicted, r._score, r._hash) == (r.doc_id, "mine", "x", 1) for r in rows)


def test_guard_only_forgives_absence():
    source = open("__spark_entry__.py").read()
    assert re.search(r"except ModuleNotFoundError", source) and "raise" in source
