import itertools
import zlib
from collections import Counter

from pyspark.sql import functions as F

from patronlens.llm.queries import op6_hilbert_sharding
from patronlens.llm.sharding import hilbert_index, name_cells, shard, write_shards
from tests.llm.conftest import python_free


def test_curve_visits_every_cell_by_single_steps(spark):
    for dims, bits in ((2, 3), (3, 2), (4, 2)):
        cells = list(itertools.product(range(1 << bits), repeat=dims))
        df = spark.createDataFrame(cells, ", ".join(f"c{d} int" for d in range(dims)))
        index = hilbert_index([F.col(f"c{d}") for d in range(dims)], bits).alias("i")
        order = [tuple(r)[:-1] for r in sorted(df.select("*", index).collect(), key=lambda r: r.i)]
        assert sorted(order) == cells
        assert all(sum(abs(a - b) for a, b in zip(p, q)) == 1 for p, q in zip(order, order[1:]))


def check(rows, texts, shards=16):
    sizes = Counter(r.shard for r in rows)
    assert len(rows) == len(texts)
    assert set(sizes) <= set(range(shards))
    counts = [sizes[s] for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))


def test_documents(spark, tiny, documents):
    df = op6_hilbert_sharding(spark, tiny)
    assert python_free(df)
    rows, texts = df.collect(), {r.doc_id: r.text for r in documents.collect()}
    check(rows, texts)
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "rows", None)
    # Runs of the curve: a later shard never begins before an earlier one ends.
    bounds = [(min(x), max(x)) for x in ([r.curve for r in rows if r.shard == s] for s in range(16))]
    assert all(a[1] <= b[0] for a, b in zip(bounds, bounds[1:]))


def test_odd_rows(odd):
    rows = shard(odd.drop("shard"), 3).collect()
    check(rows, odd.collect(), 3)
    assert {(r.size, r.text_crc32) for r in rows if r.doc_id in (2, 3)} == {(1, 0)}
    check(shard(odd, 16).collect(), odd.collect(), 16)  # fewer rows than shards
    assert shard(odd.limit(0), 16).collect() == []


def test_names_lie_in_order_and_by_frequency(spark):
    names = ["a"] * 50 + ["b", "c", "d"] + ["e"] * 40 + ["f"] * 7 + [None] * 5
    df = spark.createDataFrame([(n,) for n in names], "name string")
    cells = {}
    for r in df.select("name", name_cells(df, ["name"], 4)[0].alias("cell")).collect():
        assert cells.setdefault(r.name, r.cell) == r.cell
    assert cells == {None: 0, "a": 4, "b": 8, "c": 8, "d": 8, "e": 11, "f": 15}


def test_files_are_pruned_by_every_dimension(spark):
    """Of 16 shards, about half hold a given source or language, and fewer a given id."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    placed = docs.drop("text").join(shard(docs), "doc_id")
    for column, most in (("source", 9), ("lang", 12), ("doc_id", 9)):
        bounds = placed.groupBy("shard").agg(F.min(column).alias("lo"), F.max(column).alias("hi")).collect()
        asked = [r[0] for r in placed.select(column).distinct().orderBy(F.xxhash64(column)).limit(50).collect()]
        read = [sum(b.lo <= value <= b.hi for b in bounds) for value in asked]
        print(column, sum(read) / len(read))
        assert sum(read) / len(read) <= most


def test_written_shards(spark, tiny, documents, tmp_path):
    write_shards(documents, shard(documents, 4), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.drop("shard", "slot").exceptAll(documents).count() == 0 == documents.exceptAll(back.select(documents.columns)).count()
    placed = {r.doc_id: (r.shard, r.slot) for r in shard(documents, 4).collect()}
    assert {r.doc_id: (r.shard, r.slot) for r in back.collect()} == placed
