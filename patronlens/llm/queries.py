"""The registered queries of the operators, and their SQL twins."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlens.llm import (
    ann,
    decontam,
    hardneg,
    packing,
    periodic,
    pii,
    quality,
    secrets,
    sharding,
    simhash,
    tokencount,
    warc,
    winnow,
)
from patronlens.llm.common import table, text_bytes
from patronlens.session import scratch_path

#: Production parameters.
KEY = "patronlens"
HELD_OUT_THRESHOLD = 0.3


def op1_rp_forest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return ann.nearest(table(spark, folder, "embeddings"), "id % 50 = 0", k=5)


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, folder, "documents"), limit=2048)


def op3_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Candidates that the forest takes for secrets."""
    return secrets.scan(table(spark, folder, "documents"), path_col="source")


def op4_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), 2048)


def op5_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold a benchmark item: doc_id, the items, the least number of edits."""
    leaks = decontam.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return decontam.leaked_documents(leaks)


def op6_hilbert_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard(table(spark, folder, "documents"), 16).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(sharding.LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )


def op7_warc_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """Write the archives, then read them back."""
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, folder, "pages"), path)
    return warc.read_records(spark, path)


def op8_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality.fit_quality(docs, table(spark, folder, "labels"))
    scored = quality.score_quality(docs.select("doc_id", "text"), model, HELD_OUT_THRESHOLD)
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


def op9_pii_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with their text rewritten and the number of mentions replaced."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return pii.replace_personal_data(docs, KEY, count_col="n_replaced")


def op10_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"), width=4, limit=4)
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def _planted_repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts whose id says so repeat their words from some place on, as the query prescribes."""
    for batch in batches:
        texts = text_bytes(batch.column(1))
        for row, (doc_id, text) in enumerate(zip(batch.column(0).to_pylist(), texts, strict=True)):
            hashed = None if doc_id is None else zlib.crc32(str(doc_id).encode())
            words = text.split() if text and hashed is not None and hashed % 10 == 0 else []
            if words:
                n, g = len(words), hashed // 10
                at = g % n
                period = 1 + (n - at) // (3 + g % 8)
                again = -(-(n - at) // period)
                texts[row] = b" ".join((words[:at] + words[at : at + period] * again)[:n])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "text"])


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of the documents, with repeats planted where the id asks for it, as digests."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = periodic.periodic_runs(docs.mapInArrow(_planted_repeats, docs.schema))
    ranked = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), -r["start"], -r["period"]))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = found.select("*", F.array_max(ranked).alias("_best"), F.array_join(line, "").alias("_lines"))
    return best.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("_best.col2")).alias("start"),
        F.col("_best.length").alias("length"),
        (-F.col("_best.col3")).alias("period"),
        F.expr("1000 * _best.length div -_best.col3").alias("exponent_milli"),
        F.sha2("_lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every hundredth vector, with the labels of every seventh one shifted."""
    rows = table(spark, folder, "embeddings")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(rows.select("vec_id", shifted.alias("label"), "embedding"), "id % 100 = 0")


def op13_winnowed_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return winnow.compare_with_edits(table(spark, folder, "documents"))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_rp_forest_neighbours,
        op2_token_counts,
        op3_secret_scan,
        op4_best_fit_packing,
        op5_benchmark_decontamination,
        op6_hilbert_sharding,
        op7_warc_chunks,
        op8_quality_classifier,
        op9_pii_surrogates,
        op10_simhash_near_dedup,
        op11_periodic_runs,
        op12_hard_negatives,
        op13_winnowed_fingerprints,
    )
}

#: The other operators use hashes, tokens, models or searches that DuckDB lacks; the tests hold brute force against them.
ORACLES: dict[str, str] = {
    "op7_warc_chunks": """
WITH hashed AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
     named AS (SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr(
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                      CAST(1 + ((CAST('0x' || substr(h, (i // 4) * 5 + 1, 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31) AS INT),
                      1)), '') AS payload_digest FROM hashed),
     firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS f FROM named)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = f THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> f THEN f END AS refers_to FROM firsts""",
}
