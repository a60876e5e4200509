"""A training corpus from raw documents: five stages, each one of the library's operators.

Each stage works on all documents that its predecessor kept. Stages but the last
return the columns of documents; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlens.llm import decontam, packing, pii, quality, simhash
from patronlens.llm.common import free_name, table
from patronlens.llm.queries import HELD_OUT_THRESHOLD, KEY
from patronlens.session import materialize


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents that it rejects go."""
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    score, predicted = free_name(docs, "_score"), free_name(docs, "_predicted")
    scored = quality.score_quality(docs, model, HELD_OUT_THRESHOLD, score_col=score, predicted_col=predicted)
    return scored.filter(F.col(predicted) == 1).select(docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: the smallest doc_id of each group stays.

    A document is told by its id and its text, so different texts of one id are in groups of
    their own; of rows equal in both one stays. Rows without an id, which no group can name, stay.
    """
    key = F.struct(F.col("doc_id"), F.xxhash64("text").alias("hash"))
    named = docs.filter(F.col("doc_id").isNotNull())
    found = simhash.near_duplicates(named.select(key.alias("document"), "text"), width=4, limit=4, id_col="document")
    first = found.filter(F.col("document") == F.col("component_id")).select("document.*").distinct()
    hashed = free_name(docs, "_hash")
    kept = named.withColumn(hashed, F.xxhash64("text")).join(first.withColumnRenamed("hash", hashed), ["doc_id", hashed], "left_semi")
    return kept.dropDuplicates(["doc_id", hashed]).select(docs.columns).unionByName(docs.filter(F.col("doc_id").isNull()))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold a benchmark item go."""
    return decontam.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def replace_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """PII: personal data get surrogates; n_chars follows the text."""
    replaced = pii.replace_personal_data(docs, KEY)
    if "n_chars" not in docs.columns:
        return replaced
    return replaced.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing into sequences of 2048 tokens."""
    return packing.pack_documents(docs, 2048)


STAGES = [
    ("quality_classifier", keep_good),
    ("simhash_near_dedup", keep_one_of_each),
    ("benchmark_decontamination", drop_leaks),
    ("pii_surrogates", replace_personal),
    ("best_fit_packing", pack),
]

#: Trees, tokens and edit distances are beyond SQL; the tests compare the result with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
