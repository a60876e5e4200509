"""Hard negatives by exact inner-product search with coordinate pruning.

Rows lie in buckets of similar length, longest first within a label. A bucket keeps, for every
coordinate, its unit vectors sorted by that coordinate. An anchor asks a bucket for all rows whose
product reaches a threshold t. With the bucket's greatest length that is a least cosine c; a bucket that
would need a cosine above 1 is passed over. Otherwise the unit vectors within reach of the
anchor's form a cap, and each coordinate f of such a vector lies between

    a_f c - sqrt((1 - a_f^2)(1 - c^2))  and  a_f c + sqrt((1 - a_f^2)(1 - c^2)),

or up to 1 or -1 where that pole is in the cap. The ranges of the anchor's few largest coordinates are
found in the sorted lists by bisection, the candidates are the rows in all of them, and their products
are then taken exactly. Thresholds rise as better rows are found: the last of the best ones known,
for the positives of an anchor and for each interval of scores that its negatives may have.

Products are whole numbers. Anchors are taken in blocks of bounded size; each block meets all rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patronlens.session import materialize, scratch_path

#: Rows of a bucket and anchors of a block.
BUCKET_ROWS, BLOCK_ANCHORS = 4096, 16_384
#: Coordinates whose ranges are intersected.
FOCUS = 3
#: Room for the rounding of the bounds, which are doubles.
SLACK = 1e-9
_LOWEST = np.iinfo(np.int64).min


class Bucket:
    """Rows with their sorted coordinate lists."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.labels, self.vectors = ids, labels, vectors
        real = vectors.astype(np.float64)
        lengths = np.sqrt((real * real).sum(axis=1))
        self.longest = float(lengths.max())
        self.units = real / np.maximum(lengths, 1e-300)[:, None]
        self.order = np.argsort(self.units, axis=0, kind="stable").T.astype(np.int32)
        self.lists = np.take_along_axis(self.units, self.order.T.astype(np.int64), axis=0).T.copy()
        # Doubles hold products exactly up to 2^53.
        self.exact = real if _fits(vectors, 1 << 53) else None

    def cosine_needed(self, threshold: float, length: float) -> float:
        """The least cosine with which a row of this bucket can reach ``threshold``; -1 if all rows must be looked at."""
        if threshold <= 0:
            return -1.0
        reach = length * self.longest
        return threshold / reach * (1 - SLACK) - SLACK if reach > 0 else 2.0

    def candidates(self, unit: np.ndarray, focus: np.ndarray, cosine: float) -> np.ndarray | None:
        """Rows whose ``focus`` coordinates are all in their feasible range; None stands for all rows."""
        if cosine <= -1:
            return None
        spread = math.sqrt(max(0.0, 1 - cosine * cosine))
        ranges = []
        for f in focus.tolist():
            a = float(unit[f])
            off = math.sqrt(max(0.0, 1 - a * a)) * spread + SLACK
            low = -2.0 if -a >= cosine else a * cosine - off
            high = 2.0 if a >= cosine else a * cosine + off
            first = int(np.searchsorted(self.lists[f], low, "left"))
            ranges.append((int(np.searchsorted(self.lists[f], high, "right")) - first, first, f, low, high))
        ranges.sort()
        size, first, f, _, _ = ranges[0]
        found = self.order[f, first : first + size]
        for _, _, f, low, high in ranges[1:]:
            value = self.units[found, f]
            found = found[(value >= low) & (value <= high)]
        return found

    def products(self, anchor: np.ndarray, rows: np.ndarray | None) -> np.ndarray:
        if self.exact is not None and anchor.dtype == np.float64:
            some = self.exact if rows is None else self.exact[rows]
            return (some @ anchor).astype(np.int64)
        some = self.vectors if rows is None else self.vectors[rows]
        return (some * anchor.astype(np.int64)).sum(axis=1)


def _fits(vectors: np.ndarray, limit: int) -> bool:
    top = int(np.abs(vectors).max()) if vectors.size else 0
    return top * top * max(1, vectors.shape[1]) < limit


class Anchors:
    """A block of anchors with the thresholds that the rows seen so far set."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.labels = ids, labels
        real = vectors.astype(np.float64)
        self.lengths = np.sqrt((real * real).sum(axis=1))
        self.units = real / np.maximum(self.lengths, 1e-300)[:, None]
        self.vectors = real if _fits(vectors, 1 << 53) else vectors
        self.focus = np.argsort(-np.abs(self.units), axis=1, kind="stable")[:, :FOCUS]

    def reached(self, bucket: Bucket, n: int, threshold: float, wanted: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the rows of ``bucket``, but the anchor's own, that reach ``threshold`` for anchor ``n``."""
        cosine = bucket.cosine_needed(threshold, self.lengths[n])
        none = np.zeros(0, np.int64)
        if cosine > 1:
            return none, none
        rows = bucket.candidates(self.units[n], self.focus[n], cosine)
        if rows is not None and not len(rows):
            return none, none
        scores = bucket.products(self.vectors[n], rows)
        good = scores >= threshold
        good &= (wanted if rows is None else wanted[rows]) if wanted is not None else True
        at = np.flatnonzero(good)
        ids = bucket.ids[at if rows is None else rows[at]]
        other = ids != self.ids[n]
        return ids[other], scores[at][other]


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def find_positives(anchors: Anchors, buckets: Iterator[Bucket], k: int) -> Iterator[tuple[int, int, int]]:
    """(anchor, id, score): the ``k`` highest rows of an anchor's label among those of some buckets."""
    none = np.zeros(0, np.int64)
    best = [(none, none)] * len(anchors.ids)
    for bucket in buckets:
        for label in np.unique(bucket.labels).tolist():
            wanted = None
            for n in np.flatnonzero(anchors.labels == label).tolist():
                if wanted is None:
                    wanted = bucket.labels == label
                ids, scores = best[n]
                least = int(scores[-1]) if len(scores) == k else _LOWEST
                new_ids, new_scores = anchors.reached(bucket, n, least, wanted)
                if len(new_ids):
                    best[n] = _best(np.concatenate([ids, new_ids]), np.concatenate([scores, new_scores]), k)
    for n, (ids, scores) in enumerate(best):
        for id_, score in zip(ids.tolist(), scores.tolist(), strict=True):
            yield n, id_, score


def find_negatives(
    anchors: Anchors, intervals: list[list[tuple[int, int]]], buckets: Iterator[Bucket], k: int
) -> Iterator[tuple[int, int, int]]:
    """(anchor, id, score): rows of other labels that are among the ``k`` highest of some interval in some buckets."""
    none = np.zeros(0, np.int64)
    best = [[(none, none)] * len(held) for held in intervals]
    asking = [n for n, held in enumerate(intervals) if held]
    for bucket in buckets:
        only = bucket.labels[0] if (bucket.labels == bucket.labels[0]).all() else None
        for n in asking:
            label = anchors.labels[n]
            if only is not None and only == label:
                continue
            needed = [
                max(low, int(scores[-1])) if len(scores) == k else low
                for (low, _), (_, scores) in zip(intervals[n], best[n], strict=True)
            ]
            wanted = None if only is not None else bucket.labels != label
            ids, scores = anchors.reached(bucket, n, min(needed), wanted)
            if not len(ids):
                continue
            for i, (_, high) in enumerate(intervals[n]):
                some = (scores >= needed[i]) & (scores <= high)
                if some.any():
                    old_ids, old_scores = best[n][i]
                    best[n][i] = _best(np.concatenate([old_ids, ids[some]]), np.concatenate([old_scores, scores[some]]), k)
    for n in asking:
        pairs = {pair for ids, scores in best[n] for pair in zip(ids.tolist(), scores.tolist(), strict=True)}
        for id_, score in sorted(pairs):
            yield n, id_, score


def interval(positive: int, low_percent: int, high_percent: int) -> tuple[int, int]:
    """Least and greatest whole score with low * positive <= 100 * score <= high * positive."""
    return -(-low_percent * positive // 100), high_percent * positive // 100


def prepared(vectors: DataFrame, scale: int, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """(id, label, v) of the rows that take part, components scaled and floored, sorted by label and falling length.

    Rows with a null id, label or vector or a null or non-finite component take no part, nor
    do empty vectors, those of another length than most (the greater in a tie) and those
    whose products could leave the range of a long. Of several rows with one id the least
    by label and vector counts.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    real = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("v") > 0) & real)
    lengths = rows.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("rows"))
    most = lengths.orderBy(F.desc("rows"), F.desc("n")).first()
    size = most["n"] if most else 1
    bound = math.isqrt(((1 << 63) - 1) // size)
    rows = rows.filter((F.size("v") == size) & F.forall("v", lambda x: F.abs(F.lit(float(scale)) * x) < float(bound)))
    rows = rows.withColumn("v", F.transform("v", lambda x: F.floor(F.lit(float(scale)) * x)))
    rows = rows.groupBy("id").agg(F.min(F.struct("label", "v")).alias("_row")).select("id", "_row.*")
    square = F.aggregate("v", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    rows = rows.withColumn("_square", square)
    order = [F.col("label"), F.desc("_square"), F.col("id")]
    return materialize(rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("_square"))


def _buckets(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[Bucket]:
    """Buckets of (id, label, v) rows as they come: a whole batch cut into equal parts of at most ``rows``."""
    for batch in batches:
        parts = math.ceil(batch.num_rows / rows)
        for n in range(parts):
            at, end = batch.num_rows * n // parts, batch.num_rows * (n + 1) // parts
            vectors = batch.column(2).slice(at, end - at).flatten().to_numpy(zero_copy_only=False).reshape(end - at, -1)
            ids, labels = (batch.column(c).slice(at, end - at).to_numpy(zero_copy_only=False) for c in (0, 1))
            yield Bucket(ids, labels, vectors)


def mine(
    vectors: DataFrame,
    is_anchor: str,
    positives: int = 5,
    negatives: int = 10,
    low_percent: int = 30,
    high_percent: int = 90,
    scale: int = 256,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    bucket_rows: int = BUCKET_ROWS,
    block_anchors: int = BLOCK_ANCHORS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows that satisfy ``is_anchor`` (SQL over ``id``). An anchor's positives are the
    ``positives`` other rows of its label with the highest inner products of the scaled, floored vectors;
    its negatives for each are the ``negatives`` highest rows of other labels whose score is between
    ``low_percent`` and ``high_percent`` of the positive's. Ties go to the smaller id; where there are fewer
    rows, all are returned. Ids are whole numbers. ``prepared`` tells which rows take part.
    """
    spark = vectors.sparkSession
    rows = prepared(vectors, scale, id_col, label_col, vector_col)
    chosen = materialize(rows.filter(is_anchor).withColumn("_hash", F.xxhash64("id")))
    blocks = max(1, math.ceil(chosen.count() / block_anchors))
    path = scratch_path(spark, "negatives")
    schema = "n int, id bigint, score bigint"
    names = ["n", "id", "score"]
    out_type = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    spark.createDataFrame([], out_type).write.parquet(path)

    def emitted(found: Iterator[tuple[int, int, int]]) -> Iterator[pa.RecordBatch]:
        held = list(found)
        columns = zip(*held, strict=True) if held else ((), (), ())
        kinds = (pa.int32(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    for block in range(blocks):
        # A block has about ``block_anchors`` rows, whatever the size of the table.
        some = chosen.filter(F.pmod("_hash", F.lit(blocks)) == block).orderBy("id").select("id", "label", "v").toArrow()
        if not some.num_rows:
            continue
        matrix = np.array(some["v"].to_pylist(), np.int64)
        ids, labels = some["id"].to_numpy(), some["label"].to_numpy()

        def with_positives(batches, ids=ids, labels=labels, matrix=matrix):
            yield from emitted(find_positives(Anchors(ids, labels, matrix), _buckets(batches, bucket_rows), positives))

        place = Window.partitionBy("n").orderBy(F.desc("score"), "id")
        near = rows.mapInArrow(with_positives, schema).withColumn("_place", F.row_number().over(place))
        near = near.filter(F.col("_place") <= positives).select("n", "id", "score").orderBy("n", F.desc("score"), "id").collect()
        spans: list[list[tuple[int, int]]] = [[] for _ in ids]
        pairs = []
        for row in near:
            low, high = interval(row["score"], low_percent, high_percent)
            if low <= high:
                spans[row["n"]].append((low, high))
                pairs.append((row["n"], int(ids[row["n"]]), row["id"], row["score"], low, high))

        def with_negatives(batches, ids=ids, labels=labels, matrix=matrix, spans=spans):
            yield from emitted(find_negatives(Anchors(ids, labels, matrix), spans, _buckets(batches, bucket_rows), negatives))

        asked = spark.createDataFrame(pairs, "n int, anchor_id long, positive_id long, positive_score long, _low long, _high long")
        hits = rows.mapInArrow(with_negatives, schema).withColumnsRenamed({"id": "negative_id", "score": "negative_score"})
        inside = asked.join(hits, "n").filter(F.col("negative_score").between(F.col("_low"), F.col("_high")))
        order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
        ranked = inside.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
        ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").write.mode("append").parquet(path)
    return spark.read.schema(out_type).parquet(path)
