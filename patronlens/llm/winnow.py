"""Document fingerprints by winnowing.

Every stretch of ``k`` signs (a gram) has a rolling hash. Of each window of ``window``
grams in a row the least hash is kept, the rightmost one in a tie, with its place. Two texts that share
a stretch of ``window + k - 1`` signs share a whole window and so keep the same gram of
it: no such match is missed. About 2 of ``window + 1`` grams are kept.

Signs are the code points of a text without ASCII white space, A to Z lowered; places
are those of the text itself. The rolling hash is a polynomial modulo 2^64, all grams of a text
at once from one running sum, mixed so that the least value is a fair draw.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type


#: Signs that are worked on at once, beyond one text: each takes about a hundred bytes of sums, hashes and places.
AT_ONCE = 1 << 19
#: Signs of a gram, and grams of a window: every shared stretch of 59 signs is met.
GRAM, WINDOW = 20, 40
# Fixed values of the hash: an odd multiplier, its inverse modulo 2^64, and the mixing multipliers.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)

FINGERPRINT_TYPE = "array<struct<position: bigint, hash: bigint>>"
_PRINT = np.dtype([("position", ">u4"), ("hash", ">u8")])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX[0])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX[1])
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _least_of_windows(values: np.ndarray, window: int) -> np.ndarray:
    """Place of the least value, the rightmost in a tie, of each window that starts at each place.

    Windows double until they overlap to the wanted length. Those that would pass the end are left out.
    """
    at, size = np.arange(len(values)), 1
    while size < window:
        shift = min(size, window - size)
        left, right = at[: max(0, len(at) - shift)], at[shift:]
        at = np.where(values[right] <= values[left], right, left)
        size += shift
    return at


def winnow(texts: list[str], k: int = GRAM, window: int = WINDOW) -> list[tuple[np.ndarray, np.ndarray]]:
    """(positions, hashes) of each text, by position.

    A text of fewer than ``k`` signs is one gram, one of fewer than ``window`` grams one
    window; a text without signs has no fingerprint. Long texts are worked on piece by piece.
    """
    short = _winnow([t if len(t) <= AT_ONCE else "" for t in texts], k, window)
    return [_winnow_long(t, k, window) if len(t) > AT_ONCE else found for t, found in zip(texts, short, strict=True)]


def _winnow_long(text: str, k: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """As ``_winnow``, from pieces that share the signs of all windows but one, so that each window lies in a piece."""
    shared = window + k - 2
    start, size, found = 0, AT_ONCE, []
    while True:
        piece = text[start : start + size]
        last = start + size >= len(text)
        place = _sign_places(np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), "<u4"))
        if len(place) > shared or (last and not found):
            at, hashes = _winnow([piece], k, window)[0]
            found.append((at + start, hashes))
        if last:
            break
        if len(place) > shared:
            start, size = start + int(place[len(place) - shared]) if shared else start + size, AT_ONCE
        else:
            size *= 2
    positions, first = np.unique(np.concatenate([at for at, _ in found]), return_index=True)
    return positions, np.concatenate([hashes for _, hashes in found])[first]


def _sign_places(codes: np.ndarray) -> np.ndarray:
    return np.flatnonzero((codes > 32) | (codes < 9) | ((codes > 13) & (codes < 32)))


def _winnow(texts: list[str], k: int, window: int) -> list[tuple[np.ndarray, np.ndarray]]:
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.concatenate([[0], np.cumsum(lengths)])
    place = _sign_places(codes)
    signs = codes[place].astype(np.uint64)
    signs += np.where((signs >= 65) & (signs <= 90), np.uint64(32), np.uint64(0))
    ends = np.searchsorted(place, starts)
    counts = np.diff(ends)
    # Sums of signs times powers; a gram is the difference of two, brought down to power zero.
    n = len(signs)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((signs + np.uint64(1)) * _powers(BASE, n), out=total[1:])
    grams = _mixed((total[k:] - total[: n + 1 - k]) * _powers(INVERSE, n + 1 - k)) if n >= k else np.zeros(0, np.uint64)
    least = _least_of_windows(grams, window)
    # A window counts if it lies within one text.
    owner = np.repeat(np.arange(len(texts)), counts)
    last = window + k - 2
    inside = owner[: max(0, n - last)] == owner[last:] if n > last else np.zeros(0, bool)
    kept = np.unique(least[: len(inside)][inside])
    cuts = np.searchsorted(kept, ends)
    out = []
    for text, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)):
        if b - a > last:
            at = kept[cuts[text] : cuts[text + 1]]
            hashes = grams[at]
        elif b - a >= k:
            some = grams[a : b - k + 1]
            at = np.array([a + len(some) - 1 - int(np.argmin(some[::-1]))])
            hashes = grams[at]
        elif b > a:
            at = np.array([a])
            hashes = _mixed((total[b : b + 1] - total[a]) * np.uint64(pow(INVERSE, a, 1 << 64)) + np.uint64(b - a))
        else:
            at, hashes = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        out.append((place[at] - starts[text] if len(at) else at, hashes))
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the different hashes of two texts that both have; two empty fingerprints are alike."""
    a, b = np.unique(a), np.unique(b)
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def printed(positions: np.ndarray, hashes: np.ndarray) -> str:
    """24 lower-case digits for each gram kept: 8 of its position, 16 of its hash."""
    out = np.empty(len(hashes), _PRINT)
    out["position"], out["hash"] = positions, hashes
    return out.tobytes().hex()


def fingerprints(
    docs: DataFrame, k: int = GRAM, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_chars, fingerprint) of each row: the positions (code points from 0) and hashes kept, by position.

    Null and empty texts, and those of white space only, have an empty fingerprint. Null ids
    are kept and repeated rows come out as often as they go in. Whole texts are read.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in _sliced(batch):
                prints = winnow(texts, k, window)
                sizes = np.cumsum([0, *[len(h) for _, h in prints]])
                positions = np.concatenate([np.zeros(0, np.int64), *[p for p, _ in prints]])
                hashes = np.concatenate([np.zeros(0, np.uint64), *[h for _, h in prints]])
                items = pa.StructArray.from_arrays([pa.array(positions), pa.array(hashes.view(np.int64))], names=["position", "hash"])
                lists = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), items)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([len(t) for t in texts], pa.int64()), lists], [id_col, "n_chars", "fingerprint"]
                )

    rows = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    return rows.mapInArrow(work, f"`{id_col}` {kind}, n_chars bigint, fingerprint {FINGERPRINT_TYPE}")


def _sliced(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, list[str]]]:
    """Ids and texts (null: empty) of a batch, some megabytes at a time."""
    first, size, texts = 0, 0, []
    for text in batch.column(1):
        texts.append(text.as_py() or "")
        size += len(texts[-1])
        if size >= AT_ONCE:
            yield batch.column(0).slice(first, len(texts)), texts
            first, size, texts = first + len(texts), 0, []
    if texts:
        yield batch.column(0).slice(first, len(texts)), texts


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by as much of the beginning of ``following``."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> DataFrame:
    """(part, extra, id, text) sorted within partitions so that the next row in order follows each.

    Order is by id (none last), then by a hash of the text. Rows are dealt into stretches of
    that order, as many as shuffle partitions unless ``parts`` says so, with bounds taken from the ids alone; texts are
    shuffled once. The first row of a stretch also comes, as ``extra`` = 1, at the end of the
    stretch before, and the very first one at the end of the last.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_hash"), text.alias("_text"))
    ordered = rows.select("_id", "_hash").repartitionByRange(parts, F.col("_id").asc_nulls_last(), F.col("_hash"))
    # One row per stretch goes to the driver.
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_hash")).alias("first")
    firsts = ordered.groupBy(F.spark_partition_id()).agg(first).select("first.*").collect()
    bounds = sorted(_order_key(b["_id"], b["_hash"]) for b in firsts)

    def stretch(ids: pa.Array, hashes: pa.Array) -> pa.Array:
        """The stretch of each row, then for the first one of a stretch the stretch before."""
        found = []
        for key in map(_order_key, ids.to_pylist(), hashes.to_pylist()):
            n = bisect.bisect_right(bounds, key) - 1
            found.append([n, (n - 1) % len(bounds)] if bounds[n] == key else [n])
        return pa.array(found, pa.list_(pa.int32()))

    stretch.__annotations__ = {"ids": pa.Array, "hashes": pa.Array, "return": pa.Array}
    dealt = rows.withColumn("_parts", F.arrow_udf(stretch, "array<int>")("_id", "_hash"))
    dealt = dealt.select("_id", "_hash", "_text", F.posexplode("_parts").alias("extra", "part"))
    near = dealt.repartitionById(max(1, len(bounds)), F.col("part")).sortWithinPartitions(
        "part", "extra", F.col("_id").asc_nulls_last(), "_hash"
    )
    return near.select("part", "extra", F.col("_id").alias(id_col), F.col("_text").alias(text_col))


def _order_key(id_: object, hashed: int) -> tuple:
    return (id_ is None, 0 if id_ is None else id_, hashed)


def compare_with_edits(
    docs: DataFrame, k: int = GRAM, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Each row's fingerprint held against that of its edited text and of the next row.

    The edited text has its last quarter replaced by as much of the next row's beginning. Returns id,
    n_chars, edited_sha256, fingerprint and edited_fingerprint (``printed``), near_edited and near_next
    (``likeness``). Null texts count as empty. Rows without an id come last in the order; the
    next one of the last row is the first one, for a single row that row itself. Repeated rows follow one another.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def compared(rows: list[tuple]) -> pa.RecordBatch:
        """Results of rows that are followed by one of their own stretch."""
        texts = [row[3] for row in rows]
        asked = [n for n in range(len(rows) - 1) if rows[n][0] == rows[n + 1][0] and not rows[n][1]]
        changed = [edited(texts[n], texts[n + 1]) for n in asked]
        prints = winnow(texts, k, window)
        others = winnow(changed, k, window)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([rows[n][2] for n in asked], id_type),
                pa.array([len(texts[n]) for n in asked], pa.int64()),
                pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed], pa.string()),
                pa.array([printed(*prints[n]) for n in asked], pa.string()),
                pa.array([printed(*p) for p in others], pa.string()),
                pa.array([likeness(prints[n][1], p[1]) for n, p in zip(asked, others, strict=True)], pa.float64()),
                pa.array([likeness(prints[n][1], prints[n + 1][1]) for n in asked], pa.float64()),
            ],
            names=names,
        )

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                columns = [batch.column(c).slice(at, 64).to_pylist() for c in range(4)]
                for part, extra, id_, text in zip(*columns, strict=True):
                    held.append((part, extra, id_, text or ""))
                    size += len(held[-1][3])
                    if size >= AT_ONCE and len(held) > 1:
                        yield compared(held)
                        held, size = held[-1:], len(held[-1][3])
        if len(held) > 1:
            yield compared(held)

    id_type = to_arrow_type(docs.schema[id_col].dataType)
    schema = (
        f"`{id_col}` {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string,"
        " near_edited double, near_next double"
    )
    return with_next(docs, id_col, text_col).mapInArrow(follow, schema)
