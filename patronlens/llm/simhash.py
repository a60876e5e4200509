"""SimHash near-duplicates, found by fuzzy hashing with the binary Golay code.

A 64-bit fingerprint is cut into segments of 23, 23 and 18 bits. The perfect
[23, 12] Golay code gives every segment the index of the one codeword within
three bits of it. ``near`` adds the indices of all words one bit away: six or one
in all. If two segments differ in at most one bit, the index of either is among
those of the other; if in two bits, their sets meet.

Four differing bits fall on three segments in one of two ways.

* Some segment agrees. Of the others one differs in two bits at most. Key: the
  agreeing segment as it is, and an index of the other (6 combinations).
* All differ. Then two segments differ in exactly one bit each, and the third in
  two at most, so that one of its three blocks agrees. Key: the index of one, the
  near indices of the other and the block (3 pairs, 2 directions, 3 blocks).

Every pair within the distance therefore shares a key, and a key holds about 35
bits, which keeps chance meetings rare. All meetings are verified on the
fingerprints themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlens.llm.common import SLICE_BYTES, per_row
from patronlens.operators.density import connected_components
from patronlens.session import materialize

#: Fixed values of the method: bits, seed of XXH64, greatest distance that the keys cover.
BITS, SEED, MAX_DISTANCE = 64, 42, 4
#: Start and length of the segments, and of the blocks of each.
SEGMENTS = ((0, 23), (23, 23), (46, 18))
BLOCKS = (((0, 8), (8, 8), (16, 7)), ((0, 8), (8, 8), (16, 7)), ((0, 6), (6, 6), (12, 6)))
#: Generator of the binary Golay code: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101
#: Rows of one key that a task compares at once; keys with more are compared block by block in tasks of their own.
RUN = 2048
#: Runs up to this length list their links; longer ones give a spanning forest of them.
LISTED = 16


def fingerprint(text: bytes | None, width: int = 4) -> int:
    """SimHash of the word shingles of ``text``; zero if it has no word.

    ASCII letters are lowered, words end at ASCII white space. The words are read
    slice by slice, so that a very long text needs little more memory than itself.
    """
    counts, total, held, at = np.zeros(BITS, np.int64), 0, [], 0
    text = text or b""
    while at < len(text):
        end = min(len(text), at + SLICE_BYTES)
        while end < len(text) and text[end : end + 1].strip():
            end += 1
        words = held + text[at:end].lower().split()
        last, at = end == len(text), end
        if len(words) >= width:
            line = b" ".join(words)
            sizes = np.fromiter(map(len, words), np.int64, len(words))
            ends = np.cumsum(sizes + 1) - 1
            starts = (ends - sizes)[: len(words) - width + 1].tolist()
            hashes = [xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist(), strict=True)]
        elif last and words and not total:
            hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
        else:
            hashes = []
        if hashes:
            counts += _bit_counts(np.array(hashes, "<u8"))
            total += len(hashes)
        held = words[max(0, len(words) - width + 1) :] if width > 1 else []
    bits = np.packbits(2 * counts > total, bitorder="little")
    return int(bits.view("<u8")[0])


def _bit_counts(values: np.ndarray) -> np.ndarray:
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(values), 1 << 14):
        part = values[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return counts


def fingerprints(docs: DataFrame, width: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): the fingerprint of each row as a signed long. Null and blank texts have zero."""
    kind = docs.schema[id_col].dataType.simpleString()

    def work(texts: list[bytes | None]) -> list[list]:
        values = np.fromiter((fingerprint(t, width) for t in texts), np.uint64, len(texts))
        return [values.view(np.int64)]

    rows = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    return rows.mapInArrow(per_row([("fp", pa.int64())], work), f"`{id_col}` {kind}, fp bigint")


class Golay:
    """Nearest codewords of the [23, 12] code, by syndrome."""

    def __init__(self) -> None:
        errors = [0]
        for weight in (1, 2, 3):
            errors += [sum(1 << i for i in bits) for bits in combinations(range(23), weight)]
        values = np.array(errors)
        self._bytes = [self._remainders(np.arange(256) << shift) for shift in (0, 8, 16)]
        self._error = np.zeros(2048, np.int64)
        self._error[self._syndrome(values)] = values
        self._flips = np.array([0, *[1 << i for i in range(23)]])

    @staticmethod
    def _remainders(values: np.ndarray) -> np.ndarray:
        rest = values.astype(np.int64)
        for bit in range(23, 10, -1):
            rest = np.where(rest >> bit & 1, rest ^ (GENERATOR << (bit - 11)), rest)
        return rest

    def _syndrome(self, x: np.ndarray) -> np.ndarray:
        return self._bytes[0][x & 255] ^ self._bytes[1][x >> 8 & 255] ^ self._bytes[2][x >> 16]

    def index(self, x: np.ndarray) -> np.ndarray:
        """Message of the codeword within three bits."""
        return (x ^ self._error[self._syndrome(x)]) >> 11

    def near(self, x: np.ndarray) -> np.ndarray:
        """Six columns: the indices of ``x`` and of all words one bit from it, -1 where there are fewer."""
        found = np.sort(self.index(x[:, None] ^ self._flips), axis=1)
        fresh = np.ones(found.shape, bool)
        fresh[:, 1:] = found[:, 1:] != found[:, :-1]
        out = np.full((len(x), 6), -1, np.int64)
        row, col = np.nonzero(fresh)
        out[row, (np.cumsum(fresh, axis=1) - 1)[row, col]] = found[row, col]
        return out


def link_keys(fps: np.ndarray, code: Golay) -> tuple[np.ndarray, np.ndarray]:
    """All (key, fingerprint) rows of some fingerprints; see the head of the module."""
    x = fps.view(np.uint64)
    part = [((x >> np.uint64(at)) & np.uint64((1 << size) - 1)).astype(np.int64) for at, size in SEGMENTS]
    index = [code.index(p) for p in part]
    near = [code.near(p) for p in part]
    keys, owners, tag = [], [], 0

    def add(rest: np.ndarray, some: np.ndarray) -> None:
        row, col = np.nonzero(some >= 0)
        keys.append((np.int64(tag) << 56) | (rest[row] << 12) | some[row, col])
        owners.append(fps[row])

    for i in range(3):
        for j in range(3):
            if i != j:
                add(part[i], near[j])
                tag += 1
    for k in range(3):
        i, j = (n for n in range(3) if n != k)
        for at, size in BLOCKS[k]:
            block = part[k] >> at & ((1 << size) - 1)
            add(block << 13 | index[i], near[j])
            # The other direction has its places exchanged so that both give the same key.
            row, col = np.nonzero(near[i] >= 0)
            keys.append((np.int64(tag) << 56) | ((block[row] << 13 | near[i][row, col]) << 12) | index[j][row])
            owners.append(fps[row])
            tag += 1
    return np.concatenate(keys), np.concatenate(owners)


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64))


def spanning_links(fps: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join distinct fingerprints exactly as all links within ``limit`` do, one fewer than there are at most."""
    rest, a, b = fps, [], []
    while len(rest):
        queue, rest = [rest[:1]], rest[1:]
        while queue and len(rest):
            for value in (block := queue.pop()):
                close = _distance(rest, np.broadcast_to(value, rest.shape)) <= limit
                if close.any():
                    found, rest = rest[close], rest[~close]
                    a.append(np.repeat(value, len(found)))
                    b.append(found)
                    queue.append(found)
            del block
    none = np.empty(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def _runs(keys: np.ndarray, fps: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within each run of equal keys of sorted rows."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, len(keys)])
    a, b = [], []
    first = np.flatnonzero(np.repeat(sizes <= LISTED, sizes)) if len(keys) else starts
    stop = np.repeat(starts + sizes, sizes)
    lag = 1
    while (first := first[first + lag < stop[first]]).size:
        left, right = fps[first], fps[first + lag]
        close = (_distance(left, right) <= limit) & (left != right)
        a.append(left[close])
        b.append(right[close])
        lag += 1
    for at, size in zip(starts[sizes > LISTED].tolist(), sizes[sizes > LISTED].tolist(), strict=True):
        one, two = spanning_links(np.unique(fps[at : at + size]), limit)
        a.append(one)
        b.append(two)
    none = np.empty(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def _links_of(batches: Iterator[pa.RecordBatch], limit: int, run: int) -> Iterator[pa.RecordBatch]:
    """Links of rows sorted by key: (u, v, key). Rows of keys longer than ``run`` come out as they are, with v null."""

    def out(u: np.ndarray, v: np.ndarray | None, key: np.ndarray | None) -> pa.RecordBatch:
        blank = pa.nulls(len(u), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(u), blank if v is None else pa.array(v), blank if key is None else pa.array(key)], ["u", "v", "key"]
        )

    def linked(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        u, v = _runs(keys, fps, limit)
        pairs = np.unique(np.stack([np.minimum(u, v), np.maximum(u, v)]), axis=1)
        return out(pairs[0], pairs[1], None)

    keys = fps = np.empty(0, np.int64)
    long = None
    for batch in batches:
        new_keys, new_fps = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if long is not None:
            same = np.searchsorted(new_keys, long, "right")
            if same:
                yield out(new_fps[:same], None, new_keys[:same])
            if same == len(new_keys):
                continue
            new_keys, new_fps, long = new_keys[same:], new_fps[same:], None
        keys, fps = np.concatenate([keys, new_keys]), np.concatenate([fps, new_fps])
        if not len(keys):
            continue
        cut = np.searchsorted(keys, keys[-1])
        if cut:
            yield linked(keys[:cut], fps[:cut])
        keys, fps = keys[cut:], fps[cut:]
        if len(keys) > run:
            yield out(fps, None, keys)
            long, keys, fps = keys[0], keys[:0], fps[:0]
    if len(keys):
        yield linked(keys, fps)


def fingerprint_links(distinct: DataFrame, limit: int = MAX_DISTANCE, run: int = RUN) -> DataFrame:
    """Links (u, v) between the different fingerprints of column ``fp`` that differ in ``limit`` bits or fewer.

    Fingerprints that meet in a key of few rows give all their links; those of
    long runs a spanning forest, which joins the same ones. Nothing is capped: the
    rows of a key that more than ``run`` rows share go to tasks for pairs of blocks.
    """
    if limit > MAX_DISTANCE:
        raise ValueError(f"the keys cover {MAX_DISTANCE} differing bits, not {limit}")

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Golay()
        for batch in batches:
            fps = batch.column(0).to_numpy()
            for at in range(0, len(fps), 4096):
                keys, owners = link_keys(fps[at : at + 4096], code)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(owners)], ["key", "fp"])

    rows = distinct.select("fp").mapInArrow(expand, "key bigint, fp bigint")
    ordered = rows.repartition("key").sortWithinPartitions("key", "fp")
    found = materialize(ordered.mapInArrow(lambda b: _links_of(b, limit, run), "u bigint, v bigint, key bigint"))
    links = found.filter(F.col("v").isNotNull()).select("u", "v")
    crowded = found.filter(F.col("v").isNull()).select("key", F.col("u").alias("fp")).distinct()
    if not crowded.isEmpty():
        links = links.unionByName(_crowded_links(crowded, limit, run))
    return links.distinct()


def _crowded_links(crowded: DataFrame, limit: int, run: int) -> DataFrame:
    """Links within keys of very many rows, from tasks that compare two blocks of about ``run`` rows each."""
    sizes = crowded.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / run).alias("_blocks"))
    dealt = crowded.join(sizes, "key").withColumn("_own", F.pmod(F.xxhash64("fp"), F.col("_blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_blocks") - 1))
    pairs = dealt.select("key", "fp", "_own", other.alias("_other")).select(
        "key", "fp", F.least("_own", "_other").alias("_i"), F.greatest("_own", "_other").alias("_j")
    )

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        u, v = spanning_links(np.unique(group["fp"].to_numpy()), limit)
        return pd.DataFrame({"u": np.minimum(u, v), "v": np.maximum(u, v)})

    return pairs.groupBy("key", "_i", "_j").applyInPandas(compare, "u bigint, v bigint")


def near_duplicates(
    docs: DataFrame,
    width: int = 4,
    limit: int = MAX_DISTANCE,
    id_col: str = "doc_id",
    text_col: str = "text",
    run: int = RUN,
) -> DataFrame:
    """(id, fp, component_id) of each row of ``docs``.

    Rows are linked if their fingerprints differ in ``limit`` bits or fewer;
    ``component_id`` is the smallest id reachable over links, the row's own included.
    Equal fingerprints are one vertex, so copies are never compared. Null texts
    count as empty; empty texts have fingerprint zero and link like any other.
    A null id is kept; a component of null ids only has a null component. Repeated
    rows come out as often as they go in.
    """
    marked = materialize(fingerprints(docs, width, id_col, text_col))
    vertices = materialize(marked.groupBy("fp").agg(F.min(id_col).alias("_least")))
    links = materialize(fingerprint_links(vertices, limit, run))
    ends = links.select("u").union(links.select(F.col("v").alias("u"))).distinct()
    labels = connected_components(ends.select(F.col("u").alias("v")), links)
    joined = labels.join(vertices, labels["v"] == vertices["fp"]).select("v", "label", "_least")
    smallest = joined.groupBy("label").agg(F.min("_least").alias("_joint"))
    linked = joined.join(smallest, "label").select(F.col("v").alias("fp"), "_joint")
    owners = vertices.join(linked, "fp", "left").select("fp", F.coalesce("_joint", "_least").alias("component_id"))
    return marked.join(owners, "fp").select(id_col, "fp", "component_id")


def hex_fingerprint(fp: str = "fp") -> Column:
    """16 lower-case digits."""
    return F.lpad(F.lower(F.hex(F.col(fp))), 16, "0")
