"""Runs of repeated words, found with a dictionary of basic factors.

A basic factor is a stretch of 2^k words. Level by level its name is the rank of the
names of its two halves, so that equal stretches bear equal names. Sorting the names with
their places gives each place its successor: the next place of the same factor.

Within a run of period q and at least four periods, take the level with 2^(k-1) < q <= 2^k.
A factor of it that starts in the run holds a whole period, which as a primitive word
meets itself again only q words on; so its next occurrences are exactly i + q and i + 2q, both
within twice its length as 2^(k+1) < 4q. Places whose successors form such an arithmetic
progression propose (i, q). Consecutive places that propose the same q are one run: the first
proposes nothing one word earlier only because the words q apart differ there, and the last
one reaches to the end, b + 2q + 2^k. So extending and removing repeats is one grouping.

Only factors that occur more than once are named at the next level. Places of many texts
are named at once; a text's words have names of their own, so texts never meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens.llm.common import SLICE_BYTES

RUNS_TYPE = "array<struct<start: bigint, length: bigint, period: bigint>>"


def _sorted_places(key: np.ndarray, place: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Both arrays by key, then place."""
    top = int(key.max()) + 1 if len(key) else 1
    if top * n < 1 << 63:
        both = np.sort(key * n + place)
        key = both // n
        return key, both - key * n
    order = np.argsort(key, kind="stable")
    return key[order], place[order]


def runs_of(words: np.ndarray, sizes: np.ndarray, least: int = 6, exponent: int = 4) -> np.ndarray:
    """(start, length, period) of all runs of the texts that lie one after another in ``words``.

    ``words`` are numbers of words, equal only within a text; ``sizes`` has for each place the
    number of words of its text. A run has ``exponent`` periods (four or more) and ``least`` words at least.
    """
    if exponent < 4:
        raise ValueError("the progressions prove runs of four periods or more")
    n = len(words)
    key, place = words.astype(np.int64), np.arange(n)
    found, length = [], 1
    while len(key):
        key, place = _sorted_places(key, place, n)
        same = key[1:] == key[:-1]
        gap = np.zeros(len(key), np.int64)
        gap[:-1][same] = (place[1:] - place[:-1])[same]
        step = gap[:-1]
        hit = (step > 0) & (step == gap[1:]) & (2 * step > length) & (step <= length)
        hit = np.flatnonzero(hit)
        at, period = place[hit], gap[hit]
        order = np.argsort(at)
        at, period = at[order], period[order]
        if len(at):
            first = np.r_[True, (at[1:] != at[:-1] + 1) | (period[1:] != period[:-1])]
            starts = np.flatnonzero(first)
            lasts = np.r_[starts[1:], len(at)] - 1
            q = period[starts]
            extent = at[lasts] - at[starts] + 2 * q + length
            enough = extent >= np.maximum(least, exponent * q)
            found.append(np.stack([at[starts], extent, q], axis=1)[enough])
        # The name of a factor is its rank; unique ones cannot be part of a longer one that repeats.
        name = np.cumsum(np.r_[0, ~same])
        repeated = np.r_[same, False] | np.r_[False, same]
        repeated &= sizes[place] >= 4 * length + 4
        name, place = name[repeated], place[repeated]
        name_at = np.full(n + length, -1, np.int64)
        name_at[place] = name
        right = name_at[place + length]
        both = right >= 0
        place = place[both]
        # Fits: a row of Spark has at most 2^30 words.
        key = name[both] * n + right[both]
        length *= 2
    runs = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _slices(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Stretches of rows of about ``limit`` bytes; a longer row is one of its own."""
    first = held = 0
    for n, size in enumerate(sizes.tolist()):
        if held and held + size > limit:
            yield first, n
            first, held = n, 0
        held += size
    if first < len(sizes):
        yield first, len(sizes)


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of some texts, and how many each text has."""
    parts = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    words = parts.flatten()
    real = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
    upto = np.concatenate([[0], np.cumsum(real)])
    offsets = parts.offsets.to_numpy()
    counts = np.diff(upto[offsets - offsets[0]])
    return words.filter(pa.array(real)), counts


def _found(ids: pa.Array, texts: pa.Array, least: int, exponent: int, names: list[str]) -> pa.RecordBatch:
    words, counts = _words(texts)
    ends = np.cumsum(counts)
    owner = np.repeat(np.arange(len(counts)), counts)
    coded = words.dictionary_encode()
    code = owner * max(len(coded.dictionary), 1) + coded.indices.to_numpy(zero_copy_only=False)
    runs = runs_of(code, np.repeat(counts, counts), least, exponent)
    start, length, period = runs.T
    cover = np.zeros(len(code) + 1, np.int64)
    np.add.at(cover, start + period, 1)
    np.add.at(cover, start + length, -1)
    kept = np.cumsum(cover[:-1]) == 0
    upto = np.concatenate([[0], np.cumsum(kept)])
    offsets = upto[np.concatenate([[0], ends])]
    lines = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), words.filter(pa.array(kept)))
    of = owner[start] if len(start) else start
    first = ends[of] - counts[of] if len(start) else start
    items = pa.StructArray.from_arrays([pa.array(start - first), pa.array(length), pa.array(period)], names=["start", "length", "period"])
    held = np.searchsorted(of, np.arange(len(counts) + 1))
    lists = pa.ListArray.from_arrays(pa.array(held, pa.int32()), items)
    return pa.RecordBatch.from_arrays([ids, pa.array(counts), lists, pc.binary_join(lines, " ")], names=names)


def periodic_runs(
    docs: DataFrame, least: int = 6, exponent: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_words, runs, collapsed) of each row.

    Words are what ASCII white space parts, numbered from 0. A run is a stretch of at least
    ``least`` words and ``exponent`` times its smallest period that no neighbouring word extends;
    ``runs`` has all of them by start, then period. ``collapsed`` has the words, joined by
    blanks, but for those that any run holds after its first period.

    Null and empty texts have no word and no run and collapse to the empty text. Null ids are
    kept and repeated rows come out as often as they go in. A text is read as a whole; texts of
    some megabytes together are worked on at once.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "n_words", "runs", "collapsed"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.string())
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
            for a, b in _slices(sizes, SLICE_BYTES):
                yield _found(batch.column(0).slice(a, b - a), texts.slice(a, b - a), least, exponent, names)

    rows = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    return rows.mapInArrow(find, f"`{id_col}` {kind}, n_words bigint, runs {RUNS_TYPE}, collapsed string")
