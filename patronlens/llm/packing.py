"""Packing of documents into sequences of fixed length by exact complements.

Lengths are whole numbers up to the capacity, so the whole corpus is one table of
counts, however many documents it has. The plan is made on these counts: the
largest length left is completed to exactly the capacity by one, two or three
others as often as the counts allow; what has no complement goes into the best
fitting gap. A plan is a list of patterns with multiplicities. Its size depends on
the number of lengths, not on the number of documents. Each piece then finds its
place from its rank among the pieces of its length.
"""

from __future__ import annotations

import base64
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, cached_property

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens.llm.common import free_name, text_bytes
from patronlens.operators.ranking import global_rank
from patronlens.session import materialize

Pattern = tuple[int, ...]


class _Shelf:
    """Counts of lengths left, with look-ups of the combinations that fill a gap exactly."""

    def __init__(self, counts: np.ndarray) -> None:
        self.left = counts.astype(np.int64).copy()

    def times(self, parts: Pattern) -> int:
        """How often the counts allow ``parts``."""
        return min(int(self.left[size]) // n for size, n in Counter(parts).items())

    def single(self, gap: int, most: int) -> Iterator[Pattern]:
        if 0 < gap <= most and self.left[gap]:
            yield (gap,)

    def pairs(self, gap: int, most: int) -> Iterator[Pattern]:
        """Largest first member first."""
        first = np.arange(min(gap - 1, most), (gap + 1) // 2 - 1, -1)
        if len(first):
            for size in first[(self.left[first] > 0) & (self.left[gap - first] > 0)].tolist():
                yield size, gap - size

    def triples(self, gap: int, most: int) -> Iterator[Pattern]:
        first = np.arange(min(gap - 2, most), (gap + 2) // 3 - 1, -1)
        if len(first):
            for size in first[self.left[first] > 0].tolist():
                for pair in self.pairs(gap - size, size):
                    yield size, *pair

    def fill(self, size: int, gap: int, searches: tuple[str, ...]) -> tuple[Pattern, int] | None:
        """The first combination of lengths up to ``size`` that completes one ``size`` exactly, and how often."""
        for search in searches:
            for parts in getattr(self, search)(gap, size):
                if times := self.times((size, *parts)):
                    return (size, *parts), times
        return None

    def take(self, parts: Pattern, times: int) -> None:
        for size in parts:
            self.left[size] -= times


#: Orders in which combinations are looked up; the plan of fewest sequences is taken, the first in a tie.
ORDERS = (("single", "pairs", "triples"), ("single", "triples", "pairs"), ("pairs", "single", "triples"))


def plan(counts: np.ndarray, capacity: int) -> list[tuple[Pattern, int]]:
    """Patterns of lengths that sum to ``capacity`` at most, with multiplicities that use up ``counts`` (by length)."""
    return min((_planned(counts, capacity, order) for order in ORDERS), key=lambda p: sum(n for _, n in p))


def _planned(counts: np.ndarray, capacity: int, searches: tuple[str, ...]) -> list[tuple[Pattern, int]]:
    shelf, found = _Shelf(counts), []
    if shelf.left[capacity]:
        found.append(((capacity,), int(shelf.left[capacity])))
        shelf.left[capacity] = 0
    for size in range(capacity - 1, 0, -1):
        while shelf.left[size] and (hit := shelf.fill(size, capacity - size, searches)):
            shelf.take(*hit)
            found.append(hit)
    return found + _best_fit(shelf, capacity)


def _best_fit(shelf: _Shelf, capacity: int) -> list[tuple[Pattern, int]]:
    """Decreasing best fit, for many equal bins at a time."""
    bins: list[list[tuple[Pattern, int]]] = [[] for _ in range(capacity + 1)]  # by gap
    for size in range(capacity - 1, 0, -1):
        while items := int(shelf.left[size]):
            gap = next((g for g in range(size, capacity) if bins[g]), capacity)
            parts, times = bins[gap].pop() if bins[gap] else ((), items)
            each = min(gap // size, items)
            used = min(times, items // each)
            if times > used and parts:
                bins[gap].append((parts, times - used))
            bins[gap - each * size].append((parts + (size,) * each, used))
            shelf.left[size] -= used * each
    return [pattern for group in bins for pattern in group]


@dataclass(frozen=True)
class Places:
    """Where the pieces of each length go: intervals of ranks, sorted by (length, first rank)."""

    length: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray

    @classmethod
    def of(cls, patterns: list[tuple[Pattern, int]]) -> Places:
        rows, used, base = [], Counter(), 0
        for parts, times in patterns:
            at = 0
            for size in parts:
                rows.append((size, used[size], base, at))
                used[size] += times
                at += size
            base += times
        columns = np.array(sorted(rows), np.int64).reshape(-1, 4).T
        return cls(*columns)

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        wide = int(self.first.max()) + 1 if len(self.first) else 1
        scale = max(wide, int(rank.max()) + 1) if len(rank) else wide
        at = np.searchsorted(self.length * scale + self.first, length * scale + rank, "right") - 1
        return self.sequence[at] + rank - self.first[at], self.offset[at]


@dataclass(frozen=True)
class Vocabulary:
    """Paths of the two forms of one byte-level vocabulary: ranks and .json."""

    ranks: str
    json: str

    @classmethod
    def standard(cls) -> Vocabulary:
        return cls(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json"))


class Encoder:
    """Token ids by the faster form; texts that its pattern engine refuses (vast runs of blanks) by the other."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        with open(vocabulary.ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        # The string of the one special token stands for that token, as in the .json form.
        self._fast = tiktoken.Encoding(
            "bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={"<|endoftext|>": len(table)}
        )
        self._json = vocabulary.json

    @cached_property
    def _full(self) -> tokenizers.Tokenizer:
        return tokenizers.Tokenizer.from_file(self._json)

    def ids(self, text: str) -> np.ndarray:
        try:
            return self._fast.encode_to_numpy(text, allowed_special="all")
        except ValueError:
            return np.array(self._full.encode(text, add_special_tokens=False).ids, np.uint32)


@cache
def encoder(vocabulary: Vocabulary) -> Encoder:
    """One per Python worker."""
    return Encoder(vocabulary)


def pack(pieces: DataFrame, capacity: int, order: list[str], length: str = "length") -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows of a ``length`` between 1 and ``capacity``.

    ``order`` names columns that tell rows apart; it decides which of the pieces
    of one length goes where. Equal rows are packed one by one. An empty table
    stays empty.
    """
    ranked = global_rank(pieces, [length, *order], rank := free_name(pieces, "_rank"))
    # One row per length: bounded by the capacity.
    rows = pieces.groupBy(length).agg(F.count(F.lit(1)).alias("n")).collect()
    counts = np.zeros(capacity + 1, np.int64)
    for row in rows:
        counts[row[0]] = row["n"]
    places = Places.of(plan(counts, capacity))
    before = np.r_[0, np.cumsum(counts)]
    columns = pieces.columns
    names = [*columns, "sequence_id", "offset"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column(length).to_numpy()
            sequence, offset = places.find(size, batch.column(rank).to_numpy() - 1 - before[size])
            kept = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names=names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(place, f"{schema}, sequence_id bigint, offset bigint")


def token_pieces(
    docs: DataFrame,
    capacity: int = 2048,
    vocabulary: Vocabulary | None = None,
    keep_ids: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of the token ids of each row: (id, piece, start, length, ids_crc32[, ids]).

    Every document ends in the id 0. Documents of more than
    ``capacity`` ids are cut into pieces of ``capacity``, of which the first may be
    shorter. A null text counts as empty and is the id 0 alone.
    """
    vocabulary = vocabulary or Vocabulary.standard()
    kind = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "piece", "start", "length", "ids_crc32", *["ids"] * keep_ids]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).ids
        for batch in batches:
            owner, piece, start, length, crc, kept = [], [], [], [], [], []
            for row, text in enumerate(text_bytes(batch.column(1))):
                ids = np.append(encode((text or b"").decode()), 0).astype("<u4")
                edges = [0, *range(len(ids) % capacity or capacity, len(ids), capacity), len(ids)]
                for n, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                    owner.append(row)
                    piece.append(n)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(ids[a:b].tobytes()))
                    if keep_ids:
                        kept.append(ids[a:b].astype(np.int32))
            made = [
                batch.column(0).take(pa.array(owner, pa.int64())),
                pa.array(piece, pa.int32()),
                *[pa.array(c, pa.int64()) for c in (start, length, crc)],
            ]
            if keep_ids:
                made.append(pa.array(kept, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(made, names=names)

    schema = f"`{id_col}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * keep_ids
    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(cut, schema)


def pack_documents(docs: DataFrame, capacity: int = 2048, **options) -> DataFrame:
    """Pieces of ``docs`` with their ``sequence_id`` and gapless ``offset``; see ``token_pieces`` and ``pack``.

    Repeated rows are packed as often as they occur; other columns are left out.
    """
    pieces = materialize(token_pieces(docs, capacity, **options))
    return pack(pieces, capacity, [options.get("id_col", "doc_id"), "piece"])


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of pieces that kept their ids; no group is longer than the capacity."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    grouped = packed.groupBy("sequence_id").agg(parts.alias("_parts"))
    return grouped.select("sequence_id", F.flatten(F.col("_parts.ids")).alias("ids"))
