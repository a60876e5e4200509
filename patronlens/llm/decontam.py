"""Benchmark decontamination: edit distance through random walks and bit sampling.

A walk (the CGK embedding of Chakraborty, Goldenberg and Koucky, 2016) reads a
window and writes the sign under its pointer; a random bit for the step and the sign
says whether the pointer moves on. Two strings that differ in few edits fall back into
step soon, so their outputs differ in few places: edit distance becomes Hamming
distance. Signs sampled from the output are then bucket keys, with enough repetitions
for the wanted recall. Windows start at anchors, words chosen by their own content, so
that an item and a document that quotes it choose the same ones. Each meeting of keys
places an item-sized window on the document, and the exact edit distance between
the item and that window decides.

Items too short for whole walks, or with too few anchors (one word, a script without blanks), are
looked up exactly: of an item cut into one piece more than it may have edits, a document that
holds it has one piece unchanged, and all places of all documents are compared with all pieces.

Texts are compared in a normal form: lower case, words joined by one blank.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens.llm.common import text_bytes

#: Characters of normal text that a task embeds at a time.
SLICE = 1 << 21
#: Candidates of pieces that are checked at a time.
PIECE_ROWS = 1 << 20
#: Odd factor of the hash of a piece.
PIECE_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_WORD_SIGNS = np.array([chr(c).isalnum() for c in range(0x10000)])


def normal_form(text: str) -> str:
    """Lower case; runs of other signs than letters and digits become one blank."""
    signs = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    # Beyond the basic plane every sign counts as one of a word.
    keep = np.where(signs < 0x10000, _WORD_SIGNS[np.minimum(signs, 0xFFFF)], True)
    return " ".join(np.where(keep, signs, 32).astype(np.uint32).tobytes().decode("utf-32-le").split())


def codes(text: str) -> np.ndarray:
    """One byte per sign, equal for equal signs and never zero."""
    signs = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return ((signs ^ signs >> 8) % 255 + 1).astype(np.uint8)


@dataclass(frozen=True)
class Walks:
    """Random choices of the embedding, the same for items and documents."""

    steps: int = 72
    samples: int = 8
    walks: int = 2
    tables: int = 3
    every: int = 3
    seed: int = 7

    def __post_init__(self) -> None:
        rng = np.random.default_rng(self.seed)
        # A walk that reads zero, the end of the text, stays there.
        moves = rng.integers(0, 2, (self.walks, self.steps, 256), dtype=np.uint8)
        moves[:, :, 0] = 0
        places = np.stack([
            np.stack([np.sort(rng.choice(self.steps, self.samples, replace=False)) for _ in range(self.tables)])
            for _ in range(self.walks)
        ])
        object.__setattr__(self, "_moves", moves)
        object.__setattr__(self, "_places", places)
        object.__setattr__(self, "_mix", rng.integers(1, 1 << 62, (self.walks, self.tables, self.samples)) * 2 + 1)
        object.__setattr__(self, "_anchor", rng.integers(0, 1 << 30, (5, 256)))

    def recall(self, mismatch: float, windows: int) -> float:
        """Chance that a key of one of ``windows`` agrees if each sampled sign differs with chance ``mismatch``."""
        return 1 - (1 - (1 - mismatch) ** self.samples) ** (self.walks * self.tables * windows)

    @classmethod
    def for_recall(cls, target: float, mismatch: float = 0.2, windows: int = 4) -> Walks:
        """The fewest tables that reach ``target``; ``windows`` is the least number of anchors of an item."""
        tables = 1
        while cls(tables=tables).recall(mismatch, windows) < target:
            tables += 1
        return cls(tables=tables)

    def anchor_value(self, signs: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """A hash of the first five signs of each word; ``signs`` ends in zeros."""
        value = np.zeros(len(starts), np.int64)
        for i in range(5):
            value += self._anchor[i][signs[starts + i]]
        return value & 0x3FFFFFFF

    def keys(self, signs: np.ndarray, starts: np.ndarray) -> Iterator[np.ndarray]:
        """For each table of each walk the keys of the windows at ``starts``; ``signs`` ends in enough zeros."""
        for w in range(self.walks):
            at = starts.copy()
            wanted = {}
            for t in range(self.tables):
                for s, step in enumerate(self._places[w, t].tolist()):
                    wanted.setdefault(step, []).append((t, int(self._mix[w, t, s])))
            keys = [np.zeros(len(starts), np.uint64) for _ in range(self.tables)]
            for step in range(max(wanted) + 1):
                sign = signs[at]
                for t, factor in wanted.get(step, ()):
                    keys[t] += (sign.astype(np.uint64) + np.uint64(step * 257)) * np.uint64(factor)
                at += self._moves[w, step][sign]
            yield from (k ^ k >> np.uint64(29) for k in keys)


def piece_hashes(signs: np.ndarray, lengths: list[int]) -> dict[int, np.ndarray]:
    """For each length the hash of the signs from each place on."""
    out, hashes = {}, np.zeros(len(signs), np.uint64)
    for length in range(1, max(lengths, default=0) + 1):
        if length > len(signs):
            break
        hashes = hashes[: len(signs) - length + 1] * PIECE_FACTOR + signs[length - 1 :]
        if length in lengths:
            out[length] = hashes ^ hashes >> np.uint64(31)
    return out


def word_starts(signs: np.ndarray) -> np.ndarray:
    """Places after a blank or a zero."""
    before = np.r_[np.uint8(0), signs[:-1]]
    blank = codes(" ")[0]
    return np.flatnonzero((signs != blank) & (signs != 0) & ((before == blank) | (before == 0)))


def edit_distance(item: str, window: str, most: int) -> int | None:
    """Distance between ``item`` and the best part of ``window`` (free ends), or None beyond ``most``.

    Bit-parallel columns (Myers, 1999) on whole numbers of any length.
    """
    size = len(item)
    if not size:
        return 0
    places: dict[str, int] = {}
    for i, sign in enumerate(item):
        places[sign] = places.get(sign, 0) | 1 << i
    full, top = (1 << size) - 1, 1 << (size - 1)
    up, down, score, best = full, 0, size, size
    for sign in window:
        eq = places.get(sign, 0)
        across = (((eq & up) + up) ^ up) | eq
        vertical = eq | down
        plus = down | ~(across | up) & full
        minus = up & across
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus = plus << 1 & full
        minus = minus << 1 & full
        up = minus | ~(vertical | plus) & full
        down = plus & vertical
        best = min(best, score)
    return best if best <= most else None


@dataclass(frozen=True)
class Items:
    """One block of benchmark items with the keys of their anchor windows."""

    ids: list
    texts: list[str]
    forced: np.ndarray
    keys: list[np.ndarray]
    owner: list[np.ndarray]
    place: list[np.ndarray]
    #: By length of a piece: sorted hashes, and the item and place of each.
    pieces: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]
    walks: Walks
    share: float

    @classmethod
    def of(cls, rows: list[tuple], walks: Walks, share: float) -> Items:
        found = sorted({(i, t) for i, raw in rows if (t := normal_form(raw or ""))}, key=lambda r: (r[0] is None, r))
        pad, owner, place, parts, at = np.zeros(walks.steps + 8, np.uint8), [], [], [], 0
        starts_all, forced, cut = [], [], {}
        for n, (_, text) in enumerate(found):
            signs = np.r_[codes(text), pad]
            starts = word_starts(signs)
            value = walks.anchor_value(signs, starts)
            chosen = starts[value % walks.every == 0]
            # A walk reads about half as many signs as it has steps, two thirds at most but for rare ones.
            if np.count_nonzero(starts <= min(len(text) // 2, len(text) - walks.steps * 2 // 3)) < 4:
                count = math.floor((1 - share) * len(text)) + 1
                ends = np.linspace(0, len(text), count + 1).astype(int).tolist()
                for a, b in zip(ends, ends[1:], strict=False):
                    if a < b:
                        cut.setdefault(b - a, []).append((int(piece_hashes(signs[a:b], [b - a])[b - a][0]), n, a))
                continue
            # Windows near the end of an item would be cut short: an item needs anchors in its first half too.
            if np.count_nonzero(chosen <= len(text) // 2) < 4:
                chosen = starts[starts <= len(text) // 2] if len(starts) > 1 else starts
                forced.append(walks.anchor_value(signs, chosen))
            chosen = chosen[(chosen <= max(0, len(text) - walks.steps // 2)) | (chosen == starts[0])]
            starts_all.append(chosen + at)
            owner.append(np.full(len(chosen), n))
            place.append(chosen)
            parts.append(signs)
            at += len(signs)
        none = np.empty(0, np.int64)
        signs = np.concatenate(parts) if parts else pad
        starts = np.concatenate(starts_all) if starts_all else none
        owners = np.concatenate(owner) if owner else none
        places = np.concatenate(place) if place else none
        keys, by_owner, by_place = [], [], []
        for key in walks.keys(signs, starts):
            order = np.argsort(key, kind="stable")
            keys.append(key[order])
            by_owner.append(owners[order])
            by_place.append(places[order])
        forced = np.unique(np.concatenate(forced)) if forced else none
        pieces = {}
        for length, of in cut.items():
            key, item, start = (np.array(c, d) for c, d in zip(zip(*sorted(of), strict=True), (np.uint64, np.int64, np.int64), strict=True))
            pieces[length] = (key, item, start)
        return cls([i for i, _ in found], [t for _, t in found], forced, keys, by_owner, by_place, pieces, walks, share)

    def most(self, item: int) -> int:
        return math.floor((1 - self.share) * len(self.texts[item]))

    def candidates(self, signs: np.ndarray) -> np.ndarray:
        """Rows (item, start) of item-sized windows of ``signs`` that share a key; starts may be negative."""
        starts = word_starts(signs)
        value = self.walks.anchor_value(signs, starts)
        wanted = value % self.walks.every == 0
        if len(self.forced):
            wanted |= np.isin(value, self.forced)
        starts = starts[wanted]
        found = []
        mask = np.uint64((1 << 20) - 1)
        for key, table, owner, place in zip(self.walks.keys(signs, starts), self.keys, self.owner, self.place, strict=True):
            bitmap = np.zeros(1 << 20, bool)
            bitmap[table & mask] = True
            maybe = np.flatnonzero(bitmap[key & mask])
            low, high = np.searchsorted(table, key[maybe], "left"), np.searchsorted(table, key[maybe], "right")
            many = high - low
            row = np.repeat(maybe, many)
            at = np.repeat(low - np.r_[0, np.cumsum(many)[:-1]], many) + np.arange(many.sum()) if len(many) else row
            found.append(np.stack([owner[at], starts[row] - place[at]], axis=1))
        return np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 2), np.int64)

    def held_pieces(self, signs: np.ndarray) -> Iterator[np.ndarray]:
        """Rows (item, start) of item-sized windows of ``signs`` that hold a piece of an item unchanged, part by part."""
        for length, hashes in piece_hashes(signs, sorted(self.pieces)).items():
            table, owner, place = self.pieces[length]
            mask = np.uint64((1 << 22) - 1)
            bitmap = np.zeros(1 << 22, bool)
            bitmap[table & mask] = True
            maybe = np.flatnonzero(bitmap[hashes & mask])
            low, high = np.searchsorted(table, hashes[maybe], "left"), np.searchsorted(table, hashes[maybe], "right")
            many = high - low
            maybe, low, many = maybe[many > 0], low[many > 0], many[many > 0]
            parts = np.flatnonzero(np.diff((np.cumsum(many) - many) // PIECE_ROWS)) + 1
            for at, some, first in zip(*(np.split(x, parts) for x in (maybe, many, low)), strict=True):
                row = np.repeat(at, some)
                of = np.repeat(first - (np.cumsum(some) - some), some) + np.arange(some.sum())
                if len(row):
                    yield np.unique(np.stack([owner[of], row - place[of]], axis=1), axis=0)

    def plausible(self, signs: np.ndarray, candidates: np.ndarray) -> np.ndarray:
        """The candidates whose codes are within the bound of an item; a lower bound of the distance decides.

        Rows of the distance table are taken for all candidates at once, in a band
        around the start, and a candidate leaves as soon as its whole band is too far.
        """
        kept = [candidates[:0]]
        bound = np.array([self.most(i) for i in range(len(self.texts))], np.int64)
        sizes = np.array([len(t) for t in self.texts], np.int64)
        order = np.argsort(bound[candidates[:, 0]], kind="stable")
        for at in range(0, len(order), 8192):
            part = candidates[order[at : at + 8192]]
            most, size = bound[part[:, 0]], sizes[part[:, 0]]
            table = np.zeros((len(part), int(size.max())), np.uint8)
            for i in np.unique(part[:, 0]).tolist():
                table[part[:, 0] == i, : sizes[i]] = codes(self.texts[i])
            reach = int(most.max())
            slope = np.arange(2 * reach + 1, dtype=np.int32)
            far, low = np.zeros((len(part), len(slope)), np.int32), part[:, 1] - reach
            live = np.arange(len(part))
            for row in range(int(size.max())):
                read = np.clip(low[live, None] + slope + row, 0, len(signs) - 1)
                across = far + (signs[read] != table[live, row, None])
                across[:, :-1] = np.minimum(across[:, :-1], far[:, 1:] + 1)
                far = np.minimum.accumulate(across - slope, axis=1) + slope
                least = far.min(axis=1)
                ended = size[live] == row + 1
                kept.append(part[live[ended & (least <= most[live])]])
                stay = ~ended & (least <= most[live])
                if not stay.all():
                    live, far = live[stay], far[stay]
                if not len(live):
                    break
        return np.concatenate(kept)

    def verified(self, text: str, candidates: np.ndarray) -> dict[int, tuple[int, int]]:
        """Of each item the least distance within bounds and its window's start."""
        best: dict[int, tuple[int, int]] = {}
        last, reach = -1, 0
        for item, start in sorted(map(tuple, candidates.tolist())):
            most, size = self.most(item), len(self.texts[item])
            # A window that begins a little after the last one of the item has been read with it.
            if last == item and start <= reach:
                continue
            last, reach = item, start + most
            a, b = max(0, start - most), max(0, start + size + 2 * most)
            distance = edit_distance(self.texts[item], text[a:b], most)
            if distance is not None and (item not in best or (distance, a) < best[item]):
                best[item] = (distance, a)
        return best


def _slices(text: str, overlap: int) -> Iterator[tuple[int, str]]:
    for at in range(0, max(len(text), 1), SLICE):
        yield at, text[at : at + SLICE + overlap]


def _blocks(
    benchmark: DataFrame, walks: Walks, share: float, block_bytes: int, item_col: str, item_text: str
) -> Iterator[Items]:
    """The benchmark in blocks of about ``block_bytes``, one on the driver at a time."""
    sized = benchmark.select(F.col(item_col).alias("i"), F.col(item_text).cast("string").alias("t")).filter("t is not null")
    total = sized.agg(F.sum(F.octet_length("t") + 16)).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    for block in range(blocks):
        part = sized.filter(F.pmod(F.xxhash64("t"), F.lit(blocks)) == block)
        yield Items.of([tuple(r) for r in part.collect()], walks, share)


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    share: float = 0.9,
    target_recall: float = 0.98,
    block_bytes: int = 4 << 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(id, item_id, distance, start): items that a document holds but for 1 - ``share`` of their signs.

    ``distance`` counts edits between the item and the best part of the document,
    ``start`` is about where that is in the normal form. ``target_recall`` decides how often
    bits are sampled. Items are read in blocks of about ``block_bytes``, each of which
    meets all documents, so neither the driver nor a task ever holds more than one block of a
    larger benchmark. Items without a word, null ones included, match nothing; null and
    empty texts hold nothing. Repeated rows are reported as often as they occur, repeated
    items once.
    """
    kind, item_kind = (d.schema[c].dataType.simpleString() for d, c in ((docs, id_col), (benchmark, item_col)))
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    out = None
    for items in _blocks(benchmark, Walks.for_recall(target_recall), share, block_bytes, item_col, item_text):
        found = rows.mapInArrow(
            lambda b, items=items: _leaks_of(b, items, id_col, item_col),
            f"`{id_col}` {kind}, `{item_col}` {item_kind}, distance int, start bigint",
        )
        out = found if out is None else out.unionByName(found)
    return out


def without_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    share: float = 0.9,
    target_recall: float = 0.98,
    block_bytes: int = 4 << 20,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` in which ``find_leaks`` finds nothing, each decided by its own text; no join, no shuffle."""
    at, schema = docs.columns.index(text_col), docs.schema

    def kept(batches: Iterator[pa.RecordBatch], items: Items) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaking = {row for row, _ in _found(text_bytes(batch.column(at)), items)}
            yield batch.filter(pa.array([row not in leaking for row in range(batch.num_rows)], pa.bool_()))

    for items in _blocks(benchmark, Walks.for_recall(target_recall), share, block_bytes, item_col, item_text):
        docs = docs.mapInArrow(lambda b, items=items: kept(b, items), schema)
    return docs


def _found(texts: list[bytes | None], items: Items) -> dict[tuple[int, int], tuple[int, int]]:
    """(row, item) of each leak, with its least distance and start."""
    longest = max(map(len, items.texts), default=0)
    gap = np.zeros(items.walks.steps + 8, np.uint8)
    best: dict[tuple[int, int], tuple[int, int]] = {}

    def search(pending: list[tuple[int, int, str]]) -> None:
        parts = [codes(t) for _, _, t in pending]
        signs = np.concatenate([x for p in parts for x in (p, gap)])
        edges = np.cumsum([0, *[len(p) + len(gap) for p in parts]])
        found = [items.plausible(signs, c) for c in itertools.chain([items.candidates(signs)], items.held_pieces(signs))]
        found = np.concatenate(found)
        # A window belongs to the text that holds its middle: its start may lie before a text.
        middle = found[:, 1] + np.array([len(items.texts[i]) // 2 for i in found[:, 0]], np.int64)
        text = np.clip(np.searchsorted(edges, middle, "right") - 1, 0, len(pending) - 1)
        for n in np.unique(text).tolist():
            row, at, body = pending[n]
            mine = found[text == n] - np.array([0, edges[n]])
            for item, (distance, start) in items.verified(body, mine).items():
                value = (distance, start + at)
                best[row, item] = min(best.get((row, item), value), value)

    pending: list[tuple[int, int, str]] = []
    size = 0
    for row, raw in enumerate(texts):
        if raw and items.texts:
            for at, body in _slices(normal_form(raw.decode()), 3 * longest):
                pending.append((row, at, body))
                size += len(body)
                if size >= SLICE:
                    search(pending)
                    pending, size = [], 0
    if pending:
        search(pending)
    return dict(sorted(best.items()))


def _leaks_of(batches: Iterator[pa.RecordBatch], items: Items, id_col: str, item_col: str) -> Iterator[pa.RecordBatch]:
    item_ids = pa.array(items.ids) if items.ids else pa.nulls(0, pa.int64())
    for batch in batches:
        best = _found(text_bytes(batch.column(1)), items)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array([r for r, _ in best], pa.int64())),
                item_ids.take(pa.array([i for _, i in best], pa.int64())),
                pa.array([d for d, _ in best.values()], pa.int32()),
                pa.array([s for _, s in best.values()], pa.int64()),
            ],
            names=[id_col, item_col, "distance", "start"],
        )


def leaked_documents(leaks: DataFrame, id_col: str = "doc_id", item_col: str = "item_id") -> DataFrame:
    """One row per document that holds an item: (id, items, distance), items sorted, the least distance."""
    items = F.array_sort(F.collect_set(item_col)).alias("items")
    return leaks.groupBy(id_col).agg(items, F.min("distance").alias("distance"))
