"""Quality classifier: boosted trees on histograms of document statistics.

Statistics of whole texts are taken in the tasks that read them. The trees are
fitted on the driver from a bounded sample of labelled rows, kept as flat arrays of
complete binary trees, and walked for all rows and trees of a batch at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlens.llm.common import SLICE_BYTES, text_bytes

_MARKS = b"!|*$#%&.,\n"
STATISTICS = (
    "bytes", "words", "lines", "upper", "lower", "digit", "space", "other", "wide",
    *[f"mark_{m:02x}" for m in _MARKS],
    "word_bytes", "word_spread", "longest_word", "distinct_words", "capital_words", "short_words",
    "distinct_lines", "line_bytes", "longest_line", "repeated_neighbours",
)


def _byte_classes() -> np.ndarray:
    table = np.zeros((256, 6 + len(_MARKS)))
    for value in range(256):
        one = bytes([value])
        tests = (one.isupper(), one.islower(), one.isdigit(), one.isspace())
        kind = next((i for i, yes in enumerate(tests) if yes), 5 if value > 127 else 4)
        table[value, kind] = 1
        if one in _MARKS:
            table[value, 6 + _MARKS.index(one)] = 1
    return table


_CLASSES = _byte_classes()


def statistics(text: bytes | None) -> np.ndarray:
    """The numbers of ``STATISTICS`` for one text; zeros for an empty one.

    A long text is read slice by slice; shares of distinct words and lines are
    then weighted means over its slices, all of which count.
    """
    out = np.zeros(len(STATISTICS))
    if not text:
        return out
    counts = np.zeros(256)
    words = lines = spread = total = capital = short = apart = lines_apart = again = 0
    longest = longest_line = 0
    for at in range(0, len(text), SLICE_BYTES):
        part = text[at : at + SLICE_BYTES]
        counts += np.bincount(np.frombuffer(part, np.uint8), minlength=256)
        split, rows = part.split(), part.split(b"\n")
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        words += len(split)
        lines += len(rows)
        if len(split):
            total += int(sizes.sum())
            spread += float((sizes**2).sum())
            longest = max(longest, int(sizes.max()))
            short += int((sizes <= 2).sum())
            capital += sum(map(bytes.isupper, split))
            apart += len(set(split))
            again += sum(map(bytes.__eq__, split, split[1:]))
        lines_apart += len(set(rows))
        longest_line = max(longest_line, max(map(len, rows)))
    n, k = len(text), max(words, 1)
    mean = total / k
    shares = counts @ _CLASSES / n
    out[:3] = n, words, lines
    out[3 : 3 + len(shares)] = shares
    out[3 + len(shares) :] = (
        mean, max(0.0, spread / k - mean * mean) ** 0.5, longest, apart / k, capital / k, short / k,
        lines_apart / lines, n / lines, longest_line, again / k,
    )
    return out


@dataclass(frozen=True)
class Boosted:
    """Complete binary trees as arrays: inner nodes in heap order, one row per tree."""

    edges: list[np.ndarray]
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    base: float

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(self.edges)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 of each row."""
        return 1 / (1 + np.exp(-self.margin(self.bins(x))))

    def margin(self, bins: np.ndarray) -> np.ndarray:
        trees, inner = self.feature.shape
        node = np.zeros((len(bins), trees), np.int64)
        row, tree = np.arange(len(bins))[:, None], np.arange(trees)[None, :]
        while trees and node[0, 0] < inner if len(bins) else False:
            right = bins[row, self.feature[tree, node]] > self.cut[tree, node]
            node = 2 * node + 1 + right
        return self.base + self.leaf[tree, node - inner].sum(axis=1)


def fit_boosted(
    x: np.ndarray,
    y: np.ndarray,
    trees: int = 80,
    depth: int = 4,
    rate: float = 0.15,
    bins: int = 64,
    shrink: float = 1.0,
    least: float = 1.0,
) -> Boosted:
    """Second-order boosting of the logistic loss on quantile histograms.

    Ties between splits go to the first statistic and the lowest edge, so a fit
    repeats exactly. Without rows, or with one class only, the model is its base rate.
    """
    rows, width = x.shape
    rate_of_ones = (y.sum() + 1.0) / (rows + 2.0)
    base = float(np.log(rate_of_ones / (1 - rate_of_ones)))
    inner = 2**depth - 1
    if rows == 0 or y.min() == y.max():
        none = np.zeros((0, inner), np.int64)
        return Boosted([np.empty(0)] * width, none, none, np.zeros((0, inner + 1)), base)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
    model = Boosted(edges, np.zeros((0, inner), np.int64), np.zeros((0, inner), np.int64), np.zeros((0, inner + 1)), base)
    at = model.bins(x)
    cell = at + np.arange(width) * bins
    margin = np.full(rows, base)
    features, cuts, leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        slope, bend = p - y, p * (1 - p)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, bins, np.int64)
        node = np.zeros(rows, np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            where = ((node - first) * width * bins)[:, None] + cell
            shape = (count, width, bins)
            g = np.bincount(where.ravel(), np.repeat(slope, width), count * width * bins).reshape(shape).cumsum(axis=2)
            h = np.bincount(where.ravel(), np.repeat(bend, width), count * width * bins).reshape(shape).cumsum(axis=2)
            g_all, h_all = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + shrink) + (g_all - g) ** 2 / (h_all - h + shrink) - g_all**2 / (h_all + shrink)
            gain[(h < least) | (h_all - h < least)] = 0
            best = gain.reshape(count, -1).argmax(axis=1)
            good = gain.reshape(count, -1)[np.arange(count), best] > 1e-9
            feature[first : first + count] = np.where(good, best // bins, 0)
            cut[first : first + count] = np.where(good, best % bins, bins)
            node = 2 * node + 1 + (at[np.arange(rows), feature[node]] > cut[node])
        g = np.bincount(node - inner, slope, inner + 1)
        h = np.bincount(node - inner, bend, inner + 1)
        leaf = -rate * g / (h + shrink)
        margin += leaf[node - inner]
        features.append(feature)
        cuts.append(cut)
        leaves.append(leaf)
    return Boosted(edges, np.stack(features), np.stack(cuts), np.stack(leaves), base)


def held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    """True if the CRC-32 of the id as text leaves no rest; false for a null id."""
    rest = F.crc32(F.col(id_col).cast("string").cast("binary")) % folds
    return F.coalesce(rest == 0, F.lit(False))


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    max_rows: int = 20_000,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> Boosted:
    """Fit on the labelled rows of ``docs`` that are not held out.

    ``max_rows`` bounds the sample: the labels of the lowest id hashes are used, so
    the sample is the same in every run and the driver never holds more than
    ``max_rows`` rows of statistics. Ids with several labels or texts count as often.
    """
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    label = (F.col(label_col) > 0).cast("double").alias("_label")
    chosen = known.select(F.col(id_col), label).orderBy(F.xxhash64(id_col), "_label").limit(max_rows)
    # At most max_rows rows of two numbers: a bounded side.
    rows = docs.select(id_col, F.col(text_col).cast("string").alias("_text")).join(F.broadcast(chosen), id_col)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [statistics(t) for t in text_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(values, pa.list_(pa.float64()))], ["id", "label", "x"]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    sample = (
        rows.select(id_col, "_text", "_label")
        .mapInArrow(measure, f"id {kind}, label double, x array<double>")
        .orderBy(F.xxhash64("id"), "x", "label")
        .limit(max_rows)
        .collect()
    )
    x = np.array([r["x"] for r in sample], float).reshape(len(sample), len(STATISTICS))
    return fit_boosted(x, np.array([r["label"] for r in sample], float))


def score_quality(
    docs: DataFrame,
    model: Boosted,
    threshold: float = 0.3,
    text_col: str = "text",
    score_col: str = "score",
    predicted_col: str = "predicted",
) -> DataFrame:
    """``docs`` with ``score_col`` and ``predicted_col`` added; null texts score as empty ones.

    Existing columns of these names are replaced.
    """
    kept = docs.drop(score_col, predicted_col)
    at = kept.columns.index(text_col)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.stack([statistics(t) for t in text_bytes(batch.column(at))])
            score = model.score(x)
            predicted = (score >= threshold).astype(np.int32)
            names = [*batch.schema.names, score_col, predicted_col]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score), pa.array(predicted)], names=names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return kept.mapInArrow(walk, f"{schema}, `{score_col}` double, `{predicted_col}` int")
