"""Areas under the ROC curve of a forest when one input of each row is taken from a donor row.

A tree asks of an input only on which side of its thresholds it lies. So a row is coded once, as the number of
thresholds below each input, and for each tree a table gives for each input and code the leaves that
this code leaves open, as bits. The leaf that a row reaches is the one that all of its inputs leave open; with one
input exchanged, it is the one that the others and the donor's code leave open. Thus no variant of a row is
a row of its own and no tree is walked. The scores are the forest's own, to the last bit.

The scores of each shuffle are counted by blocks of rows and meet in ranges of scores, so no task holds all of them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patronlens.operators.attribution import blocks_of, saved_trees
from patronlens.operators.ranking import global_rank
from patronlens.schema import CUSTOMER
from patronlens.session import materialize

#: Leaves of the largest tree for which tables of bits are made: as many as a double has powers of two from 1.
MOST_LEAVES = 1024
#: Rows that are scored at once.
SLICE = 8192
#: Scores of one shuffle that meet in one task, about.
RANGE = 1 << 16
#: Rows whose scores choose the bounds of these ranges. Any bounds give the same areas.
BOUNDS_FROM = 1 << 15


@dataclass(frozen=True)
class Forest:
    """A forest of classifiers for two classes, by leaf.

    ``cuts`` are the thresholds of each input; ``low`` and ``high`` the least and greatest code of each input
    (columns) with which a row can reach each leaf (rows), ``shares`` its shares of both classes.
    """

    cuts: list[np.ndarray]
    low: list[np.ndarray]
    high: list[np.ndarray]
    shares: list[np.ndarray]

    @property
    def words(self) -> int:
        """Words of 64 bits that hold a bit for each leaf of the largest tree."""
        return -(-max(len(low) for low in self.low) // 64)

    @property
    def code_type(self) -> np.dtype:
        return np.min_scalar_type(max(len(c) for c in self.cuts))

    def codes(self, x: np.ndarray) -> np.ndarray:
        """Number of thresholds below each input; ``x`` and the result are (inputs, rows)."""
        return np.stack([np.searchsorted(c, column) for c, column in zip(self.cuts, x, strict=True)]).astype(self.code_type)


def forest_of(model: PipelineModel) -> Forest | None:
    """The last stage of ``model``, or None if it is no forest for two classes, on its first stage's inputs, of trees small enough."""
    stage = model.stages[-1]
    if type(stage).__name__ != "RandomForestClassificationModel" or stage.numClasses != 2 or len(model.stages) != 2:
        return None
    trees = saved_trees(stage)
    leaves = [sum(n["leftChild"] < 0 for n in nodes) for nodes in trees]
    if max(leaves) > MOST_LEAVES or any(n["leftChild"] >= 0 and n["split"]["numCategories"] >= 0 for nodes in trees for n in nodes):
        return None
    found: list[set[float]] = [set() for _ in range(stage.numFeatures)]
    for nodes in trees:
        for n in nodes:
            if n["leftChild"] >= 0:
                found[n["split"]["featureIndex"]].add(n["split"]["leftCategoriesOrThreshold"][0])
    cuts = [np.array(sorted(c), np.float64) for c in found]
    low, high, shares = [], [], []
    for nodes in trees:
        ended = []
        stack = [(0, np.zeros(len(cuts), np.int32), np.array([len(c) for c in cuts], np.int32))]
        while stack:
            at, least, most = stack.pop()
            n = nodes[at]
            if n["leftChild"] < 0:
                total = sum(n["impurityStats"])
                ended.append((least, most, [s / total if total else 0.0 for s in n["impurityStats"]]))
                continue
            f = n["split"]["featureIndex"]
            k = int(np.searchsorted(cuts[f], n["split"]["leftCategoriesOrThreshold"][0]))
            below, above = most.copy(), least.copy()
            below[f], above[f] = min(most[f], k), max(least[f], k + 1)
            stack += [(n["leftChild"], least, below), (n["rightChild"], above, most)]
        low.append(np.stack([e[0] for e in ended]))
        high.append(np.stack([e[1] for e in ended]))
        shares.append(np.array([e[2] for e in ended]).T.copy())
    return Forest(cuts, low, high, shares)


class Scorer:
    """Probabilities of class 1 with each input exchanged in turn."""

    def __init__(self, forest: Forest):
        self.shares = forest.shares
        self.tables = []
        for low, high in zip(forest.low, forest.high, strict=True):
            table = {}
            for f, cuts in enumerate(forest.cuts):
                code = np.arange(len(cuts) + 1)[:, None]
                bits = np.zeros((len(code), 64 * forest.words), bool)
                bits[:, : len(low)] = (code >= low[:, f]) & (code <= high[:, f])
                if not bits[:, : len(low)].all():
                    table[f] = np.packbits(bits, axis=1, bitorder="little").view("<u8").T.copy()
            self.tables.append(table)
        # A word of one bit, times its factor, is a power of two whose exponent is the number of the leaf.
        self.factors = 2.0 ** (64 * np.arange(forest.words))

    def _leaves(self, open_leaves: np.ndarray) -> np.ndarray:
        power = open_leaves[0].view(np.int64).astype(np.float64)
        for word, factor in zip(open_leaves[1:], self.factors[1:], strict=True):
            power += word.view(np.int64) * factor
        # The sign is set for the last bit of a word.
        return (power.view(np.int64) >> 52 & 0x7FF) - 1023

    def exchanged(self, own: np.ndarray, donor: np.ndarray) -> np.ndarray:
        """(inputs, rows): the row's score with this one input's code taken from its donor."""
        own, donor = own.astype(np.intp), donor.astype(np.intp)
        votes = np.zeros((2, *own.shape))
        for table, shares in zip(self.tables, self.shares, strict=True):
            used = list(table)
            mine = [table[f].take(own[f], axis=1) for f in used]
            # What the inputs after each one leave open.
            after = mine[1:]
            for i in range(len(after) - 2, -1, -1):
                after[i] = after[i] & after[i + 1]
            before = None
            for i, f in enumerate(used):
                left = table[f].take(donor[f], axis=1)
                if i > 0:
                    left &= before
                if i < len(after):
                    left &= after[i]
                at = self._leaves(left)
                votes[0, f] += shares[0].take(at)
                votes[1, f] += shares[1].take(at)
                before = mine[i] if before is None else before & mine[i]
            at = np.zeros(own.shape[1], np.int64) if before is None else self._leaves(before)
            for f in set(range(len(own))).difference(used):
                votes[0, f] += shares[0].take(at)
                votes[1, f] += shares[1].take(at)
        total = votes[0] + votes[1]
        return np.divide(votes[1], total, out=votes[1], where=total != 0)


def _coded(rows: DataFrame, model: PipelineModel, forest: Forest, unique: str) -> DataFrame:
    """(unique, label, codes). The model's first stage refuses missing inputs, as it does when the model is applied."""
    inputs = model.stages[0].transform(rows).select(unique, F.col("label").cast("bigint").alias("label"), vector_to_array(model.stages[0].getOutputCol()).alias("codes"))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(forest.cuts))
            packed = [row.tobytes() for row in forest.codes(x.T).T]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=batch.schema.names)

    return inputs.mapInArrow(code, f"`{unique}` {rows.schema[unique].dataType.simpleString()}, label bigint, codes binary")


def _paired(coded: DataFrame, repeats: int, seed: int, unique: str) -> DataFrame:
    """(repeat, label, codes, donor, _position): in each repeat the row at a place by a seeded hash meets the row there by id."""
    turns = coded.withColumn("repeat", F.explode(F.array(*[F.lit(i) for i in range(repeats)])))
    keyed = turns.withColumn("_hash", F.xxhash64(F.col(unique), F.lit(seed) + F.col("repeat")))
    ranked = global_rank(keyed, ["repeat", "_hash", unique], "_rank", "_total")
    # Every repeat has all rows, so its places start after those of all before.
    place = F.col("_rank") - F.col("repeat") * (F.col("_total") / repeats).cast("bigint")
    donors = global_rank(coded.select(unique, F.col("codes").alias("donor")), [unique], "_position").select("_position", "donor")
    return ranked.select("repeat", "label", "codes", place.alias("_position")).join(donors, "_position")


def _scores(block: pa.RecordBatch, forest: Forest, scorer: Scorer) -> np.ndarray:
    """(inputs, rows) of a block with columns codes and donor."""
    own, donor = (
        np.frombuffer(b"".join(block.column(c).to_pylist()), forest.code_type).reshape(block.num_rows, -1).T for c in ("codes", "donor")
    )
    parts = [scorer.exchanged(own[:, a : a + SLICE], donor[:, a : a + SLICE]) for a in range(0, block.num_rows, SLICE)]
    return np.concatenate(parts, axis=1)


def _bounds(paired: DataFrame, forest: Forest, features: Sequence[str], ranges: int) -> list[np.ndarray]:
    """For each input bounds between ranges of about equally many scores, from some rows of the first repeat."""
    if ranges < 2:
        return [np.zeros(0) for _ in features]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(forest)
        for block in blocks_of(batches):
            for f, found in enumerate(_scores(block, forest, scorer)):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), f, np.int32)), pa.array(found)], names=["f", "score"])

    # Places by hash are drawn at random.
    some = paired.filter((F.col("repeat") == 0) & (F.col("_position") <= BOUNDS_FROM)).select("codes", "donor")
    at = F.percentile("score", F.array(*[F.lit(i / ranges) for i in range(1, ranges)])).alias("at")
    found = {r["f"]: np.unique(r["at"]) for r in some.mapInArrow(score, "f int, score double").groupBy("f").agg(at).collect()}
    return [found[f] for f in range(len(features))]


def _meet(table: pa.Table) -> pa.Table:
    """Counts of one range of scores, and how many pairs inside it are in the right order."""
    score, pos, neg = (pc.list_flatten(table[c]).to_numpy() for c in ("scores", "pos", "neg"))
    values, at = np.unique(score, return_inverse=True)
    pos, neg = (np.bincount(at, n, len(values)) for n in (pos, neg))
    wins = float((pos * (neg.cumsum() - neg + neg / 2)).sum())
    found = {"repeat": table["repeat"][:1], "feature": table["feature"][:1], "range": table["range"][:1]}
    return pa.table(found | {"pos": [int(pos.sum())], "neg": [int(neg.sum())], "wins": [wins]})


def exchanged_areas(
    rows: DataFrame, model: PipelineModel, forest: Forest, features: Sequence[str], repeats: int, seed: int, unique: str = CUSTOMER
) -> DataFrame:
    """(repeat, feature, roc_auc) of ``rows`` (unique, label, features) with each input shuffled in turn; equal scores count half."""
    coded = materialize(_coded(rows, model, forest, unique))
    paired = _paired(coded, repeats, seed, unique)
    bounds = _bounds(paired, forest, features, -(-coded.count() // RANGE))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(forest)
        for block in blocks_of(batches):
            scores = _scores(block, forest, scorer)
            label, repeat = block.column("label"), block.column("repeat").to_numpy()
            # A row without a label counts on neither side.
            known = label.is_valid().to_numpy(zero_copy_only=False)
            pos = label.fill_null(0).to_numpy()
            neg = np.where(known, 1 - pos, 0)
            for turn in np.unique(repeat):
                at = np.flatnonzero(repeat == turn)
                for f, name in enumerate(features):
                    values, spot = np.unique(scores[f, at], return_inverse=True)
                    ends = np.append(np.searchsorted(values, bounds[f], "right"), len(values))
                    held = np.flatnonzero(np.diff(ends, prepend=0))
                    offsets = pa.array(np.append(0, ends[held]), pa.int32())
                    sums = [np.bincount(spot, n[at], len(values)).astype(np.int64) for n in (pos, neg)]
                    lists = [pa.ListArray.from_arrays(offsets, pa.array(v)) for v in (values, *sums)]
                    key = [pa.array(np.full(len(held), turn, np.int32)), pa.array([name] * len(held)), pa.array(held.astype(np.int32))]
                    yield pa.RecordBatch.from_arrays(key + lists, names=["repeat", "feature", "range", "scores", "pos", "neg"])

    packed = paired.select("repeat", "label", "codes", "donor").mapInArrow(
        count, "repeat int, feature string, range int, scores array<double>, pos array<bigint>, neg array<bigint>"
    )
    met = packed.groupBy("repeat", "feature", "range").applyInArrow(
        _meet, "repeat int, feature string, range int, pos bigint, neg bigint, wins double"
    )
    # One row per range of a shuffle.
    earlier = Window.partitionBy("repeat", "feature").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    wins = F.col("wins") + F.col("pos") * F.coalesce(F.sum("neg").over(earlier), F.lit(0))
    pairs = (F.sum("pos") * F.sum("neg")).cast("double")
    return (
        met.withColumn("_wins", wins).groupBy("repeat", "feature").agg(F.try_divide(F.sum("_wins"), pairs).alias("roc_auc"))
    )
