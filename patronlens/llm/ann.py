"""Approximate nearest neighbours by a forest of random-projection trees.

Each tree splits the unit vectors at the median of their projection on a random
direction, one direction for each level. The forest is fitted on a bounded sample; all rows
are then dropped down its trees, which get so deep that a leaf holds about ``leaf``
rows of the whole table. A query walks all trees through one priority queue: the branch
that its own side of the splits crossed least comes next, whichever tree it is in. Visits
meet the rows of their leaves in a join, and the candidates are ranked by their exact
cosine. How many leaves a query visits is measured on the table itself: true neighbours of
sampled queries, found by brute force over all rows, tell after how many visits the wanted
share of them is met. Where the leaves of a query's visits would hold nearly all rows between them, all
rows are read.

Equal vectors are one row of the index with the few smallest of their ids, as no
answer can hold more of them. So neither copies nor their queries crowd a leaf.
"""

from __future__ import annotations

import heapq
import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patronlens.session import materialize

#: Sample rows below which a fitted node is not split by a median of its own.
LEAST_SAMPLE = 8
#: Rows of a leaf, and leaves of a tree for which its leaves hold fewer rows.
LEAF, LEAST_LEAVES = 128, 128
#: Share of all rows in the leaves of a query from which on it reads all rows, and rows of a leaf there.
NEARLY_ALL, SCAN_LEAF = 0.95, 4096
#: Queries that meet a leaf in one group at a time, on average.
GROUP_QUERIES = 8192


@dataclass(frozen=True)
class Forest:
    """Trees as arrays: directions by tree and level, thresholds by tree and node in heap order.

    Levels beyond ``fitted`` take their threshold from the fitted node above them, so
    the arrays stay as small as the sample however deep the trees are.
    """

    directions: np.ndarray
    thresholds: np.ndarray
    deeper: np.ndarray
    fitted: int

    @property
    def depth(self) -> int:
        return self.directions.shape[1]

    @classmethod
    def fit(cls, sample: np.ndarray, rows: int, trees: int, leaf: int, seed: int = 1) -> Forest:
        rng = np.random.default_rng(seed)
        depth = max(0, math.ceil(math.log2(max(rows, 1) / leaf)))
        fitted = min(depth, max(0, int(math.log2(max(len(sample), 1) / LEAST_SAMPLE)))) if len(sample) else 0
        directions = rng.standard_normal((trees, depth, sample.shape[1]))
        directions /= np.maximum(np.linalg.norm(directions, axis=2, keepdims=True), 1e-300)
        thresholds = np.zeros((trees, (1 << fitted) - 1))
        deeper = np.zeros((trees, 1 << fitted, depth - fitted))
        for t in range(trees):
            along = sample @ directions[t].T if depth else np.zeros((len(sample), 0))
            groups = [np.arange(len(sample))]
            for level in range(fitted):
                below = []
                for n, rows_of in enumerate(groups):
                    values = along[rows_of, level]
                    cut = float(np.median(values)) if len(values) else 0.0
                    thresholds[t, (1 << level) - 1 + n] = cut
                    below += [rows_of[values <= cut], rows_of[values > cut]]
                groups = below
            for n, rows_of in enumerate(groups):
                if len(rows_of) and depth > fitted:
                    deeper[t, n] = np.median(along[rows_of, fitted:], axis=0)
        return cls(directions, thresholds, deeper, fitted)

    def leaves(self, units: np.ndarray) -> np.ndarray:
        """Leaf of each row in each tree: (rows, trees)."""
        out = np.zeros((len(units), len(self.directions)), np.int64)
        for t, directions in enumerate(self.directions):
            along = units @ directions.T
            code = np.zeros(len(units), np.int64)
            for level in range(self.fitted):
                code = 2 * code + (along[:, level] > self.thresholds[t, (1 << level) - 1 + code])
            node = code
            for level in range(self.fitted, self.depth):
                code = 2 * code + (along[:, level] > self.deeper[t, node, level - self.fitted])
            out[:, t] = code
        return out

    def costs(self, unit: np.ndarray) -> np.ndarray:
        """What the queue pays to reach each leaf of each tree: (trees, leaves)."""
        along = self.directions @ unit
        cost, code = np.zeros((len(along), 1)), np.arange(1)
        for level in range(self.depth):
            if level < self.fitted:
                cuts = self.thresholds[:, (1 << level) - 1 + code]
            else:
                cuts = self.deeper[:, code >> (level - self.fitted), level - self.fitted]
            margin = along[:, level, None] - cuts
            square = margin * margin
            below = np.stack([cost + np.where(margin > 0, square, 0.0), cost + np.where(margin > 0, 0.0, square)], axis=2)
            cost, code = below.reshape(len(along), -1), np.arange(2 << level)
        return cost

    def visits_for(self, target: float, asked: list[np.ndarray], nearest: list[np.ndarray]) -> int:
        """The fewest visits after which a share ``target`` of the ``nearest`` units of the ``asked`` ones is met."""
        needed = []
        for unit, wanted in zip(asked, nearest, strict=True):
            cost = self.costs(unit)
            reached = cost[np.arange(len(cost)), self.leaves(wanted)].min(axis=1)
            needed += np.searchsorted(np.sort(cost, axis=None), reached, "right").tolist()
        return max(len(self.directions), sorted(needed)[math.ceil(target * len(needed)) - 1] if needed else 0)

    def share_read(self, asked: list[np.ndarray], sample: np.ndarray, probes: int) -> float:
        """Mean share of the ``sample`` in the leaves that the ``asked`` units visit."""
        leaves, trees = self.leaves(sample), np.arange(len(self.directions))
        shares = []
        for unit in asked:
            seen = np.zeros((len(trees), 1 << self.depth), bool)
            tree, leaf = np.array(self.visits(unit, probes)).T
            seen[tree, leaf] = True
            shares.append(seen[trees, leaves].any(axis=1).mean())
        return float(np.mean(shares))

    def visits(self, unit: np.ndarray, probes: int) -> list[tuple[int, int]]:
        """The first ``probes`` (tree, leaf) of the shared queue, nearest first."""
        along = self.directions @ unit
        if probes * 32 > len(along) << self.depth:
            order = np.argsort(self.costs(unit), axis=None, kind="stable")[:probes]
            return list(zip(*(n.tolist() for n in np.divmod(order, 1 << self.depth)), strict=True))
        queue: list[tuple[float, int, int, int]] = [(0.0, t, 0, 0) for t in range(len(along))]
        found = []
        while queue and len(found) < probes:
            cost, tree, level, code = heapq.heappop(queue)
            mine, cuts, deeper = along[tree], self.thresholds[tree], self.deeper[tree]
            while level < self.depth:
                if level < self.fitted:
                    margin = mine[level] - cuts[(1 << level) - 1 + code]
                else:
                    margin = mine[level] - deeper[code >> (level - self.fitted), level - self.fitted]
                side = int(margin > 0)
                level += 1
                heapq.heappush(queue, (cost + margin * margin, tree, level, 2 * code + 1 - side))
                code = 2 * code + side
            found.append((tree, code))
        return found


def units_of(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def cosines(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Cosines in double precision, the same for a pair whatever other rows stand beside it."""
    dot = (one * many).sum(axis=1)
    return dot / (np.sqrt((one * one).sum(axis=1)) * np.sqrt((many * many).sum(axis=1)))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector) of the rows that take part.

    Null ids and null, empty or zero vectors take no part, nor do vectors with a null or
    non-finite component or of another length than most (the greater length in a tie).
    Of several vectors with one id the least counts, by the order of arrays.
    """
    vector = F.col(vector_col)
    real = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(id_col, vector_col).filter(
        F.col(id_col).isNotNull() & vector.isNotNull() & real & F.exists(vector, lambda x: x != 0)
    )
    lengths = rows.groupBy(F.size(vector).alias("n")).agg(F.count(F.lit(1)).alias("rows"))
    most = lengths.orderBy(F.desc("rows"), F.desc("n")).first()
    rows = rows.filter(F.size(vector) == (most["n"] if most else 0))
    return rows.groupBy(F.col(id_col).alias("id")).agg(F.min(vector).alias("v"))


def true_neighbours(classes: DataFrame, asked: np.ndarray, k: int) -> list[np.ndarray]:
    """The ``k`` nearest other vectors of each of a few ``asked`` ones, by brute force over all rows."""
    units = units_of(asked)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, score = np.zeros((len(units), 0, units.shape[1])), np.zeros((len(units), 0))
        for batch in batches:
            many = _matrix(batch.column(0))
            for at in range(0, len(many), SCAN_LEAF):
                part = many[at : at + SCAN_LEAF]
                close = units @ units_of(part).T
                top = np.argsort(-close, axis=1)[:, : k + 1]
                held = np.concatenate([held, part[top]], axis=1)
                score = np.concatenate([score, np.take_along_axis(close, top, 1)], axis=1)
                top = np.argsort(-score, axis=1)[:, : k + 1]
                held, score = np.take_along_axis(held, top[:, :, None], 1), np.take_along_axis(score, top, 1)
        owner = np.repeat(np.arange(len(units)), score.shape[1])
        rows = held.reshape(-1, units.shape[1])
        yield pa.RecordBatch.from_arrays([pa.array(owner), pa.array(score.ravel()), pa.array(list(rows), pa.list_(pa.float64()))], ["q", "score", "v"])

    found = classes.select("v").mapInArrow(best, "q bigint, score double, v array<double>")
    order = Window.partitionBy("q").orderBy(F.desc("score"), "v")
    found = found.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= k + 1)
    near: list[list] = [[] for _ in asked]
    for row in found.orderBy("q", "_n").collect():
        near[row["q"]].append(row["v"])
    # The vector itself is one of the rows.
    return [units_of(m[(m != one).any(axis=1)][:k]) for one, m in zip(asked, (np.array(n, np.float64) for n in near), strict=True)]


def nearest(
    vectors: DataFrame,
    is_query: str,
    k: int = 5,
    trees: int = 8,
    leaf: int | None = None,
    probes: int | None = None,
    sample_rows: int = 16_384,
    target_recall: float = 0.95,
    sample_queries: int = 128,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` nearest rows found for each row that satisfies ``is_query``.

    Nearness is the cosine in double precision, ties go to the smaller id; a row is no
    neighbour of itself. ``sample_rows`` bounds the vectors that the forest is fitted on; every
    row is indexed. A query visits ``probes`` leaves; by default as many as ``sample_queries`` of
    the queries need to meet ``target_recall`` of their true neighbours, or all rows where
    their leaves hold nearly all. Equal (id, vector) rows count once. A query with fewer than ``k`` other rows
    gets them all.
    """
    rows = usable(vectors, id_col, vector_col)
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    few = rows.withColumn("_place", place).filter(F.col("_place") <= k + 1)
    classes = few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    classes = materialize(classes.select(F.col("ids")[0].alias("rep"), "ids", "v"))
    total = classes.count()
    sample = classes.orderBy(F.xxhash64("rep", "v"), "v").limit(sample_rows).select("v").collect()
    points = np.array([r["v"] for r in sample], np.float64)
    points = units_of(points) if total else np.zeros((0, 1))
    forest = Forest.fit(points, total, trees, leaf or max(1, min(LEAF, total // LEAST_LEAVES)))

    asked = rows.filter(is_query).join(classes.select("v", F.md5(F.col("v").cast("string").cast("binary")).alias("cls")), "v")
    asked = materialize(asked.select(F.col("id").alias("query_id"), "cls", "v"))
    searched = materialize(asked.select("cls", "v").distinct())
    if probes is None:
        some = searched.orderBy(F.xxhash64("v", F.lit(11)), "v").limit(sample_queries).select("v").collect()
        some = np.array([r["v"] for r in some], np.float64)
        units = list(units_of(some)) if len(some) else []
        probes = forest.visits_for(target_recall, units, true_neighbours(classes, some, k)) if units else trees
        if units and forest.share_read(units, points, probes) >= NEARLY_ALL:
            forest = Forest.fit(points, total, 1, SCAN_LEAF)
            probes = 1 << forest.depth
    # Where many queries visit a leaf they meet it in several groups.
    groups = max(1, math.ceil(searched.count() * probes / (len(forest.directions) << forest.depth) / GROUP_QUERIES))
    kind = classes.schema["v"].dataType.simpleString()
    id_kind = rows.schema["id"].dataType.simpleString()

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaves = forest.leaves(units_of(_matrix(batch.column(1))))
                for t, group in itertools.product(range(leaves.shape[1]), range(groups)):
                    tree, part = (pa.array(np.full(batch.num_rows, n, np.int32)) for n in (t, group))
                    yield pa.RecordBatch.from_arrays(
                        [tree, part, pa.array(leaves[:, t]), batch.column(0), batch.column(1)], ["tree", "part", "leaf", "ids", "v"]
                    )

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, unit in enumerate(units_of(_matrix(batch.column(1))) if batch.num_rows else ()):
                tree, leaf_of = np.array(forest.visits(unit, probes), np.int64).reshape(-1, 2).T
                owner = pa.array(np.full(len(tree), row))
                part = pa.array(np.full(len(tree), int(batch.column(0)[row].as_py()[:8], 16) % groups, np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tree.astype(np.int32)), part, pa.array(leaf_of), batch.column(0).take(owner), batch.column(1).take(owner)],
                    ["tree", "part", "leaf", "cls", "v"],
                )

    def rank(visits: pa.Table, held: pa.Table) -> pa.Table:
        """The ``k`` + 1 best rows of a leaf for each query that visits it; its own class is one of them."""
        owner, row, score = [], [], []
        if visits.num_rows and held.num_rows:
            asked_of, many = _matrix(visits["v"]), _matrix(held["v"])
            units, keep = units_of(many), min(k + 1, len(many))
            for at in range(0, len(asked_of), 512):
                close = units_of(asked_of[at : at + 512]) @ units.T
                # The product only preselects, with room for its rounding; scores are taken anew.
                floor = np.partition(close, close.shape[1] - keep, axis=1)[:, -keep] - 1e-9
                some, rows_of = np.nonzero(close >= floor[:, None])
                owner += (some + at).tolist()
                row += rows_of.tolist()
            score = cosines(asked_of[owner], many[row])
        return pa.table(
            {
                "cls": visits["cls"].take(pa.array(owner, pa.int64())),
                "ids": held["ids"].take(pa.array(row, pa.int64())),
                "score": pa.array(score, pa.float64()),
            }
        )

    visits = searched.mapInArrow(visit, f"tree int, part int, leaf bigint, cls string, v {kind}")
    held = classes.select("ids", "v").mapInArrow(index, f"tree int, part int, leaf bigint, ids array<{id_kind}>, v {kind}")
    ranked = visits.groupBy("tree", "part", "leaf").cogroup(held.groupBy("tree", "part", "leaf"))
    hits = ranked.applyInArrow(rank, f"cls string, ids array<{id_kind}>, score double")
    # A row found by several trees counts once.
    hits = hits.groupBy("cls", "ids").agg(F.max("score").alias("score"))
    best = Window.partitionBy("cls").orderBy(F.desc("score"), F.col("ids")[0])
    hits = hits.withColumn("_place", F.row_number().over(best)).filter(F.col("_place") <= k + 1).drop("_place")
    named = asked.select("query_id", "cls").join(hits, "cls").select("query_id", F.explode("ids").alias("id"), "score")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    out = named.filter(F.col("id") != F.col("query_id")).withColumn("rank", F.row_number().over(order))
    return out.filter(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")
