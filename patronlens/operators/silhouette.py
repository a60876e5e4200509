"""Silhouette on plain Euclidean distance, which takes all pairs of rows.

Rows are packed into blocks, and a task meets one block with a share of all
blocks: memory is bounded whatever the table, and the work, which grows with
the square of the rows, spreads over as many tasks as there are blocks. Several
clusterings of the same rows share the distances. Blocks are sorted by cluster,
so that sums by cluster are sums over runs of rows.

Callers who name a number of ``members`` compare with a sample instead: those of
lowest seeded hash of each cluster, and the result says by how much that can move it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronlens.session import materialize

_BLOCK = 256
#: Rows and columns of the distances that are held at once: half a megabyte.
_TILE = 256
#: Rows of a block at most, and sums by cluster and row that a task holds.
_BLOCK_ROWS = 4096
_SUMS = 1 << 18
#: Rows that a task meets its block with.
_SHARE = 1 << 20
#: Squared distances below this share of the squared norms come from differences: above it a product of matrices is right to nine digits.
_NEAR = 2.0**-20


class Silhouette(NamedTuple):
    """Mean over all rows, and two standard errors of the sampling (0 where nothing was sampled).

    Both are None with fewer than two clusters.
    """

    value: float | None
    error: float | None


class _Members(NamedTuple):
    points: np.ndarray  # by cluster, one after the other
    starts: np.ndarray
    taken: np.ndarray
    sizes: np.ndarray
    last: list[tuple[int, str]]  # hash and id of each cluster's last member in the sample


def _scores(members: _Members, points: np.ndarray, own: np.ndarray, sampled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Silhouette and its two standard errors for a block of rows; 0 for the only row of a cluster."""
    squared = np.zeros((len(points), len(members.points)))
    for axis in range(points.shape[1]):
        apart = points[:, axis, None] - members.points[None, :, axis]
        squared += apart * apart
    sums = np.add.reduceat(np.sqrt(squared), members.starts, axis=1)
    squares = np.add.reduceat(squared, members.starts, axis=1)
    at = np.arange(len(points))
    # A row is not its own neighbour; its distance to itself adds nothing to the sums.
    counted = np.repeat(members.taken[None, :].astype(float), len(points), axis=0)
    counted[at, own] -= sampled
    sizes = np.repeat(members.sizes[None, :].astype(float), len(points), axis=0)
    sizes[at, own] -= 1.0
    some = np.maximum(counted, 1.0)
    mean = sums / some
    spread = np.maximum(squares / some - mean * mean, 0.0) * some / np.maximum(some - 1.0, 1.0)
    left_out = np.clip(1.0 - counted / np.maximum(sizes, 1.0), 0.0, 1.0)
    error = np.sqrt(spread / some * left_out)
    inside, inside_error = mean[at, own], error[at, own]
    mean[at, own] = np.inf
    nearest = mean.argmin(axis=1)
    outside, outside_error = mean[at, nearest], error[at, nearest]
    longest = np.maximum(inside, outside)
    alone = (members.sizes[own] < 2) | (longest == 0)
    longest = np.where(alone, 1.0, longest)
    score = np.where(alone, 0.0, (outside - inside) / longest)
    return score, np.where(alone, 0.0, 2.0 * (inside_error + outside_error) / longest)

class _Parts(NamedTuple):
    """What the tasks know of the clusterings: cluster values by clustering, places of their sums, sizes."""

    values: list[np.ndarray]
    starts: np.ndarray
    sizes: list[np.ndarray]

    @property
    def total(self) -> int:
        return int(self.starts[-1])

    @property
    def kind(self) -> str:
        return "<i2" if self.total < 1 << 15 else "<i4"


def _pack(rows: DataFrame, parts: _Parts, size: int) -> DataFrame:
    """Blocks of up to ``size`` rows (v, one label per clustering): block, points, and places of their clusters' sums."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for first in range(0, batch.num_rows, size):
                part = batch.slice(first, size)
                points = part.column(0).flatten().to_numpy(zero_copy_only=False)
                places = np.full((part.num_rows, len(parts.values)), -1, parts.kind)
                for j, values in enumerate(parts.values):
                    known = part.column(j + 1).is_valid().to_numpy(zero_copy_only=False)
                    label = part.column(j + 1).drop_null().to_numpy(zero_copy_only=False)
                    places[known, j] = parts.starts[j] + np.searchsorted(values, label)
                yield pa.RecordBatch.from_pydict(
                    {"block": [number], "points": [points.astype("<f8").tobytes()], "places": [places.tobytes()]}
                )
                number += 1

    return rows.mapInArrow(pack, "block bigint, points binary, places binary")


def _distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Distances between all rows of ``left`` and of ``right``.

    By one product of matrices; where its rounding could show in the distance, from the differences.
    """
    first, second = (left * left).sum(1), (right * right).sum(1)
    squared = np.column_stack([left, first, np.ones(len(left))]) @ np.vstack([-2.0 * right.T, np.ones(len(right)), second])
    near = squared < (first.max() + second.max()) * _NEAR
    if near.any():
        i, j = np.nonzero(near)
        squared[i, j] = ((left[i] - right[j]) ** 2).sum(1)
    return np.sqrt(squared, out=squared)


def _add_sums(sums: np.ndarray, targets: np.ndarray, points: np.ndarray, places: np.ndarray) -> None:
    """Add to ``sums`` (place, target) the distances to ``points``, each at the places of its clusters."""
    centre = points.mean(axis=0)
    targets, points = targets - centre, points - centre
    for first in range(0, len(points), _TILE):
        tile, at = points[first : first + _TILE], places[first : first + _TILE].astype(np.int64)
        # Rows are sorted by their clusters, so that a tile has few runs of rows with equal ones.
        begins = np.concatenate([[True], (at[1:] != at[:-1]).any(axis=1)])
        runs = np.zeros((begins.sum(), len(tile)))
        runs[begins.cumsum() - 1, np.arange(len(tile))] = 1.0
        placed = np.zeros((len(sums), len(runs)))
        for column in at[begins].T:
            known = np.flatnonzero(column >= 0)
            placed[column[known], known] = 1.0
        joined = placed @ runs if 2 * len(runs) > len(sums) else None
        for start in range(0, len(targets), _TILE):
            apart = _distances(tile, targets[start : start + _TILE])
            found = placed @ (runs @ apart) if joined is None else joined @ apart
            sums[:, start : start + _TILE] += found


def _block_scores(parts: _Parts, sums: np.ndarray, places: np.ndarray) -> Iterator[tuple[float, int]]:
    """Summed silhouette and number of the rows of a block, by clustering."""
    for j, sizes in enumerate(parts.sizes):
        own = places[:, j].astype(np.int64) - parts.starts[j]
        taken = np.flatnonzero(own >= 0)
        own, at = own[taken], np.arange(len(taken))
        mine = sums[parts.starts[j] : parts.starts[j + 1], taken].T
        mean = mine / sizes
        inside = mine[at, own] / np.maximum(sizes[own] - 1, 1)
        mean[at, own] = np.inf
        outside = mean.min(axis=1) if len(sizes) else inside
        longest = np.maximum(inside, outside)
        alone = (sizes[own] < 2) | (longest == 0)
        score = np.where(alone, 0.0, (outside - inside) / np.where(alone, 1.0, longest))
        yield float(score.sum()), len(taken)


def euclidean_silhouettes(rows: DataFrame, vector: Column, clusters: Sequence[str]) -> list[Silhouette]:
    """Silhouette of the rows for each column of ``clusters``, every row against every other.

    A pair's distance is taken once for all clusterings. ``vector`` gives arrays of equal
    length without nulls. Rows without a cluster take no part in that clustering.
    """
    labels = [F.col(c).cast("int").alias(f"c{j}") for j, c in enumerate(clusters)]
    taken = materialize(rows.filter(F.coalesce(*[F.col(c) for c in clusters]).isNotNull()).select(vector.alias("v"), *labels))
    each = F.array(*[F.struct(F.lit(j).alias("j"), F.col(f"c{j}").alias("c")) for j in range(len(clusters))])
    counted = taken.select(F.inline(each)).filter(F.col("c").isNotNull()).groupBy("j", "c").agg(F.count(F.lit(1)).alias("n"))
    found = sorted(counted.collect())
    values = [np.array([r.c for r in found if r.j == j], np.int64) for j in range(len(clusters))]
    sizes = [np.array([r.n for r in found if r.j == j], np.int64) for j in range(len(clusters))]
    parts = _Parts(values, np.cumsum([0, *map(len, values)]), sizes)
    if all(len(v) < 2 for v in values):
        return [Silhouette(None, None)] * len(clusters)
    count = max(int(s.sum()) for s in sizes)
    block = int(min(max(count // 64, _TILE), _BLOCK_ROWS, max(_SUMS // parts.total, _TILE)))
    # A task meets a block of rows with a share of all rows that does not grow with the table.
    shares = -(-count // _SHARE)
    blocks = materialize(_pack(taken.repartition(shares).sortWithinPartitions(*[f"c{j}" for j in range(len(clusters))]), parts, block))
    others = blocks.select(F.col("points").alias("_points"), F.col("places").alias("_places")).coalesce(shares)
    met = blocks.repartition(-(-count // block)).crossJoin(others.hint("shuffle_replicate_nl"))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sums = None, None

        def done() -> pa.RecordBatch:
            columns = {"block": [held[0]], "places": [held[2]], "sums": [sums.tobytes()]}
            return pa.RecordBatch.from_pydict(columns)

        for batch in batches:
            for row in zip(*[batch.column(i) for i in range(5)], strict=True):
                number = row[0].as_py()
                if held is None or held[0] != number:
                    if held is not None:
                        yield done()
                    places = row[2].as_py()
                    rows_here = len(places) // (len(parts.values) * np.dtype(parts.kind).itemsize)
                    held = (number, np.frombuffer(row[1].as_buffer()).reshape(rows_here, -1).copy(), places)
                    sums = np.zeros((parts.total, rows_here))
                theirs = np.frombuffer(row[4].as_buffer(), parts.kind).reshape(-1, len(parts.values))
                _add_sums(sums, held[1], np.frombuffer(row[3].as_buffer()).reshape(len(theirs), -1), theirs)
        if held is not None:
            yield done()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                places = np.frombuffer(batch.column(0)[at].as_buffer(), parts.kind).reshape(-1, len(parts.values))
                sums = sum(np.frombuffer(s.as_buffer()) for s in batch.column(1)[at].values).reshape(parts.total, -1)
                totals, counts = zip(*_block_scores(parts, sums, places), strict=True)
                yield pa.RecordBatch.from_pydict({"j": pa.array(range(len(totals)), pa.int32()), "total": totals, "n": counts})

    added = met.select("block", "points", "places", "_points", "_places").mapInArrow(add, "block bigint, places binary, sums binary")
    whole = added.groupBy("block").agg(F.first("places").alias("places"), F.collect_list("sums").alias("sums")).drop("block")
    scored = whole.mapInArrow(score, "j int, total double, n bigint").groupBy("j").agg((F.sum("total") / F.sum("n")).alias("value"))
    means = {r.j: r.value for r in scored.collect()}
    return [Silhouette(means[j], 0.0) if len(values[j]) > 1 else Silhouette(None, None) for j in range(len(clusters))]


def euclidean_silhouette(
    clustered: DataFrame, vector: Column, cluster: str, unique: str, members: int | None = None, seed: int = 42
) -> Silhouette:
    """Silhouette of the rows of ``clustered``, every row against every other.

    ``vector`` gives arrays of equal length without nulls. Rows without a cluster take no part.
    With ``members``, rows are compared with a sample of so many of each cluster; ``unique`` then
    names a column that tells the rows apart.
    """
    if members is None:
        return euclidean_silhouettes(clustered, vector, [cluster])[0]
    name = F.col(unique).cast("string")
    rows = clustered.filter(F.col(cluster).isNotNull()).select(
        vector.alias("v"), F.col(cluster).cast("int").alias("c"), F.xxhash64(name, F.lit(seed)).alias("h"), name.alias("id")
    )
    sizes = {r.c: r.n for r in rows.groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return Silhouette(None, None)
    place = F.row_number().over(Window.partitionBy("c").orderBy("h", "id"))
    # At most ``members`` rows a cluster reach the driver.
    drawn = rows.withColumn("_place", place).filter(F.col("_place") <= members).orderBy("c", "_place").collect()
    clusters = sorted(sizes)
    taken = np.array([sum(r.c == c for r in drawn) for c in clusters])
    ends = np.cumsum(taken)
    table = _Members(
        np.array([r.v for r in drawn], dtype=float),
        ends - taken,
        taken,
        np.array([sizes[c] for c in clusters]),
        [(drawn[end - 1].h, drawn[end - 1].id) for end in ends],
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, error, count = 0.0, 0.0, 0
        for batch in batches:
            for start in range(0, batch.num_rows, _BLOCK):
                part = batch.slice(start, _BLOCK)
                points = part.column(0).flatten().to_numpy().reshape(part.num_rows, -1)
                own = np.searchsorted(clusters, part.column(1).to_numpy())
                keys = zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)
                sampled = np.array([key <= table.last[c] for key, c in zip(keys, own, strict=True)], dtype=float)
                values, errors = _scores(table, points, own, sampled)
                total, error, count = total + values.sum(), error + errors.sum(), count + len(values)
        yield pa.RecordBatch.from_pydict({"total": [float(total)], "error": [float(error)], "n": [count]})

    sums = rows.mapInArrow(score, "total double, error double, n bigint").agg(
        (F.sum("total") / F.sum("n")).alias("value"), (F.sum("error") / F.sum("n")).alias("error")
    )
    found = sums.first()
    return Silhouette(found.value, found.error)
