"""k-means of many models at once: one pass over the rows is a round of all of them.

A fit on little data is a string of short jobs, and ninety fits are ninety
strings. Here Spark's k-means draws the first centres of each model and all
models then take their rounds together: each partition gives sums, counts and
costs by centre, a few numbers whatever its rows, and the driver moves the centres.
"""

from __future__ import annotations

from collections.abc import Hashable, Iterator, Mapping
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows whose distances to the centres of a model are held at once.
_ROWS = 4096


def _block(points: np.ndarray) -> np.ndarray:
    """Points by axis, a row of ones below."""
    return np.vstack([points.T, np.ones(len(points))])


def _round(block: np.ndarray, norms: float, centres: np.ndarray) -> tuple[np.ndarray, float]:
    """By centre the sums of its rows by axis and their number, and the cost. ``norms`` are the rows' squared norms, summed."""
    score = np.column_stack([-2.0 * centres, (centres * centres).sum(axis=1)]) @ block
    best = score.min(axis=0)
    sums = (score == best).astype(float) @ block.T
    if sums[:, -1].sum() != len(best):  # rows as near to a second centre: the lowest takes them
        sums = (score.argmin(axis=0) == np.arange(len(centres))[:, None]).astype(float) @ block.T
    return sums, float(best.sum() + norms)


@dataclass(frozen=True)
class Clusters:
    """Centres, and the summed squared distance of the rows to the centres of the last round's start."""

    centres: np.ndarray
    cost: float
    vector: str
    cluster: str = "KMeans_Cluster"

    def clusterCenters(self) -> list[np.ndarray]:  # noqa: N802, as Spark's models name it
        return list(self.centres)

    def nearest(self, point: Column) -> Column:
        """Number of the nearest centre to an array, the lowest on ties."""
        squared = F.array(
            *[sum(((point[i] - F.lit(float(x))) * (point[i] - F.lit(float(x))) for i, x in enumerate(c)), F.lit(0.0)) for c in self.centres]
        )
        return (F.array_position(squared, F.array_min(squared)) - 1).cast("int")

    def transform(self, df: DataFrame) -> DataFrame:
        placed = df.withColumn("_point", vector_to_array(F.col(self.vector)))
        return placed.withColumn(self.cluster, self.nearest(F.col("_point"))).drop("_point")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, _ROWS):
            part = batch.slice(first, _ROWS)
            points = part.column(0).flatten().to_numpy(zero_copy_only=False).astype(float)
            yield pa.RecordBatch.from_pydict({"points": [points.tobytes()], "n": pa.array([part.num_rows], pa.int32())})


def fit_rounds(
    rows: DataFrame, vector: str, starts: Mapping[Hashable, np.ndarray], max_iter: int, tol: float
) -> dict[Hashable, Clusters]:
    """The models that end from the centres ``starts``, by the same names.

    A model ends when no centre moves by more than ``tol``, or after ``max_iter``
    rounds; a centre without rows stays. ``rows`` are passed over once a round.
    """
    packed = rows.select(vector_to_array(F.col(vector)).alias("point")).mapInArrow(_pack, "points binary, n int")
    # Arrays in storage: a round is a job without a plan, which matters where rounds are many and rows few.
    blocks = packed.rdd.map(lambda r: np.frombuffer(r.points).reshape(r.n, -1)).map(_block).persist(StorageLevel.MEMORY_AND_DISK)
    centres = {name: np.array(c, dtype=float) for name, c in starts.items()}
    costs = dict.fromkeys(centres, 0.0)
    moving = list(centres)
    for _ in range(max_iter):
        if not moving:
            break
        now = [centres[name] for name in moving]

        def sums(part: Iterator[np.ndarray], now: list[np.ndarray] = now) -> Iterator[np.ndarray]:
            found = [np.zeros(c.size + len(c) + 1) for c in now]
            for block in part:
                norms = float((block[:-1] * block[:-1]).sum())
                for c, total in zip(now, found, strict=True):
                    added, cost = _round(block, norms, c)
                    total[:-1] += added.ravel()
                    total[-1] += cost
            yield np.concatenate(found)

        flat = reduce(np.add, blocks.mapPartitions(sums).collect())
        still, at = [], 0
        for name, c in zip(moving, now, strict=True):
            total = flat[at : at + c.size + len(c)].reshape(len(c), -1)
            at += total.size + 1
            costs[name] = float(flat[at - 1])
            held = total[:, -1:] > 0
            centres[name] = np.where(held, total[:, :-1] / np.where(held, total[:, -1:], 1.0), c)
            if ((centres[name] - c) ** 2).sum(axis=1).max() > tol * tol:
                still.append(name)
        moving = still
    blocks.unpersist()
    return {name: Clusters(c, costs[name], vector) for name, c in centres.items()}


def placed_by_all(rows: DataFrame, vector: str, models: Mapping[str, Clusters]) -> DataFrame:
    """(point, the nearest centre by each model, the lowest on ties, in a column of the model's name) for each row."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, _ROWS):
                part = batch.slice(first, _ROWS).column(0)
                points = part.flatten().to_numpy(zero_copy_only=False).reshape(len(part), -1)
                columns = [part]
                for model in models.values():
                    squared = sum((c[:, None] - x) ** 2 for c, x in zip(model.centres.T, points.T, strict=True))
                    columns.append(pa.array(squared.argmin(axis=0), pa.int32()))
                yield pa.RecordBatch.from_arrays(columns, names=["point", *models])

    schema = ", ".join(["point array<double>", *[f"`{name}` int" for name in models]])
    return rows.select(vector_to_array(F.col(vector)).alias("point")).mapInArrow(place, schema)
