"""Density clusters (DBSCAN) without comparing all pairs.

Rows with equal coordinates become one weighted point. Points are put into grid
cells whose diagonal is at most eps, so all points of a cell are neighbours:
a cell of enough weight is core throughout without looking at its pairs. All
other questions are asked between a point, or a cell, and the bounding box of a
cell: a box wholly outside eps is dropped, a box wholly inside counts in full,
and a box that is cut is split into halves per axis until it is small. Only
boxes of at most ``LEAF`` points are ever compared point by point, so no join
key collects more than a bounded number of rows, however crowded a cell is.
Joins are merge joins where both tables grow with the points or cells: a broadcast would pass through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import product
from math import sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from patronlens.functions.rounding import zero_if_missing
from patronlens.operators.clustering import standardize
from patronlens.operators.ranking import global_rank
from patronlens.schema import CUSTOMER, RFM
from patronlens.session import materialize

LEAF = 64
NOISE = -1
#: Up to so many axes a cell asks for the cells around it by name; beyond, their number explodes and two trees are walked.
LISTED_AXES = 4
#: Halvings of one step of the walk, on the axes then longest: a node has at most 2 ** 4 children.
HALVED_AT_ONCE = 4
#: Halvings of the first step, where a table has one node.
HALVED_FIRST = 9
#: A graph of at most so many edges is finished on the driver.
FEW_EDGES = 1 << 15


class _Grid:
    """Cells of side eps / sqrt(d) and their halvings."""

    def __init__(self, eps: float, dimensions: int):
        self.eps2 = eps * eps
        self.axes = range(dimensions)
        # A hair smaller, so that rounding cannot stretch a cell beyond eps.
        self.side = eps / sqrt(dimensions) * (1.0 - 1e-9)
        self.dimensions = dimensions

    def rings(self) -> list[tuple[int, int]]:
        """Squared gaps between cells, in sides, as (above, up to): cells that touch first, the last in reach at the end."""
        listed = self.dimensions <= LISTED_AXES
        ends = sorted({0, self.dimensions} if listed else {0, self.dimensions // 3, self.dimensions})
        return list(zip([-1, *ends], ends))

    def offsets(self, ring: tuple[int, int]) -> list[tuple[int, ...]]:
        reach = int(sqrt(self.dimensions)) + 1
        return [
            o
            for o in product(range(-reach, reach + 1), repeat=self.dimensions)
            if ring[0] < sum(max(abs(i) - 1, 0) ** 2 for i in o) <= ring[1]
        ]

    def cell(self, level: int) -> Column:
        width = self.side / 2**level
        return F.array(*[F.floor(F.col(f"x{i}") / F.lit(width)).cast("bigint") for i in self.axes])

    def boxes(self, points: DataFrame, level: int = 0) -> DataFrame:
        """Non-empty nodes of a level: parent, points, weight and tight bounding box."""
        return points.groupBy(self.cell(level).alias("node"), self.cell(max(level - 1, 0)).alias("parent")).agg(
            F.count(F.lit(1)).alias("k"),
            F.sum("w").alias("weight"),
            *[F.min(f"x{i}").alias(f"lo{i}") for i in self.axes],
            *[F.max(f"x{i}").alias(f"hi{i}") for i in self.axes],
        )

    def box_columns(self) -> list[str]:
        return [f"{side}{i}" for side in ("lo", "hi") for i in self.axes]

    def neighbours(self, cells: DataFrame, others: DataFrame, ring: tuple[int, int] | None = None) -> DataFrame:
        """Pairs of a cell and another one in reach (itself included) or in the given ring, with the other's box.

        With few axes each cell asks for its offsets, a fixed number of keys of the
        other table; with more, ``_walk`` meets only cells that are not empty.
        """
        ring = ring or (-1, self.dimensions)
        if self.dimensions > LISTED_AXES:
            asked = self._walk(cells, others.select(F.col("node").alias("cell")), ring)
        else:
            asked = self._listed(cells, ring)
        return asked.join(others.select("node", "k", "weight", *self.box_columns()).hint("merge"), "node")

    def apart(self, cells: DataFrame, ring: tuple[int, int]) -> DataFrame:
        """Pairs (cell, node) of ``cells`` (cell, part) in the ring that are of different parts, each pair once."""
        if self.dimensions > LISTED_AXES:
            return self._walk(cells, None, ring)
        sides = cells.select(F.col("cell").alias("node"), F.col("part").alias("_part"))
        met = self._listed(cells, ring).join(cells.hint("merge"), "cell").join(sides.hint("merge"), "node")
        return met.filter((F.col("cell") < F.col("node")) & (F.col("part") != F.col("_part"))).select("cell", "node")

    def _listed(self, cells: DataFrame, ring: tuple[int, int]) -> DataFrame:
        shifts = F.array(*[F.array(*[F.lit(i).cast("bigint") for i in o]) for o in self.offsets(ring)])
        return cells.select("cell", F.explode(shifts).alias("_shift")).select(
            "cell", F.array(*[F.col("cell")[i] + F.col("_shift")[i] for i in self.axes]).alias("node")
        )

    def _walk(self, cells: DataFrame, others: DataFrame | None, ring: tuple[int, int]) -> DataFrame:
        """Pairs (cell, node) whose cells lie in the ring, by descending two trees side by side.

        A node of a tree is a block of cells; a step halves the blocks along the
        axes on which they are longest, and keeps the pairs of children that
        hold cells and whose tight bounds come within reach. All is whole-number
        arithmetic on the places of cells. Without ``others`` the cells meet themselves,
        each pair once, and pairs of blocks that are both of one and the same ``part`` end there.
        """
        within = others is None
        cells = materialize(cells.select("cell", "part") if within else cells.select("cell"))
        others = cells if within else materialize(others)
        place = [F.col("cell")[i] for i in self.axes]
        span = (
            cells.select("cell").unionByName(others.select("cell"))
            .agg(
                F.array(*[F.coalesce(F.min(p), F.lit(0)) for p in place]).alias("low"),
                F.array(*[F.coalesce(F.max(p), F.lit(0)) for p in place]).alias("high"),
            )
            .first()
        )
        shifts = [(high - low).bit_length() for low, high in zip(span["low"], span["high"], strict=True)]

        def block(by: Sequence[int]) -> Column:
            return F.array(*[F.shiftright(p - F.lit(low), s) for p, low, s in zip(place, span["low"], by, strict=True)])

        def children(table: DataFrame, side: str, parent: Sequence[int], child: Sequence[int]) -> DataFrame:
            return table.groupBy(block(parent).alias(side), block(child).alias(f"{side}_child")).agg(
                *[F.min(p).alias(f"{side}lo{i}") for i, p in enumerate(place)],
                *[F.max(p).alias(f"{side}hi{i}") for i, p in enumerate(place)],
                *([F.min("part").alias(f"{side}_first"), F.max("part").alias(f"{side}_last")] if within else []),
            )

        # Between the cells themselves lies one side less than between their places.
        gaps = [
            F.greatest(F.col(f"alo{i}") - F.col(f"bhi{i}"), F.col(f"blo{i}") - F.col(f"ahi{i}"), F.lit(1)) - 1
            for i in self.axes
        ]
        gap = sum((g.cast("double") * g for g in gaps), F.lit(0.0))
        kept = gap <= ring[1]
        if within:
            one_part = (F.col("a_first") == F.col("a_last")) & (F.col("b_first") == F.col("b_last"))
            kept = kept & ~(one_part & (F.col("a_first") == F.col("b_first")))
            # Children of a block paired with itself come in both orders, all others in one.
            kept = kept & ((F.col("a") != F.col("b")) | (F.col("a_child") <= F.col("b_child")))
        root = F.array(*[F.lit(0).cast("bigint") for _ in self.axes])
        pairs = cells.sparkSession.range(1).select(root.alias("a"), root.alias("b"))
        halvings = HALVED_FIRST
        while True:
            halved = list(shifts)
            for _ in range(halvings):
                longest = max(self.axes, key=lambda i: halved[i])
                halved[longest] = max(halved[longest] - 1, 0)
            halvings = HALVED_AT_ONCE
            pairs = materialize(
                pairs.join(children(cells, "a", shifts, halved).hint("merge"), "a")
                .join(children(others, "b", shifts, halved).hint("merge"), "b")
                .filter(kept if any(halved) else kept & (gap > ring[0]))
                .select(F.col("a_child").alias("a"), F.col("b_child").alias("b"))
            )
            shifts = halved
            if not any(shifts):
                break

        def back(side: str) -> Column:
            return F.array(*[F.col(side)[i] + F.lit(low) for i, low in enumerate(span["low"])])

        return pairs.select(back("a").alias("cell"), back("b").alias("node"))

    def nearest(self, low: list[Column], high: list[Column], prefix: str = "") -> Column:
        """Squared distance from the box (low, high) to the row's box."""
        gaps = [
            F.greatest(F.col(f"{prefix}lo{i}") - high[i], low[i] - F.col(f"{prefix}hi{i}"), F.lit(0.0))
            for i in self.axes
        ]
        return sum((g * g for g in gaps), F.lit(0.0))

    def farthest(self, low: list[Column], high: list[Column], prefix: str = "") -> Column:
        """Squared distance between the farthest corners of the two boxes."""
        gaps = [
            F.greatest(
                F.abs(F.col(f"{prefix}hi{i}") - low[i]), F.abs(high[i] - F.col(f"{prefix}lo{i}"))
            )
            for i in self.axes
        ]
        return sum((g * g for g in gaps), F.lit(0.0))


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _hits(grid: _Grid, queries: DataFrame, near: DataFrame, points: DataFrame, enough: int | None) -> DataFrame:
    """Weight within eps of each query point, per cell in reach: (pid, root, weight).

    ``queries`` are (pid, q0.., cell); ``near`` comes from ``neighbours``. With
    ``enough``, a point is not looked at any deeper once it has that weight, so
    its weight is then only a lower bound.
    """
    at = [F.col(f"q{i}") for i in grid.axes]
    frontier = queries.join(near.hint("merge"), "cell").withColumn("root", F.col("node"))
    found: list[DataFrame] = []
    level = 0
    while True:
        seen = frontier.filter(grid.nearest(at, at) <= grid.eps2).withColumn(
            "_whole", grid.farthest(at, at) <= grid.eps2
        )
        seen = materialize(seen)
        found.append(seen.filter("_whole").select("pid", "root", "weight"))
        located = points.select(
            grid.cell(level).alias("node"), "w", *[F.col(f"x{i}") for i in grid.axes]
        )
        apart = [F.col(f"x{i}") - F.col(f"q{i}") for i in grid.axes]
        distance = sum((a * a for a in apart), F.lit(0.0))
        found.append(
            seen.filter(~F.col("_whole") & (F.col("k") <= LEAF))
            .select("pid", "root", "node", *at)
            .join(located.hint("merge"), "node")
            .filter(distance <= grid.eps2)
            .groupBy("pid", "root")
            .agg(F.sum("w").alias("weight"))
        )
        deep = seen.filter(~F.col("_whole") & (F.col("k") > LEAF)).select("pid", "root", "node", *at)
        if enough is not None:
            satisfied = _union(found).groupBy("pid").agg(F.sum("weight").alias("_sum")).filter(F.col("_sum") >= enough)
            deep = deep.join(satisfied, "pid", "left_anti")
        deep = materialize(deep)
        if deep.isEmpty():
            return _union(found)
        level += 1
        frontier = deep.withColumnRenamed("node", "parent").join(grid.boxes(points, level), "parent")


def _edges(grid: _Grid, points: DataFrame, cells: DataFrame, near: DataFrame) -> DataFrame:
    """Those pairs (a, b) of the cells (cell, node) of ``near`` that hold a pair of points within eps."""
    first = cells.select(
        F.col("node").alias("cell"), F.col("k").alias("ak"), *[F.col(c).alias(f"a{c}") for c in grid.box_columns()]
    )
    boxes = cells.select("node", "k", *grid.box_columns())
    pairs = near.filter(F.col("cell") != F.col("node")).join(boxes.hint("merge"), "node").join(first.hint("merge"), "cell")
    frontier = pairs.withColumns({"a": F.col("cell"), "b": F.col("node"), "na": F.col("cell")})
    low = [F.col(f"alo{i}") for i in grid.axes]
    high = [F.col(f"ahi{i}") for i in grid.axes]
    found: list[DataFrame] = []
    level = 0
    while True:
        seen = frontier.filter(grid.nearest(low, high) <= grid.eps2).select(
            "a",
            "b",
            "na",
            F.col("node").alias("nb"),
            (grid.farthest(low, high) <= grid.eps2).alias("_whole"),
            (F.col("ak") * F.col("k") <= LEAF).alias("_small"),
        )
        seen = materialize(seen)
        found.append(seen.filter("_whole").select("a", "b").distinct())
        open_pairs = seen.join(found[-1].hint("merge"), ["a", "b"], "left_anti")
        left = points.select(grid.cell(level).alias("na"), *[F.col(f"x{i}").alias(f"l{i}") for i in grid.axes])
        right = points.select(grid.cell(level).alias("nb"), *[F.col(f"x{i}").alias(f"r{i}") for i in grid.axes])
        apart = [F.col(f"l{i}") - F.col(f"r{i}") for i in grid.axes]
        distance = sum((d * d for d in apart), F.lit(0.0))
        # At most LEAF comparisons per pair of small boxes.
        found.append(
            open_pairs.filter("_small")
            .join(left.hint("merge"), "na")
            .join(right.hint("merge"), "nb")
            .filter(distance <= grid.eps2)
            .select("a", "b")
            .distinct()
        )
        deep = materialize(open_pairs.filter(~F.col("_small")).join(found[-1].hint("merge"), ["a", "b"], "left_anti"))
        if deep.isEmpty():
            return _union(found).distinct()
        level += 1
        nodes = grid.boxes(points, level)
        one = nodes.select(
            F.col("parent").alias("na"),
            F.col("node").alias("_child"),
            F.col("k").alias("ak"),
            *[F.col(c).alias(f"a{c}") for c in grid.box_columns()],
        )
        two = nodes.select(F.col("parent").alias("nb"), "node", "k", *grid.box_columns())
        frontier = (
            deep.select("a", "b", "na", "nb")
            .join(one, "na")
            .drop("na")
            .withColumnRenamed("_child", "na")
            .join(two, "nb")
        )


def _last_steps(edges: DataFrame) -> DataFrame:
    """(u, to): one and the same vertex for all of a component, for the vertices of at most ``FEW_EDGES`` edges."""
    above: dict = {}

    def top(v):
        while above.setdefault(v, v) != v:
            above[v] = v = above[above[v]]
        return v

    for u, v in edges.select("u", "v").collect():
        above[top(u)] = top(v)
    kind = edges.schema["u"].dataType
    schema = StructType([StructField("u", kind), StructField("to", kind)])
    return edges.sparkSession.createDataFrame([(v, top(v)) for v in list(above)], schema)


def connected_components(vertices: DataFrame, edges: DataFrame, merged: bool = False) -> DataFrame:
    """Smallest vertex id of each vertex's component: (v, label).

    Randomised contraction (Boegeholz, Brand and Todor, 2019): in each round
    every vertex joins the one of lowest hash among itself and its neighbours,
    with a new hash each time. The vertices left shrink by a constant factor
    per round whatever the shape of the graph, long chains included. A graph that is down to ``FEW_EDGES`` edges is
    finished in one step. ``merged`` asks for merge joins, so that no round's table passes through the driver.
    """
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    left = materialize(both.filter(F.col("u") != F.col("v")).distinct())
    held = vertices.select("v", F.col("v").alias("label"))
    turn = 0
    while edges_left := left.count():
        if edges_left <= FEW_EDGES:
            ends = _last_steps(left)
            step = ends.hint("merge") if merged else ends
            held = held.join(step.select(F.col("u").alias("label"), "to"), "label", "left").select(
                "v", F.coalesce("to", "label").alias("label")
            )
            held = materialize(held)
            break

        def priority(name: str, seed: int = turn) -> Column:
            return F.struct(F.xxhash64(F.col(name), F.lit(seed)).alias("h"), F.col(name).alias("id"))

        lowest = left.groupBy("u").agg(F.min(priority("v")).alias("_low"))
        lowered = materialize(lowest.select("u", F.least("_low", priority("u"))["id"].alias("to")))
        step = lowered.hint("merge") if merged else lowered
        held = materialize(
            held.join(step.select(F.col("u").alias("label"), "to"), "label", "left").select(
                "v", F.coalesce("to", "label").alias("label")
            )
        )
        left = materialize(
            left.join(step.select("u", F.col("to").alias("_u")), "u")
            .join(step.select(F.col("u").alias("v"), F.col("to").alias("_v")), "v")
            .filter(F.col("_u") != F.col("_v"))
            .select(F.col("_u").alias("u"), F.col("_v").alias("v"))
            .distinct()
        )
        turn += 1
    smallest = held.groupBy("label").agg(F.min("v").alias("_smallest"))
    return materialize(held.join(smallest, "label").select("v", F.col("_smallest").alias("label")))


def _core_points(grid: _Grid, points: DataFrame, cells: DataFrame, min_samples: int) -> DataFrame:
    """Points with a flag for enough weight within eps, themselves included."""
    weights = cells.select(F.col("node").alias("cell"), F.col("weight").alias("cell_weight"))
    placed = points.withColumn("cell", grid.cell(0)).join(weights.hint("merge"), "cell")
    crowded = F.col("cell_weight") >= min_samples
    sparse = placed.filter(~crowded).select(
        "pid", "cell", *[F.col(f"x{i}").alias(f"q{i}") for i in grid.axes], F.lit(0).cast("bigint").alias("_near")
    )
    # Ring by ring, so that only points still short of neighbours look at the many cells farther away.
    cored: list[DataFrame] = []
    for ring in grid.rings():
        sparse = materialize(sparse)
        near = grid.neighbours(sparse.select("cell").distinct(), cells, ring)
        weight = _hits(grid, sparse.drop("_near"), near, points, min_samples).groupBy("pid").agg(F.sum("weight").alias("_more"))
        summed = sparse.join(weight.hint("merge"), "pid", "left").withColumn("_near", F.col("_near") + F.coalesce("_more", F.lit(0)))
        summed = materialize(summed.drop("_more"))
        cored.append(summed.filter(F.col("_near") >= min_samples).select("pid"))
        sparse = summed.filter(F.col("_near") < min_samples)
    found = _union(cored).withColumn("_found", F.lit(True))
    flagged = placed.join(found.hint("merge"), "pid", "left").withColumn("core", crowded | F.coalesce("_found", F.lit(False)))
    return materialize(flagged.select(*points.columns, "cell", "core"))


def _weighted_points(
    customers: DataFrame, features: Sequence[str], unique: str
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Rows with standardised coordinates, and one weighted point per distinct place."""
    axes = [f"x{i}" for i in range(len(features))]
    scaled = standardize(customers, features, "_z")
    rows = materialize(
        scaled.select(
            F.struct(*customers.columns).alias("_row"),
            F.col(unique).alias("_id"),
            *[zero_if_missing(F.col(f"{c}_z")).alias(x) for c, x in zip(features, axes, strict=True)],
        )
    )
    points = rows.groupBy(*axes).agg(F.min("_id").alias("pid"), F.count(F.lit(1)).alias("w"))
    return rows, materialize(points), axes


def dbscan_core(
    customers: DataFrame,
    eps: float = 0.5,
    min_samples: int = 5,
    features: Sequence[str] = RFM,
    unique: str = CUSTOMER,
) -> DataFrame:
    """Customers with a flag for at least ``min_samples`` customers (themselves included) within eps."""
    rows, points, axes = _weighted_points(customers, features, unique)
    grid = _Grid(eps, len(axes))
    flagged = _core_points(grid, points, materialize(grid.boxes(points)), min_samples)
    return rows.join(flagged.select(*axes, "core").hint("merge"), axes).select("_row.*", F.col("core").alias("Is_Core"))


def dbscan_outliers(
    customers: DataFrame,
    eps: float = 0.5,
    min_samples: int = 5,
    features: Sequence[str] = RFM,
    unique: str = CUSTOMER,
) -> DataFrame:
    """Cluster per customer on standardised features, -1 for noise.

    Clusters are numbered from 0 by the smallest id among their core
    customers; a border customer joins the lowest-numbered cluster in reach.
    """
    rows, points, axes = _weighted_points(customers, features, unique)
    grid = _Grid(eps, len(axes))
    flagged = _core_points(grid, points, materialize(grid.boxes(points)), min_samples)
    core = flagged.filter("core")
    core_cells = materialize(grid.boxes(core))

    # A cell stands for all its core points; its name is their smallest id.
    names = materialize(core.groupBy(F.col("cell").alias("node")).agg(F.min("pid").alias("v")))
    # Cells that touch mostly connect what belongs together; farther ones matter only between parts still separate.
    parts = names.select(F.col("node").alias("cell"), F.col("v").alias("part"))
    for ring in grid.rings():
        touching = (
            _edges(grid, core, core_cells, grid.apart(parts, ring))
            .join(parts.select(F.col("cell").alias("a"), F.col("part").alias("u")).hint("merge"), "a")
            .join(parts.select(F.col("cell").alias("b"), F.col("part").alias("v")).hint("merge"), "b")
            .select("u", "v")
        )
        components = connected_components(parts.select(F.col("part").alias("v")).distinct(), touching, merged=True)
        parts = materialize(parts.withColumnRenamed("part", "v").join(components.hint("merge"), "v").select("cell", F.col("label").alias("part")))
    numbers = global_rank(parts.select("part").distinct(), ["part"], "_number")
    clusters = materialize(
        parts.join(numbers, "part").select(F.col("cell").alias("node"), (F.col("_number") - 1).cast("int").alias("cluster"))
    )

    rest = flagged.filter(~F.col("core")).select(
        "pid", "cell", *[F.col(f"x{i}").alias(f"q{i}") for i in grid.axes]
    )
    near = grid.neighbours(rest.select("cell").distinct(), core_cells)
    border = (
        _hits(grid, rest, near, core, None)
        .join(clusters.withColumnRenamed("node", "root").hint("merge"), "root")
        .groupBy("pid")
        .agg(F.min("cluster").alias("cluster"))
    )
    inside = core.join(clusters.withColumnRenamed("node", "cell").hint("merge"), "cell").select("pid", "cluster")
    labels = points.join(inside.unionByName(border).hint("merge"), "pid", "left").select(
        *axes, F.coalesce("cluster", F.lit(NOISE)).alias("DBSCAN_Cluster")
    )
    return rows.join(labels.hint("merge"), axes).select("_row.*", "DBSCAN_Cluster")
