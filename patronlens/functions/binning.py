"""Bin expressions with right-closed edges."""

from __future__ import annotations

import math
from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column
from pyspark.sql import functions as F


def even_probabilities(bins: int) -> list[float]:
    """1/bins .. (bins-1)/bins, never below the exact fraction.

    A probability a hair too small would put an order statistic that is hit
    exactly just below its own value.
    """
    inner = []
    for i in range(1, bins):
        p = i / bins
        inner.append(p if Fraction(p) >= Fraction(i, bins) else math.nextafter(p, 1.0))
    return inner


def bin_of_rank(rank: Column, total: Column, bins: int) -> Column:
    """Quantile bin 1..bins of a 1-based rank among ``total`` distinct ranks.

    Equal to binning the ranks at their linearly interpolated quantiles, in
    integer arithmetic. One row alone has no distinct edges and raises.
    """
    scaled = (rank - 1) * bins + total - 2
    bucket = (scaled - F.pmod(scaled, total - 1)) / (total - 1)
    checked = F.when(total < 2, F.raise_error(F.lit("quantile bins need at least two rows"))).otherwise(bucket)
    return F.greatest(F.lit(1), checked.cast("int"))


def bin_of_value(value: Column, inner_edges: Sequence[Column]) -> Column:
    """1 + number of edges strictly below the value (bins closed on the right)."""
    return sum(((value > edge).cast("int") for edge in inner_edges), F.lit(1)).cast("int")


def fixed_bins(
    value: Column,
    edges: Sequence[float],
    labels: Sequence[str],
    include_lowest: bool = False,
) -> Column:
    """Label of the interval (edge[i], edge[i+1]] holding the value, else null."""
    low = value >= edges[0] if include_lowest else value > edges[0]
    chain = F.when(value.isNull() | F.isnan(value) | ~low, F.lit(None).cast("string"))
    for upper, label in zip(edges[1:], labels, strict=True):
        chain = chain.when(value <= upper, F.lit(label))
    return chain


def order_of(label: Column, labels: Sequence[str]) -> Column:
    """0-based position of a label in a fixed order, null when unknown."""
    chain = F.when(F.lit(False), F.lit(None).cast("int"))
    for position, name in enumerate(labels):
        chain = chain.when(label == name, F.lit(position))
    return chain
