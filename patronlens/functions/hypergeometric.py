"""Expected purchases over several horizons, vectorised per Arrow batch."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Beyond this argument the series is taken around one instead of around zero.
NEAR_ONE = 0.9
#: Terms after which a row that has not converged is an error; nothing is cut off silently.
MAX_TERMS = 20_000_000
TOLERANCE = 1e-14
#: The expansion around one loses digits where c - a - b is this close to a whole number.
WHOLE = 1e-3
#: Steps of c, either side of the whole number, between which such values are interpolated.
STEP = 4e-3
STEPS = 5


def _series(a: np.ndarray, b: np.ndarray, c: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Gauss series; each row stops by itself, so its value does not depend on its batch."""
    total = np.ones_like(z)
    live = np.arange(len(z))
    a, b, c, z, term, part = a.copy(), b.copy(), c.copy(), z.copy(), np.ones_like(z), np.ones_like(z)
    for j in range(MAX_TERMS):
        if not len(live):
            return total
        ratio = (a + j) * (b + j) / ((c + j) * (1.0 + j)) * z
        term = term * ratio
        part = part + term
        # Once terms shrink, the largest later ratio bounds what is left out.
        later = np.maximum(np.abs(ratio), z)
        done = (term == 0) | (later < 1) & (np.abs(term) * later <= TOLERANCE * np.abs(part) * (1.0 - later))
        if done.any():
            total[live[done]] = part[done]
            keep = ~done
            live, a, b, c, z, term, part = (v[keep] for v in (live, a, b, c, z, term, part))
    raise ArithmeticError(f"the series of {len(live)} rows has not converged after {MAX_TERMS} terms")


def _gamma(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log of the absolute value of the gamma function and its sign; infinite at the poles."""
    pole = (x <= 0) & (x == np.floor(x))
    logs = np.array([math.inf if at else math.lgamma(v) for v, at in zip(x.tolist(), pole.tolist(), strict=True)])
    return logs, np.where((x < 0) & (np.floor(x) % 2 != 0), -1.0, 1.0)


def _ratio(above: list[np.ndarray], below: list[np.ndarray]) -> np.ndarray:
    """Product of gamma values over another; zero where one below has a pole."""
    logs, sign = np.zeros_like(above[0]), np.ones_like(above[0])
    for x in above:
        value, its = _gamma(x)
        logs, sign = logs + value, sign * its
    for x in below:
        value, its = _gamma(x)
        logs, sign = logs - value, sign * its
    return sign * np.exp(logs)


def _around_one(a: np.ndarray, b: np.ndarray, c: np.ndarray, z: np.ndarray) -> np.ndarray:
    """The connection formula: two series at 1 - z; c - a - b must not be whole."""
    gap = c - a - b
    one = _ratio([c, gap], [c - a, c - b]) * _series(a, b, 1.0 - gap, 1.0 - z)
    two = _ratio([c, -gap], [a, b]) * (1.0 - z) ** gap * _series(c - a, c - b, 1.0 + gap, 1.0 - z)
    return one + two


def _around_whole(a: np.ndarray, b: np.ndarray, c: np.ndarray, z: np.ndarray) -> np.ndarray:
    """The same where c - a - b is whole or nearly so.

    Both series have a pole there, but their sum is smooth in c: it is
    interpolated between values of c a few steps off the whole number.
    """
    off = c - a - b - np.round(c - a - b)
    steps = [STEP * k for k in range(-STEPS, STEPS + 1) if k]
    total = np.zeros_like(z)
    for at in steps:
        weight = np.ones_like(z)
        for other in steps:
            if other != at:
                weight = weight * (off - other) / (at - other)
        total = total + weight * _around_one(a, b, c - off + at, z)
    return total


def hyp2f1(a: float, b: float, c: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Gauss hypergeometric function for small fixed a and b, c > 0 and 0 <= z < 1.

    Near one the series at 1 - z takes over (the connection formula), with its
    limit where c - a - b is whole. Only for c next to zero, where the steps
    around it would leave the domain, the slower series at z runs to its end.
    """
    shape = np.broadcast_shapes(np.shape(c), np.shape(z))
    c, z = (np.broadcast_to(np.asarray(v, float), shape).ravel() for v in (c, z))
    a, b = np.full_like(z, a), np.full_like(z, b)
    gap = c - a - b
    whole = np.abs(gap - np.round(gap)) <= WHOLE
    near = (z > NEAR_ONE) & ~(whole & (c <= 2 * STEPS * STEP))
    out = np.empty_like(z)
    for rows, form in ((~near, _series), (near & ~whole, _around_one), (near & whole, _around_whole)):
        if rows.any():
            out[rows] = form(a[rows], b[rows], c[rows], z[rows])
    return out.reshape(shape)


def purchases_until(params: dict[str, float], horizons: Sequence[float], x, t_x, age) -> np.ndarray:
    """Expected purchases up to each horizon given x repeat purchases, the last at t_x, seen for ``age``.

    Uses the Euler transform of the series: its parameters do not grow with x,
    so nothing overflows for heavy buyers.
    """
    r, alpha, a, b = (params[n] for n in ("r", "alpha", "a", "b"))
    x, t_x, age = (np.asarray(v, dtype=float)[:, None] for v in (x, t_x, age))
    t = np.asarray(horizons, dtype=float)[None, :]
    c = a + b + x - 1.0
    z = t / (alpha + age + t)
    defined = np.broadcast_to(c > 0, z.shape)
    if a == 1.0:
        return np.full(z.shape, np.nan)
    safe_c = np.broadcast_to(np.where(c > 0, c, 1.0), z.shape)
    series = hyp2f1(a + b - 1.0 - r, a - 1.0, safe_c, z)
    numerator = c / (a - 1.0) * (1.0 - (1.0 - z) ** (a - 1.0) * series)
    repeat = x > 0
    odds = np.where(repeat, a / np.where(repeat, b + x - 1.0, 1.0), 0.0)
    inactive = odds * np.exp((r + x) * np.log((alpha + age) / (alpha + t_x)))
    return np.where(defined, numerator / (1.0 + inactive), np.nan)


def expected_purchases(
    params: dict[str, float], horizons: Sequence[float], x: Column, t_x: Column, age: Column
) -> Column:
    """Array with the expected purchases up to each horizon; null where the model is singular."""
    fixed = dict(params)
    times = list(horizons)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def compute(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for xs, txs, ages in batches:
            values = purchases_until(fixed, times, xs, txs, ages)
            yield pd.Series([[None if np.isnan(v) else float(v) for v in row] for row in values])

    return compute(x.cast("double"), t_x.cast("double"), age.cast("double"))
