"""Log-gamma and its first two derivatives in generated code."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Divisors of the Stirling series of ln(gamma) and the shift that makes it accurate.
SHIFT = 8
STIRLING_DIVISORS = (12, -360, 1260, -1680)
# Bernoulli numbers B2 to B12 as fractions, of which the series of the derivatives are made.
BERNOULLI = ((1, 6), (-1, 30), (1, 42), (-1, 30), (5, 66), (-691, 2730))


def ln_gamma(name: str) -> Column:
    """ln(gamma) of a positive double column (absolute error below 1e-11).

    The argument is raised by eight, where the series is accurate, and the
    product of the eight factors is taken off again. Takes a column name: the
    argument occurs many times, and a name keeps it from being computed anew.
    """
    product = " * ".join(f"({name} + {i}D)" for i in range(SHIFT))
    y = f"({name} + {SHIFT}D)"
    series = f"1D / {STIRLING_DIVISORS[-1]}D"
    for divisor in reversed(STIRLING_DIVISORS[:-1]):
        series = f"({series}) / ({y} * {y}) + 1D / {divisor}D"
    half_log = 0.5 * math.log(2 * math.pi)
    return F.expr(f"({y} - 0.5D) * ln({y}) - {y} + {half_log!r}D + ({series}) / {y} - ln({product})")


def _series(y: str, terms: list[tuple[float, float]]) -> str:
    """Sum of terms over rising even powers of ``y``, by Horner's rule."""
    text = "0D"
    for above, below in reversed(terms):
        text = f"(({text}) / ({y} * {y}) + {above}D / {below}D)"
    return text


def digamma(name: str) -> Column:
    """Derivative of ln(gamma) of a positive double column (absolute error below 1e-11)."""
    y = f"({name} + {SHIFT}D)"
    below = " + ".join(f"1D / ({name} + {i}D)" for i in range(SHIFT))
    series = _series(y, [(a, b * 2 * n) for n, (a, b) in enumerate(BERNOULLI, 1)])
    return F.expr(f"ln({y}) - 0.5D / {y} - {series} / ({y} * {y}) - ({below})")


def trigamma(name: str) -> Column:
    """Second derivative of ln(gamma) of a positive double column (absolute error below 1e-11)."""
    y = f"({name} + {SHIFT}D)"
    below = " + ".join(f"1D / (({name} + {i}D) * ({name} + {i}D))" for i in range(SHIFT))
    return F.expr(f"1D / {y} + 0.5D / ({y} * {y}) + {_series(y, list(BERNOULLI))} / ({y} * {y} * {y}) + ({below})")
