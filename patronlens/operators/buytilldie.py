"""Buy-till-you-die lifetime value: BG/NBD purchases and Gamma-Gamma spend.

Formulas from Fader, Hardie and Lee (2005) and Fader and Hardie (2013). The
likelihood is a Spark aggregation; only parameter vectors and their scores
reach the driver.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime
from itertools import combinations_with_replacement
from math import lgamma, log

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlens.functions.gamma import digamma, ln_gamma, trigamma
from patronlens.functions.hypergeometric import expected_purchases
from patronlens.operators.rfm import latest
from patronlens.schema import CUSTOMER, DATE, REVENUE
from patronlens.session import for_iteration, materialize

logger = logging.getLogger(__name__)

BGNBD = ("r", "alpha", "a", "b")
GAMMA_GAMMA = ("p", "q", "v")
PENALTY = 0.01
#: Logs of parameters are searched between minus and plus this.
LOG_RANGE = 50.0
DAYS_PER_MONTH = 30


def rfm_t_summary(df: DataFrame, observation_end: datetime | None = None) -> DataFrame:
    """Per customer: repeat purchase days, age at the last one, age at the end, mean repeat spend.

    Days are calendar days; lines after the end are dropped; the first day's
    spend is left out of the mean, which is 0 without a repeat.
    """
    day = F.col(DATE).cast("date")
    if observation_end is not None:
        end = F.lit(observation_end).cast("date")
        df = df.filter(day <= end)
    days = df.groupBy(CUSTOMER, day.alias("_day")).agg(F.sum(REVENUE).alias("_spent"))
    customers = (
        days.groupBy(CUSTOMER)
        .agg(
            (F.count(F.lit(1)) - 1).alias("frequency"),
            F.min("_day").alias("_first"),
            F.max("_day").alias("_last"),
            F.sum("_spent").alias("_total"),
            F.min_by("_spent", "_day").alias("_opening"),
        )
    )
    if observation_end is None:
        customers = materialize(customers)
        end = latest(customers)
    return (
        customers.filter(F.col(CUSTOMER).isNotNull() & F.col("_first").isNotNull())
        .select(
            CUSTOMER,
            "frequency",
            F.date_diff("_last", "_first").cast("bigint").alias("recency"),
            F.date_diff(end, F.col("_first")).cast("bigint").alias("T"),
            F.when(
                F.col("frequency") > 0,
                (F.col("_total") - F.col("_opening")).cast("double") / F.col("frequency"),
            )
            .otherwise(0.0)
            .alias("monetary_value"),
        )
    )


def returning_customers(summary: DataFrame) -> DataFrame:
    return summary.filter(F.col("frequency") > 0)


def _candidates(data: DataFrame, rows: Sequence[dict[str, float]]) -> DataFrame:
    """Every row of ``data`` once per parameter vector, for an aggregation that follows at once.

    The vectors are one constant array, so the generated code is the same for
    any values and is compiled once.
    """
    structs = []
    for i, row in enumerate(rows):
        fields = ", ".join(f"'{name}', {float(value)!r}D" for name, value in row.items())
        structs.append(f"named_struct('candidate', {i}, {fields})")
    return data.select("*", F.expr(f"inline(array({', '.join(structs)}))"))


def bgnbd_loglik(summary: DataFrame, vectors: Sequence[dict[str, float]]) -> DataFrame:
    """Log-likelihood of each customer (x, t_x, age) under each parameter vector.

    Terms that do not depend on the customer are worked out once per vector.
    """
    rows = []
    for v in vectors:
        r, alpha, a, b = (float(v[n]) for n in BGNBD)
        constant = r * log(alpha) - lgamma(r) + lgamma(a + b) - lgamma(b)
        rows.append({"r": r, "alpha": alpha, "a": a, "b": b, "ln_a": log(a), "constant": constant})
    terms = _candidates(summary, rows).select(
        "*",
        F.expr("r + x").alias("rx"),
        F.expr("b + x").alias("bx"),
        F.expr("a + b + x").alias("abx"),
    )
    alive_gone = terms.select(
        "*",
        F.expr("-rx * ln(alpha + age)").alias("alive"),
        F.expr("ln_a - ln(b + greatest(x, 1D) - 1D) - rx * ln(alpha + t_x)").alias("gone"),
        (F.col("constant") + ln_gamma("rx") + ln_gamma("bx") - ln_gamma("abx")).alias("shape"),
    )
    mixed = F.expr("greatest(alive, gone) + log1p(exp(least(alive, gone) - greatest(alive, gone)))")
    return alive_gone.select(
        *summary.columns,
        "candidate",
        (F.col("shape") + F.when(F.col("x") > 0, mixed).otherwise(F.col("alive"))).alias("loglik"),
    )


def bgnbd_derivatives(summary: DataFrame, vector: dict[str, float]) -> DataFrame:
    """Log-likelihood of each customer with its gradient (``g_`` columns) and curvature (``h_`` columns).

    The likelihood is a shape times a mixture of being alive and gone. ``w`` is the share of the
    latter; the mixture's curvature is the mean one of its parts plus w (1 - w) times the square of the
    difference of their gradients.
    """
    r, alpha, a, b = (float(vector[n]) for n in BGNBD)
    row = {"r": r, "alpha": alpha, "a": a, "b": b, "ab": a + b, "ln_alpha": log(alpha)}
    terms = _candidates(bgnbd_loglik(summary, [vector]).drop("candidate"), [row]).select(
        "*", F.expr("r + x").alias("rx"), F.expr("b + x").alias("bx"), F.expr("ab + x").alias("abx"), F.expr("alpha + age").alias("end"),
        F.expr("alpha + t_x").alias("last"), F.expr("b + greatest(x, 1D) - 1D").alias("bx1"),
    )
    odds = F.expr("exp(ln(a) - ln(bx1) + rx * (ln(end) - ln(last)))")
    terms = terms.select("*", F.when(F.col("x") > 0, 1.0 - 1.0 / (1.0 + odds)).otherwise(0.0).alias("w"))
    names = ("r", "b", "ab", "rx", "bx", "abx")
    terms = terms.select("*", *[digamma(n).alias(f"d_{n}") for n in names], *[trigamma(n).alias(f"t_{n}") for n in names])
    # Differences of the gradients of the two parts.
    terms = terms.selectExpr(
        "*", "ln(last) - ln(end) AS e_r", "rx * (1D / last - 1D / end) AS e_alpha", "-1D / a AS e_a", "1D / bx1 AS e_b", "w * (1D - w) AS ww"
    )
    return terms.selectExpr(
        "loglik",
        "d_rx - d_r + ln_alpha - (1D - w) * ln(end) - w * ln(last) AS g_r",
        "r / alpha - rx * ((1D - w) / end + w / last) AS g_alpha",
        "d_ab - d_abx + w / a AS g_a",
        "d_ab - d_b + d_bx - d_abx - w / bx1 AS g_b",
        "t_rx - t_r + ww * e_r * e_r AS h_r_r",
        "1D / alpha - (1D - w) / end - w / last + ww * e_r * e_alpha AS h_r_alpha",
        "ww * e_r * e_a AS h_r_a",
        "ww * e_r * e_b AS h_r_b",
        "-r / (alpha * alpha) + rx * ((1D - w) / (end * end) + w / (last * last)) + ww * e_alpha * e_alpha AS h_alpha_alpha",
        "ww * e_alpha * e_a AS h_alpha_a",
        "ww * e_alpha * e_b AS h_alpha_b",
        "t_ab - t_abx - w / (a * a) + ww * e_a * e_a AS h_a_a",
        "t_ab - t_abx + ww * e_a * e_b AS h_a_b",
        "t_ab - t_b + t_bx - t_abx + w / (bx1 * bx1) + ww * e_b * e_b AS h_b_b",
    )


def gamma_gamma_loglik(returning: DataFrame, vectors: Sequence[dict[str, float]]) -> DataFrame:
    """Log-likelihood of each returning customer (x, m > 0) under each parameter vector."""
    rows = []
    for vector in vectors:
        p, q, v = (float(vector[n]) for n in GAMMA_GAMMA)
        rows.append({"p": p, "q": q, "v": v, "constant": q * log(v) - lgamma(q)})
    terms = _candidates(returning, rows).select("*", F.expr("p * x").alias("px"), F.expr("p * x + q").alias("pxq"))
    spend = F.expr("constant + (px - 1D) * ln(m) + px * ln(x) - pxq * ln(v + x * m)")
    return terms.select(
        *returning.columns, "candidate", (ln_gamma("pxq") - ln_gamma("px") + spend).alias("loglik")
    )


def gamma_gamma_derivatives(returning: DataFrame, vector: dict[str, float]) -> DataFrame:
    """Log-likelihood of each returning customer with its gradient (``g_``) and curvature (``h_``)."""
    row = {name: float(vector[name]) for name in GAMMA_GAMMA}
    terms = _candidates(gamma_gamma_loglik(returning, [vector]).drop("candidate"), [row]).select(
        "*", F.expr("p * x").alias("px"), F.expr("p * x + q").alias("pxq"), F.expr("v + x * m").alias("spent")
    )
    names = ("q", "px", "pxq")
    terms = terms.select("*", *[digamma(n).alias(f"d_{n}") for n in names], *[trigamma(n).alias(f"t_{n}") for n in names])
    return terms.selectExpr(
        "loglik",
        "x * (d_pxq - d_px + ln(m) + ln(x) - ln(spent)) AS g_p",
        "d_pxq - d_q + ln(v) - ln(spent) AS g_q",
        "q / v - pxq / spent AS g_v",
        "x * x * (t_pxq - t_px) AS h_p_p",
        "x * t_pxq AS h_p_q",
        "-x / spent AS h_p_v",
        "t_pxq - t_q AS h_q_q",
        "1D / v - 1D / spent AS h_q_v",
        "-q / (v * v) + pxq / (spent * spent) AS h_v_v",
    )


def bgnbd_input(summary: DataFrame, scale: float = 1.0) -> DataFrame:
    """The columns the purchase likelihood reads, times multiplied by ``scale``."""
    return summary.select(
        F.col("frequency").cast("double").alias("x"),
        (F.col("recency") * F.lit(scale)).alias("t_x"),
        (F.col("T") * F.lit(scale)).alias("age"),
    )


def gamma_gamma_input(summary: DataFrame) -> DataFrame:
    """The columns the spend likelihood reads, for returning customers with positive spend."""
    return (
        returning_customers(summary)
        .filter(F.col("monetary_value") > 0)
        .select(F.col("frequency").cast("double").alias("x"), F.col("monetary_value").alias("m"))
    )


@dataclass
class Fit:
    """Fitted parameters with the mean log-likelihood and the gradient of the objective at them."""

    params: dict[str, float]
    mean_log_likelihood: float
    rows: int
    gradient: list[float]
    iterations: int
    converged: bool = True

    @property
    def log_likelihood(self) -> float:
        return self.mean_log_likelihood * self.rows


#: Halvings of a step before a search gives up.
HALVINGS = 30


def _newton(objective: Callable[[np.ndarray], tuple[float, np.ndarray, np.ndarray]], start: np.ndarray, max_iter: int, tolerance: float):
    """Damped Newton steps on an objective that gives its value, gradient and curvature at a point in one pass.

    The curvature's eigenvalues are made positive, so every step leads downhill. A full step that
    is taken has already paid for the next round; others are halved.
    """
    theta = start.astype(float)
    here, gradient, hessian = objective(theta)
    iterations = 0
    while iterations < max_iter and np.max(np.abs(gradient)) >= tolerance:
        iterations += 1
        eigenvalues, basis = np.linalg.eigh(hessian)
        step = -basis @ ((basis.T @ gradient) / np.maximum(np.abs(eigenvalues), 1e-12))
        step *= min(1.0, 2.0 / max(np.max(np.abs(step)), 1e-300))
        for _ in range(HALVINGS):
            tried = np.clip(theta + step, -LOG_RANGE, LOG_RANGE)
            value, slope, bend = objective(tried)
            if np.isfinite(value) and np.isfinite(slope).all() and np.isfinite(bend).all():
                # Close to the end, values differ by less than their rounding; there the gradient decides.
                level = abs(value - here) <= 1e-12 * max(1.0, abs(here))
                if value < here or (level and np.max(np.abs(slope)) < np.max(np.abs(gradient))):
                    break
            step = step / 2
        else:
            break
        theta, here, gradient, hessian = tried, value, slope, bend
    return theta, here, gradient, iterations


def _fit(
    data: DataFrame,
    names: Sequence[str],
    derivatives: Callable[[DataFrame, dict[str, float]], DataFrame],
    penalty: float,
    penalize_logs: bool,
    max_iter: int,
    tolerance: float,
) -> Fit:
    kept = for_iteration(data)
    rows = kept.count()
    if rows == 0:
        raise ValueError("no customers to fit")

    def means(vector: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Mean log-likelihood, gradient and curvature: one aggregation to one row."""
        each = derivatives(kept, dict(zip(names, map(float, vector), strict=True)))
        row = each.agg(*[F.avg(c).alias(c) for c in each.columns]).first()
        gradient = np.array([row[f"g_{n}"] for n in names], dtype=float)
        hessian = np.empty((len(names), len(names)))
        for (i, one), (j, two) in combinations_with_replacement(enumerate(names), 2):
            hessian[i, j] = hessian[j, i] = row[f"h_{one}_{two}"]
        return float(row["loglik"]), gradient, hessian

    def objective(logs: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        natural = np.exp(logs)
        mean, gradient, hessian = means(natural)
        # By the logs of the parameters, with the penalty.
        slope = -gradient * natural
        bend = -hessian * np.outer(natural, natural) + np.diag(slope)
        if penalize_logs:
            weight, tilt, curve = logs**2, 2 * logs, np.full(len(logs), 2.0)
        else:
            weight, tilt, curve = natural**2, 2 * natural**2, 4 * natural**2
        return -mean + penalty * weight.sum(), slope + penalty * tilt, bend + penalty * np.diag(curve)

    theta, least, gradient, iterations = _newton(objective, np.zeros(len(names)), max_iter, tolerance)
    natural = np.exp(theta)
    weight = theta if penalize_logs else natural
    mean = penalty * float(np.sum(weight**2)) - least
    kept.unpersist()
    params = dict(zip(names, map(float, natural), strict=True))
    # A search that ran out of rounds or of shorter steps, or reached the range of the logs, has not arrived.
    converged = bool(np.max(np.abs(gradient)) < tolerance and np.max(np.abs(theta)) < LOG_RANGE)
    if not converged:
        logger.warning("fit of %s did not converge: gradient %s", ", ".join(names), gradient)
    return Fit(params, mean, rows, [float(g) for g in gradient], iterations, converged)


def fit_bgnbd(
    summary: DataFrame,
    penalty: float = PENALTY,
    penalize_logs: bool = False,
    max_iter: int = 60,
    tolerance: float = 1e-8,
) -> Fit:
    """Penalised maximum likelihood of the purchase model.

    Minimises the negative mean log-likelihood plus ``penalty`` times the sum
    of squared parameters (of their logs with ``penalize_logs``). Times are
    divided by the largest age for the fit, so the penalty on alpha does not
    depend on the unit of time; alpha is returned in the caller's unit and the
    likelihood in the scaled one.
    """
    longest = float(summary.agg(F.max("T").alias("t")).first()["t"] or 0)
    scale = 1.0 / longest if longest > 0 else 1.0
    fit = _fit(
        bgnbd_input(summary, scale), BGNBD, bgnbd_derivatives, penalty, penalize_logs, max_iter, tolerance
    )
    fit.params["alpha"] /= scale
    return fit


def fit_gamma_gamma(
    summary: DataFrame,
    penalty: float = PENALTY,
    penalize_logs: bool = False,
    max_iter: int = 60,
    tolerance: float = 1e-8,
) -> Fit:
    """Penalised maximum likelihood of the spend model, on returning customers with positive spend."""
    return _fit(
        gamma_gamma_input(summary),
        GAMMA_GAMMA,
        gamma_gamma_derivatives,
        penalty,
        penalize_logs,
        max_iter,
        tolerance,
    )


def expected_avg_profit(x: Column, spend: Column, params: dict[str, float]) -> Column:
    """Expected spend per purchase given the past mean.

    Null where the model has no mean, that is for p * x + q <= 1: with q <= 1 these
    are the customers without a repeat purchase.
    """
    p, q, v = (params[n] for n in GAMMA_GAMMA)
    below = F.lit(p) * x + F.lit(q - 1.0)
    return F.when(below > 0, F.lit(p) * (F.lit(v) + x * spend) / F.when(below > 0, below))


def with_expected_purchases(summary: DataFrame, bgnbd: dict[str, float], days: int = 365) -> DataFrame:
    purchases = expected_purchases(bgnbd, [days], F.col("frequency"), F.col("recency"), F.col("T"))
    return summary.withColumn("predicted_purchases_12m", purchases[0])


def with_lifetime_value(
    summary: DataFrame,
    bgnbd: dict[str, float],
    gamma_gamma: dict[str, float],
    months: int = 12,
    discount: float = 0.01,
    days: int = 365,
) -> DataFrame:
    """Add expected purchases, expected spend and discounted value of ``months`` 30-day months.

    One Arrow round trip gives the expected purchases at all horizons.
    """
    horizons = [DAYS_PER_MONTH * i for i in range(1, months + 1)] + [days]
    known = summary.withColumn(
        "_until", expected_purchases(bgnbd, horizons, F.col("frequency"), F.col("recency"), F.col("T"))
    ).withColumn(
        "expected_avg_profit", expected_avg_profit(F.col("frequency"), F.col("monetary_value"), gamma_gamma)
    )
    until = F.col("_until")
    value = F.lit(0.0)
    for i in range(months):
        before = until[i - 1] if i else F.lit(0.0)
        value = value + (until[i] - before) * (1.0 / (1.0 + discount) ** (i + 1))
    return known.select(
        *summary.columns,
        until[months].alias("predicted_purchases_12m"),
        "expected_avg_profit",
        (value * F.col("expected_avg_profit")).alias("LTV_12m"),
    )


def lifetime_value(df: DataFrame, observation_end: datetime | None = None) -> tuple[DataFrame, Fit, Fit]:
    """Summarise, fit both models and score every customer; ``converged`` tells whether both fits arrived."""
    summary = materialize(rfm_t_summary(df, observation_end))
    purchases = fit_bgnbd(summary)
    spend = fit_gamma_gamma(summary)
    scored = with_lifetime_value(summary, purchases.params, spend.params)
    return scored.withColumn("converged", F.lit(purchases.converged and spend.converged)), purchases, spend
