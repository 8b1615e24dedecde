"""Tail probabilities of test statistics, for the few rows of a test report.

Spark has no Student-t distribution; these are Arrow functions over result
rows, never over data rows.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F, types as T

# workers get these helpers with the task, so they need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (Lentz's method)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    total = d
    for m in range(1, 10_000):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        step = 1.0
        for term in (even, odd):
            d = 1.0 + term * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + term / c
            c = c if abs(c) > tiny else tiny
            step = c * d
            total *= step
        if abs(step - 1.0) < 1e-15:
            break
    return total


def beta_tail(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
        + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def t_two_sided(t: float, df: float) -> float:
    if math.isinf(t):
        return 0.0
    return beta_tail(df / 2.0, 0.5, df / (df + t * t))


def _numerator(small: int) -> tuple[int, list[int]]:
    """Step M and polynomial P with P / (1 - q^M)^(small + 1) = 1 / ((1 - q) * prod(1 - q^i)).

    The right side counts partitions of at most k into parts of 1 to ``small``.
    """
    step = math.lcm(*range(1, small + 1))
    poly = np.array([1], dtype=object)
    for part in (1, *range(1, small + 1)):
        # times (1 - q^M) / (1 - q^part)
        longer = np.concatenate([poly, np.zeros(step, dtype=object)])
        longer[step:] = longer[step:] - poly
        for r in range(part):
            longer[r::part] = np.cumsum(longer[r::part])
        poly = np.trim_zeros(longer, "b")
    return step, poly.tolist()


def _partitions_upto(k: int, small: int, step: int, poly: list[int]) -> int:
    """Partitions of the numbers up to k into parts of 1 to ``small``."""
    if k < 0:
        return 0
    return sum(
        poly[j] * math.comb((k - j) // step + small, small)
        for j in range(k % step, min(k + 1, len(poly)), step)
    )


def u_two_sided(u: float, n1: int, n2: int) -> float:
    """Exact two-sided p of the rank-sum statistic when there are no ties.

    The subsets of ranks with a U of at most k are the partitions of the numbers
    up to k into at most ``small`` parts of at most ``large``; the bound on the
    parts is taken out by inclusion and exclusion.  The work depends on the
    smaller sample alone.
    """
    small, large = min(n1, n2), max(n1, n2)
    k = int(min(u, small * large - u))
    shifts = {0: 1}
    for i in range(1, small + 1):
        for at, sign in list(shifts.items()):
            shifts[at + large + i] = shifts.get(at + large + i, 0) - sign
    terms = _numerator(small)
    ways = sum(sign * _partitions_upto(k - at, small, *terms) for at, sign in shifts.items())
    return min(1.0, 2.0 * (ways / math.comb(small + large, small)))


def three_digits(p: float) -> float:
    return float(f"{p:.2e}")


@F.pandas_udf(T.DoubleType())
def t_p_value(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(
        [
            None if pd.isna(a) or pd.isna(b) else three_digits(t_two_sided(float(a), float(b)))
            for a, b in zip(t, df)
        ],
        dtype="float64",
    )


@F.pandas_udf(T.DoubleType())
def u_p_value(
    u: pd.Series, n1: pd.Series, n2: pd.Series, z: pd.Series, tie_term: pd.Series
) -> pd.Series:
    """Exact law for a small sample without ties, else the normal approximation."""

    def one(u_, a, b, z_, ties):
        if pd.isna(u_) or pd.isna(a) or pd.isna(b) or a == 0 or b == 0:
            return None
        if min(a, b) <= 8 and ties == 0:
            return three_digits(u_two_sided(float(u_), int(a), int(b)))
        if pd.isna(z_):
            return None
        # z is that of the larger of the two U values, less the continuity step
        return three_digits(min(1.0, math.erfc(float(z_) / math.sqrt(2.0))))

    return pd.Series([one(*row) for row in zip(u, n1, n2, z, tie_term)], dtype="float64")
