"""Tail probabilities, as Columns for use in plans and as floats for the few numbers of a fitted model."""

from __future__ import annotations

import math
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Abramowitz & Stegun 26.2.17, upper tail of the standard normal, |error| < 7.5e-8.
TAIL_P = 0.2316419
TAIL_B = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)


def normal_tail(z: Column) -> Column:
    """P(Z >= z) for a standard normal."""
    t = 1.0 / (1.0 + TAIL_P * F.abs(z))
    poly = F.lit(0.0)
    for b in reversed(TAIL_B):
        poly = (poly + F.lit(b)) * t
    upper = poly * F.exp(-0.5 * z * z) / math.sqrt(2.0 * math.pi)
    return F.when(z >= 0, upper).otherwise(1.0 - upper)


def chi2_tail(statistic: Column, dof: Column) -> Column:
    """P(X >= statistic) for chi-square by the Wilson-Hilferty cube root."""
    safe = F.greatest(dof, F.lit(1.0))
    spread = F.lit(2.0) / (9.0 * safe)
    z = (F.pow(statistic / safe, F.lit(1.0 / 3.0)) - (1.0 - spread)) / F.sqrt(spread)
    return F.when(dof > 0, normal_tail(z)).otherwise(F.lit(1.0))


def normal_tail_value(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2.0))


def chi2_tail_value(statistic: float, dof: float) -> float:
    """P(X >= statistic) for chi-square by the Wilson-Hilferty cube root."""
    if dof <= 0 or statistic <= 0:
        return 1.0
    spread = 2.0 / (9.0 * dof)
    return normal_tail_value(((statistic / dof) ** (1.0 / 3.0) - (1.0 - spread)) / math.sqrt(spread))


def weighted_chi2_tail_value(statistic: float, traces: tuple[float, float, float]) -> float:
    """P(sum of weight * chi-square_1 >= statistic), from the sums of the weights, their squares and cubes.

    Three cumulants are matched by a shifted chi-square (the Hall-Buckley-Eagleson approximation).
    """
    c1, c2, c3 = traces
    if not (c1 > 0 and c2 > 0 and c3 > 0):
        return 1.0
    dof = c2 ** 3 / c3 ** 2
    return chi2_tail_value((statistic - c1) / math.sqrt(2.0 * c2) * math.sqrt(2.0 * dof) + dof, dof)


def kolmogorov_tail_value(distance: float, n: float, m: float) -> float:
    """P(D >= distance) for the largest distance between two empirical distributions of one law."""
    if distance <= 0:
        return 1.0
    size = math.sqrt(n * m / (n + m))
    x = (size + 0.12 + 0.11 / size) * distance
    return min(1.0, max(0.0, 2.0 * sum((-1) ** (k - 1) * math.exp(-2.0 * (k * x) ** 2) for k in range(1, 101))))


def f_tail_value(statistic: float, d1: float, d2: float) -> float:
    """P(F >= statistic) by Paulson's cube root."""
    if statistic <= 0:
        return 1.0
    if math.isinf(statistic):
        return 0.0
    a, b, root = 2.0 / (9.0 * d1), 2.0 / (9.0 * d2), statistic ** (1.0 / 3.0)
    return normal_tail_value(((1.0 - b) * root - (1.0 - a)) / math.sqrt(b * root * root + a))


def normal_quantile_value(p: float) -> float:
    """Inverse of the normal distribution function by bisection."""
    lo, hi = -40.0, 40.0
    for _ in range(200):
        mid = 0.5 * (lo + hi)
        lo, hi = (mid, hi) if 1.0 - normal_tail_value(mid) < p else (lo, mid)
    return 0.5 * (lo + hi)


@lru_cache
def normal_edges(bins: int) -> list[float]:
    """Inner edges that cut a standard normal into ``bins`` equally likely parts."""
    return [round(normal_quantile_value(i / bins), 12) for i in range(1, bins)]


def normal_bin(column: str, mean: float, sd: float, bins: int = 16) -> Column:
    """Bin 0..bins-1 of a column among the equally likely parts of a normal with the given moments.

    The edges need two moments and no sort, so binning is one map over the data whatever its size. The
    nested comparisons are written as one SQL expression: four tests per value, one call to build.
    """
    if not sd > 0:
        return F.lit(0)
    edges = [float(mean + sd * e) for e in normal_edges(bins)]

    def split(low: int, high: int) -> str:
        if low == high:
            return str(low)
        mid = (low + high) // 2
        return f"CASE WHEN `{column}` < {edges[mid]!r}D THEN {split(low, mid)} ELSE {split(mid + 1, high)} END"

    return F.expr(split(0, bins - 1))


def significant(x: Column, digits: int = 9) -> Column:
    """Round to significant digits, to compare sums whose order of addition differs."""
    return F.format_string(f"%.{digits - 1}e", x.cast("double")).cast("double")
