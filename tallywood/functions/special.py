"""Functions of probability theory as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Places that an argument is moved up before Stirling's series.
_SHIFT = 10
# The first coefficients of Stirling's series, of 1/a, 1/a^3, 1/a^5, 1/a^7.
_STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680)


def log_gamma(a: Column) -> Column:
    """Logarithm of the gamma function of a positive number."""
    high = a + _SHIFT
    series = (high - 0.5) * F.log(high) - high + 0.5 * math.log(2 * math.pi)
    for place, coefficient in enumerate(_STIRLING):
        series = series + coefficient / F.pow(high, F.lit(2 * place + 1))
    for i in range(_SHIFT):
        series = series - F.log(a + i)
    return series


def upper_gamma(a: Column, x: Column) -> Column:
    """Regularised upper incomplete gamma function Q(a, x), for a > 0 and x >= 0.

    Below a + 1 one less the power series, beyond it the continued fraction of Q itself,
    so that small tails keep their digits. Both take a number of steps that grows with
    the root of a. Nulls and NaN give null.
    """
    steps = F.sequence(F.lit(1), (F.lit(200) + 12 * F.sqrt(a)).cast("int"))
    scale = F.exp(a * F.log(x) - x - log_gamma(a))
    term = (1 / a).alias("term")
    series = F.aggregate(
        steps,
        F.struct(term, (1 / a).alias("total")),
        lambda s, n: F.struct(
            (s["term"] * x / (a + n)).alias("term"),
            (s["total"] + s["term"] * x / (a + n)).alias("total"),
        ),
        lambda s: s["total"],
    )
    # Convergents upper / lower of 1/(x+1-a- 1(1-a)/(x+3-a- ...)): ``up`` and ``down`` are
    # the ratios of a convergent's upper and lower number to the ones before.
    first = x + 1 - a

    def following(s: Column, n: Column) -> Column:
        part, whole = n * (a - n), first + 2 * n
        up = whole + part / s["up"]
        down = whole + part / s["down"]
        return F.struct(
            up.alias("up"), down.alias("down"), (s["value"] * up / down).alias("value")
        )

    # The upper number's ratio starts unbounded: its part of the first step is nothing.
    start = F.struct(F.lit(1e300).alias("up"), first.alias("down"), (1 / first).alias("value"))
    fraction = F.aggregate(steps, start, following, lambda s: s["value"])
    value = (
        F.when(x == 0, F.lit(1.0))
        .when(x == float("inf"), F.lit(0.0))
        .when(x < a + 1, 1 - scale * series)
        .otherwise(scale * fraction)
    )
    known = (a > 0) & (x >= 0) & ~F.isnan(a) & ~F.isnan(x)
    return F.when(known, F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)))


def chi_square_tail(statistic: Column, dof: Column) -> Column:
    """Chance that a chi-square variable exceeds ``statistic``; 1 without freedom."""
    half = statistic.cast("double") / 2
    return F.when(dof == 0, F.lit(1.0)).otherwise(upper_gamma(dof.cast("double") / 2, half))
