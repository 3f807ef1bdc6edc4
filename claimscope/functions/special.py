"""Tail probabilities for the few summary rows that need them: as column expressions, and exact ones of small samples."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def kolmogorov_pvalue(d: Column, n1: Column, n2: Column, terms: int = 100) -> Column:
    """Asymptotic two-sided p-value of the two-sample statistic ``d``."""
    z = d * F.sqrt(F.try_divide(n1.cast("double") * n2.cast("double"), n1.cast("double") + n2.cast("double")))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * z * z),
    )
    # Below z = 0.2 the probability is 1 to twelve digits and the series converges too slowly.
    return F.when(z < 0.2, F.lit(1.0)).otherwise(F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0)))


def exact_ks_pvalue(d: float, m: int, n: int) -> float:
    """Chance that two samples of one continuous distribution, of sizes ``m`` and ``n``, differ by ``d`` or more.

    All orders of the pooled sample are equally likely: they are the lattice paths from (0, 0) to (m, n), and the statistic is the
    farthest a path gets from the diagonal. Chances are carried from one antidiagonal to the next, inside the band around the
    diagonal that the bound leaves; what steps out of it is added up, so a small result keeps its digits. Time grows with
    (m + n) times the width of the band, d m n / (m + n), memory with that width.
    """
    bound = round(d * m * n)  # the statistic is a whole number of 1 / (m n)
    if bound <= 0:
        return 1.0
    low, inside, gone = 0, np.ones(1), 0.0  # chances of the points (low, s - low), (low + 1, s - low - 1), ...
    for s in range(1, m + n + 1):
        i = np.arange(low, low + len(inside))
        left = m + n - s + 1
        now = np.zeros(len(inside) + 1)
        now[:-1] = inside * ((n - s + 1 + i) / left)  # on to (i, j + 1)
        now[1:] += inside * ((m - i) / left)  # on to (i + 1, j)
        first = (s * m - bound) // (m + n) + 1  # the band: |i n - j m| < bound
        last = -((-s * m - bound) // (m + n)) - 1
        a, b = max(first - low, 0), min(last - low + 1, len(now))
        if a >= b:
            return min(gone + float(now.sum()), 1.0)
        gone += float(now[:a].sum() + now[b:].sum())
        inside, low = now[a:b], low + a
    return min(gone, 1.0)


# Coefficients of the asymptotic series of ln gamma(a + 1) - (a + 1/2) ln a + a - ln(2 pi) / 2 in 1 / a.
_STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680)


def _log_front(a: Column, x: Column, odd: Column) -> Column:
    """ln of x^a e^-x / gamma(a + 1), for whole and half-whole ``a``, without losing digits where a and x are large and close."""
    small = F.when(odd, F.lit(0.5 * math.log(math.pi))).otherwise(F.lit(0.0)) + F.aggregate(
        F.sequence(F.lit(0), F.least(a, F.lit(30.0)).cast("int")), F.lit(0.0),
        lambda acc, j: acc + F.when(odd, F.ln(j + F.lit(0.5))).when(j > 0, F.ln(j.cast("double"))).otherwise(F.lit(0.0)))
    t = (x - a) / a
    series = sum((F.lit(c) / F.pow(a, F.lit(2.0 * k + 1)) for k, c in enumerate(_STIRLING)), F.lit(0.0))
    large = a * (F.log1p(t) - t) - F.lit(0.5) * F.ln(F.lit(2 * math.pi) * a) - series
    return F.when(a < 30, a * F.ln(x) - x - small).otherwise(large)


def chi_square_pvalue(statistic: Column, df: Column) -> Column:
    """Upper tail of the chi-square distribution with a whole number of degrees of freedom.

    Below the middle it is one less the power series of the lower tail, above it the continued fraction of the upper
    tail, which keeps its digits however small it is. Both run for as many terms as the degrees of freedom need.
    """
    a, x = df / F.lit(2.0), statistic / F.lit(2.0)
    front = F.exp(_log_front(a, x, df.cast("int") % 2 == 1))
    terms = F.sequence(F.lit(1), (F.lit(20.0) * F.sqrt(a) + 100).cast("int"))
    lower = F.aggregate(
        terms, F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total")),
        lambda acc, n: F.struct((acc["term"] * x / (a + n)).alias("term"), (acc["total"] + acc["term"] * x / (a + n)).alias("total")),
        lambda acc: acc["total"])
    b = x + 1 - a

    def step(acc: Column, i: Column) -> Column:
        part = -i * (i - a)
        bottom = b + 2 * i
        d = F.lit(1.0) / (part * acc["d"] + bottom)
        c = bottom + part / acc["c"]
        return F.struct(c.alias("c"), d.alias("d"), (acc["h"] * c * d).alias("h"))

    upper = F.aggregate(terms, F.struct(F.lit(1e300).alias("c"), (F.lit(1.0) / b).alias("d"), (F.lit(1.0) / b).alias("h")), step, lambda acc: acc["h"])
    return (
        F.when(df < 1, F.lit(None).cast("double"))
        .when(statistic <= 0, F.lit(1.0))
        .when(x > a + 1, F.least(front * a * upper, F.lit(1.0)))
        .otherwise(F.greatest(F.lit(1.0) - front * lower, F.lit(0.0)))
    )
