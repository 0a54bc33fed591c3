"""Tail probabilities of test statistics, as column expressions.

Both are the regularised upper incomplete gamma function Q(a, x). Below ``a + 1`` it is one minus
a power series, above a continued fraction. The number of terms follows from ``a`` alone
(``_terms``): the terms fall at least as fast as exp(-n^2 / 2a), so those left out are below
1e-16 of the sum. What remains is rounding: the relative error of a result stays below 1e-9 for up to
a million degrees of freedom, except that a series' result near 0 has an absolute one of 1e-14.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the coefficients 1/12, -1/360, ... of Stirling's series for ln gamma
STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188, -691 / 360360)
_SHIFT = 10  # the series is taken at a + 10, where its first term left out is below 1e-15


def log_gamma(a: Column) -> Column:
    """ln gamma(a) for a > 0."""
    z = a + F.lit(float(_SHIFT))
    tail = sum((F.lit(c) / F.pow(z, F.lit(2.0 * i + 1)) for i, c in enumerate(STIRLING)), F.lit(0.0))
    shifted = (z - 0.5) * F.log(z) - z + F.lit(0.5 * math.log(2 * math.pi)) + tail
    steps = sum((F.log(a + F.lit(float(i))) for i in range(1, _SHIFT)), F.log(a))
    return shifted - steps


def _terms(a: Column) -> Column:
    return F.sequence(F.lit(1), (F.lit(100) + F.ceil(F.sqrt(a) * 10)).cast("int"))


def _lower_series(a: Column, x: Column) -> Column:
    """The sum of x^n / (a (a + 1) ... (a + n))."""
    first = F.lit(1.0) / a
    start = F.struct(first.alias("term"), first.alias("total"))

    def step(s: Column, n: Column) -> Column:
        term = s["term"] * x / (a + n)
        return F.struct(term.alias("term"), (s["total"] + term).alias("total"))

    return F.aggregate(_terms(a), start, step, lambda s: s["total"])


def _upper_fraction(a: Column, x: Column) -> Column:
    """The continued fraction 1 / (x + 1 - a - 1 (1 - a) / (x + 3 - a - ...)), by ratios of its convergents."""
    b = x + 1 - a
    start = F.struct(F.lit(1e300).alias("c"), (F.lit(1.0) / b).alias("d"), (F.lit(1.0) / b).alias("h"))

    def step(s: Column, n: Column) -> Column:
        up, down = n * (a - n), b + n * 2
        d = F.lit(1.0) / (up * s["d"] + down)
        c = down + up / s["c"]
        return F.struct(c.alias("c"), d.alias("d"), (s["h"] * c * d).alias("h"))

    return F.aggregate(_terms(a), start, step, lambda s: s["h"])


def upper_gamma(a: Column, x: Column) -> Column:
    """Q(a, x): 1 for x <= 0, null if either is null or not a number, or a is not above 0."""
    edge = a + 1
    # each branch gets an x of its own side, wherever the planner evaluates it
    low, high = F.greatest(F.least(x, edge), F.lit(1e-300)), F.greatest(x, edge)
    front = lambda y: F.exp(a * F.log(y) - y - log_gamma(a))
    below = F.greatest(F.lit(1.0) - front(low) * _lower_series(a, low), F.lit(0.0))
    far = F.when(high == float("inf"), F.lit(0.0)).otherwise(front(high) * _upper_fraction(a, high))
    known = a.isNotNull() & x.isNotNull() & ~F.isnan(a) & ~F.isnan(x) & (a > 0)
    return F.when(known, F.when(x <= 0, F.lit(1.0)).when(x < edge, below).otherwise(far))


def chi2_p(x: Column | str, df: Column | str) -> Column:
    """P(X >= x) for a chi-square variable; null without degrees of freedom."""
    x, df = (F.col(c) if isinstance(c, str) else c for c in (x, df))
    return upper_gamma(df.cast("double") / 2, x.cast("double") / 2)


def normal_p(z: Column | str) -> Column:
    """The two-sided tail of a standard normal variable: erfc(|z| / sqrt 2) = Q(1/2, z^2 / 2)."""
    z = (F.col(z) if isinstance(z, str) else z).cast("double")
    return upper_gamma(F.lit(0.5), z * z / 2)
