"""Tail probabilities as Column expressions: no Python in the plan, steps in proportion to the root of the degrees of freedom."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_SHIFT = 10
_TINY = 1e-300


def _number(x: Column | str | float) -> Column:
    """A column, a column's name or a number."""
    if isinstance(x, str):
        x = F.col(x)
    return (x if isinstance(x, Column) else F.lit(x)).cast("double")


def log_gamma(x: Column | float) -> Column:
    """ln of the gamma function for x > 0: Stirling's series, ten places further up."""
    x = _number(x)
    z = x + _SHIFT
    z2 = z * z
    series = (1 / 12 - (1 / 360 - (1 / 1260 - (1 / 1680 - 1 / 1188 / z2) / z2) / z2) / z2) / z
    steps = F.lit(0.0)
    for k in range(_SHIFT):
        steps = steps + F.log(x + k)
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series - steps


def _steps(a: Column) -> Column:
    return F.sequence(F.lit(1), F.least(F.ceil(60 + 8 * F.sqrt(a)), F.lit(100_000)).cast("int"))


def gamma_tail(a: Column | float, x: Column | float) -> Column:
    """Regularised upper incomplete gamma function Q(a, x); 1 where x <= 0, null where either is null.

    Below a + 1 the power series, above it the continued fraction; both settle within about the root of ``a`` steps.
    """
    a, x = _number(a), _number(x)
    front = F.exp(a * F.log(x) - x - log_gamma(a))

    def term(state: Column, n: Column) -> Column:
        next_term = state["term"] * x / (a + n)
        return F.struct(next_term.alias("term"), (state["total"] + next_term).alias("total"))

    one = F.struct((1 / a).alias("term"), (1 / a).alias("total"))
    below = 1 - front * F.aggregate(_steps(a), one, term, lambda s: s["total"])

    def fraction(state: Column, n: Column) -> Column:
        up = -n * (n - a)
        b = x + 1 - a + 2 * n
        d = 1 / _away(up * state["d"] + b)
        c = _away(b + up / state["c"])
        return F.struct(c.alias("c"), d.alias("d"), (state["h"] * c * d).alias("h"))

    first = 1 / _away(x + 1 - a)
    start = F.struct(F.lit(1 / _TINY).alias("c"), first.alias("d"), first.alias("h"))
    above = front * F.aggregate(_steps(a), start, fraction, lambda s: s["h"])
    tail = F.when(x < a + 1, below).otherwise(above)
    return F.when(x.isNull() | a.isNull(), None).when((x <= 0) | (a <= 0), 1.0).otherwise(F.least(F.greatest(tail, F.lit(0.0)), F.lit(1.0)))


def _away(x: Column) -> Column:
    """Never quite zero."""
    return F.when(F.abs(x) < _TINY, F.lit(_TINY)).otherwise(x)


def chi2_tail(value: Column | str | float, dof: Column | str | float) -> Column:
    """P(X >= value) for a chi-square variable."""
    return gamma_tail(_number(dof) / 2, _number(value) / 2)


def normal_two_sided(z: Column | str | float) -> Column:
    """P(|Z| >= |z|) for a standard normal variable."""
    z = _number(z)
    return gamma_tail(F.when(z.isNotNull(), F.lit(0.5)), z * z / 2)
