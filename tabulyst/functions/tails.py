"""Tail probabilities of Student's t, F and chi-square.

They are applied to test results, a handful of rows whatever the table's size,
as Arrow-batched column functions so that a test stays one lazy plan.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_EPS = 1e-15
_TINY = 1e-300
_LARGE = 1e5
_TERMS = 20000


def _continued_fraction(first: float, coefficients) -> float:
    """first + a1/(b1 + a2/(b2 + ...)), extended until it no longer moves."""
    value = numerator = first if abs(first) > _TINY else _TINY
    denominator = 0.0
    for a, b in coefficients:
        denominator = b + a * denominator
        denominator = 1.0 / (denominator if abs(denominator) > _TINY else _TINY)
        numerator = b + a / numerator
        numerator = numerator if abs(numerator) > _TINY else _TINY
        change = numerator * denominator
        value *= change
        if abs(change - 1.0) < _EPS:
            break
    return value


def gamma_upper(s: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(s, x)."""
    if x <= 0.0:
        return 1.0
    scale = math.exp(s * math.log(x) - x - math.lgamma(s))
    if x < s + 1.0:
        term = total = 1.0 / s
        for k in range(1, _TERMS):
            term *= x / (s + k)
            total += term
            if term < total * _EPS:
                break
        return 1.0 - scale * total
    steps = ((-k * (k - s), x + 2.0 * k + 1.0 - s) for k in range(1, _TERMS))
    return scale / _continued_fraction(x + 1.0 - s, steps)


def _beta_coefficients(a: float, b: float, x: float):
    for m in range(_TERMS):
        if m:
            yield m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), 1.0
        yield -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)), 1.0


def beta_lower(a: float, b: float, log_x: float, log_rest: float) -> float:
    """Regularised incomplete beta I_x(a, b) from log(x) and log(1 - x)."""
    if a > _LARGE and b < 100.0:
        # many rows: the beta tail turns into a gamma tail, error of order 1/a^2
        return gamma_upper(b, -(a + (b - 1.0) / 2.0) * log_x)
    x, rest = math.exp(log_x), math.exp(log_rest)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * log_x + b * log_rest
    )

    def part(p: float, q: float, z: float) -> float:
        return front / p / _continued_fraction(1.0, _beta_coefficients(p, q, z))

    if x < (a + 1.0) / (a + b + 2.0):
        return part(a, b, x)
    return 1.0 - part(b, a, rest)


def t_two_sided(t: float, df: float) -> float:
    ratio = t * t / df
    if ratio == 0.0:
        return 1.0
    return beta_lower(df / 2.0, 0.5, -math.log1p(ratio), math.log(ratio) - math.log1p(ratio))


def f_upper(f: float, d1: float, d2: float) -> float:
    ratio = d1 * f / d2
    if ratio <= 0.0:
        return 1.0
    return beta_lower(d2 / 2.0, d1 / 2.0, -math.log1p(ratio), math.log(ratio) - math.log1p(ratio))


def chi2_upper(x: float, df: float) -> float:
    return gamma_upper(df / 2.0, x / 2.0)


def _mapped(fn, *series: pd.Series) -> pd.Series:
    def one(*args):
        if any(v is None or math.isnan(v) or math.isinf(v) for v in args):
            # an infinite statistic leaves no tail, a missing one has none
            return 0.0 if args[0] is not None and math.isinf(args[0]) else None
        return fn(*args)

    return pd.Series([one(*row) for row in zip(*series)], dtype="float64")


def t_tail(t: Column, df: Column) -> Column:
    @F.pandas_udf("double")
    def tail(a: pd.Series, b: pd.Series) -> pd.Series:
        return _mapped(t_two_sided, a, b)

    return tail(t, df)


def f_tail(f: Column, d1: Column, d2: Column) -> Column:
    @F.pandas_udf("double")
    def tail(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        return _mapped(f_upper, a, b, c)

    return tail(f, d1, d2)


def chi2_tail(x: Column, df: Column) -> Column:
    @F.pandas_udf("double")
    def tail(a: pd.Series, b: pd.Series) -> pd.Series:
        return _mapped(chi2_upper, a, b)

    return tail(x, df)
