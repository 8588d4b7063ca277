"""Tail probabilities of chi-square, t and F, as vectorised UDFs for the few rows of a result table."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TINY = 1e-300
_EPS = 1e-15
_STEPS = 1_000_000
# From here on differences of lgamma lose digits; limits in many degrees of freedom are nearer.
_MANY, _FEW = 1e7, 2e4


def _gamma_upper(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function."""
    if x <= 0 or x == math.inf:
        return float(x <= 0)
    scale = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * _EPS:
            n += 1
            term *= x / n
            total += term
        return 1.0 - total * scale
    b, c, d = x + 1 - a, 1 / _TINY, 1 / (x + 1 - a)
    h = d
    for i in range(1, _STEPS):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b or _TINY)
        c = b + an / c or _TINY
        h *= d * c
        if abs(d * c - 1) < _EPS:
            return h * scale
    raise ArithmeticError(f"gamma tail of {a}, {x} did not converge")


def _beta_fraction(x: float, a: float, b: float) -> float:
    c, d = 1.0, 1 / (1 - (a + b) * x / (a + 1) or _TINY)
    h = d
    for m in range(1, _STEPS):
        up = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        d = 1 / (1 + up * d or _TINY)
        c = 1 + up / c or _TINY
        h *= d * c
        down = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1 / (1 + down * d or _TINY)
        c = 1 + down / c or _TINY
        h *= d * c
        if abs(d * c - 1) < _EPS:
            return h
    raise ArithmeticError(f"beta tail of {x}, {a}, {b} did not converge")


def _beta_lower(x: float, a: float, b: float) -> float:
    """Regularised lower incomplete beta function."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(x, a, b) / a
    return 1.0 - front * _beta_fraction(1 - x, b, a) / b


def _normal_tail(z: float) -> float:
    return math.erfc(z / math.sqrt(2)) / 2


def chi2_tail(stat: float, dof: float) -> float:
    if dof <= _MANY:
        return _gamma_upper(dof / 2, stat / 2)
    v = 2 / (9 * dof)
    return _normal_tail((math.cbrt(max(stat, 0.0) / dof) - (1 - v)) / math.sqrt(v))  # cube root is near normal


def t_two_sided(stat: float, dof: float) -> float:
    if dof <= _MANY:
        return _beta_lower(dof / (dof + stat * stat), dof / 2, 0.5)
    return f_tail(stat * stat, 1, dof)


def f_tail(stat: float, dof1: float, dof2: float) -> float:
    if max(dof1, dof2) <= _MANY:
        return _beta_lower(dof2 / (dof2 + dof1 * stat), dof2 / 2, dof1 / 2)
    if stat <= 0 or stat == math.inf:
        return float(stat <= 0)
    if dof1 > dof2:
        return 1.0 - f_tail(1 / stat, dof2, dof1)
    if dof1 <= _FEW:
        return chi2_tail((dof2 + dof1 / 2 - 1) * math.log1p(dof1 * stat / dof2), dof1)
    root, v1, v2 = math.cbrt(stat), 2 / (9 * dof1), 2 / (9 * dof2)
    return _normal_tail(((1 - v2) * root - (1 - v1)) / math.sqrt(v2 * root * root + v1))


def _apply(fn, *series: pd.Series) -> pd.Series:
    out = [fn(*map(float, row)) if not any(pd.isna(v) for v in row) else None for row in zip(*series)]
    return pd.Series(out, dtype="float64")


@F.pandas_udf(T.DoubleType())
def _chi2_udf(stat: pd.Series, dof: pd.Series) -> pd.Series:
    return _apply(chi2_tail, stat, dof)


@F.pandas_udf(T.DoubleType())
def _t_udf(stat: pd.Series, dof: pd.Series) -> pd.Series:
    return _apply(t_two_sided, stat, dof)


@F.pandas_udf(T.DoubleType())
def _f_udf(stat: pd.Series, dof1: pd.Series, dof2: pd.Series) -> pd.Series:
    return _apply(f_tail, stat, dof1, dof2)


def chi2_p(stat: str, dof: str) -> Column:
    d = F.when(F.col(dof) > 0, F.col(dof).cast("double"))
    return _chi2_udf(F.col(stat).cast("double"), d)


def t_p(stat: str, dof: str) -> Column:
    d = F.when(F.col(dof) > 0, F.col(dof).cast("double"))
    return _t_udf(F.col(stat).cast("double"), d)


def f_p(stat: str, dof1: str, dof2: str) -> Column:
    d1 = F.when(F.col(dof1) > 0, F.col(dof1).cast("double"))
    d2 = F.when(F.col(dof2) > 0, F.col(dof2).cast("double"))
    return _f_udf(F.col(stat).cast("double"), d1, d2)
