"""Tail probabilities of the normal, t, F and chi-square distributions.

Used only on reduced results (one row per test or per group), via the pandas UDFs at the bottom. The
regularised incomplete beta and gamma functions are a prefactor times a continued fraction (DLMF
8.17.22, 8.9.2) or a series (DLMF 8.7.1). The prefactors are written around the distribution's mean,
so that no large logarithms cancel and the digits hold for any sample size. A value that does not
converge is NaN.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PRECISION = 1e-15
_MOST_TERMS = 1 << 22


def normal_sf(z: float) -> float:
    """P(Z > z) for a standard normal."""
    return 0.5 * math.erfc(z / math.sqrt(2.0))


def normal_cdf(z: float) -> float:
    return 0.5 * math.erfc(-z / math.sqrt(2.0))


def _beyond_stirling(a: float) -> float:
    """ln Γ(a) without Stirling's (a - 1/2) ln a - a + ln(2π)/2."""
    if a >= 12.0:
        r = 1.0 / (a * a)
        return (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r * (1 / 1680 - r / 1188)))) / a
    return math.lgamma(a) - ((a - 0.5) * math.log(a) - a + 0.5 * math.log(2 * math.pi))


def _beyond_linear(u: float) -> float:
    """u - ln(1 + u), also for tiny u (its power series)."""
    if abs(u) > 0.05:
        return u - math.log1p(u)
    return sum((-1) ** k * u ** k / k for k in range(2, 16))


def _from_the_end(numerator, denominator) -> float:
    """The continued fraction d(0) + n(1)/(d(1) + n(2)/(d(2) + ...)), with twice as many terms until it stands still."""
    terms, before = 32, math.nan
    while terms <= _MOST_TERMS:
        value = denominator(terms)
        for k in range(terms, 0, -1):
            value = denominator(k - 1) + numerator(k) / value
        if abs(value - before) <= _PRECISION * abs(value):
            return value
        terms, before = 2 * terms, value
    return math.nan


def betainc(a: float, b: float, x: float, y: float | None = None) -> float:
    """Regularised incomplete beta I_x(a, b); ``y`` is 1 - x where the caller has it with more digits."""
    y = 1.0 - x if y is None else y
    if x <= 0.0 or y <= 0.0:
        return 0.0 if x <= 0.0 else 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - betainc(b, a, y, x)
    mean, rest = a / (a + b), b / (a + b)
    off = x - mean if x < 0.5 else rest - y
    log_front = (-a * _beyond_linear(off / mean) - b * _beyond_linear(-off / rest)
                 + _beyond_stirling(a + b) - _beyond_stirling(a) - _beyond_stirling(b))
    front = math.sqrt(a * b / (2 * math.pi * (a + b))) * math.exp(log_front) / a

    if x <= 0.5:
        def numerator(k: int) -> float:
            m = k // 2
            if k % 2 == 0:
                return m * (b - m) * x / ((a + k - 1) * (a + k))
            return -(a + m) * (a + b + m) * x / ((a + k - 1) * (a + k))
        return front / _from_the_end(numerator, lambda k: 1.0)

    # near 1 that fraction cancels: Gauss' fraction (DLMF 15.7.5) of F(1, 1 - b; a + 1; -x/y), whose terms do not
    def gauss(k: int) -> float:
        m = k // 2
        if k % 2 == 0:
            return m * (a + b + m - 1) * (x / y) / ((a + k - 1) * (a + k))
        return (m + 1 - b) * (a + m if m else 1.0) * (x / y) / ((a + k - 1 if m else 1.0) * (a + k))
    return front / y / _from_the_end(gauss, lambda k: 1.0)


def gammaincc(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x)."""
    if x <= 0.0:
        return 1.0
    log_front = -a * _beyond_linear((x - a) / a) - 0.5 * math.log(2 * math.pi * a) - _beyond_stirling(a)
    front = math.exp(log_front)  # x^a e^-x / Γ(a + 1)
    if x < a + 1.0:
        total = term = 1.0
        k = 0
        while term > _PRECISION * total:
            k += 1
            term *= x / (a + k)
            total += term
            if k > _MOST_TERMS:
                return math.nan
        return max(0.0, 1.0 - front * total)
    return front * a / _from_the_end(lambda k: k * (a - k), lambda k: x + 2 * k + 1 - a)


def t_sf(t: float, df: float) -> float:
    """P(T > t) for Student's t with ``df`` degrees of freedom."""
    if math.isnan(t) or math.isnan(df) or df <= 0:
        return float("nan")
    tail = 0.5 * betainc(df / 2.0, 0.5, df / (df + t * t), t * t / (df + t * t))
    return tail if t >= 0 else 1.0 - tail


def t_two_sided(t: float, df: float) -> float:
    if math.isnan(t) or math.isnan(df) or df <= 0:
        return float("nan")
    return min(1.0, betainc(df / 2.0, 0.5, df / (df + t * t), t * t / (df + t * t)))


def f_sf(f: float, d1: float, d2: float) -> float:
    """P(F > f) for the F distribution with (d1, d2) degrees of freedom."""
    if math.isnan(f) or d1 <= 0 or d2 <= 0:
        return float("nan")
    if f <= 0:
        return 1.0
    return betainc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f), d1 * f / (d2 + d1 * f))


def chi2_sf(x: float, k: float) -> float:
    """P(X > x) for chi-square with ``k`` degrees of freedom."""
    if math.isnan(x) or k <= 0:
        return float("nan") if k < 0 else 1.0
    return gammaincc(k / 2.0, x / 2.0)


# ---------------------------------------------------------------- pandas UDFs
def _vec(fn, *cols: pd.Series) -> pd.Series:
    out = np.empty(len(cols[0]), dtype="float64")
    for i, vals in enumerate(zip(*cols)):
        if any(v is None or (isinstance(v, float) and math.isnan(v)) for v in vals):
            out[i] = np.nan
        else:
            out[i] = fn(*[float(v) for v in vals])
    return pd.Series(out)


@F.pandas_udf(T.DoubleType())
def t_two_sided_p(t: pd.Series, df: pd.Series) -> pd.Series:
    """Two-sided p-value of a t statistic."""
    return _vec(t_two_sided, t, df)


@F.pandas_udf(T.DoubleType())
def normal_two_sided_p(z: pd.Series) -> pd.Series:
    """Two-sided p-value of a standard normal statistic: 2·(1 − Φ(|z|))."""
    return _vec(lambda v: 2.0 * (1.0 - normal_cdf(abs(v))), z)


@F.pandas_udf(T.DoubleType())
def f_upper_p(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return _vec(f_sf, f, d1, d2)


@F.pandas_udf(T.DoubleType())
def chi2_upper_p(x: pd.Series, k: pd.Series) -> pd.Series:
    return _vec(chi2_sf, x, k)
