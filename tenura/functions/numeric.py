"""Arithmetic that gives the same digits on every engine."""

import math

import pandas as pd
from pyspark.sql import Column, functions as F, types as T


def half_up(value: Column | str, digits: int) -> Column:
    """Round half away from zero in plain IEEE arithmetic (built-in rounding differs by engine).

    From 2^53 / 10^digits on a double has no such digits left and stays as it is.
    """
    x = F.col(value) if isinstance(value, str) else value
    x = x.cast("double")
    scale = float(10 ** digits)
    # + 0.0 turns a negative zero into zero
    rounded = F.signum(x) * F.floor(F.abs(x) * scale + 0.5).cast("double") / scale + 0.0
    return F.when(F.abs(x) * scale < 2.0 ** 53, rounded).otherwise(x)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as double, null where the whole is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def mean_of(value: Column) -> Column:
    """Mean from an exact sum, so the result does not depend on row order for ints and decimals."""
    return ratio(F.sum(value), F.count(value))


def share_pct(part: Column, whole: Column, digits: int = 2) -> Column:
    return half_up(100.0 * ratio(part, whole), digits)


def chi2_tail(stat: float, dof: int) -> float:
    """Upper tail of the chi-square distribution for whole degrees of freedom (finite sums, whose terms
    are taken from their logarithms, so nothing overflows)."""
    if stat is None or dof is None or math.isnan(stat):
        return float("nan")
    half = stat / 2.0
    if half <= 0:
        return 1.0
    start = 0.5 * (dof % 2)
    terms = (math.exp((k + start) * math.log(half) - half - math.lgamma(k + start + 1)) for k in range(dof // 2))
    return min(1.0, math.fsum(terms) + (math.erfc(math.sqrt(half)) if dof % 2 else 0.0))


@F.pandas_udf(T.DoubleType())
def chi2_p_value(stat: pd.Series, dof: pd.Series) -> pd.Series:
    """p-values of a result table with one row per test (the engine has no erfc)."""
    return pd.Series([chi2_tail(s, int(d)) for s, d in zip(stat, dof)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def normal_two_sided_p(z: pd.Series) -> pd.Series:
    return z.abs().map(lambda v: min(1.0, math.erfc(v / math.sqrt(2.0))))
