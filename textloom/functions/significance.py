"""p-values. The UDFs see one row per comparison, never the values of single queries."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Ranks up to which the sign patterns of a signed-rank test are counted one rank after the other.
COUNTED = 600


def student_t_two_sided(t: Column | str, dof: Column | str) -> Column:
    """Two-sided p-value of Student's t.

    The functions are nested so that a task receives them whole and the
    executors need not have this package installed.
    """

    def incomplete_beta(a, b, x):
        """Regularised incomplete beta function by its continued fraction (modified Lentz)."""
        swap = x > (a + 1) / (a + b + 2)
        p, q = np.where(swap, b, a), np.where(swap, a, b)
        y = np.where(swap, 1 - x, x)

        def guarded(v):
            return np.where(np.abs(v) < 1e-300, 1e-300, v)

        c = np.ones_like(y)
        d = 1 / guarded(1 - (p + q) * y / (p + 1))
        fraction = d.copy()
        for m in range(1, 300):
            for numerator in (
                m * (q - m) * y / ((p + 2 * m - 1) * (p + 2 * m)),
                -(p + m) * (p + q + m) * y / ((p + 2 * m) * (p + 2 * m + 1)),
            ):
                d = 1 / guarded(1 + numerator * d)
                c = guarded(1 + numerator / c)
                fraction = fraction * c * d
        log_gamma = np.vectorize(math.lgamma, otypes=[float])
        with np.errstate(divide="ignore"):
            log_front = p * np.log(y) + q * np.log1p(-y) - (log_gamma(p) + log_gamma(q) - log_gamma(p + q))
        value = np.exp(log_front) * fraction / p
        return np.where(swap, 1 - value, value)

    @F.pandas_udf(T.DoubleType())
    def p_value(t: pd.Series, dof: pd.Series) -> pd.Series:
        known = t.notna() & dof.notna()
        result = pd.Series([None] * len(t), dtype="float64")
        tk, dk = t[known].to_numpy(float), dof[known].to_numpy(float)
        if len(tk):
            result[known] = incomplete_beta(dk / 2, 0.5, dk / (dk + tk * tk))
        return result

    return p_value(t, dof)


def normal_two_sided(z: Column | str) -> Column:
    """Two-sided p-value of a standard normal deviate."""

    @F.pandas_udf(T.DoubleType())
    def p_value(z: pd.Series) -> pd.Series:
        tail = np.frompyfunc(lambda v: math.erfc(abs(v) / math.sqrt(2)), 1, 1)
        return pd.Series(np.where(z.isna(), np.nan, tail(z.fillna(0.0).to_numpy(float)).astype(float)))

    return p_value(z)


def exact_signed_rank_p(n: Column, w_max: Column) -> Column:
    """Two-sided p of the signed-rank statistic over all sign patterns of ranks 1..n, one row per comparison.

    Up to ``COUNTED`` ranks the shares of subsets by their sum are counted: rank
    after rank, an array of n(n+1)/2 sums is added to itself, shifted. Beyond, the
    same shares come from their characteristic function, which falls so fast that
    few frequencies have a value; it is tilted so that the statistic stands in
    the middle, and small tails keep their digits.
    """
    counted = COUNTED

    def by_counting(ranks: int, least: int) -> float:
        top = ranks * (ranks + 1) // 2
        shares = np.zeros(top + 1)
        shares[0] = 1.0
        for r in range(1, ranks + 1):
            shares[r:] = shares[r:] + shares[:-r]
            shares /= 2
        return float(shares[least:].sum())

    def by_inversion(ranks: int, least: int) -> float:
        r = np.arange(1, ranks + 1, dtype=float)

        def moments(tilt):
            p = 1 / (1 + np.exp(-tilt * r))
            return (p * r).sum(), (p * (1 - p) * r * r).sum()

        low, high = 0.0, 60.0 / ranks  # the tilt at which the mean is ``least``
        for _ in range(80):
            middle = (low + high) / 2
            low, high = (middle, high) if moments(middle)[0] < least else (low, middle)
        tilt = (low + high) / 2
        sigma = math.sqrt(moments(tilt)[1])
        size = 1 << max(8, math.ceil(math.log2(40 * sigma + 1)))  # sums beyond 20 deviations have no share
        count = min(size // 2, math.ceil(12 * size / (2 * math.pi * sigma)) + 1)
        p = 1 / (1 + np.exp(-tilt * r))
        values = np.zeros(size, complex)
        for k in range(count):
            angle = 2 * math.pi * k / size * r
            value = np.exp(np.log1p(p * (np.exp(1j * angle) - 1)).sum() - 2j * math.pi * k / size * (least - size // 2))
            values[k] = value
            values[-k] = np.conj(value)
        values[0] = 1.0
        shares = np.fft.fft(values).real / size  # of the sums from least - size / 2 on
        steps = np.arange(size - size // 2)
        tail = (np.maximum(shares[size // 2 :], 0.0) * np.exp(-tilt * steps)).sum()
        log_mass = (np.logaddexp(0.0, tilt * r) - math.log(2.0)).sum() - tilt * least
        return float(tail * math.exp(log_mass))

    @F.pandas_udf(T.DoubleType())
    def p_value(n: pd.Series, w: pd.Series) -> pd.Series:
        out = []
        for ranks, greatest in zip(n, w):
            if pd.isna(ranks) or pd.isna(greatest):
                out.append(None)
                continue
            ranks, least = int(ranks), math.ceil(greatest)
            upper = by_counting(ranks, least) if ranks <= counted else by_inversion(ranks, least)
            out.append(min(1.0, 2 * upper))
        return pd.Series(out, dtype="float64")

    return p_value(n.cast("long"), w_max.cast("double"))
