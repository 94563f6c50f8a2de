"""Column arithmetic shared by the operators."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields NULL instead of failing when the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def allele_fraction(alternative: str = "alternative_ad", total: str = "total_dp", digits: int = 2) -> Column:
    """Share of reads with the alternative allele, rounded half to even."""
    return F.bround(ratio(F.col(alternative), F.col(total)), digits)


def codon_of(distance: Column) -> Column:
    """Codon number of a 1-based nucleotide distance."""
    return F.floor((distance - 1) / 3 + 1).cast("long")


def wald_bound(share: Column, total: Column, sign: int, z: float = 1.96) -> Column:
    """One end of the normal-approximation interval of a proportion, in percent."""
    half_width = z * F.sqrt(ratio(share * (1 - share), total))
    return 100 * (share + sign * half_width)


def _log_beta(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    lgamma = np.frompyfunc(math.lgamma, 1, 1)
    return np.asarray(lgamma(a) + lgamma(b) - lgamma(a + b), dtype=float)


def _continued_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Modified Lentz evaluation of the incomplete-beta continued fraction, element-wise."""
    tiny = 1e-300
    c = np.ones_like(x)
    d = 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
    total = d.copy()
    # The fraction settles after a number of terms that grows with the root of the larger shape.
    steps = 200 + int(10 * math.sqrt(float(np.max(np.maximum(a, b), initial=1.0))))
    for m in range(1, steps + 1):
        for term in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + term * d
            d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1.0 + term / np.where(np.abs(c) < tiny, tiny, c)
            delta = c * d
            total = total * delta
        if not np.any(np.abs(delta - 1.0) >= 1e-14):
            break
    else:
        if np.any(np.abs(delta - 1.0) >= 1e-9):
            raise ArithmeticError(f"the continued fraction has not settled after {steps} terms")
    return total


def beta_cdf(x: np.ndarray, a: np.ndarray, b: np.ndarray, log_beta: np.ndarray | None = None) -> np.ndarray:
    """Regularised incomplete beta function, element-wise, worked out in log space."""
    x, a, b = np.broadcast_arrays(np.asarray(x, float), np.asarray(a, float), np.asarray(b, float))
    swap = x > (a + 1.0) / (a + b + 2.0)
    p, q, z = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, 1.0 - x, x)
    log_beta = _log_beta(a, b) if log_beta is None else log_beta
    with np.errstate(divide="ignore", invalid="ignore"):
        front = np.exp(p * np.log(z) + q * np.log1p(-z) - log_beta) / p
    value = np.where(z <= 0.0, 0.0, front * _continued_fraction(p, q, z))
    return np.where(swap, 1.0 - value, value)


def beta_quantile(prob: float, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inverse of :func:`beta_cdf` by bisection; NaN where a shape is not positive."""
    a, b = np.asarray(a, float), np.asarray(b, float)
    valid = (a > 0) & (b > 0)
    shape_a, shape_b = np.where(valid, a, 1.0), np.where(valid, b, 1.0)
    low, high = np.zeros_like(shape_a), np.ones_like(shape_a)
    log_beta = _log_beta(shape_a, shape_b)
    for _ in range(60):
        middle = (low + high) / 2
        below = beta_cdf(middle, shape_a, shape_b, log_beta) < prob
        low, high = np.where(below, middle, low), np.where(below, high, middle)
    return np.where(valid, (low + high) / 2, np.nan)


@F.pandas_udf(DoubleType())
def _upper_bound(resistant: pd.Series, susceptible: pd.Series) -> pd.Series:
    # Few pairs of counts are common to most rows: each is worked out once a batch.
    pairs, place = np.unique(np.stack([resistant.to_numpy(float), susceptible.to_numpy(float)]), axis=1, return_inverse=True)
    return pd.Series(beta_quantile(0.975, pairs[0] + 1.0, pairs[1])[place.ravel()])


def clopper_pearson_upper(resistant: Column, susceptible: Column) -> Column:
    """Upper 97.5 % bound of R / (R + S); NaN, hence below no threshold, when nothing is susceptible."""
    return F.coalesce(_upper_bound(resistant, susceptible), F.lit(float("nan")))


def critical_susceptible(resistant: np.ndarray, threshold: float, prob: float = 0.975) -> np.ndarray:
    """Smallest S, at least 1, for which the upper bound of R / (R + S) is below the threshold.

    The bound falls with S, and is below t exactly where the beta distribution of (R + 1, S) has more than ``prob`` of its mass below
    t; so S is found by doubling and halving, without the bound itself.  A threshold outside (0, 1) is an error.
    """
    if not 0 < threshold < 1:
        raise ValueError("thresholds lie between 0 and 1")
    a = np.asarray(resistant, float) + 1.0

    def enough(s: np.ndarray) -> np.ndarray:
        return beta_cdf(threshold, a, s) > prob

    low, high = np.zeros_like(a), np.ones_like(a)  # enough at ``high``, not at ``low``
    while not (reached := enough(high)).all():
        low, high = np.where(reached, low, high), np.where(reached, high, 2 * high)
    while (high - low > 1).any():
        middle = np.floor((low + high) / 2)
        reached = enough(np.maximum(middle, 1)) & (middle >= 1)
        low, high = np.where(reached, low, middle), np.where(reached, middle, high)
    return high.astype(np.int64)
