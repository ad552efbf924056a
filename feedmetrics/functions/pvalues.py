"""Two-sided tail probabilities for result rows.

Spark SQL has neither the error function nor the incomplete beta function, so these two are
Arrow-batched UDFs. They run on test results (one row, or one per replicate), never on events.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TINY = 1e-300
_ROUNDS = 20_000


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Continued fraction of the incomplete beta function (modified Lentz evaluation).

    NaN where it has not converged after ``_ROUNDS`` rounds.
    """
    def safe(v: np.ndarray) -> np.ndarray:
        return np.where(np.abs(v) < _TINY, _TINY, v)

    c = np.ones_like(x)
    d = 1.0 / safe(1.0 - (a + b) * x / (a + 1.0))
    total = d.copy()
    step = np.zeros_like(x)
    for m in range(1, _ROUNDS):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for term in (even, odd):
            d = 1.0 / safe(1.0 + term * d)
            c = safe(1.0 + term / c)
            step = c * d
            total = total * step
        if np.all(np.abs(step - 1.0) < 4e-15):
            break
    return np.where(np.abs(step - 1.0) < 1e-12, total, np.nan)


def _log_gamma_step(a: np.ndarray) -> np.ndarray:
    """log(Γ(a + 1/2) / Γ(a)), without taking two large numbers from one another.

    From the ratio at a + 32, where its series in 1 / a has long settled, step by step down.
    """
    high = a + 32
    inverse = 1 / high
    out = 0.5 * np.log(high) - inverse / 8 + inverse**3 / 192 - inverse**5 / 640 + 17 * inverse**7 / 14336
    for k in range(32):
        out -= np.log1p(0.5 / (a + k))
    return out


def beta_half(a: np.ndarray, odds: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta function I_x(a, 1/2) at x = 1 / (1 + odds).

    Given the odds, neither x nor 1 - x is rounded away near 1.
    """
    half = np.full_like(a, 0.5)
    x, rest = 1 / (1 + odds), odds / (1 + odds)
    # The fraction converges fast on one side only; with many degrees of freedom and not far out, both
    # of its sides take nearly equal numbers from one another, and a series of positive terms does not.
    near = (a > 1e3) & (a * odds < 18)
    flip = near | (x > (a + 1.0) / (a + 2.5))
    p, q = np.where(flip, half, a), np.where(flip, a, half)
    y = np.where(flip, rest, x)
    with np.errstate(divide="ignore", invalid="ignore"):
        log_front = _log_gamma_step(a) - 0.5 * math.log(math.pi) - (a + 0.5) * np.log1p(odds) + 0.5 * np.log(odds)
        sums = np.full_like(a, np.nan)
        sums[near] = _beta_series(a[near], rest[near])
        sums[~near] = _beta_fraction(p[~near], q[~near], y[~near])
        tail = np.where(y <= 0.0, 0.0, np.exp(log_front) / p * sums)
    return np.where(flip, 1.0 - tail, tail)


def _beta_series(a: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The sum of (a + 1/2)(a + 3/2)… y^n / (3/2)(5/2)…, all terms positive; NaN if it does not end."""
    total, term = np.ones_like(a), np.ones_like(a)
    for k in range(_ROUNDS):
        term = term * (a + 0.5 + k) / (1.5 + k) * y
        total = total + term
        if np.all(term < 1e-17 * total):
            return total
    return np.full_like(a, np.nan)


def student_two_sided(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    """P(|T| >= |t|) for Student's t with ``df`` degrees of freedom; NaN for NaN input."""
    out = np.full(t.shape, np.nan)
    ok = np.isfinite(t) & np.isfinite(df) & (df > 0)
    if ok.any():
        tt, dd = t[ok], df[ok]
        out[ok] = beta_half(dd / 2.0, tt * tt / dd)
    return out


def gaussian_two_sided(z: np.ndarray) -> np.ndarray:
    """P(|Z| >= z) for the standard normal, at most 1 (a negative ``z`` counts as no evidence)."""
    return np.minimum(1.0, np.array([math.erfc(v / math.sqrt(2.0)) for v in z], dtype=float))


def _nullable(values: np.ndarray) -> pd.Series:
    return pd.Series(values, dtype=object).where(~np.isnan(values), None)


@F.pandas_udf(T.DoubleType())
def t_two_sided(t: pd.Series, df: pd.Series) -> pd.Series:
    return _nullable(student_two_sided(t.to_numpy(dtype=float), df.to_numpy(dtype=float)))


@F.pandas_udf(T.DoubleType())
def normal_two_sided(z: pd.Series) -> pd.Series:
    return _nullable(gaussian_two_sided(z.to_numpy(dtype=float)))
