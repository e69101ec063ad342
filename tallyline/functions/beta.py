"""K4: Beta-distribution functions.

* `lgamma` / `beta_logpdf` are Column expressions, so densities over large
  grids stay inside whole-stage codegen.  The log density is taken relative to
  the mean, with Stirling remainders, so counts of any size lose no digits.
* `beta_cdf` / `beta_ppf` are vectorised pandas UDFs (Arrow batches).  The
  regularised incomplete beta is Lentz's continued fraction, run until it has
  converged (an error otherwise), and for large parameters Gauss-Legendre
  quadrature of the density over the twelve standard deviations that carry the
  tail.  They run on AGGREGATED rows (one per group, or group x evaluation
  point), never per input record.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

_HALF_LN_2PI = 0.5 * math.log(2 * math.pi)


def lgamma(x: Column) -> Column:
    """ln Gamma(x) for x > 0 as a native expression."""
    y = x + F.lit(8.0)
    shift = F.lit(0.0)
    for k in range(8):
        shift = shift + F.ln(x + F.lit(float(k)))
    inv = F.lit(1.0) / y
    inv2 = inv * inv
    series = inv * (F.lit(1 / 12) - inv2 * (F.lit(1 / 360) - inv2 * (F.lit(1 / 1260) - inv2 * F.lit(1 / 1680))))
    return (y - F.lit(0.5)) * F.ln(y) - y + F.lit(_HALF_LN_2PI) + series - shift


def _remainder(z: Column) -> Column:
    """ln Gamma(z) less its leading Stirling terms."""
    inv = F.lit(1.0) / z
    inv2 = inv * inv
    series = inv * (F.lit(1 / 12) - inv2 * (F.lit(1 / 360) - inv2 * (F.lit(1 / 1260) - inv2 * F.lit(1 / 1680))))
    return F.when(z >= 10, series).otherwise(
        lgamma(z) - ((z - F.lit(0.5)) * F.ln(z) - z + F.lit(_HALF_LN_2PI)))


def beta_logpdf(x: Column, a: Column, b: Column) -> Column:
    n = a + b
    shift = n * x - a                                       # distance from the mean, in counts
    return (F.lit(0.5) * F.ln(a * (b / n)) - F.lit(_HALF_LN_2PI) + _remainder(n) - _remainder(a) - _remainder(b)
            + a * F.log1p(shift / a) + b * F.log1p(-shift / b) - F.ln(x) - F.log1p(-x))


# ---------------------------------------------------------------- NumPy core

_lgam = np.frompyfunc(math.lgamma, 1, 1)
_NODES, _WEIGHTS = np.polynomial.legendre.leggauss(64)
LARGE = 3000.0                        # both parameters above: quadrature


def _lg(v: np.ndarray) -> np.ndarray:
    return _lgam(v).astype(float)


def _betacf(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Lentz's continued fraction, to convergence.  It takes about the square root of the larger
    parameter in steps; far beyond that it is an error."""
    tiny = 1e-300
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c = np.ones_like(x)
    d = 1.0 - qab * x / qap
    d = np.where(np.abs(d) < tiny, tiny, d)
    d = 1.0 / d
    h = d.copy()
    for m in range(1, int(1000 + 20 * math.sqrt(max(a.max(), b.max()))) + 1):
        m2 = 2 * m
        for aa in (m * (b - m) * x / ((qam + m2) * (a + m2)), -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))):
            d = 1.0 + aa * d
            d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1.0 + aa / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            delta = d * c
            h = h * delta
        if np.all(np.abs(delta - 1.0) < 4e-16):
            return h
    raise ArithmeticError("incomplete beta: the continued fraction did not converge")


def _large_tail(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """I_x(a, b) for large a and b: the smaller tail by quadrature."""
    n = a + b
    m, sd = a / n, np.sqrt(a / n * (b / n) / n)
    low = x <= m
    end = np.where(low, np.maximum(x - 12 * sd, 0.0), np.minimum(x + 12 * sd, 1.0))
    t = x[:, None] + (end - x)[:, None] * (0.5 * (_NODES + 1.0))[None]
    shift = t - m[:, None]
    stirling = lambda z: 1 / (12 * z) - 1 / (360 * z ** 3)
    with np.errstate(divide="ignore", invalid="ignore", under="ignore"):
        logf = (0.5 * np.log(a * (b / n) / (2 * math.pi)) + stirling(n) - stirling(a) - stirling(b))[:, None] \
            + a[:, None] * np.log1p(shift / m[:, None]) + b[:, None] * np.log1p(-shift / (b / n)[:, None]) \
            - np.log(t) - np.log1p(-t)
        f = np.where((t > 0) & (t < 1), np.exp(logf), 0.0)
    tail = np.abs(end - x) * 0.5 * (f @ _WEIGHTS)
    return np.where(low, tail, 1.0 - tail)


def betainc(a, b, x) -> np.ndarray:
    """Regularised incomplete beta I_x(a, b), vectorised."""
    a, b, x = (np.asarray(v, dtype=float) for v in (a, b, x))
    a, b, x = np.broadcast_arrays(a, b, x)
    out = np.full(x.shape, np.nan)
    out[x <= 0] = 0.0
    out[x >= 1] = 1.0
    m = (x > 0) & (x < 1) & (a > 0) & (b > 0)
    large = m & (np.minimum(a, b) > LARGE)
    if large.any():
        out[large] = _large_tail(a[large], b[large], x[large])
    m &= ~large
    if m.any():
        am, bm, xm = a[m], b[m], x[m]
        lfront = _lg(am + bm) - _lg(am) - _lg(bm) + am * np.log(xm) + bm * np.log1p(-xm)
        front = np.exp(lfront)
        direct = xm < (am + 1.0) / (am + bm + 2.0)
        res = np.empty_like(xm)
        if direct.any():
            res[direct] = front[direct] * _betacf(am[direct], bm[direct], xm[direct]) / am[direct]
        if (~direct).any():
            r = ~direct
            res[r] = 1.0 - front[r] * _betacf(bm[r], am[r], 1.0 - xm[r]) / bm[r]
        out[m] = res
    return out


def betaincinv(a, b, q, iters: int = 100) -> np.ndarray:
    a, b, q = (np.asarray(v, dtype=float) for v in (a, b, q))
    a, b, q = np.broadcast_arrays(a, b, q)
    lo, hi = np.zeros(q.shape), np.ones(q.shape)
    for _ in range(iters):
        mid = 0.5 * (lo + hi)
        below = betainc(a, b, mid) < q
        lo = np.where(below, mid, lo)
        hi = np.where(below, hi, mid)
    return 0.5 * (lo + hi)


# ---------------------------------------------------------------- pandas UDFs

@pandas_udf(DoubleType())
def beta_cdf(a: pd.Series, b: pd.Series, x: pd.Series) -> pd.Series:
    return pd.Series(betainc(a.to_numpy(), b.to_numpy(), x.to_numpy()))


@pandas_udf(DoubleType())
def beta_ppf(a: pd.Series, b: pd.Series, q: pd.Series) -> pd.Series:
    return pd.Series(betaincinv(a.to_numpy(), b.to_numpy(), q.to_numpy()))
