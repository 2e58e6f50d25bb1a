"""Normal and hypergeometric tails in log space, as Arrow UDFs: the JVM has no erfc."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

LN_2PI = math.log(2 * math.pi)


def _erfc(x: np.ndarray) -> np.ndarray:
    return np.fromiter(map(math.erfc, x), float, len(x))


def ln_sf(z: np.ndarray) -> np.ndarray:
    """ln P(Z > z) for z >= 0; an asymptotic series from 25 on."""
    z = np.asarray(z, float)
    out = np.empty_like(z)
    near = ~(z >= 25)
    with np.errstate(all="ignore"):
        out[near] = np.log(_erfc(z[near] / math.sqrt(2)) / 2)
        far = z[~near]
        w = far**-2
        out[~near] = -far * far / 2 - np.log(far) - LN_2PI / 2 + np.log1p(-w + 3 * w**2 - 15 * w**3 + 105 * w**4)
    return out


def z_of_ln_sf(ln_p: np.ndarray) -> np.ndarray:
    """The z >= 0 with ln P(Z > z) = ln_p, by Newton steps in log space; NaN for ln_p over ln(1/2)."""
    ln_p = np.asarray(ln_p, float)
    with np.errstate(all="ignore"):
        z = np.where(ln_p > -2, 1.0, np.sqrt(np.maximum(-2 * ln_p, 1.0)))
        for _ in range(60):
            now = ln_sf(z)
            hazard = np.exp(-z * z / 2 - LN_2PI / 2 - now)
            step = (now - ln_p) / hazard
            z = np.maximum(z + step, 0.0)
            if not np.any(np.abs(step) > 1e-15 * np.maximum(z, 1e-3)):
                break
        return np.where(ln_p <= math.log(0.5) + 1e-15, z, np.nan)


def ln_hypergeometric(k: float, population: float, marked: float, drawn: float) -> float:
    """ln P(X >= k)."""
    low, high = max(0, int(drawn + marked - population)), int(min(marked, drawn))
    if k <= low:
        return 0.0
    if k > high:
        return -math.inf
    choose = lambda n, r: math.lgamma(n + 1) - math.lgamma(r + 1) - math.lgamma(n - r + 1)
    terms = [choose(marked, i) + choose(population - marked, drawn - i) for i in range(int(k), high + 1)]
    top = max(terms)
    return min(0.0, top + math.log(math.fsum(math.exp(t - top) for t in terms)) - choose(population, drawn))


@pandas_udf(DoubleType())
def z_magnitude(ln_p: pd.Series, tail: pd.Series) -> pd.Series:
    """abs(z) of ln p over `tail` tails."""
    x = ln_p.to_numpy(float) - np.log(tail.to_numpy(float))
    return pd.Series(z_of_ln_sf(x)).where(~np.isnan(x))


@pandas_udf(DoubleType())
def lp_from_z(z: pd.Series) -> pd.Series:
    """-log10 of the two-sided p of z."""
    return pd.Series(-(math.log(2) + ln_sf(np.abs(z.to_numpy(float)))) / math.log(10))


@pandas_udf(DoubleType())
def erfc(x: pd.Series) -> pd.Series:
    return pd.Series(_erfc(x.to_numpy(float)))


@pandas_udf(DoubleType())
def hypergeometric_tail(k: pd.Series, population: pd.Series, marked: pd.Series, drawn: pd.Series) -> pd.Series:
    """P(X >= k)."""
    return pd.Series([math.exp(ln_hypergeometric(*x)) for x in zip(k, population, marked, drawn)], dtype=float)
