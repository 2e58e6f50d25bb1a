"""Column expressions over effects, errors, frequencies and p-values."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .variants import finite

LN10 = math.log(10.0)


def p_from_lp(lp: Column, least: float | None = None) -> Column:
    """10 ** -LP, at least `least` if that is given."""
    p = F.pow(F.lit(10.0), -lp)
    return p if least is None else F.when(lp > -math.log10(least), F.lit(least)).otherwise(p)


def ln_p_from_lp(lp: Column) -> Column:
    """ln p, exact where p itself underflows."""
    return -lp * F.lit(LN10)


def effective_n(cases: Column, controls: Column) -> Column:
    """4 / (1 / cases + 1 / controls), null unless both are positive and finite."""
    ok = finite(cases) & finite(controls) & (cases > 0) & (controls > 0)
    return F.when(ok, 4.0 / (1.0 / cases + 1.0 / controls))


def decimal_count(text: Column) -> Column:
    """Struct (count, fractional) of a count's text, by exact decimals, rounded half away from zero."""
    d = F.trim(text).try_cast("decimal(38,18)")
    d = F.coalesce(d, F.trim(text).try_cast("double").try_cast("decimal(38,18)"))
    return F.when(d.isNotNull(), F.struct(F.round(d, 0).cast("bigint").alias("count"), (d != F.round(d, 0)).alias("fractional")))


def log_odds(odds: Column) -> Column:
    return F.when(odds > 0, F.log(odds))


def log_odds_error(odds: Column, error: Column, scale: str = "odds") -> Column:
    """The log-odds error of one given on the scale of odds, log odds, or exponentiated."""
    if scale == "odds":
        return F.when(odds > 0, error / odds)
    if scale == "exponentiated":
        return F.when(finite(error) & (error > 1), F.log(error))
    return error


def z_score(beta: Column, se: Column, given: Column | None = None) -> Column:
    z = F.when(finite(beta) & finite(se) & (se > 0), beta / se)
    return z if given is None else F.coalesce(given, z)


def effect_from_z(z: Column, beta: Column, se: Column, af: Column, n: Column, sigma: float = 1.0, method: str = "neff") -> Column:
    """Struct (beta, se) from z and what of the others there is."""
    spread = 2.0 * af * (1.0 - af)
    denominator = F.sqrt(spread * (n + (F.pow(z, F.lit(2.0)) if method == "zhu_2016" else F.lit(0.0))))
    new_se = F.when(se.isNotNull() & (se > 0), se).when(beta.isNotNull() & (F.signum(beta) == F.signum(z)) & (z != 0), F.abs(beta / z)).when(beta.isNull() & finite(denominator) & (denominator > 0), F.lit(sigma) / denominator)
    return F.struct(F.coalesce(beta, z * new_se).alias("beta"), new_se.alias("se"))


def recovered_error(beta: Column, z: Column, se: Column) -> Column:
    """abs(beta / z) where both are finite, not zero and of one sign; a given positive error stays."""
    ok = finite(beta) & finite(z) & (beta != 0) & (z != 0) & (F.signum(beta) == F.signum(z))
    return F.when(finite(se) & (se > 0), se).when(ok, F.abs(beta / z))


def close(observed: Column, expected: Column, absolute: float, relative: float) -> Column:
    """abs(observed - expected) <= absolute + relative * abs(expected)."""
    return F.abs(observed - expected) <= absolute + relative * F.abs(expected)


def compared(expected: Column, observed: Column, tolerance: tuple[float, float]) -> Column:
    """Struct (difference, checked, observed, concordant): checked rows without an observation are discordant."""
    there = finite(observed)
    checked = finite(expected)
    return F.struct(
        F.when(checked & there, observed - expected).alias("difference"),
        checked.alias("checked"),
        (checked & there).alias("observed"),
        F.when(checked, F.coalesce(there & close(observed, expected, *tolerance), F.lit(False))).alias("concordant"),
    )


def bounded_p(p: Column, tolerance: float = 1.05, low: float = 1e-300, high: float = 1.0, exact_ln: Column | None = None) -> Column:
    """Struct (p, flag): negative or beyond tolerance is null, zero and (1, tolerance] are clipped."""
    zero = (p == 0) if exact_ln is None else (p == 0) & exact_ln.isNull()
    value = F.when(~finite(p) | (p < 0) | (p > tolerance), F.lit(None).cast("double")).when(zero, F.lit(low)).when(p > 1, F.lit(high)).otherwise(p)
    flag = F.when(p.isNull(), "missing").when(~finite(p) | (p < 0) | (p > tolerance), "out_of_range").when(zero, "clipped_low").when(p > 1, "clipped_high").otherwise("kept")
    return F.struct(value.alias("p"), flag.alias("flag"))


def imputed_from_ld(r2: Column, dprime: Column, maf_typed: Column, maf_missing: Column, beta: Column, se: Column) -> Column:
    """Struct (beta, se, z, or_missing): an untyped variant's effect from a typed one in LD.

    D has the sign that makes D' agree better; frequencies of one half are taken as 0.4999; beta is
    negated for a negative D and D is positive afterwards; the error is by the delta method.
    """
    pt = F.when(maf_typed == 0.5, 0.4999).otherwise(maf_typed)
    pm = F.when(maf_missing == 0.5, 0.4999).otherwise(maf_missing)
    d = F.sqrt(r2 * pt * pm * (1 - pt) * (1 - pm))
    high = F.least(pt * (1 - pm), pm * (1 - pt))
    low = F.least(pt * pm, (1 - pt) * (1 - pm))
    negative = F.abs(F.abs(dprime) - d / low) < F.abs(F.abs(dprime) - d / high)
    b = F.when(negative, -beta).otherwise(beta)
    odds = F.exp(b) - 1
    inner = pm * ((1 - pm) + (pt * (1 - pm) - d) * odds)
    or_m = 1 + d * odds / inner
    # derivative of ln(or_m) by b
    slope = (d * F.exp(b) * pm * (1 - pm)) / (inner * inner) / or_m
    new = F.log(or_m)
    new_se = F.abs(slope) * se
    return F.struct(new.alias("beta"), new_se.alias("se"), F.when(new_se > 0, new / new_se).alias("z"), or_m.alias("or_missing"))


def average_of_list(c: Column, separator: str = ",", how: str = "median", low: float = 0.0, high: float = 1.0) -> Column:
    """Struct (value, n, invalid) of a delimited list of numbers: what can't be read or lies outside is invalid."""
    parts = F.filter(F.transform(F.split(c, separator), lambda x: F.nullif(F.trim(x), F.lit(""))), lambda x: x.isNotNull())
    read = F.transform(parts, lambda x: x.try_cast("double"))
    good = F.array_sort(F.filter(read, lambda x: finite(x) & (x >= low) & (x <= high)))
    n = F.size(good)
    if how == "median":
        at = lambda i: F.try_element_at(good, i.cast("int"))
        value = (at(F.floor((n + 1) / 2)) + at(F.floor(n / 2) + 1)) / 2
        value = F.when(n > 0, value)
    else:
        value = F.when(n > 0, F.aggregate(good, F.lit(0.0), lambda a, x: a + x) / n)
    return F.when(c.isNotNull(), F.struct(value.alias("value"), n.alias("n"), (F.size(parts) - n).alias("invalid")))


def dot(a: Column, b: Column) -> Column:
    """The scalar product of two arrays of numbers."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
