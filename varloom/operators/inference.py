"""Decisions about a whole study: the scale of its effects, errors, p-values and scores."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.variants import finite


def effect_type(statistics: dict, most_non_positive: float = 0.005, low: float = 0.8, high: float = 1.25) -> str:
    """odds_ratio if hardly any value isn't positive and the median is near one; beta if neither holds."""
    n = statistics["finite"]
    if not n:
        raise ValueError("no finite effects")
    positive = statistics["non_positive"] / n <= most_non_positive
    centred = low <= statistics["median"] <= high
    if positive != centred:
        raise ValueError("effects look neither like odds ratios nor like betas")
    return "odds_ratio" if positive else "beta"


def p_scale(statistics: dict, least_fraction: float = 0.01, least_count: int = 1, median: float = 0.30103, tolerance: float = 0.15) -> str:
    """neglog10 if enough values exceed one and the median is that of -log10 of uniform p; raw if none does."""
    n = statistics["finite"]
    if not n:
        raise ValueError("no finite p-values")
    above = statistics["above"] / n > least_fraction and statistics["above"] >= least_count
    if not above:
        return "raw"
    if statistics["median"] < median - tolerance:
        raise ValueError("p-values exceed one and their median fits neither scale")
    return "neglog10"


def error_scale(df: DataFrame, odds: str, se: str, z: str, least_rows: int = 100, agreement: float = 0.95, margin: float = 0.1, tolerance: float = 0.05) -> tuple[str, dict]:
    """odds, log_odds or exponentiated: the scale of the error under which beta / se agrees best with z.

    Rows count where the scales' expected z differ pairwise by more than the tolerance.
    """
    beta = F.log(odds)
    scales = {"odds": F.col(se) / F.col(odds), "log_odds": F.col(se), "exponentiated": F.when(F.col(se) > 1, F.log(se))}
    usable = df.filter((F.col(odds) > 0) & (F.col(se) > 0) & finite(F.col(z)) & (F.col(z) != 0))
    far = lambda a, b: F.abs(a - b) > tolerance * F.greatest(F.abs(a), F.abs(b))
    expected = {k: beta / v for k, v in scales.items()}
    zs = usable.withColumns({f"__{k}": v for k, v in expected.items()})
    tells = far(F.col("__odds"), F.col("__log_odds")) | far(F.col("__log_odds"), F.col("__exponentiated"))
    hits = [F.count_if(F.abs(F.col(f"__{k}") - F.col(z)) <= tolerance * F.abs(F.col(z))).alias(k) for k in scales]
    row = zs.filter(F.coalesce(tells, F.lit(False))).agg(F.count("*").alias("n"), *hits).first()
    if row["n"] < least_rows:
        raise ValueError(f"{row['n']} rows tell the scales apart")
    score = {k: row[k] / row["n"] for k in scales}
    first, second = sorted(score, key=score.get, reverse=True)[:2]
    if score[first] < agreement or score[first] - score[second] < margin:
        raise ValueError(f"no scale fits: {score}")
    return first, score


def info_kind(statistics: dict, least: float = 0.001) -> str:
    n = max(1, statistics["finite"])
    if statistics["above_2"] / n > least:
        raise ValueError("scores exceed 2")
    return "mach_r2" if statistics["to_2"] / n >= least else "info"


def frequency_kind(statistics: dict, cutoff: float = 0.95) -> str:
    """maf if at least the cutoff of usable frequencies is one half or less."""
    return "maf" if statistics["usable"] and statistics["minor"] / statistics["usable"] >= cutoff else "eaf"


def frequency_screen(df: DataFrame, column: str) -> DataFrame:
    x = F.col(column)
    ok = finite(x) & (x >= 0) & (x <= 1)
    return df.agg(F.count_if(ok).alias("usable"), F.count_if(ok & (x <= 0.5)).alias("minor"))


def pooled_screens(screens: DataFrame) -> DataFrame:
    """Sums of counts; fractions are never averaged."""
    return screens.agg(F.sum("usable").alias("usable"), F.sum("minor").alias("minor"))


def allele_test(df: DataFrame, study: str, reference: str) -> DataFrame:
    """Correlation and mean absolute error of frequencies as given and inverted."""
    from .aggregates import guarded_corr

    x, y = F.col(study), F.col(reference)
    return df.agg(guarded_corr(x, y).alias("corr_given"), F.avg(F.abs(x - y)).alias("mae_given"), guarded_corr(1 - x, y).alias("corr_inverted"), F.avg(F.abs(1 - x - y)).alias("mae_inverted"))


def lp_threshold(p: float) -> Column:
    """The threshold on -log10 p, at which p itself can't underflow."""
    return F.lit(-math.log10(p))
