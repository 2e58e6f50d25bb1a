"""Corrections for multiple testing, within families or over a whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scans import scanned_by_rank, within

METHODS = ("bonferroni", "sidak", "holm", "fdr_bh")


def adjusted(df: DataFrame, p: str, methods: tuple[str, ...] = METHODS, family: list[str] | None = None, ties: list[str] = (), prefix: str = "adj_") -> DataFrame:
    """df with adjusted p-values by method; null and NaN p are left out and get null.

    Rows are ranked by ranges, and the running maximum and minimum are carried from bin to bin, so
    that no task holds all rows of a table or of a large family.
    """
    unknown = set(methods) - set(METHODS)
    if unknown:
        raise ValueError(f"unknown methods: {sorted(unknown)}")
    good = F.col(p).isNotNull() & ~F.isnan(p)
    tested, rest = df.filter(good), df.filter(~good)
    keys = list(family or [])
    out, _ = within(tested, keys, [F.asc(p), *[F.asc(t) for t in ties]], "__r")
    for method in methods:
        x = _value(method, F.col(p), F.col("__r"), F.col("__m"))
        if method == "holm":
            out = scanned_by_rank(out, "__r", x, "max", prefix + method, keys=keys)
        elif method == "fdr_bh":
            out = scanned_by_rank(out, "__r", x, "min", prefix + method, forward=False, keys=keys)
        else:
            out = out.withColumn(prefix + method, x)
    return out.drop("__r", "__m").unionByName(rest, allowMissingColumns=True)


def _value(method: str, p: Column, rank: Column, m: Column) -> Column:
    """The adjusted p; for holm and fdr_bh what the running maximum and minimum are taken of."""
    if method == "bonferroni":
        return F.least(p * m, F.lit(1.0))
    if method == "sidak":
        return F.least(-F.expm1(m * F.log1p(-p)), F.lit(1.0))
    if method == "holm":
        return F.least(p * (m - rank + 1), F.lit(1.0))
    return F.least(p * m / rank, F.lit(1.0))


def by_named_family(df: DataFrame, name: str, p: str, pattern: str, methods: tuple[str, ...] = METHODS, ties: list[str] = ()) -> DataFrame:
    """Correction over all rows, and again over those whose name matches (null outside), never pooled."""
    whole = adjusted(df, p, methods, ties=list(ties))
    member = F.coalesce(F.col(name).rlike(pattern), F.lit(False))
    inside = adjusted(whole.filter(member), p, methods, ties=list(ties), prefix="family_")
    return inside.unionByName(whole.filter(~member), allowMissingColumns=True)


def flags(df: DataFrame, p: str, threshold: float = 0.05, methods: tuple[str, ...] = ("bonferroni", "fdr_bh"), ties: list[str] = ()) -> DataFrame:
    """Nominal and adjusted significance."""
    out = adjusted(df, p, methods, ties=list(ties))
    return out.withColumns({"nominal": F.coalesce(F.col(p) <= threshold, F.lit(False)), **{f"significant_{m}": F.coalesce(F.col(f"adj_{m}") <= threshold, F.lit(False)) for m in methods}})


def summary(df: DataFrame, p: str, methods: tuple[str, ...], threshold: float = 0.05) -> DataFrame:
    """How many are at or below the threshold, by p and by each adjusted p."""
    cols = {"nominal": p, **{m: f"adj_{m}" for m in methods}}
    return df.agg(F.count(p).alias("tested"), *[F.count_if(F.col(c) <= threshold).alias(k) for k, c in cols.items()])
