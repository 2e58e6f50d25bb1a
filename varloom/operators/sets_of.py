"""Operations on sets of identifiers and lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def difference(a: Column, b: Column) -> Column:
    """Elements of one list that another lacks."""
    return F.array_except(a, b)


def sorted_union(frames: list[DataFrame], column: str) -> DataFrame:
    out = frames[0].select(column)
    for f in frames[1:]:
        out = out.union(f.select(column))
    return out.distinct().orderBy(column)


def overlap_fractions(ids: DataFrame, primary: DataFrame, alternate: DataFrame, key: str, least: float) -> tuple[str, float, float]:
    """Which of two identifier tables to use: the alternate only where the primary overlaps too little."""
    n = ids.select(key).distinct().count()
    share = lambda t: ids.select(key).distinct().join(t.select(key).distinct(), key, "left_semi").count() / max(n, 1)
    p, a = share(primary), share(alternate)
    return ("primary" if p >= least or p >= a else "alternate"), p, a


def stacked(frames: dict[str, DataFrame], label: str) -> DataFrame:
    """Frames of one schema under each other, with where each came from."""
    out = None
    for name, f in frames.items():
        f = f.withColumn(label, F.lit(name))
        out = f if out is None else out.unionByName(f)
    return out


def beside(left: DataFrame, right: DataFrame, row: str) -> DataFrame:
    """Columns side by side by a row id: Spark has no order to paste by."""
    return left.join(right, row)
