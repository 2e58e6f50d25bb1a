"""Joins of points and intervals, through bins as wide as the intervals.

An interval lies in at most two bins of the least power of two that is no less than its length; a
point lies in one bin of each width. So each pair meets in exactly one bin, short and long
intervals cost the same, and no pair is made that the bins don't nearly hold already.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import written


def _levels(intervals: DataFrame, start: str, end: str) -> DataFrame:
    level = F.ceil(F.log2(F.greatest(F.col(end) - F.col(start) + 1, F.lit(1)).cast("double"))).cast("int")
    return intervals.withColumn("__level", level).withColumn("__bin", F.explode(F.array_distinct(F.array(F.floor(F.col(start) / F.pow(F.lit(2.0), F.col("__level"))), F.floor(F.col(end) / F.pow(F.lit(2.0), F.col("__level")))))))


def contains(points: DataFrame, intervals: DataFrame, keys: list[tuple[str, str]], pos: str, start: str, end: str, how: str = "inner", half_open: bool = False) -> DataFrame:
    """Pairs of points and intervals with start <= pos <= end (start < pos <= end if half_open).

    keys: (point column, interval column); null keys and ends meet nothing. how: inner, left or
    left_semi, of the points. The widths in use, a few dozen at most, are collected first.
    """
    made = _levels(intervals.filter(F.col(start).isNotNull() & F.col(end).isNotNull() & (F.col(start) <= F.col(end))), start, end)
    levels = sorted(r[0] for r in made.select("__level").distinct().collect())
    spread = F.transform(F.array(*[F.lit(x) for x in levels]).cast("array<int>"), lambda x: F.struct(x.alias("l"), F.floor(F.col(pos) / F.pow(F.lit(2.0), x)).alias("b")))
    pts = written(points.withColumn("__pid", F.monotonically_increasing_id()), "points") if how in ("left", "left_semi") else points
    cut = pts.withColumn("__x", F.explode(spread)).withColumn("__pl", F.col("__x.l")).withColumn("__pb", F.col("__x.b")).drop("__x")
    met = (F.col("__pl") == F.col("__level")) & (F.col("__pb") == F.col("__bin"))
    for p, i in keys:
        met = met & (cut[p] == made[i])
    low = (cut[pos] > made[start]) if half_open else (cut[pos] >= made[start])
    met = met & low & (cut[pos] <= made[end])
    if how == "left_semi":
        # a point has a row for each width; equal points are told apart by their number
        hits = cut.join(made, met, "left_semi").select(F.col("__pid").alias("__q")).distinct()
        return pts.join(hits, F.col("__pid") == F.col("__q"), "left_semi").drop("__pid")
    got = cut.join(made, met).drop("__pl", "__pb", "__level", "__bin")
    if how == "inner":
        return got
    rest = pts.join(got.select(F.col("__pid").alias("__q")).distinct(), F.col("__pid") == F.col("__q"), "left_anti")
    return got.unionByName(rest, allowMissingColumns=True).drop("__pid")


def overlaps(a: DataFrame, b: DataFrame, keys: list[tuple[str, str]], a_ends: tuple[str, str], b_ends: tuple[str, str]) -> DataFrame:
    """Pairs of intervals that share a place, ends included: one's start lies in the other."""
    first = contains(a, b, keys, a_ends[0], *b_ends)
    second = contains(b, a, [(y, x) for x, y in keys], b_ends[0], *a_ends).filter(F.col(b_ends[0]) > F.col(a_ends[0]))
    return first.unionByName(second.select(*first.columns))


def near(a: DataFrame, b: DataFrame, keys: list[tuple[str, str]], a_pos: str, b_pos: str, distance: int) -> DataFrame:
    """Pairs of points at most `distance` apart."""
    wide = b.withColumn("__s", F.col(b_pos) - distance).withColumn("__e", F.col(b_pos) + distance)
    return contains(a, wide, keys, a_pos, "__s", "__e").drop("__s", "__e")


def lifted(df: DataFrame, chain: DataFrame, chrom: str, pos: str) -> DataFrame:
    """df moved through chain segments (src_chrom, src_start, src_end, dst_chrom, dst_start, strand); unmapped rows go."""
    got = contains(df, chain, [(chrom, "src_chrom")], pos, "src_start", "src_end")
    off = F.col(pos) - F.col("src_start")
    new = F.when(F.col("strand") == "-", F.col("dst_start") + (F.col("src_end") - F.col("src_start")) - off).otherwise(F.col("dst_start") + off)
    return got.select(*df.columns, F.col("dst_chrom").alias("lifted_chrom"), new.cast("long").alias("lifted_pos"))
