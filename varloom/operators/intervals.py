"""Clusters and unions of intervals: gaps and islands without a task per chromosome."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import written
from .scans import running


def merged(df: DataFrame, keys: list[str], start: str, end: str, distance: float = 0, ties: list[str] = (), out: str = "cluster", width: float = 1e6) -> DataFrame:
    """df with a cluster number within keys: a row joins if its start is at most `distance` past the greatest end before it."""
    ties = [end, *ties]
    got = running(df, keys, start, ties, F.col(end), "max", "__prev", width, exclusive=True)
    got = written(got.withColumn("__new", F.when(F.col("__prev").isNull() | (F.col(start) > F.col("__prev") + distance), 1).otherwise(0)), "islands")
    return running(got, keys, start, ties, F.col("__new"), "sum", out, width).drop("__prev", "__new")


def gap_groups(df: DataFrame, keys: list[str], pos: str, distance: float, ties: list[str] = (), out: str = "group", width: float = 1e6) -> DataFrame:
    """df with a group number: a new group begins more than `distance` past the point before."""
    return merged(df.withColumn("__end", F.col(pos)), keys, pos, "__end", distance, ties, out, width).drop("__end")


def coverage(df: DataFrame, keys: list[str], start: str, end: str, width: float = 1e6) -> DataFrame:
    """Places covered at least once, ends included, and the number of islands by key."""
    got = merged(df, keys, start, end, 0, out="__c", width=width)
    each = got.groupBy(*keys, "__c").agg(F.min(start).alias("s"), F.max(end).alias("e"))
    return each.groupBy(*keys).agg(F.sum(F.col("e") - F.col("s") + 1).alias("covered"), F.count("*").alias("islands"))


def loci(df: DataFrame, keys: list[str], start: str, end: str, score: str, identifier: str, distance: float, width: float = 1e6) -> DataFrame:
    """A row per cluster: bounds, members, and the identifier of the best score (then the least identifier)."""
    got = merged(df, keys, start, end, distance, [identifier], "locus", width)
    top = F.min(F.struct((-F.col(score)).alias("s"), F.col(identifier).alias("i")))
    return got.groupBy(*keys, "locus").agg(F.min(start).alias("locus_start"), F.max(end).alias("locus_end"), F.count("*").alias("members"), top.alias("top")).withColumn("lead", F.col("top.i")).withColumn("lead_score", -F.col("top.s")).drop("top")


def overlap_plan(df: DataFrame, keys: list[str], start: str, end: str, most_kb: float, width: float = 1e6) -> DataFrame:
    """Connected overlapping intervals with their span and whether they can be handled jointly."""
    got = merged(df, keys, start, end, 0, out="overlap_group", width=width)
    return got.groupBy(*keys, "overlap_group").agg(F.min(start).alias("group_start"), F.max(end).alias("group_end"), F.count("*").alias("members")).withColumn("eligible", (F.col("group_end") - F.col("group_start")) / 1000 <= most_kb)
