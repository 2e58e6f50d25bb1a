"""Running values, ranks and as-of matches whose work is split within a key.

A window by chromosome has as many tasks as there are chromosomes. Here the order column is cut
into bins: each bin is reduced to one row, the running value over bins is a window over those few
rows, and rows get their bin's carry and a window within the bin.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import written

REDUCERS = {"max": (F.max, F.greatest), "min": (F.min, F.least), "sum": (F.sum, lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))}


def running(df: DataFrame, keys: list[str], order: str, ties: list[str], value: Column, how: str, out: str, width: float, exclusive: bool = False) -> DataFrame:
    """df with the running max, min or sum of value within keys in the order of (order, ties).

    exclusive leaves the row itself out; then the first row's value is null (0 for sums).
    """
    reducer, merge = REDUCERS[how]
    df = df.withColumn("__v", value).withColumn("__bin", F.floor(F.col(order) / F.lit(width)))
    before = Window.partitionBy(*keys).orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    carry = df.groupBy(*keys, "__bin").agg(reducer("__v").alias("__b")).withColumn("__carry", reducer("__b").over(before)).drop("__b")
    carry = carry.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__bin").alias("__cb"), "__carry")
    same = F.col("__bin").eqNullSafe(F.col("__cb"))
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    met = df.join(carry, same, "left").drop(*[f"__k{i}" for i in range(len(keys))], "__cb")
    inner = Window.partitionBy(*keys, "__bin").orderBy(order, *ties).rowsBetween(Window.unboundedPreceding, -1 if exclusive else 0)
    return met.withColumn(out, merge(F.col("__carry"), reducer("__v").over(inner))).drop("__v", "__bin", "__carry")


def ranked(df: DataFrame, order: list[Column], out: str = "rank", partitions: int | None = None) -> DataFrame:
    """df with its row number in a total order, without moving all rows to one task.

    Rows are dealt by ranges and sorted within; the sizes of the ranges, one row a partition, give
    the offsets. The sorted rows are written first, so that a range's number can't change.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    dealt = written(dealt.withColumn("__id", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("__id", 33)
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy(part.alias("__p")).agg(F.count("*").alias("__n"))
    sizes = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    return dealt.withColumn("__q", part).join(F.broadcast(sizes), F.col("__q") == F.col("__p")).withColumn(out, F.col("__before") + F.col("__id").bitwiseAND((1 << 33) - 1) + 1).drop("__q", "__p", "__before", "__id")


def scanned_by_rank(df: DataFrame, rank: str, value: Column, how: str, out: str, forward: bool = True, rows_a_bin: int = 100_000, keys: list[str] = ()) -> DataFrame:
    """The running value along a rank, over all rows or within keys, from the front or from the back."""
    at = F.col(rank) if forward else -F.col(rank)
    df = df.withColumn("__at", at).withColumn("__one", F.lit(0))
    return running(df, [*keys, "__one"], "__at", [], value, how, out, rows_a_bin).drop("__at", "__one")


def within(df: DataFrame, keys: list[str], order: list[Column], out: str) -> tuple[DataFrame, DataFrame]:
    """df with its row number within keys in a total order, and each key's size as __m; a key may hold all rows.

    Also the keys' table: keys, __off (the global rank before the key's first row), __m.
    """
    every = ranked(df, [*[F.asc(k) for k in keys], *order], "__g")
    sizes = every.groupBy(*keys).agg((F.min("__g") - 1).alias("__off"), F.count("*").alias("__m"))
    if not keys:
        n = sizes.first()["__m"]
        return every.withColumn(out, F.col("__g")).withColumn("__m", F.lit(n)).drop("__g"), sizes
    named = sizes.select(*[F.col(k).alias(f"__s{i}") for i, k in enumerate(keys)], "__off", "__m")
    same = [F.col(k).eqNullSafe(F.col(f"__s{i}")) for i, k in enumerate(keys)]
    met = every.join(named, reduce(lambda a, b: a & b, same)).withColumn(out, F.col("__g") - F.col("__off"))
    return met.drop("__g", "__off", *[f"__s{i}" for i in range(len(keys))]), sizes


def quantiles(df: DataFrame, column: str, wanted: dict[str, float], keys: list[str] = (), nearest: bool = False) -> DataFrame:
    """Exact quantiles of a column's values that aren't null, by rank: keys and one column each.

    The value at (n - 1) q, between two elements in proportion or, if nearest, at the rounded place.
    Rows are ranked by ranges; then the few wanted ranks are looked up. Without keys there is
    always one row; keys without values have none.
    """
    keys = list(keys)
    values = df.filter(F.col(column).isNotNull()).select(*keys, F.col(column).alias("__v"))
    every = written(ranked(values, [*[F.asc(k) for k in keys], F.asc("__v")], "__g"), "quantiles")
    sizes = every.groupBy(*keys).agg((F.min("__g") - 1).alias("__off"), F.count("*").alias("__m"))
    at = lambda q: F.round((F.col("__m") - 1) * q) if nearest else (F.col("__m") - 1) * F.lit(float(q))
    picks = [F.struct(F.lit(name).alias("name"), F.lit(side).alias("side"), (F.col("__off") + 1 + (F.floor if side == 0 else F.ceil)(at(q))).cast("long").alias("at"), (at(q) - F.floor(at(q))).alias("share")) for name, q in wanted.items() for side in (0, 1)]
    picks = sizes.filter("__m > 0").select(F.explode(F.array(*picks)).alias("p")).select("p.*")
    got = every.join(picks, F.col("__g") == F.col("at"))
    one = lambda name, side: F.max(F.when((F.col("name") == name) & (F.col("side") == side), F.col("__v")))
    share = lambda name: F.max(F.when(F.col("name") == name, F.col("share")))
    if nearest:
        return got.groupBy(*keys).agg(*[one(name, 0).alias(name) for name in wanted])
    low, high = (lambda name: one(name, 0).cast("double")), (lambda name: one(name, 1).cast("double"))
    return got.groupBy(*keys).agg(*[F.when(share(name) == 0, low(name)).otherwise(low(name) + (high(name) - low(name)) * share(name)).alias(name) for name in wanted])


def beside(df: DataFrame, more: DataFrame, keys: list[str] = ()) -> DataFrame:
    """The columns of two frames with a row a key, or with one row each."""
    keys = list(keys)
    left = df if keys else df.withColumn("__k", F.lit(0))
    right = more.select(*[F.col(k).alias(f"__r{i}") for i, k in enumerate(keys)], *[c for c in more.columns if c not in keys])
    right = right if keys else right.withColumn("__r0", F.lit(0))
    same = [F.col(k).eqNullSafe(F.col(f"__r{i}")) for i, k in enumerate(keys or ["__k"])]
    return left.join(right, reduce(lambda a, b: a & b, same), "left").drop("__k", *[f"__r{i}" for i in range(max(1, len(keys)))])


def asof(left: DataFrame, right: DataFrame, keys: list[str], at: str, values: list[str], tolerance: float | None, direction: str, width: float, ties: str | None = None) -> DataFrame:
    """left with the values of the right row at or before (backward), after (forward) or nearest to it.

    Both have the keys and the order column; right's columns come as right_*. Of right rows at the
    same place the greatest `ties` is taken (backward and forward). Nearest prefers the earlier.
    """
    both = left.withColumn("__l", F.monotonically_increasing_id())
    both = written(both, "asof")
    pick = F.struct(F.col(at).alias("at"), *([F.col(ties).alias("tie")] if ties else []), F.struct(*[F.col(v).alias(v) for v in values]).alias("v"))
    cells = right.filter(F.col(at).isNotNull()).withColumn("__pick", pick)
    events = both.select(*keys, F.col(at), F.col("__l"), F.lit(None).cast(cells.schema["__pick"].dataType).alias("__pick")).unionByName(cells.select(*keys, F.col(at), F.lit(None).cast("long").alias("__l"), "__pick"))
    out = both
    sides = {"backward": [("b", 1)], "forward": [("f", -1)], "nearest": [("b", 1), ("f", -1)]}[direction]
    for name, sign in sides:
        # right rows stand before left rows at the same place
        run = events.withColumn("__o", F.col(at).cast("double") * sign).withColumn("__side", F.when(F.col("__l").isNull(), 0).otherwise(1))
        run = _last(run, keys, width)
        found = run.filter("__l is not null").select(F.col("__l").alias("__j"), F.col("__last").alias(f"__{name}"))
        out = out.join(found, F.col("__l") == F.col("__j"), "left").drop("__j")
    if direction == "nearest":
        db, df_ = F.col(at) - F.col("__b.at"), F.col("__f.at") - F.col(at)
        got = F.when(df_.isNull() | (db <= df_), F.col("__b")).otherwise(F.col("__f"))
    else:
        got = F.col(f"__{sides[0][0]}")
    out = out.withColumn("__got", got)
    if tolerance is not None:
        out = out.withColumn("__got", F.when(F.abs(F.col("__got.at") - F.col(at)) <= tolerance, F.col("__got")))
    return out.select(*left.columns, F.col("__got.at").alias(f"right_{at}"), *[F.col("__got.v")[v].alias(f"right_{v}") for v in values])


def _last(events: DataFrame, keys: list[str], width: float) -> DataFrame:
    """The last pick that isn't null at or before each row in (order, side), by bins."""
    events = events.withColumn("__bin", F.floor(F.col("__o") / width))
    tie = ["__pick.tie"] if "tie" in events.schema["__pick"].dataType.names else []
    last = F.max(F.when(F.col("__pick").isNotNull(), F.struct("__o", *[F.col(t).alias("t") for t in tie], "__pick")))
    bins = events.groupBy(*keys, "__bin").agg(last.alias("__b"))
    before = Window.partitionBy(*keys).orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumn("__carry", F.last("__b.__pick", ignorenulls=True).over(before)).select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__bin").alias("__cb"), "__carry")
    same = F.col("__bin") == F.col("__cb")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    order = Window.partitionBy(*keys, "__bin").orderBy("__o", "__side", *tie).rowsBetween(Window.unboundedPreceding, 0)
    met = events.join(bins, same, "left").withColumn("__in", F.last("__pick", ignorenulls=True).over(order))
    return met.withColumn("__last", F.coalesce("__in", "__carry"))
