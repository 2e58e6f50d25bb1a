"""Statistics and quality reports, each in one or two passes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.variants import finite, snp, transition, transversion
from .ledger import Rule
from .scans import beside, quantiles
from .windows import with_average_rank


def guarded_corr(x: Column, y: Column) -> Column:
    """Pearson's correlation in [-1, 1], null for constants and under two pairs."""
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x), F.when(both, y)
    ok = (F.count(a) >= 2) & (F.min(a) != F.max(a)) & (F.min(b) != F.max(b))
    return F.when(ok, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b)))))


def moments(df: DataFrame, x: str, y: str, groups: list[str] = ()) -> DataFrame:
    """The state of two columns' moments over complete pairs: n, mean_x, mean_y and centred sums sxx, syy, sxy.

    States can be stored and pooled with others of the same groups.
    """
    both = finite(F.col(x)) & finite(F.col(y))
    a, b = F.when(both, F.col(x).cast("double")), F.when(both, F.col(y).cast("double"))
    n = F.count(a)
    return df.groupBy(*groups).agg(n.alias("n"), F.avg(a).alias("mean_x"), F.avg(b).alias("mean_y"), (F.var_pop(a) * n).alias("sxx"), (F.var_pop(b) * n).alias("syy"), (F.covar_pop(a, b) * n).alias("sxy"))


def pooled_moments(states: DataFrame, groups: list[str] = ()) -> DataFrame:
    """One state a group out of several: centred sums add up, with what the means differ by from the common mean."""
    groups, held = list(groups), states.filter("n > 0")
    mean = lambda c: (F.sum(F.col("n") * F.col(c)) / F.sum("n")).alias(f"__{c}")
    met = beside(held, held.groupBy(*groups).agg(mean("mean_x"), mean("mean_y")), groups)
    dx, dy = F.col("mean_x") - F.col("__mean_x"), F.col("mean_y") - F.col("__mean_y")
    total = lambda c, d: F.sum(F.col(c) + F.col("n") * d).alias(c)
    return met.groupBy(*groups).agg(F.sum("n").alias("n"), F.first("__mean_x").alias("mean_x"), F.first("__mean_y").alias("mean_y"), total("sxx", dx * dx), total("syy", dy * dy), total("sxy", dx * dy))


def pearson_of(states: DataFrame, out: str = "pearson") -> DataFrame:
    """Pearson's correlation from moments, null for constants and under two pairs."""
    ok = (F.col("n") >= 2) & (F.col("sxx") > 0) & (F.col("syy") > 0)
    return states.withColumn(out, F.when(ok, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("sxy") / F.sqrt(F.col("sxx") * F.col("syy"))))))


def concordance(df: DataFrame, expected: str, observed: str, tolerance: tuple[float, float] = (1e-6, 1e-3), groups: list[str] = ()) -> DataFrame:
    """Rows, eligible, concordant, differences, RMSE and Pearson of two columns, overall or by group."""
    e, o = F.col(expected), F.col(observed)
    ok = finite(e) & finite(o)
    d = F.when(ok, F.abs(o - e))
    x, y = F.when(ok, e), F.when(ok, o)
    fits = ok & (F.abs(o - e) <= tolerance[0] + tolerance[1] * F.abs(e))
    aggs = [
        F.count("*").alias("rows"),
        F.count_if(finite(e)).alias("eligible"),
        F.count_if(ok).alias("checked"),
        F.count_if(fits).alias("concordant"),
        F.avg(d).alias("mean_difference"),
        F.max(d).alias("max_difference"),
        F.sqrt(F.avg(d * d)).alias("rmse"),
        guarded_corr(x, y).alias("pearson"),
        F.avg(F.when(ok, (F.signum(e) == F.signum(o)).cast("double"))).alias("same_sign"),
    ]
    return beside(df.groupBy(*groups).agg(*aggs), quantiles(df.withColumn("__d", d), "__d", {"median_difference": 0.5}, groups), groups)


def spearman(df: DataFrame, x: str, y: str, groups: list[str] = ()) -> DataFrame:
    """Spearman's correlation: Pearson's of average ranks over complete pairs."""
    ok = df.filter(finite(F.col(x)) & finite(F.col(y)))
    r = with_average_rank(with_average_rank(ok, list(groups), x, "__rx"), list(groups), y, "__ry")
    return (r.groupBy(*groups) if groups else r).agg(guarded_corr(F.col("__rx"), F.col("__ry")).alias("spearman"))


def frequency_summary(df: DataFrame, column: str) -> DataFrame:
    """Counts by range and state, and exact statistics of the values in [0, 1]; quantiles are the nearest element."""
    x = F.col(column)
    ok = finite(x) & (x >= 0) & (x <= 1)
    v = F.when(ok, x)
    got = df.agg(
        F.count("*").alias("rows"),
        F.count_if(x.isNull()).alias("missing"),
        F.count_if(F.coalesce(x.isNotNull() & ~finite(x), F.lit(False))).alias("non_finite"),
        F.count_if(F.coalesce(finite(x) & ((x < 0) | (x > 1)), F.lit(False))).alias("out_of_range"),
        F.min(v).alias("least"),
        F.max(v).alias("most"),
        F.avg(v).alias("mean"),
        F.try_divide(F.count_if(F.coalesce(v <= 0.5, F.lit(False))), F.count(v)).alias("minor_fraction"),
    )
    return with_median(got, df, v)


def with_median(got: DataFrame, df: DataFrame, value: Column, name: str = "median") -> DataFrame:
    """The one row of got and the exact median of value over df."""
    return beside(got, quantiles(df.select(value.alias("__x")), "__x", {name: 0.5}))


def median(df: DataFrame, value: Column) -> float | None:
    return (quantiles(df.select(value.alias("__x")), "__x", {"m": 0.5}).first() or [None])[0]


def nearest_quantiles(df: DataFrame, column: str, wanted: list[float], keys: list[str] = ()) -> DataFrame:
    """The sorted value at round((n - 1) q) of each key."""
    return quantiles(df.filter(finite(F.col(column))), column, {f"q{int(round(q * 100))}": q for q in wanted}, keys, nearest=True)


def effect_statistics(df: DataFrame, effect: str) -> DataFrame:
    """Rows, finite, negative, zero, least, most, mean, median, standard deviation of the finite values."""
    x = F.col(effect)
    v = F.when(finite(x), x)
    got = df.agg(F.count("*").alias("rows"), F.count(x).alias("present"), F.count(v).alias("finite"), F.count_if(v < 0).alias("negative"), F.count_if(v == 0).alias("zero"), F.count_if(v <= 0).alias("non_positive"), F.min(v).alias("least"), F.max(v).alias("most"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("sd"))
    return with_median(got, df, v)


def p_statistics(df: DataFrame, p: str, threshold: float = 1.0) -> DataFrame:
    x = F.col(p)
    v = F.when(finite(x), x)
    got = df.agg(F.count("*").alias("rows"), F.count(v).alias("finite"), F.count_if(v > threshold).alias("above"), F.count_if(v < 0).alias("negative"), F.count_if(v == 0).alias("zero"), F.min(v).alias("least"), F.max(v).alias("most"))
    return with_median(got, df, v)


def info_statistics(df: DataFrame, info: str) -> DataFrame:
    x = F.col(info)
    v = F.when(finite(x), x)
    return df.agg(F.count("*").alias("rows"), F.count(v).alias("finite"), F.count_if(v < 0).alias("below_0"), F.count_if((v >= 0) & (v <= 1.05)).alias("unit"), F.count_if((v > 1.05) & (v <= 2)).alias("to_2"), F.count_if(v > 2).alias("above_2"), F.sum(v).alias("total"), F.min(v).alias("least"), F.max(v).alias("most"))


def sample_size_statistics(df: DataFrame, n: str, quantile: float = 0.9) -> DataFrame:
    return beside(df.agg(F.avg(n).alias("mean"), F.stddev_samp(n).alias("sd")), quantiles(df, n, {"reference": quantile}))


def quality_assessment(df: DataFrame, rules: list[Rule], ref: str, alt: str, n: str, sd_multiplier: float = 5.0) -> DataFrame:
    """Two scans: sample-size statistics, then per stage (raw, after rules) counts of classes and outliers.

    Returns one row per stage; rule counts come from ledger.attribution.
    """
    stat = df.agg(F.avg(n).alias("mean"), F.stddev_samp(n).alias("sd")).first()
    mean, sd = stat["mean"], stat["sd"] or 0.0
    fails = reduce(lambda a, b: a | b, [r.hit() for r in rules], F.lit(False))
    a, b, x = F.col(ref), F.col(alt), F.col(n)
    stages = df.withColumn("__stage", F.explode(F.when(fails, F.array(F.lit("raw"))).otherwise(F.array(F.lit("raw"), F.lit("passed")))))
    out = stages.groupBy(F.col("__stage").alias("stage")).agg(
        F.count("*").alias("records"),
        F.count_if(snp(a, b)).alias("snps"),
        F.count_if(transition(a, b)).alias("transitions"),
        F.count_if(transversion(a, b)).alias("transversions"),
        F.count_if(x.isNull()).alias("missing_n"),
        F.min(x).alias("least_n"),
        F.max(x).alias("most_n"),
        F.count_if(F.abs(x - F.lit(mean)) > F.lit(sd_multiplier * sd)).alias("n_outliers"),
    )
    return out.withColumn("ts_tv", F.when(F.col("transversions") > 0, F.col("transitions") / F.col("transversions")))


def reason_matrix(rejects: DataFrame, reasons: list[str], reason: str, column: str, values: list[str]) -> DataFrame:
    """Registered reasons by column value, zeros included, with row totals and a TOTAL row."""
    spark = rejects.sparkSession
    named = spark.createDataFrame([(r,) for r in reasons], "reason string")
    got = rejects.groupBy(F.col(reason).alias("__r")).pivot(column, values).count()
    got = named.join(got, F.col("reason") == F.col("__r"), "left").drop("__r").fillna(0)
    got = got.withColumn("total", reduce(lambda a, b: a + b, [F.col(f"`{v}`") for v in values]))
    return got.unionByName(got.agg(F.lit("TOTAL").alias("reason"), *[F.sum(f"`{v}`").alias(v) for v in [*values, "total"]]))


def pivoted_metrics(long: DataFrame, keys: list[str], column: str, values: list[str], value: str) -> DataFrame:
    return long.groupBy(*keys).pivot(column, values).agg(F.first(value, ignorenulls=True))


def field_completeness(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per field: present, missing and the missing fraction, from one aggregation."""
    one = df.agg(F.count("*").alias("__n"), *[F.count(c).alias(c) for c in columns])
    long = one.select("__n", F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("present")) for c in columns])).alias("x"))
    return long.select("x.field", "x.present", (F.col("__n") - F.col("x.present")).alias("missing"), F.when(F.col("__n") > 0, (F.col("__n") - F.col("x.present")) / F.col("__n")).alias("missing_fraction"))


def filled_sample_size(df: DataFrame, n: str, action: str = "remove") -> DataFrame:
    """Missing sample sizes removed, filled by the median or mean of the whole table, or an error."""
    if action == "remove":
        return df.filter(F.col(n).isNotNull())
    if action == "fail":
        if not df.filter(F.col(n).isNull()).isEmpty():
            raise ValueError(f"{n} is missing")
        return df
    fill = median(df, F.col(n)) if action == "median" else df.agg(F.avg(n)).first()[0]
    return df.withColumn(n, F.coalesce(F.col(n).cast("double"), F.lit(fill).cast("double")))


def above_median_fraction(df: DataFrame, n: str, fraction: float) -> DataFrame:
    """Rows whose n is at least the fraction of the whole table's median."""
    return df.filter(F.col(n) >= F.lit((median(df, F.col(n)) or 0.0) * fraction))


def prevalence(df: DataFrame, cases: str, controls: str, how: str = "median") -> DataFrame:
    c, k = F.col(cases), F.col(controls)
    share = F.when((c > 0) & (k > 0), c / (c + k))
    got = df.agg(F.avg(share).alias("prevalence"), F.min(c).alias("least_cases"), F.max(c).alias("most_cases"), F.min(k).alias("least_controls"), F.max(k).alias("most_controls"))
    return with_median(got.drop("prevalence"), df, share, "prevalence") if how == "median" else got


def study_design(df: DataFrame, cases: str, controls: str) -> str:
    c, k = df.agg(F.count(cases), F.count(controls)).first()
    if c and not k:
        raise ValueError("cases are given and controls are all missing")
    return "binary" if c else "quantitative"


def type_counts(df: DataFrame, ref: str, alt: str) -> DataFrame:
    a, b = F.col(ref), F.col(alt)
    kind = F.when(snp(a, b), "snp").when(F.length(a) != F.length(b), "indel").otherwise("other")
    return df.groupBy(kind.alias("variant_type")).agg(F.count("*").alias("n"))


def group_checks(df: DataFrame, key: str, declared: str, item: str, probability: str, tolerance: float = 1e-8) -> DataFrame:
    """Groups that break a rule: as many rows as declared, no item twice, probabilities that sum to one."""
    got = df.groupBy(key).agg(F.count("*").alias("rows"), F.min(declared).alias("low"), F.max(declared).alias("high"), F.count_distinct(item).alias("items"), F.sum(probability).alias("mass"))
    return got.withColumn("problem", F.when((F.col("low") != F.col("high")) | (F.col("rows") != F.col("low")), "count").when(F.col("items") != F.col("rows"), "repeated").when(F.abs(F.col("mass") - 1) > tolerance, "mass")).filter("problem is not null")


def population_similarity(df: DataFrame, study: str, populations: list[str]) -> DataFrame:
    """Per population: pairs, missing, Pearson and mean absolute difference, from one aggregation."""
    s = F.col(study)
    one = []
    for p in populations:
        ok = finite(s) & finite(F.col(p))
        x, y = F.when(ok, s), F.when(ok, F.col(p))
        one.append(F.struct(F.lit(p).alias("population"), F.count(x).alias("pairs"), F.count_if(~finite(F.col(p))).alias("missing"), guarded_corr(x, y).alias("pearson"), F.avg(F.abs(x - y)).alias("mae")))
    return df.agg(F.array(*one).alias("x")).select(F.explode("x").alias("x")).select("x.*")


def sign_discordance(df: DataFrame, beta: str, z: str) -> DataFrame:
    b, y = F.col(beta), F.col(z)
    ok = finite(b) & finite(y) & (b != 0) & (y != 0)
    return df.agg(F.count_if(ok).alias("comparable"), F.count_if(ok & (F.signum(b) != F.signum(y))).alias("discordant")).withColumn("fraction", F.when(F.col("comparable") > 0, F.col("discordant") / F.col("comparable")))


def ordered_union(df: DataFrame, key: str, members: str, order: str) -> DataFrame:
    """Per key the members of its lists, in order of first sight."""
    got = df.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order, members))).alias("x"))
    return got.select(key, F.array_distinct(F.flatten(F.transform("x", lambda s: s[members]))).alias(members))
