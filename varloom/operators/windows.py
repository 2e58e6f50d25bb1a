"""Duplicate resolution, ranked selection and scaling within groups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.variants import completeness, minimal_alleles
from ..runtime import written
from .scans import within


def best(df: DataFrame, keys: list[str], order: list[Column], out: str | None = None) -> DataFrame:
    """The first row of each key in a total order."""
    rn = out or "__rn"
    got = df.withColumn(rn, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col(rn) == 1)
    return got if out else got.drop(rn)


def best_value(df: DataFrame, keys: list[str], order: Column, values: list[str]) -> DataFrame:
    """Of each key the values of the row whose order is greatest, by a partial aggregation: no key's rows meet in one task."""
    got = df.groupBy(*keys).agg(F.max(F.struct(order.alias("o"), *[F.col(v) for v in values])).alias("x"))
    return got.select(*keys, *[F.col(f"x.{v}").alias(v) for v in values])


def least_row(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Of each key the whole row that is least in a total order of sortable values, by a partial aggregation."""
    values = F.struct(*[F.col(c) for c in df.columns if c not in keys]).alias("v")
    got = df.groupBy(*keys).agg(F.min(F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], values)).alias("x"))
    return got.select(*[F.col(c) if c in keys else F.col(f"x.v.{c}").alias(c) for c in df.columns])


def resolve_duplicates(df: DataFrame, chrom: str, pos: str, ea: str, oa: str, consistent: list[str], measures: list[str], sample_size: str, info: str, row: str, tolerance: float | None = None, most_broadcast: int = 200_000) -> DataFrame:
    """df with `duplicate_status`: null for rows that stay, else why a row goes.

    Key: chromosome, position and unordered alleles after trimming shared bases. Groups in both
    orientations go whole; so do groups whose consistent fields differ; else the most complete
    row stays, then the largest sample, the best info, the least row id (of any type that sorts).
    """
    ends = minimal_alleles(F.col(pos), F.col(ea), F.col(oa))
    df = df.withColumn("__t", ends).withColumn("__low", F.least("__t.a", "__t.b")).withColumn("__high", F.greatest("__t.a", "__t.b")).withColumn("__pos", F.col("__t.pos"))
    key = [chrom, "__pos", "__low", "__high"]
    turned = (F.col("__t.a") > F.col("__t.b")).cast("int")
    if tolerance is None:
        conflict = [F.min(c) != F.max(c) for c in consistent]
    else:
        conflict = [F.max(c) - F.min(c) > tolerance * F.greatest(F.abs(F.max(c)), F.abs(F.min(c))) for c in consistent]
    last = lambda c: F.coalesce(-F.col(c).cast("double"), F.lit(float("inf")))
    score = F.struct((-completeness(*[F.col(m) for m in measures])).alias("c"), last(sample_size).alias("n"), last(info).alias("i"), F.col(row).alias("r"))
    groups = df.groupBy(*key).agg(F.count("*").alias("__m"), (F.min(turned) != F.max(turned)).alias("__swap"), reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in conflict], F.lit(False)).alias("__differ"), F.min(score).alias("__best"))
    groups = groups.filter("__m > 1").select(*[F.col(k).alias(f"__g{i}") for i, k in enumerate(key)], "__swap", "__differ", F.col("__best.r").alias("__keep"))
    met = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__g{i}")) for i, k in enumerate(key)])
    # repeated keys are few as a rule: then no row is shuffled for them
    groups = written(groups, "repeated")
    out = df.join(F.broadcast(groups) if groups.count() <= most_broadcast else groups, met, "left")
    status = F.when(F.col("__swap"), "swapped_orientation_duplicate").when(F.col("__differ"), "conflicting_duplicate").when(F.col("__keep") != F.col(row), "duplicate_variant")
    return out.withColumn("duplicate_status", status).drop("__t", "__low", "__high", "__pos", "__g0", "__g1", "__g2", "__g3", "__swap", "__differ", "__keep")


def resolve_identifiers(df: DataFrame, identifier: str, policy: str, score: Column | None = None, row: str | None = None, tolerance: float = 1e-12) -> DataFrame:
    """One row an identifier by policy: allow, error, exclude_all, unique_best or first_best.

    Equal rows count once. unique_best keeps a row only if its score is the strict maximum, by more
    than the tolerance; ties and missing scores drop the group. first_best takes the greatest
    score, nulls last, then the first row.
    """
    if policy == "allow":
        return df
    df = df.dropDuplicates([c for c in df.columns if c != row])
    if policy == "error":
        if not df.groupBy(identifier).count().filter("count > 1").isEmpty():
            raise ValueError(f"{identifier} repeats")
        return df
    if policy == "exclude_all":
        alone = df.groupBy(F.col(identifier).alias("__i")).count().filter("count = 1").drop("count")
        return df.join(alone, F.col(identifier) == F.col("__i"), "left_semi")
    if policy == "first_best":
        return best(df, [identifier], [score.desc_nulls_last(), F.col(row).asc()])
    if policy != "unique_best":
        raise ValueError(f"unknown policy: {policy}")
    df = df.withColumn("__s", score)
    w = Window.partitionBy(identifier)
    top = F.max("__s").over(w)
    tied = F.sum((top - F.col("__s") <= tolerance).cast("int")).over(w)
    gap = F.count(F.when(F.col("__s").isNull(), 1)).over(w)
    return df.withColumn("__top", top).withColumn("__tied", tied).withColumn("__gap", gap).filter("__s = __top and __tied = 1 and __gap = 0").drop("__s", "__top", "__tied", "__gap")


def with_count(df: DataFrame, keys: list[str], out: str) -> DataFrame:
    """Each row's group size; counted by aggregation first, so that a large group is no large window."""
    n = df.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.count("*").alias(out))
    met = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return df.join(n, met).drop(*[f"__{k}" for k in keys])


def palindromic_evidence(candidates: DataFrame, row: str, frequency: str, reference: str, low: float = 0.4, high: float = 0.6, most: float = 0.1, margin: float = 0.2) -> DataFrame:
    """Candidates with `state` of their row and whether they are its `winner`.

    A row is resolved if all candidates have both frequencies outside (low, high), the least error
    is at most `most`, and one candidate alone lies within `margin` of it.
    """
    f, r = F.col(frequency), F.col(reference)
    usable = f.isNotNull() & r.isNotNull() & ~F.isnan(f) & ~F.isnan(r)
    band = usable & ((f > low) & (f < high) | (r > low) & (r < high))
    w = Window.partitionBy(row)
    df = candidates.withColumn("__e", F.when(usable & ~band, F.abs(f - r)))
    df = df.withColumn("__least", F.min("__e").over(w)).withColumn("__bad", F.max((~usable).cast("int")).over(w)).withColumn("__band", F.max(band.cast("int")).over(w))
    df = df.withColumn("__near", F.sum((F.col("__e") <= F.col("__least") + margin).cast("int")).over(w))
    state = F.when(F.col("__bad") == 1, "unusable_frequency").when(F.col("__band") == 1, "ambiguous_frequency_band").when(F.col("__least") > most, "maximum_difference_exceeded").when(F.col("__near") != 1, "insufficient_error_margin").otherwise("resolved")
    df = df.withColumn("state", state).withColumn("winner", (F.col("state") == "resolved") & (F.col("__e") == F.col("__least")))
    return df.drop("__e", "__least", "__bad", "__band", "__near")


def top_per_block(df: DataFrame, block: str, score: str, identifier: str, least: float) -> tuple[DataFrame, DataFrame]:
    """The strongest row of each block at or over the threshold, and such rows without a block."""
    strong = df.filter(F.col(score) >= least)
    return best(strong.filter(F.col(block).isNotNull()), [block], [F.desc(score), F.asc(identifier)]), strong.filter(F.col(block).isNull())


def block_bounds(block: Column) -> tuple[Column, Column]:
    """Start and end at the end of a block's name, _start_end."""
    return tuple(F.nullif(F.regexp_extract(block, r"_(\d+)_(\d+)$", g), F.lit("")).try_cast("bigint") for g in (1, 2))


def credible(df: DataFrame, keys: list[str], probability: str, coverage: float, ties: list[str]) -> DataFrame:
    """Rows by falling probability through the first whose sum exceeds the coverage."""
    w = Window.partitionBy(*keys).orderBy(F.desc(probability), *ties).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("__before", F.coalesce(F.sum(probability).over(w), F.lit(0.0))).filter(F.col("__before") <= coverage).drop("__before")


def credible_95(df: DataFrame, keys: list[str], probability: str, ties: list[str], order: list[str] = ()) -> DataFrame:
    """All rows if the group's sum is under .95; else, rescaled if over 1, those whose rising sum is .05 or more.

    A sum of floats depends on the order of its terms, and groups may lie at the very thresholds:
    the group's sum is taken in the order given, by default that of the rising sum.
    """
    rising = [F.asc(probability), *ties]
    group = Window.partitionBy(*keys).orderBy(*(order or rising)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    upto = Window.partitionBy(*keys).orderBy(*rising).rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("__sum", F.sum(probability).over(group))
    scaled = F.when(F.col("__sum") > 1, F.col(probability) / F.col("__sum")).otherwise(F.col(probability))
    return df.withColumn("__cum", F.sum(scaled).over(upto)).filter((F.col("__sum") < 0.95) | (F.col("__cum") >= 0.05)).drop("__sum", "__cum")


def with_average_rank(df: DataFrame, keys: list[str], column: str, out: str, descending: bool = False) -> DataFrame:
    """Ranks within keys, ties sharing their mean; rows are ranked by ranges, so a key may hold all rows."""
    made, _ = within(df, keys, [F.desc(column) if descending else F.asc(column)], "__r")
    made = written(made.drop("__m"), "ranks")
    names = [*keys, column]
    ties = made.groupBy(*[F.col(k).alias(f"__t{i}") for i, k in enumerate(names)]).agg((F.min("__r") + (F.count("*") - 1) / 2).alias(out))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__t{i}")) for i, k in enumerate(names)])
    return made.join(ties, same).drop("__r", *[f"__t{i}" for i in range(len(names))])


def relevance(df: DataFrame, name: str, score: str, p: str, out: str = "relevance", width: int = 27) -> DataFrame:
    """Average falling rank over n, halved for p over .05, doubled for p at most .05 / n; names are cut to `width`."""
    n = F.lit(df.count())
    df = with_average_rank(df, [], score, "__rank", descending=True)
    value = F.col("__rank") / n * F.when(F.col(p) > 0.05, 0.5).when(F.col(p) <= 0.05 / n, 2.0).otherwise(1.0)
    return df.withColumn(out, value).withColumn(name, F.substring(name, 1, width)).drop("__rank")


def scaled_in_group(df: DataFrame, keys: list[str], column: str, out: str, distance: bool = False) -> DataFrame:
    """Min-max scaling: distances inverted, constants 1, positive columns over their range, all-zero ones copied."""
    w = Window.partitionBy(*keys)
    low, high, x = F.min(column).over(w), F.max(column).over(w), F.col(column)
    if distance:
        value = F.when(high == low, 1.0).otherwise((high - x) / (high - low))
    else:
        value = F.when(high == 0, x.cast("double")).when(high == low, 1.0).otherwise((x - low) / (high - low))
    return df.withColumn(out, value)


def biallelic(df: DataFrame, chrom: str, pos: str, ref: str, alt: str, out: str = "biallelic") -> DataFrame:
    """Whether a site has one unordered pair of plain alleles."""
    pair = F.struct(F.least(ref, alt), F.greatest(ref, alt))
    sites = df.groupBy(F.col(chrom).alias("__c"), F.col(pos).alias("__p")).agg((F.min(pair) == F.max(pair)).alias("__one"), F.min((F.col(ref).rlike("^[ACGT]+$") & F.col(alt).rlike("^[ACGT]+$")).cast("int")).alias("__dna"))
    return df.join(sites, (F.col(chrom) == F.col("__c")) & (F.col(pos) == F.col("__p")), "left").withColumn(out, F.coalesce(F.col("__one") & (F.col("__dna") == 1), F.lit(False))).drop("__c", "__p", "__one", "__dna")


def ranked_best_model(df: DataFrame, locus: str, posterior: str, k: str, name: str, valid: str) -> DataFrame:
    """A locus's model of greatest posterior, then least k, then name; any invalid model spoils its locus."""
    bad = df.groupBy(F.col(locus).alias("__l")).agg(F.min(F.col(valid).cast("int")).alias("__ok")).filter("__ok = 0")
    return best(df.join(bad, F.col(locus) == F.col("__l"), "left_anti"), [locus], [F.desc(posterior), F.asc(k), F.asc(name)])
