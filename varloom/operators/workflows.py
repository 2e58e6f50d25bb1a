"""Operators composed of the others: diagnostics, donor imputation, gene and set annotation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import close, imputed_from_ld
from ..functions.variants import DNA, allele, canonical_chromosome, clump_chromosome, integral_position, palindromic
from ..runtime import written
from . import joins, ranges, windows
from .corrections import adjusted
from .ledger import Ledger, Rule


def normalised(df: DataFrame, missing: tuple[str, ...], keep: tuple[str, ...] = ()) -> DataFrame:
    """All string columns trimmed, missing tokens null."""
    from ..functions.variants import trimmed_string

    return df.select(*[trimmed_string(F.col(c), missing).alias(c) if t == "string" and c not in keep else F.col(c) for c, t in df.dtypes])


def distinct_roles(mapping: dict[str, str]) -> dict[str, str]:
    """Roles to columns, an error where unrelated roles share one."""
    seen: dict[str, str] = {}
    for role, column in mapping.items():
        if column in seen:
            raise ValueError(f"{role} and {seen[column]} both use {column}")
        seen[column] = role
    return mapping


def header_mapping(header: list[str], aliases: dict[str, list[str]]) -> tuple[dict[str, str], list[str]]:
    """Each role's column by the first alias that the header has, and the roles without one."""
    lower = {h.strip().lower(): h for h in header}
    found = {role: next((lower[a.lower()] for a in names if a.lower() in lower), None) for role, names in aliases.items()}
    return {r: c for r, c in found.items() if c}, [r for r, c in found.items() if not c]


def contig_spelling(contigs: list[str], wanted: str) -> str:
    """The spelling of a chromosome, with or without chr, that a file has."""
    bare = wanted.removeprefix("chr")
    for name in (wanted, bare, f"chr{bare}"):
        if name in contigs:
            return name
    raise ValueError(f"no contig is {wanted}")


def scoped_genes(genes: DataFrame, chrom: str, start: str, end: str, excluded: list[str], region: tuple[str, int, int] | None) -> tuple[DataFrame, DataFrame]:
    """Genes outside excluded chromosomes and not overlapping the region, and the others with the reason."""
    why = F.when(F.col(chrom).isin(*excluded) if excluded else F.lit(False), "chromosome")
    if region:
        why = why.when((F.col(chrom) == region[0]) & (F.col(end) >= region[1]) & (F.col(start) <= region[2]), "region")
    out = genes.withColumn("excluded_by", why)
    return out.filter("excluded_by is null").drop("excluded_by"), out.filter("excluded_by is not null")


def position_diagnostics(inputs: DataFrame, records: DataFrame, keys: list[str], metrics: dict[str, tuple[float, float]]) -> DataFrame:
    """Unmatched inputs and records that stand alone at one place: per metric whether they agree, and a reason."""
    lone = lambda d: windows.with_count(d, keys, "__m").filter("__m = 1").drop("__m")
    a, b = lone(inputs), lone(records)
    b = b.select(*[F.col(k).alias(f"__{k}") for k in keys], *[F.col(m).alias(f"record_{m}") for m in metrics])
    got = a.join(b, reduce(lambda x, y: x & y, [F.col(k) == F.col(f"__{k}") for k in keys])).drop(*[f"__{k}" for k in keys])
    for m, (absolute, relative) in metrics.items():
        got = got.withColumn(f"{m}_agrees", F.coalesce(close(F.col(f"record_{m}"), F.col(m), absolute, relative), F.lit(False)))
        got = got.withColumn(f"{m}_negated", F.coalesce(close(-F.col(f"record_{m}"), F.col(m), absolute, relative), F.lit(False)))
    all_agree = reduce(lambda x, y: x & y, [F.col(f"{m}_agrees") for m in metrics])
    all_turned = reduce(lambda x, y: x & y, [F.col(f"{m}_negated") for m in metrics])
    return got.withColumn("diagnosis", F.when(all_agree, "alleles_differ").when(all_turned, "sign_turned").otherwise("metrics_differ"))


def reference_variants(study: DataFrame, reference: DataFrame, identifier: str, a1: str, a2: str, rank: list[Column]) -> DataFrame:
    """One allele-compatible study row an identifier of the reference; palindromes go."""
    r = reference.select(F.col(identifier).alias("__i"), F.least(a1, a2).alias("__x"), F.greatest(a1, a2).alias("__y"))
    got = study.filter(~palindromic(F.col(a1), F.col(a2))).join(r, (F.col(identifier) == F.col("__i")) & (F.least(a1, a2) == F.col("__x")) & (F.greatest(a1, a2) == F.col("__y")), "left_semi")
    return windows.best(got, [identifier], rank)


def imputed(typed: DataFrame, pairs: DataFrame, identifier: str, donors: list[str], least_r2: float) -> DataFrame:
    """Effects of untyped variants from their typed partner of greatest r2, with the donors' columns averaged.

    pairs: id1 (typed), id2, maf1, maf2, r2, dprime. typed: identifier, beta, se and the donor columns.
    """
    p = pairs.filter(F.col("r2") >= least_r2).join(typed, F.col("id1") == F.col(identifier))
    p = p.join(typed.select(F.col(identifier).alias("__known")), F.col("id2") == F.col("__known"), "left_anti")
    p = p.withColumn("__x", imputed_from_ld(F.col("r2"), F.col("dprime"), F.col("maf1"), F.col("maf2"), F.col("beta"), F.col("se")))
    top = F.max(F.struct("r2", (F.lit(0) - F.length("id1")).alias("l"), F.col("id1").alias("i"), F.col("__x").alias("x"))).alias("top")
    got = p.groupBy("id2").agg(top, *[F.avg(d).alias(f"mean_{d}") for d in donors])
    return got.select(F.col("id2").alias(identifier), F.col("top.i").alias("donor"), F.col("top.r2").alias("r2"), "top.x.*", *[f"mean_{d}" for d in donors])


def imputed_from_panels(typed: DataFrame, panels: dict[str, tuple[DataFrame, dict[str, str]]], chosen: list[str], identifier: str, donors: list[str], least_r2: float) -> DataFrame:
    """``imputed`` by each chosen panel, combined: an untyped variant's estimate of greatest r2, then of the panel named first.

    panels: name to (pairs, their columns by the names that ``imputed`` knows); unknown names are an
    error. `panels` counts those that had the variant.
    """
    unknown = [p for p in chosen if p not in panels]
    if unknown or not chosen:
        raise ValueError(f"unknown panels: {unknown}" if unknown else "no panel is chosen")
    parts = []
    for place, name in enumerate(chosen):
        pairs, columns = panels[name]
        pairs = pairs.select(*[F.col(columns.get(c, c)).alias(c) for c in ("id1", "id2", "maf1", "maf2", "r2", "dprime")])
        parts.append(imputed(typed, pairs, identifier, donors, least_r2).withColumn("panel", F.lit(name)).withColumn("__place", F.lit(-place)))
    every = reduce(DataFrame.unionByName, parts)
    values = [c for c in every.columns if c not in (identifier, "__place")]
    best = every.groupBy(identifier).agg(F.max(F.struct("r2", "__place", F.struct(*values).alias("v"))).alias("x"), F.count("*").alias("panels"))
    return best.select(identifier, "x.v.*", "panels")


def with_gene_metadata(results: DataFrame, locations: DataFrame, key: str) -> DataFrame:
    """Results with their gene's columns, each gene exactly once in the locations."""
    got = windows.with_count(locations, [key], "__m").withColumnRenamed(key, "__k")
    out = results.join(got, F.col(key) == F.col("__k"), "left")
    if not out.filter("__m is null or __m > 1").isEmpty():
        raise ValueError("genes are missing from the locations or repeated in them")
    return out.drop("__m", "__k")


def best_element(results: DataFrame, mapping: DataFrame, element: str, gene: str, p: str) -> DataFrame:
    """Per gene its element of least p, then least element, and how many it has."""
    got = results.join(mapping.select(F.col(element).alias("__e"), gene).distinct(), F.col(element) == F.col("__e")).filter(F.col(p).isNotNull())
    one = got.groupBy(gene).agg(F.min(F.struct(p, element)).alias("x"), F.count("*").alias("elements"))
    return one.select(gene, F.col(f"x.{element}").alias(element), F.col(f"x.{p}").alias(p), "elements")


def annotated_sets(members: DataFrame, results: DataFrame, name: str, gene: str, p: str) -> DataFrame:
    """Per set: members, those tested with their p by gene, and those untested."""
    r = results.select(F.col(gene).alias("__g"), F.col(p).alias("__p"))
    got = members.select(name, gene).distinct().join(r, F.col(gene) == F.col("__g"), "left")
    tested = F.col("__g").isNotNull()
    return got.groupBy(name).agg(
        F.count("*").alias("members"),
        F.count_if(tested).alias("tested"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(tested, F.struct(gene, "__p")))), lambda s: F.concat_ws("=", s[gene].cast("string"), F.round(s["__p"], 6).cast("string"))), ";").alias("tested_genes"),
        F.array_join(F.array_sort(F.collect_list(F.when(~tested, F.col(gene)))).cast("array<string>"), ";").alias("untested_genes"),
    )


def qtl_scores(credible: DataFrame, qtl: DataFrame, chrom: str, pos: str, a1: str, a2: str, pip: str, qtl_id: str, gene: str, scores: list[str], wildcard: bool = False) -> DataFrame:
    """Sum and greatest of score times probability by gene, over pairs that share an id in either allele order (or by place alone)."""
    ids = [F.concat_ws("_", chrom, F.col(pos).cast("string"), a1, a2), F.concat_ws("_", chrom, F.col(pos).cast("string"), a2, a1)]
    if wildcard:
        ids.append(F.concat_ws("_", chrom, F.col(pos).cast("string"), F.lit("X"), F.lit("X")))
    got = credible.withColumn("__id", F.explode(F.array(*ids))).join(qtl, F.col("__id") == F.col(qtl_id))
    return got.groupBy(gene).agg(*[f(F.col(s) * F.col(pip)).alias(f"{s}_{n}") for s in scores for n, f in (("sum", F.sum), ("max", F.max))])


def long_sets(wide: DataFrame, keys: list[str], pairs: list[tuple[str, str]]) -> DataFrame:
    """Wide (variant, probability) column pairs as rows (set, variant, probability)."""
    one = F.explode(F.array(*[F.struct(F.lit(i + 1).alias("set"), F.col(v).cast("string").alias("variant"), F.col(p).cast("double").alias("probability")) for i, (v, p) in enumerate(pairs)])).alias("x")
    return wide.select(*keys, one).select(*keys, "x.*").filter("variant is not null and probability is not null")


def row_extremes(df: DataFrame, columns: list[str]) -> DataFrame:
    """The greatest and the sum over columns of a row; null counts as zero in the sum."""
    return df.withColumn("row_max", F.greatest(*columns)).withColumn("row_sum", reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0.0)) for c in columns]))


def result_family(df: DataFrame, name: str, p: str, expected: list[str], methods: tuple[str, ...] = ("bonferroni", "fdr_bh")) -> DataFrame:
    """Results of exactly the expected hypotheses, corrected together; anything else is an error."""
    e = df.sparkSession.createDataFrame([(x,) for x in expected], "__e string")
    if df.count() != len(expected) or not df.join(e, F.col(name) == F.col("__e"), "left_anti").isEmpty():
        raise ValueError("the results aren't those expected")
    return adjusted(df, p, methods, family=[], ties=[name])


def feature_frame(df: DataFrame, locus: str, distance: str, columns: list[str], most: float = 750_000, keep: Column | None = None) -> DataFrame:
    """Genes near a locus with each feature scaled within it, missing ones zero."""
    out = df.filter(F.abs(distance) <= most)
    if keep is not None:
        out = out.filter(keep)
    for c in columns:
        out = windows.scaled_in_group(out, [locus], c, f"rel_{c}", distance=c == distance)
    return out.fillna(0.0, [f"rel_{c}" for c in columns])


def chromosome_of(c: Column) -> Column:
    return clump_chromosome(c)


def in_regions(df: DataFrame, regions: DataFrame, keys: list[tuple[str, str]], pos: str, start: str, end: str, score: Column) -> DataFrame:
    """Rows with the summed score of the regions that hold them."""
    got = ranges.contains(df, regions, keys, pos, start, end)
    return got.groupBy(*df.columns).agg(F.sum(score).alias("region_score"))


def harmonised(df: DataFrame, reference: DataFrame, row: str, frequency: str, consistent: list[str], rules: list[Rule], left_out: list[str], most_difference: float) -> tuple[DataFrame, Ledger]:
    """A study (chrom, pos, ea, oa, beta, se, eaf, n, info, a row id) brought to a reference (chrom, pos, ea, oa, its frequency).

    Chromosomes, positions and alleles are normalised, rows of invalid coordinates or alleles or of
    chromosomes left out go, then those that meet the rules; duplicates are resolved; what stays is
    turned to the reference's effect allele, and rows that aren't there or whose frequency differs
    by more than `most_difference` go. Each row is kept or has one reason in the ledger.
    """
    book = Ledger(row)
    made = df.withColumns({"chrom": canonical_chromosome(F.col("chrom")), "pos": integral_position(F.col("pos")), "ea": allele(F.col("ea")), "oa": allele(F.col("oa"))})
    invalid = F.col("chrom").isNull() | F.col("chrom").isin(left_out) | F.col("pos").isNull() | (F.col("pos") < 1) | (F.col("ea") == F.col("oa")) | ~F.col("ea").rlike(DNA) | ~F.col("oa").rlike(DNA)
    made = written(book.reject(made, "input", [Rule("invalid_allele_or_scope", invalid), *rules]), "harmonised")
    made = windows.resolve_duplicates(made, "chrom", "pos", "ea", "oa", consistent, ["beta", "se", "eaf"], "n", "info", row)
    book.entries.append(made.filter("duplicate_status is not null").select(F.col(row), F.lit("duplicates").alias("step"), F.col("duplicate_status").alias("reason"), F.lit(None).cast("string").alias("detail")))
    made = joins.allele_join(made.filter("duplicate_status is null").drop("duplicate_status"), reference, ["chrom", "pos", "ea", "oa"], frequency, "reference_frequency")
    absent = Rule("not_in_reference", F.col("reference_frequency_orientation").isNull())
    far = Rule("frequency_differs", F.abs(F.col("eaf") - F.col("reference_frequency")) > most_difference)
    made = book.reject(written(made, "harmonised"), "reference", [absent, far], F.abs(F.col("eaf") - F.col("reference_frequency")))
    turned = F.col("reference_frequency_orientation") == "swapped"
    swapped = lambda a, b: F.when(turned, a).otherwise(b)
    return made.withColumns({"ea": swapped(F.col("oa"), F.col("ea")), "oa": swapped(F.col("ea"), F.col("oa")), "beta": swapped(-F.col("beta"), F.col("beta")), "eaf": swapped(1 - F.col("eaf"), F.col("eaf")), "reference_frequency": swapped(1 - F.col("reference_frequency"), F.col("reference_frequency"))}), book
