"""Joins by alleles, identifiers and orientation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.variants import DNA, finite, palindromic, reverse_complement, snp
from ..runtime import written


def deduplicated_reference(reference: DataFrame, keys: list[str], value: str, exact: str = "keep_one", different: str = "discard_all") -> DataFrame:
    """One row a key. Copies with one value are kept once, discarded or an error; so are keys with several; null is a value."""
    got = reference.groupBy(*keys).agg(F.count("*").alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi"), F.count(value).alias("there"))
    same = (F.col("there") == 0) | (F.col("there") == F.col("n")) & F.col("lo").eqNullSafe(F.col("hi"))
    if exact == "fail" and not got.filter((F.col("n") > 1) & same).isEmpty() or different == "fail" and not got.filter(~same).isEmpty():
        raise ValueError("reference keys repeat")
    stay = F.when(F.col("n") == 1, True).when(same, exact == "keep_one").otherwise(False)
    return got.filter(stay).select(*keys, F.col("lo").alias(value))


def reference_frequency(alts: DataFrame, chrom: str, pos: str, ref: str, alt: str, af: str) -> DataFrame:
    """Per site the REF frequency, one less the sum of its ALT frequencies, or the reason why there is none."""
    ok = finite(F.col(af)) & (F.col(af) >= 0) & (F.col(af) <= 1)
    dna = F.col(ref).rlike(DNA) & F.col(alt).rlike(DNA)
    single = (F.length(ref) == 1) & (F.length(alt) == 1)
    got = alts.groupBy(chrom, pos).agg(F.count("*").alias("n"), F.min(ref).alias("lo"), F.max(ref).alias("hi"), F.min(dna.cast("int")).alias("dna"), F.min(single.cast("int")).alias("single"), F.min(ok.cast("int")).alias("ok"), F.sum(af).alias("total"), (F.count("*") - F.count_distinct(alt)).alias("again"))
    why = (
        F.when(F.col("lo") != F.col("hi"), "several_reference_alleles")
        .when(F.coalesce(F.col("dna"), F.lit(0)) == 0, "not_plain_bases")
        .when((F.col("n") > 1) & (F.col("single") == 0), "several_alleles_not_single_bases")
        .when(F.col("again") > 0, "repeated_allele")
        .when(F.col("ok") == 0, "invalid_frequency")
        .when((F.col("total") < 0) | (F.col("total") > 1), "sum_out_of_range")
    )
    return got.select(chrom, pos, F.col("lo").alias(ref), F.when(why.isNull(), 1 - F.col("total")).alias("ref_af"), why.alias("reason"))


def allele_join(study: DataFrame, reference: DataFrame, keys: list[str], value: str, out: str, swap: str = "one_minus", prefer_present: bool = True) -> DataFrame:
    """study, each row once, with the reference value for its alleles in either order.

    keys: chromosome, position, effect allele, other allele, named alike in both. Direct rows stand
    before swapped ones, whose value is one_minus or same; with prefer_present a null or infinite
    value stands last.
    """
    chrom, pos, ea, oa = keys
    ref = deduplicated_reference(reference, keys, value)
    turned = F.col(value) if swap == "same" else 1 - F.col(value)
    direct = ref.select(chrom, pos, F.col(ea).alias("__a"), F.col(oa).alias("__b"), F.col(value).alias("__v"), F.lit(0).alias("__o"))
    swapped = ref.select(chrom, pos, F.col(oa).alias("__a"), F.col(ea).alias("__b"), turned.alias("__v"), F.lit(1).alias("__o"))
    both = direct.unionByName(swapped)
    if prefer_present:
        both = both.withColumn("__o", F.col("__o") + F.when(finite(F.col("__v").cast("double")), 0).otherwise(2))
    best = both.groupBy(F.col(chrom).alias("__c"), F.col(pos).alias("__p"), "__a", "__b").agg(F.min(F.struct("__o", "__v")).alias("__x"))
    met = (F.col(chrom) == F.col("__c")) & (F.col(pos) == F.col("__p")) & (F.col(ea) == F.col("__a")) & (F.col(oa) == F.col("__b"))
    orientation = F.when(F.col("__x").isNull(), F.lit(None).cast("string")).when(F.col("__x.__o") % 2 == 0, "direct").otherwise("swapped")
    return study.join(best, met, "left").withColumn(out, F.col("__x.__v")).withColumn(f"{out}_orientation", orientation).drop("__c", "__p", "__a", "__b", "__x")


def orientations(study: DataFrame, reference: DataFrame, chrom: str, pos: str, ea: str, oa: str, ref: str, alt: str, row: str) -> DataFrame:
    """A row per study row, reference variant at its place and orientation that fits, with the row's number of candidates.

    forward: (ea, oa) is (alt, ref); swapped: (ref, alt); complements only for single bases.
    """
    r = reference.select(F.col(chrom).alias("__c"), F.col(pos).alias("__p"), *[F.col(c).alias(f"ref_{c}") for c in reference.columns if c not in (chrom, pos)])
    got = study.join(r, (F.col(chrom) == F.col("__c")) & (F.col(pos) == F.col("__p"))).drop("__c", "__p")
    a, b, x, y = F.col(ea), F.col(oa), F.col(f"ref_{alt}"), F.col(f"ref_{ref}")
    ra, rb = reverse_complement(a), reverse_complement(b)
    one = (F.length(a) == 1) & (F.length(b) == 1)
    fits = F.array_compact(F.array(F.when((a == x) & (b == y), "forward"), F.when((a == y) & (b == x), "forward_swapped"), F.when(one & (ra == x) & (rb == y), "reverse_complement"), F.when(one & (ra == y) & (rb == x), "reverse_complement_swapped")))
    got = got.withColumn("orientation", F.explode(fits)).distinct()
    return got.withColumn("candidates", F.count("*").over(Window.partitionBy(row)))


def oriented(candidates: DataFrame, row: str, ea: str, oa: str, consensus: str | None = None) -> DataFrame:
    """A row per study row: the orientation chosen, or why there is none.

    Palindromes follow the study's consensus strand (forward or reverse) if there is one.
    """
    pal = palindromic(F.col(ea), F.col(oa))
    forward = F.col("orientation").startswith("forward")
    eligible = ~pal | (F.lit(consensus == "forward") & forward) | (F.lit(consensus == "reverse") & ~forward)
    got = candidates.groupBy(row).agg(F.max(pal.cast("int")).alias("pal"), F.count_if(eligible).alias("n"), F.min(F.when(eligible, F.col("orientation"))).alias("orientation"))
    reason = F.when(F.col("n") == 1, F.lit(None).cast("string")).when((F.col("n") == 0) & (F.col("pal") == 1), "palindromic_unresolved").when(F.col("n") == 0, "unmatched").otherwise("ambiguous")
    return got.select(row, F.when(F.col("n") == 1, F.col("orientation")).alias("orientation"), reason.alias("reason"))


def strand_consensus(candidates: DataFrame, ea: str, oa: str, least: int = 100, dominant: float = 0.95) -> str:
    """forward, reverse, mixed or unresolved, from rows that aren't palindromes."""
    forward = F.col("orientation").startswith("forward")
    f, n = candidates.filter(~palindromic(F.col(ea), F.col(oa))).agg(F.count_if(forward), F.count("*")).first()
    if n < least:
        return "unresolved"
    return "forward" if f / n >= dominant else "reverse" if 1 - f / n >= dominant else "mixed"


def signed_alignment(study: DataFrame, reference: DataFrame, identifier: str, a1: str, a2: str, beta: str) -> DataFrame:
    """Inner join one to one on the identifier with beta turned to the reference's a1: direct, swapped, and complements; palindromes and misfits go."""
    r = reference.select(F.col(identifier).alias("__i"), F.col(a1).alias("__a"), F.col(a2).alias("__b"))
    got = study.join(r, F.col(identifier) == F.col("__i")).filter(~palindromic(F.col(a1), F.col(a2)))
    a, b = F.col(a1), F.col(a2)
    ra, rb = reverse_complement(a), reverse_complement(b)
    direct = (a == F.col("__a")) & (b == F.col("__b"))
    swapped = (a == F.col("__b")) & (b == F.col("__a"))
    comp = (ra == F.col("__a")) & (rb == F.col("__b"))
    comp_swapped = (ra == F.col("__b")) & (rb == F.col("__a"))
    case = F.when(direct, "direct").when(swapped, "swapped").when(comp, "complement").when(comp_swapped, "complement_swapped")
    sign = F.when(direct | comp, 1.0).when(swapped | comp_swapped, -1.0)
    return got.withColumn("alignment", case).filter("alignment is not null").withColumn(f"aligned_{beta}", F.col(beta) * sign).withColumn(a1, F.col("__a")).withColumn(a2, F.col("__b")).drop("__i", "__a", "__b")


def build_evidence(study: DataFrame, builds: dict[str, DataFrame], chrom: str, pos: str, ea: str, oa: str, row: str) -> DataFrame:
    """Per build: study rows whose place and alleles it has on either strand, the reference's unique markers, and testable rows."""
    out = []
    testable = study.filter(snp(F.col(ea), F.col(oa)))
    for name, ref in builds.items():
        r = ref.select(F.col(chrom).alias("__c"), F.col(pos).alias("__p"), F.least(ea, oa).alias("__a"), F.greatest(ea, oa).alias("__b")).distinct()
        place = (F.col(chrom) == F.col("__c")) & (F.col(pos) == F.col("__p"))
        plain = (F.least(ea, oa) == F.col("__a")) & (F.greatest(ea, oa) == F.col("__b"))
        ra, rb = reverse_complement(F.col(ea)), reverse_complement(F.col(oa))
        turned = (F.least(ra, rb) == F.col("__a")) & (F.greatest(ra, rb) == F.col("__b"))
        got = testable.join(r, place & (plain | turned), "left_semi")
        out.append(got.agg(F.count_distinct(row).alias("matches")).crossJoin(r.agg(F.count("*").alias("markers"))).crossJoin(testable.agg(F.count("*").alias("testable"))).select(F.lit(name).alias("build"), "matches", "markers", "testable"))
    return reduce(DataFrame.unionByName, out)


def chosen_build(evidence: list[dict], matches: int = 100, of_markers: float = 0.1, of_testable: float = 0.8, of_total: float = 0.9) -> tuple[str | None, list[str]]:
    """The build that passes all gates, and the names of the gates that fail."""
    total = sum(e["matches"] for e in evidence)
    ordered = sorted(evidence, key=lambda e: -e["matches"])
    top = ordered[0]
    failed = []
    if len(ordered) > 1 and ordered[1]["matches"] == top["matches"]:
        failed.append("tied")
    if top["matches"] < matches:
        failed.append("matches")
    if top["matches"] < of_markers * max(1, top["markers"]):
        failed.append("markers")
    if top["matches"] < of_testable * max(1, top["testable"]):
        failed.append("testable")
    if top["matches"] < of_total * max(1, total):
        failed.append("total")
    return (None if failed else top["build"]), failed


def matched(inputs: DataFrame, records: DataFrame, key: str, complement_key: str, row: str, record_key: str, palindrome: str) -> DataFrame:
    """Inputs matched to records on the listed key, then, where that fails, on the complement key.

    Of inputs that meet one record the listed ones stand first, then the first row; the others are
    left unmatched. All rows of the inputs are returned, with match_type null if unmatched.
    """
    rec = records.select(F.col(record_key).alias("__rk")).distinct()
    listed = inputs.join(rec, F.col(key) == F.col("__rk")).withColumn("__pr", F.lit(0))
    rest = inputs.join(rec, F.col(key) == F.col("__rk"), "left_anti").filter(~F.col(palindrome))
    turned = rest.join(rec, F.col(complement_key) == F.col("__rk")).withColumn("__pr", F.lit(1))
    every = listed.select(row, "__rk", "__pr").unionByName(turned.select(row, "__rk", "__pr"))
    won = every.groupBy("__rk").agg(F.min(F.struct("__pr", row)).alias("x")).select(F.col(f"x.{row}").alias("__row"), F.col("__rk").alias("record"), F.when(F.col("x.__pr") == 0, "listed").otherwise("complement").alias("match_type"))
    return inputs.join(won, F.col(row) == F.col("__row"), "left").drop("__row")


def either_id(left: DataFrame, right: DataFrame, ids: list[Column], right_id: str, distinct: bool = False) -> DataFrame:
    """left joined on any of several identifiers; a pair that meets by two of them counts twice unless distinct."""
    name = F.array_distinct(F.array(*ids)) if distinct else F.array(*ids)
    return left.withColumn("__id", F.explode(name)).join(right, F.col("__id") == F.col(right_id)).drop("__id")


def one_to_one(left: DataFrame, table: DataFrame, key: str, table_key: str, unmapped: str = "drop") -> DataFrame:
    """left joined to a crosswalk in which each key stands once; unmapped rows are dropped, kept or an error."""
    if not table.groupBy(table_key).count().filter("count > 1").isEmpty():
        raise ValueError(f"{table_key} repeats")
    renamed = table.withColumnRenamed(table_key, "__k")
    if unmapped == "error" and not left.join(renamed, F.col(key) == F.col("__k"), "left_anti").isEmpty():
        raise ValueError(f"{key} has values without a match")
    return left.join(renamed, F.col(key) == F.col("__k"), "left" if unmapped == "keep" else "inner").drop("__k")


def integrated(scored: DataFrame, target: DataFrame, key: str, score: str, order: str) -> DataFrame:
    """Full outer join with a four-state status."""
    t = target.withColumnRenamed(key, "__k")
    got = scored.join(t, F.col(key) == F.col("__k"), "full_outer")
    status = F.when(F.col("__k").isNull(), "scored_only").when(F.col(key).isNull(), "target_only").when(F.col(score).isNull(), "target_unscored").otherwise("scored_target")
    return got.withColumn("status", status).withColumn(key, F.coalesce(F.col(key), F.col("__k"))).drop("__k")


def universe(target: DataFrame, others: dict[str, DataFrame], key: str) -> tuple[DataFrame, DataFrame]:
    """The target rows whose key all others have, and the others with the first that lacks them."""
    out = target
    for name, other in others.items():
        out = out.join(other.select(F.col(key).alias(f"__{name}")).distinct(), F.col(key) == F.col(f"__{name}"), "left")
    lacking = reduce(lambda c, n: c.when(F.col(f"__{n}").isNull(), n), others, F.when(F.lit(False), ""))
    out = out.withColumn("missing_from", lacking).drop(*[f"__{n}" for n in others])
    return out.filter("missing_from is null").drop("missing_from"), out.filter("missing_from is not null")


def adjacency(edges: DataFrame, a: str, b: str, weight: str) -> DataFrame:
    """Edges in both directions, the strongest of each pair."""
    both = edges.select(F.col(a).alias("a"), F.col(b).alias("b"), F.col(weight).alias("w")).unionByName(edges.select(F.col(b).alias("a"), F.col(a).alias("b"), F.col(weight).alias("w")))
    return both.groupBy("a", "b").agg(F.max("w").alias("w"))
