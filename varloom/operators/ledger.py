"""Filters that account for every row they reject."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.variants import finite


@dataclass(frozen=True)
class Rule:
    """Rows to reject where mask holds; a null mask rejects too unless null_rejects is off."""

    name: str
    mask: Column
    null_rejects: bool = True
    action: str = "reject"  # or keep (count only), or fail

    def hit(self) -> Column:
        return F.coalesce(self.mask, F.lit(self.null_rejects))


def tagged(df: DataFrame, rules: list[Rule], reason: str = "reject_reason") -> DataFrame:
    """df with the name of the first rejecting rule that each row meets, null for rows that stay."""
    chain = reduce(lambda c, r: c.when(r.hit(), r.name), [r for r in rules if r.action == "reject"], F.when(F.lit(False), ""))
    return df.withColumn(reason, chain)


def split(df: DataFrame, rules: list[Rule], reason: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    """The rows that stay and those rejected, with their reason. Both come from one expression."""
    for rule in rules:
        if rule.action == "fail" and not df.filter(rule.hit()).isEmpty():
            raise ValueError(f"rows meet {rule.name}")
    out = tagged(df, rules, reason)
    return out.filter(F.col(reason).isNull()).drop(reason), out.filter(F.col(reason).isNotNull())


@dataclass
class Ledger:
    """Rejected row ids of all steps; originals are joined back when asked for."""

    row_id: str
    entries: list[DataFrame] = field(default_factory=list)

    def reject(self, df: DataFrame, step: str, rules: list[Rule], detail: Column | None = None) -> DataFrame:
        kept, rejected = split(df, rules)
        note = F.lit(None).cast("string") if detail is None else detail.cast("string")
        self.entries.append(rejected.select(F.col(self.row_id), F.lit(step).alias("step"), F.col("reject_reason").alias("reason"), note.alias("detail")))
        return kept

    def rows(self) -> DataFrame:
        return reduce(DataFrame.unionByName, self.entries)

    def originals(self, source: DataFrame) -> DataFrame:
        """The rejected rows as they were read."""
        return self.rows().join(source, self.row_id)

    def counts(self) -> DataFrame:
        return self.rows().groupBy("step", "reason").agg(F.count("*").alias("n"))


def reconcile(rows_in: int, rows_out: int, rejected: int, label: str = "") -> None:
    if rows_in - rejected != rows_out:
        raise ValueError(f"{label}: {rows_in} rows in, {rejected} rejected, {rows_out} out")


def complete_rows(df: DataFrame, required: list[str], condition: Column | None = None) -> DataFrame:
    """Rows whose required columns are not null and finite; a null condition drops the row."""
    types = dict(df.dtypes)
    masks = [finite(F.col(c)) if types[c] in ("double", "float") else F.col(c).isNotNull() for c in required]
    if condition is not None:
        masks.append(F.coalesce(condition, F.lit(False)))
    return df.filter(reduce(lambda a, b: a & b, masks))


RANGES = {
    "positive": lambda c: c > 0,
    "non_negative": lambda c: c >= 0,
    "open_unit": lambda c: (c > 0) & (c < 1),
    "closed_unit": lambda c: (c >= 0) & (c <= 1),
}


def range_predicate(checks: dict[str, list[str]]) -> Column:
    """All columns in their named ranges: {range: columns}."""
    return reduce(lambda a, b: a & b, [RANGES[k](F.col(c)) for k, cols in checks.items() for c in cols], F.lit(True))


def outside(df: DataFrame, chrom: str, pos: str, where: tuple[str, int, int]) -> DataFrame:
    """Rows outside an interval, ends included; rows with nulls stay."""
    inside = (F.col(chrom) == where[0]) & F.col(pos).between(where[1], where[2])
    return df.filter(~F.coalesce(inside, F.lit(False)))


def matching(condition: Column, null_is_match: bool) -> Column:
    """How many rows meet the condition, with nulls counted as said."""
    return F.sum(F.coalesce(condition, F.lit(null_is_match)).cast("long"))


def missing_mandatory(mandatory: list[str], alternatives: list[list[str]]) -> Column:
    """True where a mandatory column is null or a whole group of alternatives is."""
    out = F.lit(False)
    for c in mandatory:
        out = out | F.col(c).isNull()
    for group in alternatives:
        out = out | reduce(lambda a, b: a & b, [F.col(c).isNull() for c in group])
    return out


def effect_rules(se: Column, beta: Column, z: Column, keep_zero: bool = True) -> list[Rule]:
    """The six checks of effects in order; finiteness comes before sign."""
    is_finite = lambda c: ~F.isnan(c) & (F.abs(c) < float("inf"))
    return [
        Rule("se_null", se.isNull()),
        Rule("se_non_finite", ~is_finite(se)),
        Rule("se_non_positive", se <= 0),
        Rule("beta_invalid", ~finite(beta)),
        Rule("beta_zero", beta == 0, action="keep" if keep_zero else "reject"),
        Rule("z_invalid", ~finite(z)),
    ]


def coordinate_rules(chrom: Column, pos: Column, allowed: list[str], least: int = 1) -> list[Rule]:
    return [
        Rule("chromosome_missing", chrom.isNull()),
        Rule("position_missing", pos.isNull()),
        Rule("position_below_minimum", pos < least),
        Rule("chromosome_y", chrom == "Y", False) if "Y" not in allowed else Rule("chromosome_y", F.lit(False)),
        Rule("chromosome_mt", chrom == "MT", False) if "MT" not in allowed else Rule("chromosome_mt", F.lit(False)),
        Rule("chromosome_not_allowed", ~chrom.isin(*allowed)),
    ]


@dataclass(frozen=True)
class QualityPolicy:
    """Thresholds of the variant quality rules, with bounds checked."""

    least_lp: float | None = None
    least_maf: float | None = 0.01
    least_info: float | None = 0.7
    most_af_difference: float | None = 0.2
    snps_only: bool = False
    drop_palindromic: bool = False
    region: tuple[str, int, int] | None = None
    missing: str = "keep"

    def __post_init__(self):
        for name, low, high in (("least_maf", 0, 0.5), ("least_info", 0, 2), ("most_af_difference", 0, 1)):
            v = getattr(self, name)
            if v is not None and not low <= v <= high:
                raise ValueError(f"{name} must lie in [{low}, {high}]")
        if self.missing not in ("keep", "remove"):
            raise ValueError("missing is keep or remove")


def quality_rules(policy: QualityPolicy, c: dict[str, Column]) -> list[Rule]:
    """Rules in fixed priority from columns lp, af, info, external_af, ref, alt, chrom, pos."""
    from ..functions.variants import minor_frequency, palindromic, snp

    null = policy.missing == "remove"
    out = []
    if policy.least_lp is not None:
        out.append(Rule("significance", c["lp"] < policy.least_lp, null))
    if policy.least_maf is not None:
        out.append(Rule("allele_frequency", minor_frequency(c["af"]) < policy.least_maf, null))
    if policy.least_info is not None:
        out.append(Rule("imputation_quality", c["info"] < policy.least_info, null))
    if policy.most_af_difference is not None:
        out.append(Rule("external_af_concordance", F.abs(c["af"] - c["external_af"]) > policy.most_af_difference, null))
    if policy.snps_only:
        out.append(Rule("variant_type", ~snp(c["ref"], c["alt"]), null))
    if policy.drop_palindromic:
        out.append(Rule("palindromic_variants", palindromic(c["ref"], c["alt"]), null))
    if policy.region:
        chrom, start, end = policy.region
        out.append(Rule("mhc_region", (c["chrom"] == chrom) & c["pos"].between(start, end), null))
    return out


def contract_check(evaluated: DataFrame, contract: DataFrame, rule: str = "rule") -> DataFrame:
    """Evaluated rules against the contract made before the run: rule, status, differences.

    Both have the rule's name and the same columns of settings. status: agrees, changed (differences
    names the columns), missing (in the contract alone), unexpected or repeated. Nulls are equal.
    """
    columns = [c for c in contract.columns if c != rule]
    absent = set(columns) ^ {c for c in evaluated.columns if c != rule}
    if absent:
        raise ValueError(f"settings differ: {sorted(absent)}")
    side = lambda df, name: df.groupBy(F.col(rule).alias(f"{name}_rule")).agg(F.count("*").alias(f"{name}_n"), *[F.first(c).alias(f"{name}_{c}") for c in columns])
    both = side(evaluated, "e").join(side(contract, "c"), F.col("e_rule") == F.col("c_rule"), "full")
    differ = F.concat_ws(",", *[F.when(~F.col(f"e_{c}").eqNullSafe(F.col(f"c_{c}")), F.lit(c)) for c in columns])
    status = F.when(F.col("e_rule").isNull(), "missing").when(F.col("c_rule").isNull(), "unexpected").when((F.col("e_n") > 1) | (F.col("c_n") > 1), "repeated").when(differ != "", "changed").otherwise("agrees")
    return both.select(F.coalesce("e_rule", "c_rule").alias(rule), status.alias("status"), F.when(status == "changed", differ).otherwise("").alias("differences"))


def report_rows(assessment: DataFrame, keys: list[str], details: list[str]) -> DataFrame:
    """A rule's details one a row: keys, detail, value (text)."""
    return assessment.unpivot(keys, [F.col(d).cast("string").alias(d) for d in details], "detail", "value")


def attribution(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Per rule in priority order: observed, primary (first rule that a row meets), unique, overlap.

    One pass; observed = unique + overlap by construction, and unique rows meet no other rule.
    """
    hits = [r.hit() for r in rules]
    n = reduce(lambda a, b: a + b, [h.cast("int") for h in hits])
    seen, sums = F.lit(False), []
    for r, h in zip(rules, hits):
        one = lambda m: F.coalesce(F.sum(m.cast("long")), F.lit(0))
        sums.append(F.struct(F.lit(r.name).alias("rule"), one(h).alias("observed"), one(h & ~seen).alias("primary"), one(h & (n == 1)).alias("unique_only"), one(h & (n > 1)).alias("overlap")))
        seen = seen | h
    return df.agg(F.array(*sums).alias("x")).select(F.posexplode("x").alias("priority", "x")).select("priority", "x.*")
