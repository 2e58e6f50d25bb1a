"""Column expressions over variants: chromosomes, positions, alleles, identifiers."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

DNA = "^[ACGT]+$"
#: Pairs of complementary bases, and common spellings of the non-autosomes.
PALINDROMES = ("AT", "TA", "CG", "GC")
RENAMES = {"23": "X", "24": "Y", "25": "XY", "26": "MT", "M": "MT"}


def finite(c: Column) -> Column:
    """Not null, not NaN and not infinite; never null itself."""
    return F.coalesce(c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))


def numeric(c: Column) -> Column:
    """Lenient double: what can't be read is null."""
    return F.trim(c.cast("string")).try_cast("double")


def position(c: Column) -> Column:
    """Lenient long of trimmed text."""
    return F.trim(c.cast("string")).try_cast("bigint")


def integral_position(c: Column) -> Column:
    """A long from an integer or a finite double without fraction, else null."""
    x = numeric(c)
    return F.when(finite(x) & (F.floor(x) == x) & (F.abs(x) < 9.2e18), x.cast("bigint"))


def position_text(c: Column, extraction: str = "none") -> Column:
    """The position in a combined coordinate's text: leading_digits, strip_non_digits or none."""
    if extraction == "leading_digits":
        return F.nullif(F.regexp_extract(c, r"^\s*(\d+)", 1), F.lit(""))
    if extraction == "strip_non_digits":
        return F.nullif(F.regexp_replace(c, r"\D", ""), F.lit(""))
    if extraction != "none":
        raise ValueError(f"unknown extraction: {extraction}")
    return c


def split_coordinate(c: Column, separator: str = ":") -> tuple[Column, Column]:
    """Chromosome and position texts of chr:pos; null where a part is missing."""
    parts = F.split(c, re.escape(separator))
    return F.nullif(F.trim(F.get(parts, F.lit(0))), F.lit("")), F.nullif(F.trim(F.get(parts, F.lit(1))), F.lit(""))


def chromosome(c: Column, strip_prefix: bool = True, strip_leading_zero: bool = False) -> Column:
    out = F.regexp_replace(F.trim(c.cast("string")), r"\.0+$", "")
    if strip_prefix:
        out = F.regexp_replace(out, "(?i)^chr", "")
    if strip_leading_zero:
        out = F.regexp_replace(out, "^0+(?=[0-9])", "")
    return out


def clump_chromosome(c: Column) -> Column:
    """Upper case without CHR; digits alone lose leading zeros."""
    up = F.upper(F.trim(c.cast("string")))
    up = F.when(up.startswith("CHR"), F.substring(up, 4, 1 << 20)).otherwise(up)
    return F.when(up.rlike(r"^\d+$"), up.try_cast("bigint").cast("string")).otherwise(up)


def canonical_chromosome(c: Column, renames: dict[str, str] | None = RENAMES) -> Column:
    """Trimmed, without chr, fraction and leading zeros, upper case, renamed."""
    out = F.upper(chromosome(c, True, True))
    if renames:
        table = F.create_map(*[F.lit(x) for kv in renames.items() for x in kv])
        out = F.coalesce(F.try_element_at(table, out), out)
    return F.nullif(out, F.lit(""))


def chromosome_order(c: Column) -> list[Column]:
    """Sort keys of natural order: numbers first, then names."""
    digits = c.rlike(r"^\d+$")
    return [F.when(digits, 0).otherwise(1).asc(), c.try_cast("bigint").asc_nulls_last(), c.asc_nulls_last()]


def allele(c: Column) -> Column:
    """Trimmed upper case; empty is null."""
    return F.upper(F.nullif(F.trim(c), F.lit("")))


def reverse_complement(c: Column) -> Column:
    """Of plain bases, else null."""
    return F.when(c.rlike(DNA), F.reverse(F.translate(c, "ACGT", "TGCA")))


def palindromic(a: Column, b: Column) -> Column:
    """A and B are one base each and complements; null counts as false."""
    return F.coalesce(F.concat(a, b).isin(*PALINDROMES), F.lit(False))


def unordered_key(chrom: Column, pos: Column, a: Column, b: Column, missing: tuple[str, ...] = ("", ".", "NA", "0")) -> Column:
    """chr_pos_low_high, null if a part is missing."""
    ok = chrom.isNotNull() & pos.isNotNull() & a.isNotNull() & b.isNotNull() & ~a.isin(*missing) & ~b.isin(*missing)
    return F.when(ok, F.concat_ws("_", chrom, pos.cast("string"), F.least(a, b), F.greatest(a, b)))


def template(text: str, **columns: Column) -> Column:
    """A template such as {chromosome}_{position}; null if any part is null."""
    parts = re.split(r"\{(\w+)\}", text)
    return F.concat(*[F.lit(p) if i % 2 == 0 else columns[p].cast("string") for i, p in enumerate(parts) if i % 2 or p])


def captured(c: Column, pattern: str, group: int = 1) -> Column:
    """A regular expression's group, null without match."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def usable_identifier(c: Column, chrom: Column, pos: Column, a: Column, b: Column, sentinels: tuple[str, ...] = ("", ".", "NA", "nan", "NULL")) -> Column:
    """The identifier, or chr_pos_a_b where it is missing."""
    return F.when(c.isNull() | F.trim(c).isin(*sentinels), F.concat_ws("_", chrom, pos.cast("string"), a, b)).otherwise(c)


def trimmed_string(c: Column, missing: tuple[str, ...] = ("", ".", "NA", "NaN", "nan", "NULL", "null", "None")) -> Column:
    """Trimmed; missing tokens are null."""
    t = F.trim(c)
    return F.when(~t.isin(*missing), t)


def minor_frequency(af: Column) -> Column:
    """min(AF, 1 - AF); null if AF is."""
    return F.least(af, 1 - af)


def completeness(*columns: Column) -> Column:
    """How many are not null."""
    return reduce(lambda x, y: x + y, [c.isNotNull().cast("int") for c in columns])


def any_of(*masks: Column) -> Column:
    return reduce(lambda x, y: x | y, masks)


def all_of(*masks: Column) -> Column:
    return reduce(lambda x, y: x & y, masks)


def reasons(*pairs: tuple[Column, str], separator: str = ";") -> Column:
    """Names of the masks that hold, joined; null masks don't."""
    return F.concat_ws(separator, *[F.when(mask, F.lit(name)) for mask, name in pairs])


def parsed_integer(c: Column) -> Column:
    """Decimal, scientific or grouped digits as a long, if whole; by decimals, so that no digit changes."""
    x = F.regexp_replace(F.trim(c), r"[,\s_]", "").try_cast("decimal(38,10)")
    return F.when(F.floor(x) == x, x.try_cast("bigint"))


def snp(a: Column, b: Column) -> Column:
    return F.coalesce(a.rlike("^[ACGT]$") & b.rlike("^[ACGT]$") & (a != b), F.lit(False))


def transition(a: Column, b: Column) -> Column:
    return F.coalesce(F.concat(a, b).isin("AG", "GA", "CT", "TC"), F.lit(False))


def transversion(a: Column, b: Column) -> Column:
    return snp(a, b) & ~transition(a, b)


def minimal_alleles(pos: Column, a: Column, b: Column) -> Column:
    """Struct (pos, a, b) without shared padding: the shared suffix goes first, then the shared
    prefix, which advances the position; each allele keeps a base. All in the JVM: the lengths are
    the first place that differs, found over the positions of the shorter allele."""
    la, lb = F.length(a), F.length(b)
    short = F.least(la, lb) - 1
    ra, rb = F.reverse(a), F.reverse(b)

    def shared(x: Column, y: Column, most: Column) -> Column:
        differ = F.filter(F.sequence(F.lit(1), F.greatest(most, F.lit(1))), lambda i: (i <= most) & (F.substr(x, i, F.lit(1)) != F.substr(y, i, F.lit(1))))
        return F.when(most <= 0, F.lit(0)).otherwise(F.coalesce(F.try_element_at(differ, F.lit(1)) - 1, most))

    suffix = shared(ra, rb, short)
    a1, b1 = F.substr(a, F.lit(1), la - suffix), F.substr(b, F.lit(1), lb - suffix)
    prefix = shared(a1, b1, short - suffix)
    out = F.struct((pos + prefix).alias("pos"), F.substr(a1, prefix + 1).alias("a"), F.substr(b1, prefix + 1).alias("b"))
    single = (la == 1) | (lb == 1)
    return F.when(single, F.struct(pos.alias("pos"), a.alias("a"), b.alias("b"))).otherwise(out)
