"""Scores of a locus's genes by the regulatory regions that hold its credible variants.

Each source is read into one shape: gene, chrom, start, end and what a region adds to a gene's sum
and to its maximum. All sources are then scored together, by one interval join and one aggregation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranges import contains

#: The cell types of the promoter capture source, and the p from which captures are left out.
CELL_TYPES = "Mon Mac0 Mac1 Mac2 Neu MK EP Ery FoeT nCD4 tCD4 aCD4 naCD4 nCD8 tCD8 nB tB".split()
MOST_CAPTURE_P = 1000


def _shape(df: DataFrame, source: str, gene: str, chrom: Column, start: Column, end: Column, total: Column, most: Column | None = None) -> DataFrame:
    plain = F.regexp_replace(chrom.cast("string"), "^chr", "")
    return df.select(F.lit(source).alias("source"), F.col(gene).alias("gene"), plain.alias("chrom"), start.try_cast("bigint").alias("start"), end.try_cast("bigint").alias("end"), total.cast("double").alias("total"), (total if most is None else most).cast("double").alias("most"))


def _plain(source: str, value: str):
    """A reader of (gene, chr, start, end, value)."""

    def read(df: DataFrame, gene: str = "gene") -> DataFrame:
        return _shape(df, source, gene, F.col("chr"), F.col("start"), F.col("end"), F.col(f"`{value}`"))

    read.__doc__ = f"Regions of {source}: their {value}."
    return read


enhancer_links = _plain("abc_ep", "ABC.Score")
crispr_links = _plain("abc_crispr", "ABC_max")
accessibility_links = _plain("cicero", "cor")
enhancer_scores = _plain("genehancer", "score")
roadmap_links = _plain("roadmap", "max")
epigenome_links = _plain("epimap", "corr")


def promoters(df: DataFrame, gene: str = "gene") -> DataFrame:
    """A promoter counts one."""
    return _shape(df, "promoter", gene, F.col("chr"), F.col("start"), F.col("end"), F.lit(1.0))


def enhancer_correlations(df: DataFrame, gene: str = "gene") -> DataFrame:
    """(gene, enhancer as chr:start-end, correlation)."""
    part = F.split("enhancer", "[:|-]")
    return _shape(df, "f5", gene, F.get(part, F.lit(0)), F.get(part, F.lit(1)), F.get(part, F.lit(2)), F.col("correlation"))


def captured_targets(df: DataFrame, gene: str = "gene") -> DataFrame:
    """(gene, target as chr.start.end, dist_pvalue); captures of MOST_CAPTURE_P or more are left out."""
    part = F.split("target", r"\.")
    return _shape(df.filter(F.col("dist_pvalue") < MOST_CAPTURE_P), "jung_hic", gene, F.get(part, F.lit(0)), F.get(part, F.lit(1)), F.get(part, F.lit(2)), F.col("dist_pvalue"))


def captured_promoters(df: DataFrame, gene: str = "gene", cell_types: list[str] = CELL_TYPES) -> DataFrame:
    """(gene, oeChr, oeStart, oeEnd, a column a cell type): the sum over cell types adds to the sum, the greatest to the maximum."""
    total = reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0.0)) for c in cell_types])
    return _shape(df, "javierre_hic", gene, F.col("oeChr"), F.col("oeStart"), F.col("oeEnd"), total, F.greatest(*cell_types))


def enhancer_density(df: DataFrame, method: str, gene: str = "gene") -> DataFrame:
    """(gene, chr, start, end, perhaps density, which is one where it is missing) of one method, CAGE or PRO-seq_GRO-seq."""
    value = F.coalesce(F.col("density"), F.lit(1.0)) if "density" in df.columns else F.lit(1.0)
    return _shape(df, f"hacer_{method}", gene, F.col("chr"), F.col("start"), F.col("end"), value)


def region_scores(genes: DataFrame, gene: str, variants: DataFrame, chrom: str, pos: str, pip: str, sources: dict[str, DataFrame]) -> DataFrame:
    """genes with {source}_sum and {source}_max: score times probability over regions and the variants in them, 0 without any."""
    regions = reduce(DataFrame.unionByName, sources.values())
    v = variants.select(F.regexp_replace(F.col(chrom).cast("string"), "^chr", "").alias("v_chrom"), F.col(pos).alias("v_pos"), F.col(pip).alias("v_pip"))
    met = contains(v, regions, [("v_chrom", "chrom")], "v_pos", "start", "end")
    got = met.groupBy(F.col("gene").alias("__g")).pivot("source", list(sources)).agg(F.sum(F.col("total") * F.col("v_pip")).alias("sum"), F.max(F.col("most") * F.col("v_pip")).alias("max"))
    out = genes.join(got, F.col(gene) == F.col("__g"), "left").drop("__g")
    # a region that doesn't hold a variant counts zero, so a maximum is never below
    return out.select(*genes.columns, *[F.coalesce(c, F.lit(0.0)).alias(f"{s}_{k}") for s in sources for k, c in (("sum", F.col(f"`{s}_sum`")), ("max", F.greatest(F.col(f"`{s}_max`"), F.lit(0.0))))])
