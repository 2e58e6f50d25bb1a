"""Sinks that account for their rows, and exports for other tools."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import p_from_lp
from ..functions.variants import minor_frequency
from ..operators.ledger import complete_rows


def write_delimited(df: DataFrame, path: str, sep: str = "\t", null: str = "NA", header: bool = True, compression: str | None = None) -> None:
    w = df.write.option("sep", sep).option("header", header).option("nullValue", null).option("emptyValue", null)
    (w.option("compression", compression) if compression else w).csv(path)


def write_partitions(df: DataFrame, path: str, by: str, compression: str = "zstd") -> int:
    """Parquet by partition column, with the rows counted as they are written and again from the footers."""
    seen = Observation("rows")
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.partitionBy(by).option("compression", compression).parquet(path)
    n = seen.get["n"]
    back = df.sparkSession.read.parquet(path).count()
    if n != back:
        raise ValueError(f"{n} rows written, {back} read back")
    return n


def read_back(spark: SparkSession, path: str, expected: int, columns: list[str] | None = None) -> DataFrame:
    """A Parquet table whose schema and row count are checked from its footers."""
    df = spark.read.parquet(path)
    lacking = [c for c in columns or [] if c not in df.columns]
    if lacking:
        raise ValueError(f"{path} lacks {lacking}")
    if df.count() != expected:
        raise ValueError(f"{path} doesn't hold {expected} rows")
    return df.select(*columns) if columns else df


def publish(spark: SparkSession, pairs: list[tuple[str, str]]) -> None:
    """Move finished folders to their places, all or none: what stood there comes back on an error."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    moved = []
    try:
        for src, dst in pairs:
            fs = path(src).getFileSystem(conf)
            kept = dst + ".before"
            had = fs.exists(path(dst)) and fs.rename(path(dst), path(kept))
            moved.append((fs, src, dst, kept, had))
            if not fs.rename(path(src), path(dst)):
                raise OSError(f"{src} can't be moved to {dst}")
    except Exception:
        for fs, src, dst, kept, had in reversed(moved):
            if fs.exists(path(dst)):
                fs.rename(path(dst), path(src))
            if had:
                fs.rename(path(kept), path(dst))
        raise
    for fs, _, _, kept, had in moved:
        if had:
            fs.delete(path(kept), True)


def concatenated(frames: list[DataFrame]) -> DataFrame:
    """Union by name over the ordered union of columns; types widen as strings where they differ."""
    names = list(dict.fromkeys(c for f in frames for c in f.columns))
    types: dict[str, set] = {}
    for f in frames:
        for c, t in f.dtypes:
            types.setdefault(c, set()).add(t)
    wide = {c for c, t in types.items() if len(t) > 1 and not t <= {"int", "bigint", "float", "double"}}
    frames = [f.withColumns({c: F.col(c).cast("string") for c in f.columns if c in wide}) for f in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames).select(*names)


TRANSFORMS = {
    "negative_log10_to_raw_p": lambda c: p_from_lp(c, 1e-300),
    "effect_frequency_to_minor_frequency": minor_frequency,
    "integer": lambda c: F.round(c).try_cast("bigint"),
}


def mapped(df: DataFrame, columns: list[tuple[str, str, str | None]]) -> DataFrame:
    """Ordered (source, destination, transform) projection; a missing source is an error."""
    lacking = [s for s, _, _ in columns if s not in df.columns]
    if lacking:
        raise ValueError(f"columns missing: {lacking}")
    return df.select(*[(TRANSFORMS[t](F.col(s)) if t else F.col(s)).alias(d) for s, d, t in columns])


#: Tool formats as ordered (source, destination, transform).
EXPORTS = {
    "finemap": [("ID", "rsid", None), ("CHROM", "chromosome", None), ("POS", "position", None), ("ALT", "allele1", None), ("REF", "allele2", None), ("EAF", "maf", "effect_frequency_to_minor_frequency"), ("BETA", "beta", None), ("SE", "se", None)],
    "susie": [("ID", "SNP", None), ("CHROM", "CHR", None), ("POS", "BP", None), ("ALT", "A1", None), ("REF", "A2", None), ("Z", "Z", None), ("N", "N", "integer")],
    "gcta": [("ID", "SNP", None), ("ALT", "A1", None), ("REF", "A2", None), ("EAF", "freq", None), ("BETA", "b", None), ("SE", "se", None), ("LP", "p", "negative_log10_to_raw_p"), ("N", "N", "integer")],
    "magma_p": [("ID", "SNP", None), ("LP", "P", "negative_log10_to_raw_p"), ("N", "N", "integer")],
    "magma_location": [("ID", "SNP", None), ("CHROM", "CHR", None), ("POS", "BP", None)],
    "pred_ld": [("ID", "snp", None), ("CHROM", "chr", None), ("POS", "pos", None), ("ALT", "A1", None), ("REF", "A2", None), ("BETA", "beta", None), ("SE", "SE", None)],
}


def exported(df: DataFrame, kind: str, condition: Column | None = None) -> DataFrame:
    """Complete rows in a tool's format."""
    columns = EXPORTS[kind]
    return mapped(complete_rows(df, [s for s, _, _ in columns], condition), columns)


def write_by_chromosome(df: DataFrame, path: str, chrom: str, chromosomes: list[str]) -> DataFrame:
    """One folder per configured chromosome; returns how many rows of other labels were left out."""
    inside = F.col(chrom).isin(*chromosomes)
    df.filter(inside).write.partitionBy(chrom).option("sep", "\t").option("header", True).csv(path)
    return df.filter(~F.coalesce(inside, F.lit(False))).groupBy(chrom).agg(F.count("*").alias("excluded"))
