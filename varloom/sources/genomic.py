"""Gene sets, intervals, manifests, matrices and genotype companions."""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def gene_sets(spark: SparkSession, path: str) -> DataFrame:
    """GMT lines (name, description, genes...) as rows (set, place, gene)."""
    parts = F.split(F.trim("value"), "\t")
    rows = spark.read.text(path).filter(F.length(F.trim("value")) > 0).select(F.get(parts, F.lit(0)).alias("set"), F.slice(parts, 3, 1_000_000).alias("genes"))
    return rows.select("set", F.posexplode("genes").alias("place", "gene")).filter("gene <> ''")


def member_sets(df: DataFrame, name: str, gene: str) -> DataFrame:
    """Column-based sets as distinct (set, gene)."""
    return df.select(F.col(name).alias("set"), F.col(gene).alias("gene")).filter("set is not null and gene is not null").distinct()


def gene_intervals(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """gene, chrom, start, end, strand, name of a headerless table."""
    return spark.read.schema("gene string, chrom string, start bigint, end bigint, strand string, name string").option("sep", sep).option("comment", "#").csv(path)


def block_sets(spark: SparkSession, path: str) -> DataFrame:
    """Blocks of a set's name, its members and END, one a line, as (file, set, member).

    Order matters within a file, so each file is read whole, one a row.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, text in zip(pdf["path"], pdf["value"]):
                rows, current = [], None
                for line in (x.strip() for x in text.splitlines()):
                    if not line:
                        continue
                    if current is None:
                        current = line
                    elif line == "END":
                        current = None
                    else:
                        rows.append((name, current, line))
                if current is not None:
                    raise ValueError(f"{name}: {current} has no END")
                yield pd.DataFrame(rows, columns=["file", "set", "member"])

    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return files.mapInPandas(run, "file string, set string, member string")


def manifest(spark: SparkSession, path: str, separator: str = ",") -> DataFrame:
    """Strict lines of two fields: name, prefixes. Any other line is an error."""
    v = F.split(F.trim("value"), r"\s+")
    rows = spark.read.text(path).filter(F.length(F.trim("value")) > 0).withColumn("v", v)
    if not rows.filter(F.size("v") != 2).isEmpty():
        raise ValueError(f"{path} has lines that aren't two fields")
    return rows.select(F.get("v", F.lit(0)).alias("name"), F.split(F.get("v", F.lit(1)), separator).alias("prefixes"))


def gene_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.upper(F.trim("value")).alias("gene")).filter("gene <> ''").distinct()


def matrix_rows(spark: SparkSession, prefix: str, genes: list[str]) -> DataFrame:
    """Rows (chunk, gene, values) of <prefix>.mat.<i>.npy; the row count must be that of genes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, raw in zip(pdf["path"], pdf["content"]):
                mat = np.load(io.BytesIO(bytes(raw)), allow_pickle=False)
                if mat.ndim != 2 or len(mat) != len(genes):
                    raise ValueError(f"{path} has shape {mat.shape}")
                yield pd.DataFrame({"chunk": int(path.rsplit(".", 2)[1]), "gene": genes, "values": list(mat.astype(float))})

    return spark.read.format("binaryFile").load(f"{prefix}.mat.*.npy").select("path", "content").mapInPandas(run, "chunk int, gene string, values array<double>")


def bim(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("chrom string, id string, cm double, pos bigint, a1 string, a2 string").option("sep", "\t").csv(path)


def identifier_convention(variants: DataFrame, identifier: str, rsid: str = r"^rs\d+$", unique: str = r"^[0-9XYMT]+[:_]\d+[:_][ACGT]+[:_][ACGT]+$") -> DataFrame:
    """How many identifiers are rsids, unique ids or neither."""
    c = F.col(identifier)
    return variants.agg(F.count("*").alias("n"), F.count_if(c.rlike(rsid)).alias("rsid"), F.count_if(c.rlike(unique)).alias("unique_id"), F.count_if(~c.rlike(rsid) & ~c.rlike(unique)).alias("other"))


def genotypes(spark: SparkSession, path: str, samples: int) -> DataFrame:
    """Counts of A1 (null if missing) by variant row of a SNP-major BED file, two bits a genotype."""
    width = (samples + 3) // 4
    table = np.array([2, -1, 1, 0], np.int8)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, raw in zip(pdf["path"], pdf["content"]):
                data = np.frombuffer(bytes(raw), np.uint8)
                if data[:3].tolist() != [0x6C, 0x1B, 0x01]:
                    raise ValueError(f"{name} is no SNP-major BED file")
                rows = data[3:].reshape(-1, width)
                calls = table[np.stack([(rows >> s) & 3 for s in (0, 2, 4, 6)], 2).reshape(len(rows), -1)[:, :samples]]
                yield pd.DataFrame({"row": np.arange(len(rows)), "calls": [[None if c < 0 else int(c) for c in r] for r in calls]})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "row long, calls array<int>")


def log_metrics(spark: SparkSession, path: str, patterns: dict[str, str]) -> DataFrame:
    """The first number that each pattern's group 1 finds in a log."""
    lines = spark.read.text(path)
    return lines.agg(*[F.min(F.nullif(F.regexp_extract("value", p, 1), F.lit("")).try_cast("double")).alias(k) for k, p in patterns.items()])


def gene_covariance(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Genes (gene, chrom, start, end, z) and covariances (chrom, gene_a, gene_b, r) of raw gene files.

    A line has nine fields and then the correlations with the genes before it, the nearest last;
    # lines are comments. Order matters, so each file is read whole.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for text in pdf["value"]:
                rows, before = [], []
                for line in text.splitlines():
                    f = line.split()
                    if not f or f[0].startswith("#"):
                        continue
                    gene, chrom, r = f[0], f[1], [float(x) for x in f[9:]]
                    before = [g for g in before if g[1] == chrom]
                    rows.append((gene, chrom, int(f[2]), int(f[3]), float(f[8]), None, None))
                    for (other, _), v in zip(before[len(before) - len(r) :], r):
                        rows.append((gene, chrom, None, None, None, other, v))
                    before.append((gene, chrom))
                yield pd.DataFrame(rows, columns=["gene", "chrom", "start", "end", "z", "other", "r"]).astype({"start": "Int64", "end": "Int64"})

    got = spark.read.text(path, wholetext=True).mapInPandas(run, "gene string, chrom string, start long, end long, z double, other string, r double")
    return got.filter("other is null").select("gene", "chrom", "start", "end", "z"), got.filter("other is not null").select("chrom", F.col("gene").alias("gene_a"), F.col("other").alias("gene_b"), "r")
