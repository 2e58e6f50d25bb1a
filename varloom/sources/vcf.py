"""VCF text as DataFrames, and back."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FIXED = ("CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", "SAMPLE")
#: The fields of a GWAS-VCF record.
GWAS_INFO = {"AF": ("A", "Float", "Allele frequency")}
GWAS_FORMAT = {
    "ES": ("A", "Float", "Effect size"),
    "SE": ("A", "Float", "Standard error of the effect size"),
    "LP": ("A", "Float", "-log10 p-value"),
    "AF": ("A", "Float", "Allele frequency in the study"),
    "SI": ("A", "Float", "Imputation score"),
    "SS": ("A", "Integer", "Sample size"),
    "EZ": ("A", "Float", "Z score"),
    "NCO": ("A", "Integer", "Number of cases"),
    "NEF": ("A", "Integer", "Effective sample size"),
    "NC": ("A", "Integer", "Number of controls"),
    "ID": ("1", "String", "Identifier"),
}


def header(spark: SparkSession, path: str) -> list[str]:
    """The ## lines."""
    return [r[0] for r in spark.read.text(path).filter(F.col("value").startswith("##")).collect()]


def definitions(lines: list[str], category: str) -> dict[str, tuple[str, str]]:
    """Number and Type of each declared INFO or FORMAT field."""
    out = {}
    for line in lines:
        m = re.match(rf"##{category}=<ID=([^,>]+),Number=([^,>]+),Type=([^,>]+)", line)
        if m:
            out[m[1]] = (m[2], m[3])
    return out


def info_map(info: Column) -> Column:
    """key=value pairs as a map; flags have an empty value; . is an empty map."""
    items = F.filter(F.split(info, ";"), lambda x: (x != "") & (x != "."))
    return F.map_from_entries(F.transform(items, lambda x: F.struct(F.substring_index(x, "=", 1).alias("k"), F.when(F.contains(x, F.lit("=")), F.substr(x, F.instr(x, F.lit("=")) + 1)).otherwise("").alias("v"))))


def format_map(form: Column, sample: Column) -> Column:
    return F.map_from_arrays(F.split(form, ":"), F.transform(F.arrays_zip(F.split(form, ":").alias("f"), F.split(sample, ":").alias("s")), lambda z: z["s"]))


def read(spark: SparkSession, path: str, region: tuple[str, int, int] | None = None, sample: str | None = None) -> DataFrame:
    """Records with INFO and FORMAT as maps of text; of the named sample, else the first.

    region: (chrom, start, end), ends included; it is tested on the line's first two columns,
    before any field is taken apart.
    """
    parts = F.split("value", "\t")
    rows = spark.read.text(path).filter(~F.col("value").startswith("#") & (F.col("value") != ""))
    if region is not None:
        chrom, start, end = region
        at = F.substring_index(F.substring_index("value", "\t", 2), "\t", -1).try_cast("bigint")
        rows = rows.filter(F.col("value").startswith(f"{chrom}\t") & at.between(start, end))
    if sample is not None:
        names = spark.read.text(path).filter(F.col("value").startswith("#CHROM\t")).first()[0].split("\t")[9:]
        if sample not in names:
            raise ValueError(f"no sample {sample}")
        parts = F.concat(F.slice(parts, 1, 9), F.slice(parts, 10 + names.index(sample), 1))
    rows = rows.select(*[F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(FIXED)])
    return rows.select("CHROM", F.col("POS").try_cast("bigint").alias("POS"), "ID", "REF", "ALT", F.col("QUAL").try_cast("double").alias("QUAL"), "FILTER", info_map(F.col("INFO")).alias("INFO"), format_map(F.col("FORMAT"), F.col("SAMPLE")).alias("FORMAT"))


def projected(records: DataFrame, info: list[str] = (), fields: list[str] = ()) -> DataFrame:
    """Chosen INFO and FORMAT fields as doubles where they can be read."""
    get = lambda m, k: F.try_element_at(F.col(m), F.lit(k)).try_cast("double")
    return records.select("CHROM", "POS", "ID", "REF", "ALT", *[get("INFO", k).alias(f"INFO_{k}") for k in info], *[get("FORMAT", k).alias(f"FORMAT_{k}") for k in fields])


def spark_is_empty(spark: SparkSession, path: str) -> bool:
    return spark.read.text(path).isEmpty()


def write_gwas(df: DataFrame, path: str, contigs: dict[str, int], sample: str, build: str) -> None:
    """Records (CHROM, POS, ID, REF, ALT and columns named by GWAS_FORMAT) as one sorted VCF per range.

    Each part file is a VCF of its range, header included; without records there is one of the
    header alone. Missing numbers are dots, counts are whole numbers.
    """
    head = ["##fileformat=VCFv4.2", *[f'##INFO=<ID={k},Number={n},Type={t},Description="{d}">' for k, (n, t, d) in GWAS_INFO.items()], *[f'##FORMAT=<ID={k},Number={n},Type={t},Description="{d}">' for k, (n, t, d) in GWAS_FORMAT.items()], *[f"##contig=<ID={c},length={size},assembly={build}>" for c, size in contigs.items()], "\t".join(["#" + FIXED[0], *FIXED[1:-1], sample])]
    there = [k for k in GWAS_FORMAT if k in df.columns]
    whole = lambda c: GWAS_FORMAT.get(c, ("", "", ""))[1] == "Integer"
    text = lambda c: F.coalesce((F.round(c).cast("bigint") if whole(c) else F.col(c)).cast("string"), F.lit("."))
    line = F.concat_ws("\t", "CHROM", F.col("POS").cast("string"), F.coalesce("ID", F.lit(".")), "REF", "ALT", F.lit("."), F.lit("PASS"), F.concat(F.lit("AF="), text("AF")) if "AF" in df.columns else F.lit("."), F.lit(":".join(there)), F.concat_ws(":", *[text(k) for k in there]))
    order = F.element_at(F.create_map(*[F.lit(x) for i, c in enumerate(contigs) for x in (c, i)]), F.col("CHROM"))
    rows = df.withColumn("__o", order).withColumn("value", line)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(n, "__o", "POS").sortWithinPartitions("__o", "POS", "REF", "ALT").select("value")
    # the first row of a part brings the header along
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    rows.select(F.when(first, F.concat(F.lit("\n".join(head) + "\n"), "value")).otherwise(F.col("value")).alias("value")).write.text(path)
    if spark_is_empty(df.sparkSession, path):
        df.sparkSession.createDataFrame([("\n".join(head),)], "value string").coalesce(1).write.mode("overwrite").text(path)
