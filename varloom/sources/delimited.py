"""Delimited text: all-string scans, delimiter detection, preambles, compressed files."""

from __future__ import annotations

import csv
import io
from collections import Counter
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CANDIDATES = ("\t", ",", ";", " ", "|")
MISSING = ("", ".", "NA", "NaN", "nan", "NULL", "null", "None", "-")


def detect_delimiter(spark: SparkSession, path: str, candidates: tuple[str, ...] = CANDIDATES, lines: int = 100, comment: str | None = "##", accept: Callable[[list[str]], bool] | None = None) -> str:
    """The candidate that gives the widest table of constant width over the first lines."""
    text = spark.read.text(path)
    if comment:
        text = text.filter(~F.col("value").startswith(comment))
    sample = [r[0] for r in text.filter(F.length(F.trim("value")) > 0).limit(lines).collect()]
    if not sample:
        raise ValueError(f"{path} is empty")
    best = None
    for c in candidates:
        rows = [x.split() for x in sample] if c == " " else list(csv.reader(sample, delimiter=c))
        widths = Counter(map(len, rows))
        width, n = widths.most_common(1)[0]
        if width > 1 and n == len(rows) and (accept is None or accept(rows[0])) and (best is None or width > best[0]):
            best = (width, c)
    if best is None:
        raise ValueError(f"no delimiter fits {path}")
    return best[1]


def header_of(spark: SparkSession, path: str, delimiter: str, comment: str | None = "##") -> tuple[list[str], int]:
    """The column names and the number of preamble lines before them."""
    most, seen = 2000, 0
    while True:  # a preamble may be of any length
        head = [r[0] for r in spark.read.text(path).limit(most).collect()]
        for skipped, line in enumerate(head[seen:], seen):
            if comment and line.startswith(comment) or not line.strip():
                continue
            names = line.split() if delimiter == " " else next(csv.reader([line], delimiter=delimiter))
            return [n.strip().lstrip("#") for n in names], skipped
        if len(head) < most:
            raise ValueError(f"{path} has no header")
        most, seen = 8 * most, most


def read_strings(spark: SparkSession, path: str, delimiter: str = "\t", columns: list[str] | None = None, missing: tuple[str, ...] = MISSING, comment: str | None = None) -> DataFrame:
    """All columns as strings, never inferred; missing tokens are null; only the columns asked for are kept.

    With comment, lines that begin with it are left out, and the header line, which may begin with a
    part of it; all are known by themselves, so files stay splittable.
    """
    names, _ = header_of(spark, path, delimiter, comment)
    lacking = [c for c in columns or [] if c not in names]
    if lacking:
        raise ValueError(f"{path} lacks {lacking}")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    if comment:
        v = F.col("value")
        text = spark.read.text(path)
        header = text.filter(~v.startswith(comment) & (F.length(F.trim(v)) > 0)).first()[0]
        lines = text.filter(~v.startswith(comment) & (F.length(F.trim(v)) > 0) & (v != header))
        ddl = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
        df = lines.select(F.from_csv(v, ddl, {"sep": delimiter}).alias("x")).select(*[F.col("x")[n].alias(n) for n in columns or names])
    else:
        reader = spark.read.schema(schema).option("sep", delimiter).option("header", True).option("enforceSchema", True)
        df = reader.csv(path).select(*(columns or names))
    return df.select(*[F.when(~F.trim(c).isin(*missing), F.trim(c)).alias(c) for c in df.columns])


def typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Lenient casts: what can't be read is null."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def not_empty(df: DataFrame, label: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{label} is empty")
    return df


def open_bytes(name: str, raw: bytes) -> bytes:
    """The bytes of a plain, gz, bgz, bz2, xz or zip file."""
    import bz2
    import gzip
    import lzma
    import zipfile

    if name.endswith((".gz", ".bgz")):
        return gzip.decompress(raw)
    if name.endswith(".bz2"):
        return bz2.decompress(raw)
    if name.endswith(".xz"):
        return lzma.decompress(raw)
    if name.endswith(".zip"):
        with zipfile.ZipFile(io.BytesIO(raw)) as z:
            return z.read(next(n for n in z.namelist() if not n.endswith("/")))
    return raw


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines (path, value). gz and bz2 are Spark's own; xz and zip files are opened whole, one a row."""
    if not path.endswith((".xz", ".zip", ".bgz")):
        return spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), "value")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, raw in zip(pdf["path"], pdf["content"]):
                yield pd.DataFrame({"path": name, "value": open_bytes(name, bytes(raw)).decode().splitlines()})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, value string")


def inspect(spark: SparkSession, path: str, comment: str = "##") -> DataFrame:
    """Data lines, preamble lines and lines with fewer fields than the header."""
    delimiter = detect_delimiter(spark, path)
    width = len(header_of(spark, path, delimiter, comment)[0])
    v = F.col("value")
    body = ~v.startswith(comment) & (F.length(F.trim(v)) > 0)
    fields = F.size(F.split(F.trim(v), r"\s+" if delimiter == " " else "\\Q" + delimiter + "\\E", -1))
    return spark.read.text(path).agg(F.count_if(body).alias("lines"), F.count_if(v.startswith(comment)).alias("preamble"), F.count_if(body & (fields < width)).alias("short"))


def resolve_template(path: str, build: str, chromosomes: list[str]) -> dict[str, str]:
    """A literal or {build}/{chromosome} path for each chromosome."""
    return {c: path.replace("{build}", build).replace("{chromosome}", c) for c in chromosomes}
