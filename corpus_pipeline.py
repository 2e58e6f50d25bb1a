"""A corpus pipeline of five stages over documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from varloom.llm import decontaminate, exact_dedup, langid, near_dedup, packing
from varloom.llm.common import written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no known language go."""
    return langid.accepted(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents equal but for the case of A-Z, the one with the largest doc_id stays."""
    return exact_dedup.deduplicated(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at 0.8 or more, the one with the smallest doc_id stays."""
    return near_dedup.deduplicated(docs, words=5, percent=80)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.decontaminated(docs, decontaminate.benchmark_of(spark, sf_dir))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as pieces of token sequences."""
    return packing.packed(docs)


STAGES = [("language_id", language), ("exact_dedup", exact), ("near_dedup", near), ("decontamination", benchmark_free), ("packing", pack)]

#: Language models, shingles and packing aren't expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after the other, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(spark, docs, name)
    return docs
