"""Session and storage helpers shared by all operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder, unused so far, under ``spark.checkpoint.dir``; chosen and set here only where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        import tempfile

        base = f"file://{tempfile.mkdtemp(prefix='varloom-shared-')}"
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: a cut of lineage that outlives executors."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, prefix: str) -> str:
    """A column name that df doesn't have."""
    name, n = prefix, 0
    while name in df.columns:
        n += 1
        name = f"{prefix}_{n}"
    return name
