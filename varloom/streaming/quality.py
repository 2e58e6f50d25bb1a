"""Quality counts over a stream of result files: partial sums by batch, pooled on reading.

Sums are mergeable, so a batch that is run again after a failure overwrites its own partial row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.aggregates import info_statistics

SUMS = ("rows", "finite", "below_0", "unit", "to_2", "above_2", "total")


def start(spark: SparkSession, source: str, schema: StructType, column: str, out: str, checkpoint: str):
    """A query that writes one partial row a batch under out."""

    def put(batch: DataFrame, number: int) -> None:
        info_statistics(batch, column).withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return spark.readStream.schema(schema).parquet(source).writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def pooled(spark: SparkSession, out: str) -> DataFrame:
    """All batches as one row: sums of sums, least and greatest; fractions are made only from the sums."""
    parts = spark.read.parquet(f"{out}/batch=*")
    return parts.agg(*[F.sum(c).alias(c) for c in SUMS], F.min("least").alias("least"), F.max("most").alias("most")).withColumn("unit_fraction", F.when(F.col("finite") > 0, F.col("unit") / F.col("finite")))
