"""Exact deduplication by a stateful stream.

Texts are reduced to digest, stable identifier and content locator; a streaming aggregation keeps
one state row a digest, on disk (RocksDB) and without expiry: the row that stays, its locator and
the number of copies. The state is read back with the state reader. On hits (digests with more
than one row) the full bytes are compared, and groups that differ are split by the bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import join_groups, lean, located, shared_dir, without, written

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Micro-batches that a stored input is streamed in.
BATCHES = 2
#: Digests of repeated texts up to this number are broadcast for the byte check; more are joined by shuffle.
MOST_BROADCAST = 300_000


def _digests(bits: int | None):
    """Batches of texts: digest (bits of it, if given) of the text with A-Z lowered; the key is binary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [hashlib.sha256((t.as_py() or b"").lower()).digest() for t in b.column("__bytes")]
            key = [g if bits is None else bytes([g[0] & ((1 << bits) - 1)]) for g in got]
            kept = [n for n in b.schema.names if n != "__bytes"]
            yield pa.RecordBatch.from_arrays([*[b.column(n) for n in kept], pa.array(key, pa.binary()), pa.array([g.hex() for g in got])], [*kept, "__key", "text_sha256"])

    return run


def _state(spark: SparkSession, digests: DataFrame, n_files: int) -> DataFrame:
    """The keyed state after the digests' table has been streamed: __key, last (struct), n."""
    path = digests.inputFiles()[0].rsplit("/", 1)[0]
    checkpoint = shared_dir(spark, "dedup-state")
    held = {}
    for k, v in {"spark.sql.streaming.stateStore.providerClass": ROCKSDB, "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true", "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64", "spark.sql.streaming.stateStore.maintenanceInterval": "5s", "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true", "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false"}.items():
        held[k] = spark.conf.get(k, None)
        spark.conf.set(k, v)
    try:
        stream = spark.readStream.schema(digests.schema).option("maxFilesPerTrigger", max(1, -(-n_files // BATCHES))).parquet(path)
        keyed = stream.groupBy("__key").agg(F.max(F.struct("__null", "doc_id", "__rowneg", "__file")).alias("last"), F.count("*").alias("n"))
        query = keyed.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        state = spark.read.format("statestore").load(checkpoint)
        state = written(spark, state.select(F.col("key.__key").alias("__key"), F.col("value.max").alias("last"), F.col("value.count").alias("n")), "dedup-groups", small=True)
    finally:
        for k, v in held.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return state


def decisions(docs: DataFrame, key_bits: int | None = None) -> DataFrame:
    """A row per input row: doc_id, keep_id, group_size, kept, text_sha256, and its place __file, __row.

    Texts are equal when identical after lowering A-Z; null counts as empty. The largest doc_id of
    a group stays; of rows that repeat it, the one stored first. A null doc_id is below all others.
    key_bits shortens the digest that keys the state, to test the byte check.
    """
    return _decisions(*located(docs.sparkSession, docs), key_bits)


def _decisions(placed: DataFrame, file: str, at: str, key_bits: int | None = None) -> DataFrame:
    spark = placed.sparkSession
    slim = placed.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(file).alias("__file"), F.col(at).alias("__row"), F.col("text").cast("string").cast("binary").alias("__bytes"))
    digests = written(spark, slim.mapInArrow(lean(_digests(key_bits)), "doc_id long, __file string, __row long, __key binary, text_sha256 string").withColumns({"__null": F.col("doc_id").isNotNull(), "__rowneg": -F.col("__row")}), "digests")
    files = digests.inputFiles()
    if not files or digests.limit(1).count() == 0:
        return digests.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256", "__file", "__row")
    total = digests.count()
    groups = _state(spark, digests, len(files)).withColumn("__id", F.lit(b""))
    repeated = groups.filter("n > 1")
    # on hits, the full bytes: a group whose least and greatest bytes are the same holds equal texts alone
    few = repeated.count()
    hits = repeated.select(F.col("__key").alias("__hit"))
    members = digests.join(F.broadcast(hits) if few <= MOST_BROADCAST else hits, F.col("__key") == F.col("__hit"), "left_semi")
    members = written(spark, members.select(F.xxhash64("__file").alias("__mf"), F.col("__row").alias("__mr"), "__key"), "hits", small=True)
    if members.count() <= MOST_BROADCAST:
        members = F.broadcast(members)
    texts = slim.join(members, (F.xxhash64("__file") == F.col("__mf")) & (F.col("__row") == F.col("__mr"))).select("__key", "__bytes", "doc_id", "__file", "__row")
    texts = texts.mapInArrow(lean(_lowered), "__key binary, __text binary, doc_id long, __file string, __row long")
    ends = texts.groupBy("__key").agg(F.min("__text").alias("lo"), F.max("__text").alias("hi"))
    mixed = written(spark, ends.filter("lo <> hi").select("__key"), "mixed", small=True)  # digests that collide: none are known
    digests = digests.withColumn("__id", F.lit(b""))
    if few and mixed.count():
        texts = texts.join(mixed, "__key", "left_semi")
        split = texts.groupBy("__key", F.col("__text").alias("__id")).agg(F.max(F.struct(F.col("doc_id").isNotNull().alias("__null"), "doc_id", (-F.col("__row")).alias("__rowneg"), "__file")).alias("last"), F.count("*").alias("n"))
        groups = groups.join(mixed, "__key", "left_anti").unionByName(split)
        full = texts.select(F.col("__file").alias("__f"), F.col("__row").alias("__r"), F.col("__text").alias("__full"))
        digests = digests.drop("__id").join(full, (F.col("__file") == F.col("__f")) & (F.col("__row") == F.col("__r")), "left").withColumn("__id", F.coalesce("__full", F.lit(b""))).drop("__f", "__r", "__full")
    groups = groups.filter("n > 1").select(F.concat(F.hex("__key"), F.lit(":"), F.hex("__id")).alias("__g"), F.col("n").alias("__n"), F.col("last.doc_id").alias("__keep"), F.col("last.__file").alias("__kf"), F.col("last.__rowneg").alias("__kr"), F.col("n").alias("__size"))
    rows = digests.withColumn("__g", F.concat(F.hex("__key"), F.lit(":"), F.hex("__id")))
    rows = join_groups(rows, groups, "__g", total, ["__keep", "__kf", "__kr", "__size"])
    alone = F.col("__size").isNull()
    return rows.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("__keep")).alias("keep_id"),
        F.coalesce("__size", F.lit(1)).cast("long").alias("group_size"),
        (alone | ((F.col("__file") == F.col("__kf")) & (F.col("__row") == -F.col("__kr")))).alias("kept"),
        "text_sha256",
        "__file",
        "__row",
    )


def _lowered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield b.set_column(1, "__text", pa.array([(t.as_py() or b"").lower() for t in b.column(1)], pa.binary()))


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, whole, whatever their columns are called; null texts count as empty and are equal.
    Of rows that repeat the largest doc_id of a group one stays. No rows give no rows."""
    placed = located(docs.sparkSession, docs)
    return without(*placed, _decisions(*placed).filter("not kept").select(F.xxhash64("__file").alias("f"), F.col("__row").alias("row")))
