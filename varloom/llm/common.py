"""What the training-data operators share: shared storage, row locators and skew-safe joins."""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A group with at least this share of all rows is "hot"; at most 1 / HOT_SHARE groups can be.
HOT_SHARE = 1 / 1000

#: Rows a Python worker gets at a time; texts may be long, so batches stay small.
ARROW_ROWS = 512


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder, unused so far, that driver and executors share.

    It lies under ``spark.checkpoint.dir``; only where that is unset and all runs on one machine
    is a folder chosen here and set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        import tempfile

        base = f"file://{tempfile.mkdtemp(prefix='varloom-shared-')}"
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def batched(spark: SparkSession, rows: int = ARROW_ROWS):
    """Keep the Arrow batches of Python stages that run inside small enough for long texts."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def written(spark: SparkSession, df: DataFrame, name: str, small: bool = False, numbers: bool = False) -> DataFrame:
    """df as a Parquet table in the shared folder: a cut of lineage that outlives executors.

    small: rows of a few numbers, that a few files for each core hold better than one a partition.
    numbers: mostly hashes and ids, which don't get smaller. Neither is compressed: a codec's
    buffers lie outside the heap until it is collected, and many small files have many of them.
    """
    path = shared_dir(spark, name)
    if small:
        df = df.coalesce(4 * spark.sparkContext.defaultParallelism)
    with batched(spark):
        (df.write.option("compression", "none") if small or numbers else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, df: DataFrame) -> None:
    """Delete the files of a table made by ``written`` that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    for f in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def lean(run, blocks: bool = True):
    """A function for mapInArrow whose worker, which Spark keeps for later tasks, holds on to little memory.

    blocks: large blocks come from the system and go back to it whenever they are freed, which
    costs time where a task makes many. What is free at the end goes back in any case, and so does
    the tokenizer of earlier tasks, with the words it has met, if this one had no use for it.
    Batches come in slices of ARROW_ROWS, whatever the session's own size is.
    """

    def wrapped(batches):
        import ctypes
        import sys

        import pyarrow as pa

        try:
            libc = ctypes.CDLL("libc.so.6")
            if blocks:
                libc.mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD, else it grows with what is freed
                libc.mallopt(-1, 4 << 20)  # M_TRIM_THRESHOLD
        except (OSError, AttributeError):  # another C library
            libc = None
        if blocks:
            pa.set_memory_pool(pa.system_memory_pool())
        tokens = sys.modules.get("varloom.llm.tokens")
        used = tokens and tokens.shared_tokenizer.cache_info()
        yield from run(b.slice(i, ARROW_ROWS) for b in batches for i in range(0, b.num_rows, ARROW_ROWS))
        if tokens and tokens.shared_tokenizer.cache_info() == used:
            tokens.shared_tokenizer.cache_clear()
        pa.default_memory_pool().release_unused()
        if libc:
            libc.malloc_trim(0)

    return wrapped


def unused(names: list[str], *wanted: str) -> list[str]:
    """The wanted names, each with as many underscores before it as it takes to be none of names."""
    taken, out = {n.lower() for n in names}, []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
    return out


def located(spark: SparkSession, df: DataFrame) -> tuple[DataFrame, str, str]:
    """df with the place that each row is stored at, and the names of the two columns that say so: file, row in it.

    Files give it directly. Any other frame is written to the shared folder first, so that the
    locator names one row for good, whichever executors read it again.
    """
    file, row = unused(df.columns, "__file", "__row")
    try:
        meta = df.metadataColumn("_metadata")
        return df.select("*", meta["file_path"].alias(file), meta["row_index"].alias(row)), file, row
    except Exception as e:  # noqa: BLE001  no file source below
        if "UNRESOLVED_COLUMN" not in str(e) and "METADATA" not in str(e).upper():
            raise
        df = written(spark, df, "rows")
        meta = df.metadataColumn("_metadata")
        return df.select("*", meta["file_path"].alias(file), meta["row_index"].alias(row)), file, row


def join_groups(rows: DataFrame, groups: DataFrame, key: str, total: int, values: list[str]) -> DataFrame:
    """rows left-joined on ``key`` with groups (one row a key, with its row count ``__n``).

    Keys that hold at least HOT_SHARE of all ``total`` rows are at most 1 / HOT_SHARE, so they
    are broadcast; the rows of all other keys meet in a shuffled join, in which the rows that are
    done already are spread by a key of their own. So no key's rows meet in one task.
    """
    least = max(2, int(total * HOT_SHARE))
    hot = groups.filter(F.col("__n") >= least).select(F.col(key).alias("__hk"), F.struct(*values).alias("__hv"))
    rest = groups.filter(F.col("__n") < least).select(F.col(key).alias("__rk"), F.struct(*values).alias("__rv"))
    rows = rows.join(F.broadcast(hot), F.col(key) == F.col("__hk"), "left")
    done = F.col("__hk").isNotNull()
    rows = rows.withColumn("__k", F.when(done, F.concat(F.lit("~"), F.monotonically_increasing_id().cast("string"))).otherwise(F.col(key).cast("string")))
    rows = rows.join(rest, F.col("__k") == F.col("__rk").cast("string"), "left")
    picked = F.when(done, F.col("__hv")).otherwise(F.col("__rv"))
    rows = rows.withColumn("__v", picked)
    return rows.select("*", *[F.col("__v")[v].alias(v) for v in values]).drop("__hk", "__hv", "__rk", "__rv", "__k", "__v")


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b: long): node, component (its least node).

    Alternating large-star and small-star rounds, each a pair of aggregations and joins over the
    edges alone, written to the shared folder. Nothing is collected but a count and a checksum.
    """

    def star(e: DataFrame, large: bool, n: int) -> DataFrame:
        both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"), F.count("*").alias("__n")).withColumn("m", F.least("u", "m"))
        met = join_groups(both, low.withColumnRenamed("u", "a"), "a", n, ["m"])  # a hub is no hot key
        if large:
            return met.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        return met.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select(F.col("u").alias("a"), F.col("m").alias("b")))

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = written(spark, edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges", small=True)
    before = mark(edges)
    while before[0]:
        half = written(spark, star(edges, True, 2 * before[0]), "edges", small=True)
        now = star(half, False, before[0]).filter("a != b").distinct()
        edges, old = written(spark, now, "edges", small=True), edges
        removed(spark, old)
        removed(spark, half)
        after = mark(edges)
        if after == before:
            break
        before = after
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def without(placed: DataFrame, file: str, row: str, dropped: DataFrame, most_broadcast: int = 500_000) -> DataFrame:
    """The rows of a ``located`` frame whose place isn't among those of dropped (f, row), without the place.

    f is the hash of the file: places are two longs each; up to most_broadcast of them are broadcast, more meet in a shuffle.
    """
    spark = placed.sparkSession
    f, r = unused(placed.columns, "__df", "__dr")
    dropped = written(spark, dropped.select(F.col("f").alias(f), F.col("row").alias(r)), "dropped", small=True)
    if dropped.count() <= most_broadcast:
        dropped = F.broadcast(dropped)
    return placed.join(dropped, (F.xxhash64(file) == F.col(f)) & (F.col(row) == F.col(r)), "left_anti").drop(file, row)


def text_of(column: str) -> Column:
    """The column's text; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
