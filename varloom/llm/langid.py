"""Language identification by Bayesian fusion of evidence.

The text's character trigrams have a likelihood under each language (a multinomial model of hashed
trigrams, fitted on a bounded sample of labelled rows). To it come the declared markup language,
the address suffix and the host: for each, soft counts of languages by text alone are summed over
all rows by grouped aggregation, and a host's prior is smoothed towards its suffix's, that
towards the whole corpus.
"""

from __future__ import annotations

import functools
import math
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batched, join_groups, lean, located, text_of, without, written

#: Labelled texts that the model is fitted on, about; more are sampled down by a hash, to no fewer than this for a language.
TRAIN_ROWS, LANGUAGE_ROWS = 20_000, 20
#: Hash buckets of trigrams.
BUCKETS = 1 << 15
#: Trigrams that count in full as evidence; longer texts count as much as these.
FULL_TRIGRAMS = 300
#: Pseudo-rows with which a host leans on its suffix, and a suffix on the corpus.
HOST_WEIGHT, SUFFIX_WEIGHT = 20.0, 100.0
#: How far the declared language is trusted.
DECLARED_TRUST = 0.8
#: Confidence below which a row is rejected.
LEAST = 0.5


@functools.lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Of each code point whether its Unicode category is a letter or a mark that belongs to one."""
    return np.fromiter((unicodedata.category(chr(c))[0] in "LM" for c in range(0x110000)), bool, 0x110000)


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the trigrams of letters and spaces, and the end of each text's own among them."""
    joined = "\n" + "\n\n".join(t.lower() for t in texts) + "\n\n"
    c = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint32)
    letter = letters()[c]
    c = np.where(letter, c, np.uint32(32))
    h = (c[:-2] * np.uint32(0x9E3779B1)) ^ (c[1:-1] * np.uint32(0x85EBCA77)) ^ (c[2:] * np.uint32(0xC2B2AE3D))
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    some = letter[1:-1]  # the middle is a letter
    ends = np.cumsum([len(t.lower()) + 2 for t in texts])
    counted = np.concatenate([[0], np.cumsum(some)])
    return (h[some] >> np.uint32(32 - 15)).astype(np.int64), counted[np.minimum(ends, len(some))]


class Model:
    """Log-likelihoods of trigrams by language."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        self.table = np.log((counts + 0.5) / (counts.sum(0) + 0.5 * BUCKETS)).astype(np.float32)

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Of each text the tempered log-likelihoods, and the number of trigrams."""
        buckets, ends = trigrams(texts)
        n = np.diff(np.concatenate([[0], ends]))
        out = np.zeros((len(texts), len(self.languages)))
        some = np.flatnonzero(n)
        if len(some):
            starts = (ends - n)[some]
            for j in range(len(self.languages)):
                out[some, j] = np.add.reduceat(self.table[:, j][buckets].astype(np.float64), starts)
        return out * (np.minimum(n, FULL_TRIGRAMS) / np.maximum(n, 1))[:, None], n


def blocks(texts: list[str], most: int = 1_000_000) -> Iterator[list[str]]:
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def fitted(labelled: DataFrame, rows: int = TRAIN_ROWS) -> Model | None:
    """The model of (text, lang), of every language; None without labelled rows.

    It is fitted on distinct texts: copies count once, and a hash of the text draws them, so that
    the bound holds whatever is repeated. Each language has its text of the least hash at least.
    """
    spark = labelled.sparkSession
    labelled = labelled.filter("lang is not null and text is not null").select(text_of("text").alias("text"), F.col("lang").cast("string").alias("lang"))
    labelled = labelled.withColumn("u", F.pmod(F.xxhash64("text", F.lit(7)), F.lit(1 << 40)))
    by = sorted(tuple(r) for r in labelled.groupBy("lang").agg(F.approx_count_distinct("u"), F.min("u")).collect())
    if not by:
        return None
    languages = [k for k, _, _ in by]
    # each language keeps at least its share of the bound, so that a rare one is learnt too
    share = max(rows / len(by), LANGUAGE_ROWS)
    most = [max(least, int(min(1.0, share / max(1, n)) * (1 << 40))) for _, n, least in by]
    # as an Arrow table; a list of rows would start Python workers of another kind on the executors
    limits = spark.createDataFrame(pa.table([pa.array(languages, pa.string()), pa.array(range(len(by)), pa.int32()), pa.array(most, pa.int64())], ["l", "place", "most"]))
    sample = labelled.join(F.broadcast(limits), (F.col("lang") == F.col("l")) & (F.col("u") <= F.col("most")))
    sample = sample.groupBy("place", "u").agg(F.first("text").alias("text")).select("text", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = [np.zeros(0, np.int64)]
            for text, place in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                keys.append(place * BUCKETS + trigrams([text])[0])
            key, n = np.unique(np.concatenate(keys), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key // BUCKETS, pa.int32()), pa.array(key % BUCKETS, pa.int32()), pa.array(n, pa.int64())], ["lang", "bucket", "n"])

    got = sample.mapInArrow(lean(run), "lang int, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros((BUCKETS, len(languages)))
    with batched(spark):
        rows = got.collect()  # no more than the sample has trigrams
    for lang, bucket, n in rows:
        counts[bucket, lang] = n
    return Model(languages, counts)


def suffix_of(url: Column) -> Column:
    """The last label of an address's host."""
    return F.nullif(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://[^/?#]*?\.([a-z]{2,24})(?::[0-9]+)?(?:[/?#]|$)", 1), F.lit(""))


def declared_of(html: Column) -> Column:
    """The primary subtag of the html element's lang attribute."""
    return F.nullif(F.lower(F.regexp_extract(html, r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?([a-z]{2,3})""", 1)), F.lit(""))


def identified(rows: DataFrame, model: Model | None, least: float = LEAST) -> DataFrame:
    """rows (key columns, text, host, suffix, declared) with lang, confidence, n_trigrams and accepted instead of text.

    host, suffix and declared may be null: then they say nothing. A row without letters (by
    Unicode category: marks, signs and emoji are none) has language "und" and is rejected; so is one whose best language isn't sure enough. Without a
    model nothing is known: "und", and all rows are accepted.
    """
    spark = rows.sparkSession
    keys = [c for c in rows.columns if c != "text"]
    if model is None:
        return rows.select(*keys, F.lit("und").alias("lang"), F.lit(0.0).alias("confidence"), F.lit(0).cast("long").alias("n_trigrams"), F.lit(True).alias("accepted"))
    held = spark.sparkContext.broadcast(model)
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    n_lang = len(model.languages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column(len(keys)).to_pylist()]
            got = [held.value.scores(x) for x in blocks(texts)]
            ll = np.concatenate([g[0] for g in got])
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, ll.size + 1, n_lang, dtype=np.int32)), pa.array(ll.ravel()))
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(len(keys))], lists, pa.array(np.concatenate([g[1] for g in got]).astype(np.int64))], [*keys, "ll", "n_trigrams"])

    schema = ", ".join(f"`{k}` {types[k]}" for k in keys) + ", ll array<double>, n_trigrams long"
    scored = written(spark, rows.select(*keys, "text").mapInArrow(lean(run), schema), "languages")

    def softmax(x: Column) -> Column:
        e = F.transform(x, lambda v: F.exp(v - F.array_max(x)))
        return F.transform(e, lambda v: v / F.aggregate(e, F.lit(0.0), lambda a, y: a + y))

    # counts of languages by text alone, softly
    p = scored.filter("n_trigrams > 0").select("host", "suffix", "declared", softmax(F.col("ll")).alias("p"))
    sums = lambda g, c, n: g.agg(F.array(*[F.sum(F.col(c)[i]) for i in range(n_lang)]).alias("c"), F.sum(n).alias("__n"))
    # one pass by host and suffix; all else is summed from that
    each = written(spark, sums(p.groupBy("host", "suffix"), "p", F.lit(1)), "evidence")
    whole = sums(each.groupBy(), "c", "__n").first()
    total = whole["__n"] or 0
    corpus = [((c or 0.0) + 1.0) / (total + n_lang) for c in (whole["c"] or [0.0] * n_lang)]
    base = F.array(*[F.lit(float(x)) for x in corpus])

    def smoothed(counts: Column, n: Column, weight: float, prior: Column) -> Column:
        return F.when(counts.isNull(), prior).otherwise(F.zip_with(counts, prior, lambda c, q: (c + weight * q) / (n + weight)))

    # a suffix is one of a few thousand, but hosts are many: both are joined so that none is hot
    suffixes = sums(each.filter("suffix is not null").groupBy("suffix"), "c", "__n").select("suffix", "__n", F.col("c").alias("sc"), F.col("__n").alias("sn"))
    hosts = sums(each.filter("host is not null").groupBy("host"), "c", "__n").select("host", "__n", F.col("c").alias("hc"), F.col("__n").alias("hn"))
    out = scored
    for groups, key, values in ((suffixes, "suffix", ["sc", "sn"]), (hosts, "host", ["hc", "hn"])):
        spread = F.coalesce(F.col(key).cast("string"), F.concat(F.lit("\0"), F.monotonically_increasing_id().cast("string")))
        out = join_groups(out.withColumn("__key", spread), groups.withColumn("__key", F.col(key).cast("string")), "__key", total, values).drop("__key")
    prior = smoothed(F.col("hc"), F.col("hn"), HOST_WEIGHT, smoothed(F.col("sc"), F.col("sn"), SUFFIX_WEIGHT, base))
    names = F.array(*[F.lit(x) for x in model.languages])
    known = F.array_contains(names, F.col("declared"))
    other = math.log((1 - DECLARED_TRUST) / max(1, n_lang - 1)) if n_lang > 1 else 0.0
    said = F.transform(names, lambda x: F.when(known, F.when(x == F.col("declared"), math.log(DECLARED_TRUST)).otherwise(other)).otherwise(F.lit(0.0)))
    fused = F.zip_with(F.zip_with(F.col("ll"), F.transform(prior, lambda v: F.log(v)), lambda a, b: a + b), said, lambda a, b: a + b)
    out = out.withColumn("post", softmax(fused)).withColumn("best", F.array_max("post"))
    some = F.col("n_trigrams") > 0
    lang = F.when(some, F.element_at(names, F.array_position("post", F.col("best")).cast("int"))).otherwise("und")
    return out.select(*keys, lang.alias("lang"), F.when(some, F.col("best")).otherwise(0.0).alias("confidence"), "n_trigrams", (some & (F.col("best") >= least)).alias("accepted"))


def documents_identified(docs: DataFrame, keys: list[Column], least: float = LEAST) -> DataFrame:
    """Documents (text, lang, source): lang labels fit the model; the source stands for the host."""
    return _documents(docs, keys, fitted(docs.select("text", "lang")), least)


def _documents(docs: DataFrame, keys: list[Column], model: Model | None, least: float) -> DataFrame:
    none = F.lit(None).cast("string")
    return identified(docs.select(*keys, text_of("text").alias("text"), F.col("source").cast("string").alias("host"), none.alias("suffix"), none.alias("declared")), model, least)


def pages_identified(pages: DataFrame, model: Model | None, least: float = LEAST) -> DataFrame:
    """Pages (page_id, url, html): page_id, lang, confidence, n_trigrams, accepted by all evidence; the text is the html without tags.

    A null url has no host or suffix, null html no letters: "und" and rejected. Rows are kept as often as they come.
    """
    url, html = text_of("url"), text_of("html")
    text = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>", " "), "<[^>]*>", " ")
    host = F.nullif(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://([^/?#:]*)", 1), F.lit(""))
    return identified(pages.select("page_id", text.alias("text"), host.alias("host"), suffix_of(url).alias("suffix"), declared_of(html).alias("declared")), model, least).drop("host", "suffix", "declared")


def tables_identified(docs: DataFrame, pages: DataFrame, least: float = LEAST) -> DataFrame:
    """Documents (doc_id, text, lang, source) and pages (page_id, url, html) by one model, fitted on the documents' labels.

    A row for each of both: table, doc_id (null for pages), page_id (null for documents), lang, confidence, n_trigrams, accepted.
    """
    model = fitted(docs.select("text", "lang"))
    ids = lambda table: [F.lit(table).alias("table"), *[(F.col(c) if t == table else F.lit(None)).cast("long").alias(c) for t, c in (("documents", "doc_id"), ("pages", "page_id"))]]
    values = ["lang", "confidence", "n_trigrams", "accepted"]
    ours = _documents(docs, [F.col("doc_id").cast("long").alias("doc_id")], model, least).select(*ids("documents"), *values)
    return ours.unionByName(pages_identified(pages, model, least).select(*ids("pages"), *values))


def accepted(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """The rows of docs that aren't rejected, whole, with all their columns, whatever those are called.

    Null, empty and letterless texts are rejected; repeated rows share their text's fate. Where no
    row has a label nothing is known, and all stay. No rows give no rows.
    """
    placed, file, row = located(docs.sparkSession, docs)
    rows = documents_identified(placed, [F.xxhash64(file).alias("f"), F.col(row).alias("row")], least)
    return without(placed, file, row, rows.filter("not accepted").select("f", "row"))
