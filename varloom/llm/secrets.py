r"""Secrets in whole texts, by DataFrame functions alone.

Strong kinds (assign, access, hex) are found by their patterns. Weak parts (short assigned values,
key-like runs, identifiers, endpoints) are rows with an interval in code points; an interval join
within scopes (same document, at most SCOPE code points apart, met through SCOPE-wide buckets)
keeps a weak part only when a complementary one is there: a weak secret needs an identifier or an
endpoint, a weak identifier or an endpoint needs a secret, and the two don't overlap, so that parts
vouch for each other both ways. The join is a semi-join: it makes no pairs.

Positions come from lengths: the pieces between the matches of a pattern and the matches themselves
follow each other, so running sums of their lengths are the spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_of, written

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Where ASSIGN can match at all.
ASSIGN_WORDS = r"(?i:password|passwd|secret|token|api_?key)"
ACCESS = r"(AKIA)([A-Z0-9]{14,})"  # a run too short here would be dropped, and holds no longer one
HEX = r"()([0-9a-f]{16,})"  # runs are maximal, so shorter ones are those to drop
IDENTIFIER = r"""((?i:username|user|login|client_?id|access_?key_?id|account_?id))["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]+)"""
BLOB = r"()([A-Za-z0-9+/]{40,})"
ENDPOINT = r"""((?i:https?|ftp|jdbc:[a-z]+|postgres|postgresql|mysql|mongodb|redis|amqp|s3)://)([^\x00-\x20"'<>]+)"""

#: Fixed order of the kinds: base kinds, then those that linking adds.
KINDS = ("assign", "access", "hex", "weak_secret", "weak_id", "endpoint")
#: Code points at most between parts that belong together.
SCOPE = 200
LEAST_ASSIGN, LEAST_WEAK, BLOB_CHARS = 12, 6, 40


def _found(pattern: str, kind: int, where: Column) -> Column:
    """kind, lengths of the pieces between matches, of the matches, and of their group 2."""
    text, p = F.col("text"), F.lit(pattern)
    size = lambda x: F.length(x)
    got = F.struct(
        F.lit(kind).alias("kind"),
        F.transform(F.split(text, pattern, -1), size).alias("gaps"),
        F.transform(F.regexp_extract_all(text, p, F.lit(0)), size).alias("lens"),
        F.transform(F.regexp_extract_all(text, p, F.lit(2)), size).alias("values"),
    )
    return F.when(where, got)


def scanned(docs: DataFrame) -> DataFrame:
    """A row per document: rid, doc_id, raw (of each pattern that may match, its lengths)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text")).withColumn("rid", F.monotonically_increasing_id())
    text = F.col("text")
    rows = rows.withColumn("a", text.rlike(ASSIGN_WORDS)).withColumn("k", text.contains("AKIA")).withColumn("h", text.rlike("[0-9a-f]{16}")).withColumn("b", text.rlike(f"[A-Za-z0-9+/]{{{BLOB_CHARS}}}"))
    # identifiers and endpoints stay only near a secret, which a key-like run is too
    secret = F.col("a") | F.col("h") | F.col("b")
    raw = [
        _found(ASSIGN, 0, F.col("a")),
        _found(ACCESS, 1, F.col("k")),
        _found(HEX, 2, F.col("h")),
        _found(BLOB, 3, F.col("b")),
        _found(IDENTIFIER, 4, secret & text.rlike(r"(?i:user|login|client|access|account)")),
        _found(ENDPOINT, 5, secret & text.contains("://")),
    ]
    return rows.select("rid", "doc_id", F.filter(F.array(*raw), lambda x: x.isNotNull()).alias("raw"))


def parts(rows: DataFrame) -> DataFrame:
    """A row per match of a kind: rid, kind, s, e, base."""
    one = rows.filter(F.size("raw") > 0).select("rid", F.explode("raw").alias("x"))
    # the last gap has no match after it
    each = one.select("rid", "x.kind", F.posexplode(F.arrays_zip("x.gaps", "x.lens", "x.values"))).select("rid", F.col("kind").alias("pattern"), "pos", "col.gaps", "col.lens", "col.values").filter("lens is not null")
    upto = Window.partitionBy("rid", "pattern").orderBy("pos")
    each = each.withColumn("e", F.sum(F.col("gaps") + F.col("lens")).over(upto)).withColumn("s", F.col("e") - F.col("lens"))
    p, n = F.col("pattern"), F.col("values")
    kind = F.when((p == 0) & (n >= LEAST_ASSIGN), 0).when((p == 0) & (n >= LEAST_WEAK), 3).when(p == 1, 1).when(p == 2, 2).when((p == 3) & (n >= BLOB_CHARS), 3).when((p == 4) & (n >= 3), 4).when((p == 5) & (n >= 3), 5)
    return each.withColumn("kind", kind).filter("kind is not null").select("rid", "kind", "s", "e", (F.col("kind") < 3).alias("base"))


def linked(found: DataFrame) -> DataFrame:
    """The weak parts that no base span overlaps and that a complementary part of those left is near to."""
    keys = ["rid", "kind", "s", "e"]
    buckets = F.explode(F.sequence(F.floor(F.col("s") / SCOPE), F.floor(F.col("e") / SCOPE)))
    reach = F.explode(F.sequence(F.floor((F.col("s") - SCOPE) / SCOPE), F.floor((F.col("e") + SCOPE) / SCOPE)))
    named = lambda parts: parts.select(F.col("rid").alias("r"), F.col("kind").alias("k"), F.col("s").alias("ts"), F.col("e").alias("te"), buckets.alias("b"))
    same = (F.col("rid") == F.col("r")) & (F.col("bucket") == F.col("b"))
    base, weak = found.filter("base").select(*keys), found.filter("not base").select(*keys)
    over = weak.withColumn("bucket", buckets).join(named(base), same & (F.col("ts") < F.col("e")) & (F.col("s") < F.col("te")), "left_semi")
    weak = weak.join(over.select(*keys).distinct(), keys, "left_anti")
    apart = (F.col("te") <= F.col("s")) | (F.col("e") <= F.col("ts"))
    fits = F.when(F.col("kind") == 3, F.col("k").isin(1, 4, 5)).otherwise(F.col("k").isin(0, 2, 3)) & apart
    met = weak.withColumn("bucket", reach).join(named(base.unionByName(weak)), same & fits & (F.col("ts") - F.col("e") <= SCOPE) & (F.col("s") - F.col("te") <= SCOPE), "left_semi")
    return met.select(*keys).distinct()


def found(docs: DataFrame) -> DataFrame:
    """A row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_spans.

    spans: kind:start:end by start, then kind as listed in KINDS; comma-joined. Null text counts
    as empty and has none; null doc_ids and repeated rows are kept each. No rows give no rows.
    """
    spark = docs.sparkSession
    rows = written(spark, scanned(docs), "secrets")
    every = written(spark, parts(rows), "secret-parts", small=True)
    every = every.filter("base").select("rid", "kind", "s", "e").unionByName(linked(every))
    got = every.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("s", "kind", "e"))).alias("x")).withColumnRenamed("rid", "r")
    out = rows.select("rid", "doc_id").join(got, F.col("rid") == F.col("r"), "left").withColumn("x", F.coalesce("x", F.array().cast("array<struct<s:bigint,kind:int,e:bigint>>")))
    names = F.array(*map(F.lit, KINDS))
    base = F.filter("x", lambda f: f["kind"] < 3)
    text = lambda x: F.array_join(F.transform(x, lambda f: F.concat_ws(":", F.element_at(names, f["kind"] + 1), f["s"].cast("string"), f["e"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("x", lambda f: f["kind"] == k)).cast("long")
    return out.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(text(base).cast("binary"), 256).alias("base_sha256"), text(F.col("x")).alias("spans"), F.size("x").cast("long").alias("n_spans"))


def sql() -> str:
    """The same for DuckDB."""
    quoted = {k: "'" + v.replace("'", "''") + "'" for k, v in {"0": ASSIGN, "1": ACCESS, "2": HEX, "3": BLOB, "4": IDENTIFIER, "5": ENDPOINT}.items()}
    each = " UNION ALL ".join(f"SELECT rid, {k} AS pattern, string_split_regex(text, {v}) AS gaps, regexp_extract_all(text, {v}, 0) AS lens, regexp_extract_all(text, {v}, 2) AS vals FROM d" for k, v in quoted.items())
    kinds = "['" + "','".join(KINDS) + "']"
    return f"""
        WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
        raw AS ({each}),
        e AS (SELECT rid, pattern, unnest(range(len(lens))) AS pos, gaps, lens, vals FROM raw WHERE len(lens) > 0),
        m AS (SELECT rid, pattern, length(lens[pos + 1]) AS l, length(vals[pos + 1]) AS n,
                     sum(length(gaps[pos + 1]) + length(lens[pos + 1])) OVER (PARTITION BY rid, pattern ORDER BY pos) AS e FROM e),
        q AS (SELECT rid, e - l AS s, e, CASE WHEN pattern = 0 AND n >= {LEAST_ASSIGN} THEN 0 WHEN pattern = 0 AND n >= {LEAST_WEAK} THEN 3
                     WHEN pattern = 1 THEN 1 WHEN pattern = 2 THEN 2 WHEN pattern = 3 AND n >= {BLOB_CHARS} THEN 3 WHEN pattern = 4 AND n >= 3 THEN 4 WHEN pattern = 5 AND n >= 3 THEN 5 END AS kind FROM m),
        o AS (SELECT DISTINCT * FROM q WHERE kind IS NOT NULL),
        p AS (SELECT * FROM o WHERE kind < 3 OR NOT EXISTS (SELECT 1 FROM o t WHERE t.rid = o.rid AND t.kind < 3 AND t.s < o.e AND o.s < t.e)),
        w AS (SELECT * FROM p WHERE kind < 3 OR
                EXISTS (SELECT 1 FROM p t WHERE t.rid = p.rid AND t.s - p.e <= {SCOPE} AND p.s - t.e <= {SCOPE} AND (t.e <= p.s OR p.e <= t.s)
                        AND CASE WHEN p.kind = 3 THEN t.kind IN (1, 4, 5) ELSE t.kind IN (0, 2, 3) END)),
        g AS (SELECT rid, count(*) FILTER (kind = 0) AS a, count(*) FILTER (kind = 1) AS k, count(*) FILTER (kind = 2) AS h, count(*) AS n,
                     string_agg({kinds}[kind + 1] || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY s, kind) FILTER (kind < 3) AS base,
                     string_agg({kinds}[kind + 1] || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY s, kind) AS spans FROM w GROUP BY rid)
        SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(k, 0) AS n_access, coalesce(h, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
               coalesce(spans, '') AS spans, coalesce(n, 0) AS n_spans
        FROM d LEFT JOIN g USING (rid)"""
