"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, exact_dedup, html_extract, langid, near_dedup, packing, pii, secrets, token_binary, warc
from .common import table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.found(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decisions(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("__file", "__row")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extracted(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents").select("doc_id", "text"), decontaminate.benchmark_of(spark, sf_dir))


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.decisions(table(spark, sf_dir, "documents").select("doc_id", "text"), words=4, percent=80)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return langid.tables_identified(docs, table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_binary.token_table(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.found(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {f.__name__: f for f in (op1_secret_scan, op2_exact_dedup, op3_warc, op4_html_extract, op5_decontaminate, op6_minhash_near_dedup, op7_language_id, op8_packing, op9_token_binary, op10_pii)}

ORACLE_SQL = {
    "op1_secret_scan": secrets.sql(),
    "op2_exact_dedup": """
        WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, text_sha256
        FROM d WINDOW w AS (PARTITION BY text_sha256)""",
    "op3_warc": """
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
        h AS (SELECT page_id, octet_length(b) AS payload_bytes, sha1(b) AS x, max(page_id) OVER (PARTITION BY b) AS first FROM p),
        d AS (SELECT *, list_transform(range(0, 40), lambda i: strpos('0123456789abcdef', substr(x, CAST(i + 1 AS INT), 1)) - 1) AS n FROM h),
        s AS (SELECT *, array_to_string(list_transform(range(0, 160), lambda i: CAST((n[CAST(i // 4 + 1 AS INT)] >> CAST(3 - i % 4 AS INT)) & 1 AS VARCHAR)), '') AS bits FROM d)
        SELECT page_id, payload_bytes,
               array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
                   16 * (ascii(bits[i * 5 + 1]) - 48) + 8 * (ascii(bits[i * 5 + 2]) - 48) + 4 * (ascii(bits[i * 5 + 3]) - 48) + 2 * (ascii(bits[i * 5 + 4]) - 48) + ascii(bits[i * 5 + 5]) - 48 + 1 AS INT), 1)), '') AS payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM s""",
}
