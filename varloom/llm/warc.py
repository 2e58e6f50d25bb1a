"""WARC archives: write captures, read the files back, assemble transactions.

A capture is written as a request, a response (or, for a payload met already, a revisit) and a
metadata record, which name the response in WARC-Concurrent-To. Records are the rows of Spark's
text writer, whose line separator is the CRLF CRLF that ends a record: the files are WARC 1.1 in gzip,
on any store, under Spark's commit protocol. Readers take whole files, which MOST_RECORDS bounds,
and go from record to record by Content-Length.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import join_groups, lean, located, shared_dir, written

#: Records in a file at most.
MOST_RECORDS = 3_000
#: Revisits up to this number are broadcast to the writers; more are joined by shuffle.
MOST_BROADCAST = 200_000
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
DATE = "2024-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = "record_id string, warc_type string, concurrent_to string, target_uri string, date string, refers_to string, payload_digest string, block_bytes long, payload_bytes long, fields map<string,string>, block binary"


def urn(*parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, '|'.join(map(str, parts)))}>"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def clean(value: object) -> str:
    """A header's value: on one line."""
    return " ".join(str(value).split())


def record(kind: str, record_id: str, fields: dict[str, object], block: bytes) -> bytes:
    head = {"WARC-Type": kind, "WARC-Record-ID": record_id, "WARC-Date": DATE, **{k: clean(v) for k, v in fields.items() if v is not None}, "Content-Length": len(block)}
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block


def capture(rid: str, page_id: int | None, url: str | None, payload: bytes, first_rid: str | None, first_page: int | None) -> list[bytes]:
    """The three records of a page; first_*: the capture that has this payload, if it's another."""
    uri, sha = url or "urn:unknown", digest(payload)
    response = urn("response", rid)
    shared = {"WARC-Target-URI": uri}
    request = f"GET {clean(uri)} HTTP/1.1\r\n\r\n".encode()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    body = http + f"Content-Length: {len(payload)}\r\n\r\n".encode()
    if first_rid is None:
        main = record("response", response, shared | {"WARC-Payload-Digest": f"sha1:{sha}", "Content-Type": "application/http; msgtype=response"}, body + payload)
    else:
        main = record("revisit", response, shared | {"WARC-Payload-Digest": f"sha1:{sha}", "WARC-Profile": REVISIT, "WARC-Refers-To": urn("response", first_rid), "Content-Type": "application/http; msgtype=response"}, body)
    noted = {"page_id": "" if page_id is None else page_id, "payload_bytes": len(payload), "refers_to_page": "" if first_page is None else first_page}
    return [
        record("request", urn("request", rid), shared | {"WARC-Concurrent-To": response, "Content-Type": "application/http; msgtype=request"}, request),
        main,
        record("metadata", urn("metadata", rid), shared | {"WARC-Concurrent-To": response, "Content-Type": "application/warc-fields"}, "".join(f"{k}: {v}\r\n" for k, v in noted.items()).encode()),
    ]


def records(data: memoryview) -> Iterator[tuple[dict[str, str], memoryview]]:
    """The header fields (names in lower case) and block of each record of a file."""
    raw = data.obj if isinstance(data.obj, bytes) else bytes(data)
    at = 0
    while at < len(raw):
        end = raw.find(b"\r\n\r\n", at)
        if raw[at : at + 5] != b"WARC/" or end < 0:
            raise ValueError(f"no record at byte {at}")
        fields: dict[str, str] = {}
        for line in raw[at:end].split(b"\r\n")[1:]:
            name, _, value = line.partition(b":")
            fields.setdefault(name.decode("latin-1").strip().lower(), value.decode("utf-8", "replace").strip())
        size = int(fields["content-length"])
        yield fields, data[end + 4 : end + 4 + size]
        at = end + 4 + size + 4


def opened(content: bytes) -> bytes:
    """A file's bytes, plain or in any number of gzip members."""
    return gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content


def write_archives(pages: DataFrame, path: str) -> None:
    """Write (rid, page_id, url, html, first_rid, first_page) as WARC files under path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in zip(*(b.column(i).to_pylist() for i in range(3)), b.column(3), *(b.column(i).to_pylist() for i in range(4, 6))):
                yield pa.RecordBatch.from_arrays([pa.array(capture(*row[:3], row[3].as_py() or b"", *row[4:]), pa.binary())], ["value"])

    rows = pages.select("rid", "page_id", "url", "html", "first_rid", "first_page").mapInArrow(lean(run), "value binary")
    rows.select(F.col("value").cast("string")).write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", MOST_RECORDS).option("compression", "gzip").text(path)


def read_records(spark: SparkSession, path: str, blocks: bool = False) -> DataFrame:
    """A row per record of the archives under path: see RECORD.

    payload_bytes and payload_digest are computed from the block for responses and read from the
    header for others; blocks: also return the block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                rows, size = [], 0
                for fields, block in records(memoryview(opened(content.as_py()))):
                    payload = None
                    if fields["warc-type"] == "response":
                        at = bytes(block[:4096]).find(b"\r\n\r\n")
                        payload = block[at + 4 :] if at >= 0 else block
                        if fields.get("warc-payload-digest", "").removeprefix("sha1:") != (found := digest(payload)):
                            raise ValueError(f"{fields['warc-record-id']}: payload digest is {found}")
                    fields_of = {}
                    if fields["warc-type"] == "metadata":
                        fields_of = {k.strip(): v.strip() for k, _, v in (x.partition(":") for x in bytes(block).decode("utf-8", "replace").split("\r\n") if x)}
                    rows.append((fields["warc-record-id"], fields["warc-type"], fields.get("warc-concurrent-to"), fields.get("warc-target-uri"), fields.get("warc-date"), fields.get("warc-refers-to"), fields.get("warc-payload-digest", "").removeprefix("sha1:") or None, len(block), None if payload is None else len(payload), list(fields_of.items()), bytes(block) if blocks else None))
                    size += len(block) if blocks else 0
                    if len(rows) >= 512 or size > 1 << 24:
                        yield batch(rows)
                        rows, size = [], 0
                if rows:
                    yield batch(rows)

    types = [pa.string()] * 7 + [pa.int64()] * 2 + [pa.map_(pa.string(), pa.string()), pa.binary()]
    names = [f.split()[0] for f in RECORD.split(", ")]

    def batch(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(lean(run), RECORD)


def transactions(rows: DataFrame) -> DataFrame:
    """One nested row per capture from records: capture_id, request, response, metadata (structs, null if missing).

    Records are joined through concurrent-to: to the response or revisit itself, or to a request
    that names it. Of repeated requests or metadata records the least record id is taken.
    """
    part = F.struct("record_id", "warc_type", "target_uri", "date", "refers_to", "payload_digest", "block_bytes", "payload_bytes", "fields")
    main = F.col("warc_type").isin("response", "revisit")
    others = rows.filter(~main & F.col("concurrent_to").isNotNull())
    # a metadata record may name the request instead; then the request's own link leads on
    hop = others.filter("warc_type = 'request'").select(F.col("record_id").alias("via"), F.col("concurrent_to").alias("to"))
    others = others.join(hop, F.col("concurrent_to") == F.col("via"), "left").withColumn("capture_id", F.coalesce("to", "concurrent_to")).drop("via", "to")
    named = rows.filter(main).withColumn("capture_id", F.col("record_id")).unionByName(others)
    kind = lambda *k: F.min(F.when(F.col("warc_type").isin(*k), F.struct("record_id", part.alias("p"))))
    slim = named.select("capture_id", "warc_type", "record_id", *[c for c in ("target_uri", "date", "refers_to", "payload_digest", "block_bytes", "payload_bytes")], F.map_entries("fields").alias("fields"))
    got = slim.groupBy("capture_id").agg(kind("request").alias("q"), kind("response", "revisit").alias("r"), kind("metadata").alias("m"))
    return got.select("capture_id", F.col("q.p").alias("request"), F.col("r.p").alias("response"), F.col("m.p").alias("metadata"))


def archived(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write pages (page_id, url, html) as WARC, read them back: a row per page.

    page_id, payload_bytes, payload_digest, record_type (response or revisit), refers_to (page_id
    of the response). Of equal payloads of least_bytes or more the largest page_id is the response
    (of rows that repeat it, one). Null html is an empty payload; null page_ids count as smallest.
    """
    spark = pages.sparkSession
    placed, file, row = located(spark, pages)
    rid = F.concat_ws("-", F.xxhash64(file), row)
    slim = placed.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("html"), rid.alias("rid"))
    keys = written(spark, slim.select("page_id", "rid", F.sha2("html", 256).alias("key"), F.octet_length("html").alias("size")), "payloads")
    who = F.struct(F.col("page_id").isNotNull().alias("known"), "page_id", "rid")
    groups = keys.filter(F.col("size") >= least_bytes).groupBy("key").agg(F.max(who).alias("first"), F.count("*").alias("__n")).filter("__n > 1")
    again = join_groups(keys.filter(F.col("size") >= least_bytes), groups, "key", keys.count(), ["first"]).filter("first.rid <> rid")
    again = written(spark, again.select(F.col("rid").alias("r"), F.col("first.rid").alias("first_rid"), F.col("first.page_id").alias("first_page")), "revisits", small=True)
    if again.count() <= MOST_BROADCAST:
        again = F.broadcast(again)
    path = shared_dir(spark, "warc")
    write_archives(slim.join(again, F.col("rid") == F.col("r"), "left"), path)
    got = transactions(written(spark, read_records(spark, path), "records"))
    whole = lambda name: F.when(F.element_at(F.map_from_entries("metadata.fields"), name) != "", F.element_at(F.map_from_entries("metadata.fields"), name)).cast("long")
    return got.select(
        whole("page_id").alias("page_id"),
        F.coalesce("response.payload_bytes", whole("payload_bytes")).alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.warc_type").alias("record_type"),
        whole("refers_to_page").alias("refers_to"),
    )
