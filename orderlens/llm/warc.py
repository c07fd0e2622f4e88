"""WARC archives with revisit records for repeated payloads.

Writing: the headers of all records (id, digest, size; no payload) are shuffled
by payload digest and reduced to one original for each digest that occurs
again. The records join these: by broadcast where Spark finds them small, else
by one shuffle. Of records with equal payloads of at least ``min_bytes`` the one
with the largest id stays a response; the others become revisit records (profile
identical-payload-digest) that refer to it and have HTTP headers, but no
payload. All get fresh headers. A third of all records may share one payload:
headers are reduced before their shuffle, and as a digest has one original,
Spark can split its records in the join.

Files: each record is a gzip member of its own, as archive readers expect, and
an empty member with a comment ends it. That empty member is also the line
separator of Spark's text source, so that Spark writes archives to any store it
reaches, protects them by its commit, and splits a file of any size between
records when it reads; nobody holds more than one record and batch at a time.

Reading: members are opened where Spark cut them, headers parsed, and revisit
records joined to their responses by payload digest.

Edge cases: a null payload is empty; a null or blank URL leaves the target out
as "urn:page:unknown"; white space and control characters in URLs are
percent-encoded; a null id is smaller than every other and is written without
an id field; rows that repeat the largest id of a payload are all responses;
records that come in as revisits (null payload, a digest) join an original of
their digest, and keep their old reference where there is none; an empty table
gives no records; further columns are ignored.
"""

from __future__ import annotations

import base64
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm.shared import shared_path, ship_code, table

MIN_BYTES = 1000
DATE = "2024-01-01T00:00:00Z"          # the date of records that come without one
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")    # fixed value: URLs (RFC 9562)
# An empty gzip member (RFC 1952) with the comment "end"; flags differ from
# those of the records' members.
END = bytes([0x1F, 0x8B, 8, 16, 0, 0, 0, 0, 0, 3]) + b"end\0" + bytes([3, 0]) + bytes(8)
ENCODING = "ISO-8859-1"                # one byte per character of the separator
RECORDS_PER_BATCH = 500
RECORD = ("record_id string, record_type string, page_id long, uri string, date string, payload_digest string, "
          "payload_bytes long, refers_to_id string, payload binary")


def deduplicated(records: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """records (page_id, url, payload, optionally payload_digest (hex),
    payload_bytes, record_type and refers_to of records that are revisits
    already) -> the same with record_type and refers_to (page_id of the
    response) anew; the payload of revisits is null."""
    have = records.columns
    payload = F.col("payload").cast("binary")
    old = (F.col("record_type") == "revisit") if "record_type" in have else F.lit(False)
    old = F.coalesce(old, F.lit(False))
    digest = F.sha1(F.coalesce(payload, F.lit(b"")))
    size = F.coalesce(F.octet_length(payload), F.lit(0)).cast("long")
    if "payload_digest" in have:
        digest = F.when(old, F.col("payload_digest")).otherwise(digest)
        size = F.when(old, F.col("payload_bytes")).otherwise(size)
    known = F.col("refers_to").cast("long") if "refers_to" in have else F.lit(None).cast("long")
    rows = records.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload"),
                          digest.alias("payload_digest"), size.alias("payload_bytes"), old.alias("_old"),
                          F.when(old, known).alias("_known"))
    originals = (rows.filter((F.col("payload_bytes") >= min_bytes) & ~F.col("_old"))
                 .groupBy(F.col("payload_digest").alias("_digest"), F.col("payload_bytes").alias("_bytes"))
                 .agg(F.max("page_id").alias("_original"), F.count("*").alias("_n"))
                 # A payload that occurs once is an original for older revisits only.
                 .filter(F.col("_n") > (0 if "record_type" in have else 1)).drop("_n"))
    joined = rows.join(originals, (F.col("payload_digest") == F.col("_digest")) & (F.col("payload_bytes") == F.col("_bytes")), "left")
    again = F.col("_original").isNotNull() & (F.col("_old") | ~F.col("page_id").eqNullSafe(F.col("_original")))
    revisit = again | F.col("_old")
    return joined.select("page_id", "url", "payload_digest", "payload_bytes",
                         F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                         F.when(again, F.col("_original")).when(F.col("_old"), F.col("_known")).alias("refers_to"),
                         F.when(~revisit, F.coalesce("payload", F.lit(b""))).alias("payload"))


def clean_uri(url: str | None) -> str:
    """A URL for a header line: white space and control characters encoded."""
    if url is None or not url.strip():
        return "urn:page:unknown"
    return "".join(c if " " < c != "\x7f" and not c.isspace() else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def record_id(page_id: int | None, digest: str) -> str:
    """The same for a repeated task: by the page and the payload."""
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page_id}:{digest}')}>"


def member(page_id, url, digest, n_bytes, kind, refers_to, payload, date=DATE) -> bytes:
    """A WARC record as a gzip member."""
    b32 = base64.b32encode(bytes.fromhex(digest)).decode()
    body = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n").encode()
    if kind == "response":
        body += payload
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {date}",
             f"WARC-Target-URI: {clean_uri(url)}", f"WARC-Payload-Digest: sha1:{b32}"]
    if kind == "revisit":
        lines.append(f"WARC-Profile: {PROFILE}")
        if refers_to is not None:
            lines += [f"WARC-Refers-To: {record_id(refers_to, digest)}", f"WARC-Refers-To-Date: {date}"]
    if page_id is not None:
        lines.append(f"Page-ID: {page_id}")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    raw = "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def fields_of(block: bytes) -> dict[str, str]:
    out = {}
    for line in block.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        out[name.strip().lower().decode()] = value.strip().decode()
    return out


def parsed(raw: bytes) -> tuple:
    """A record's member -> a row of RECORD."""
    raw = zlib.decompress(raw, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/1."):
        raise ValueError("not a WARC record")
    f = fields_of(head)
    body = rest[:int(f["content-length"])]
    if len(body) != int(f["content-length"]) or rest[len(body):] != b"\r\n\r\n":
        raise ValueError(f"record {f.get('warc-record-id')} is cut short")
    http, _, payload = body.partition(b"\r\n\r\n")
    kind = f["warc-type"]
    page = f.get("page-id")
    digest = base64.b32decode(f["warc-payload-digest"].removeprefix("sha1:")).hex()
    return (f["warc-record-id"], kind, int(page) if page else None, f.get("warc-target-uri"), f.get("warc-date"), digest,
            int(fields_of(http)["content-length"]), f.get("warc-refers-to"), payload if kind == "response" else None)


def write_archives(records: DataFrame, path: str) -> None:
    """records of ``deduplicated`` -> a folder of archives, one per partition."""
    ship_code(records.sparkSession)
    columns = ["page_id", "url", "payload_digest", "payload_bytes", "record_type", "refers_to", "payload"]

    def pack(batches):
        for b in batches:
            for at in range(0, b.num_rows, RECORDS_PER_BATCH):
                part = b.slice(at, RECORDS_PER_BATCH)
                yield pa.record_batch([pa.array([member(*r) for r in zip(*(c.to_pylist() for c in part.columns))], pa.binary())],
                                      names=["member"])

    (records.select(*columns).mapInArrow(pack, "member binary").select(F.col("member").cast("string").alias("value"))
     .write.option("lineSep", END.decode(ENCODING)).option("encoding", ENCODING).text(path))


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records of a folder of archives written by ``write_archives`` (columns of RECORD)."""
    ship_code(spark)
    schema = RECORD if payloads else RECORD.removesuffix(", payload binary")
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    types = [kinds[c.split()[1]] for c in schema.split(", ")]

    def unpack(batches):
        for b in batches:
            for at in range(0, b.num_rows, RECORDS_PER_BATCH):
                rows = [parsed(m) for m in b.column(0).slice(at, RECORDS_PER_BATCH).to_pylist()]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    members = spark.read.schema("value string").option("lineSep", END.decode(ENCODING)).option("encoding", ENCODING).text(path)
    return members.select(F.col("value").cast("binary").alias("member")).mapInArrow(unpack, schema)


def resolved(records: DataFrame) -> DataFrame:
    """records (of one reading without payloads) with refers_to: the page id
    of the response that a revisit refers to, by payload digest and record id;
    null for responses and where it is not there."""
    responses = (records.filter("record_type = 'response'").groupBy(
        F.col("payload_digest").alias("_digest"), F.col("record_id").alias("_id")).agg(F.max("page_id").alias("refers_to")))
    wanted: Column = (F.col("payload_digest") == F.col("_digest")) & (F.col("refers_to_id") == F.col("_id"))
    return records.join(responses, wanted, "left").drop("_digest", "_id")


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives, and what the archives say of it."""
    pages = table(spark, sf_dir, "pages")
    path = shared_path(spark, "warc")
    write_archives(deduplicated(pages.select("page_id", "url", F.col("html").cast("string").alias("payload"))), path)
    found = resolved(read_archives(spark, path, payloads=False))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP12_SQL = """
WITH page AS (SELECT page_id, strlen(COALESCE(html, '')) AS payload_bytes, sha1(COALESCE(html, '')) AS payload_digest FROM pages),
 newest AS (SELECT *, MAX(page_id) OVER (PARTITION BY payload_digest) AS last_id FROM page)
SELECT page_id, payload_bytes, payload_digest,
  IF(payload_bytes >= 1000 AND page_id < last_id, 'revisit', 'response') AS record_type,
  IF(payload_bytes >= 1000 AND page_id < last_id, last_id, NULL) AS refers_to
FROM newest
"""
