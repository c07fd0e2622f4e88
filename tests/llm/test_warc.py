"""WARC archives: rows against SQL and a brute force, files against gzip."""

import gzip
import hashlib
import random

from orderlens.llm import warc as W

SCHEMA = "page_id long, url string, html string, record_type string, payload string"


def brute(rows):
    last = {}
    for page, _, html in rows:
        if page is not None:
            last[html or ""] = max(page, last.get(html or "", page))
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        top = last.get(html or "")
        again = len(raw) >= 1000 and top is not None and page != top
        out.append((page, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", top if again else None))
    return sorted(out, key=str)


def pages():
    rng = random.Random(3)
    bodies = ["<p>ü</p>" * 110, "x" * 999, "x" * 1000, "é" * 500, "é" * 499 + "y", "", "a\r\n\r\nb" * 300, "\x1f\x00\n" * 400, "long " * 200_000]
    rows = [(i * 3 - 40, rng.choice(["http://a.b/c?d", "http://a.b/e f\r\nX: y", "", None, "http://ü.de/"]), rng.choice(bodies)) for i in range(150)]
    rows += [(900 + i, "http://hot/", "hot " * 300) for i in range(120)]
    return rows + [(None, "http://n/", "hot " * 300), (None, None, "only null " * 200), (2000, "u", None), (2001, "u", "z" * 2000), (2001, "u", "z" * 2000)]


def write(spark, rows, path):
    spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3).write.parquet(str(path / "pages.parquet"))


def test_query(spark, tmp_path):
    rows = pages()
    write(spark, rows, tmp_path)
    got = W.op12_warc(spark, str(tmp_path))
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_archives_round_trip(spark, tmp_path):
    """Payloads come back; each file is plain gzip of WARC records; a file
    split in many places gives every record once."""
    rows = pages()
    df = spark.createDataFrame(rows, "page_id long, url string, payload string").repartition(2)
    W.write_archives(W.deduplicated(df), str(tmp_path / "a"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (old, "777b", "5000b"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            back = W.read_archives(spark, str(tmp_path / "a")).collect()
            assert len(back) == len(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want = {(p, (h or "").encode()) for p, _, h in rows}
    payload = {r["record_id"]: bytes(r["payload"]) for r in back if r["record_type"] == "response"}
    assert {(r["page_id"], payload[r["refers_to_id"] or r["record_id"]]) for r in back} == want
    text = b"".join(gzip.decompress(f.read_bytes()) for f in sorted((tmp_path / "a").glob("part-*")))
    assert text.count(b"WARC/1.1\r\n") == len(rows)
    assert b"WARC-Target-URI: http://a.b/e%20f%0D%0AX:%20y\r\n" in text and b"\r\nX: y" not in text
    assert text.count(b"WARC-Type: revisit\r\n") == sum(r["record_type"] == "revisit" for r in back) > 100
    # a payload of 1000 bytes and more is stored once per distinct text
    stored = [bytes(r["payload"]) for r in back if r["record_type"] == "response" and len(r["payload"]) >= 1000 and r["page_id"] != 2001]
    assert len(stored) == len(set(stored))


def test_existing_revisits(spark):
    sha = hashlib.sha1(b"p" * 1500).hexdigest()
    df = spark.createDataFrame([(1, "u", b"p" * 1500, None, None, "response", None), (2, "u", b"p" * 1500, None, None, "response", None),
                                (9, "u", None, sha, 1500, "revisit", 1), (8, "u", None, "ab" * 20, 1200, "revisit", 5)],
                               "page_id long, url string, payload binary, payload_digest string, payload_bytes long, record_type string, refers_to long")
    got = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in W.deduplicated(df).collect()}
    assert got == {1: ("revisit", 2), 2: ("response", None), 9: ("revisit", 2), 8: ("revisit", 5)}


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "pages.parquet"))
    assert W.op12_warc(spark, str(tmp_path)).collect() == []
