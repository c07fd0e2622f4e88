"""Packing by power-of-two decomposition.

A document's tokens are cut into as many pieces of ``max_length`` as fit and
then into the binary digits of what is left (1320 = 1024 + 256 + 32 + 8).
Every piece is a sequence of its own; sequences of equal length form one
bucket, so that a batch drawn from a bucket needs no padding and no sequence
holds two documents. ``max_length`` is a power of two.

Sequences are numbered from 0, bucket after bucket (longest first). The
numbering needs the number of pieces per (bucket, partition) only: a table
of a dozen rows per partition.

Edge cases: a null or empty text is a document of one token (the end id); a
document of any length is cut the same way; repeated rows are packed each;
an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm.shared import running_start, ship_code, table, written
from orderlens.llm.wordbpe import encoder, vocabulary_path

PACK_LENGTH = 1024
END_ID = 0
TEXTS_PER_BATCH = 2_000_000       # characters of text whose tokens a task holds at once


def piece_lengths(n_tokens: int, max_length: int) -> list[int]:
    """1320, 1024 -> [1024, 256, 32, 8]."""
    out = [max_length] * (n_tokens // max_length)
    rest = n_tokens % max_length
    while rest:
        top = 1 << (rest.bit_length() - 1)
        out.append(top)
        rest -= top
    return out


def text_slices(texts: pa.Array, most: int) -> list[tuple[int, int]]:
    """Cut a column of texts into slices of about ``most`` characters."""
    size = np.cumsum(pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    cuts = (np.flatnonzero(np.diff(size // most)) + 1).tolist()
    return [(a, z) for a, z in zip([0, *cuts], [*cuts, len(texts)]) if z > a]


def token_batches(batches, encode, end_id: int):
    """Arrow batches of (doc_id, text) -> (doc ids, all ids with the end id
    after each text, first and length of each text's ids)."""
    for b in batches:
        doc_ids, texts = b.column(0), b.column(1)
        for a, z in text_slices(texts, TEXTS_PER_BATCH):
            ids, counts = encode(texts.slice(a, z - a).to_pylist())
            lengths = counts + 1
            stop = np.cumsum(lengths)
            full = np.full(int(stop[-1]), end_id, np.uint32)
            inside = np.ones(len(full), bool)
            inside[stop - 1] = False
            full[inside] = ids
            yield doc_ids.slice(a, z - a), full, stop - lengths, lengths


def pack_documents(docs: DataFrame, vocabulary: str | None = None, max_length: int = PACK_LENGTH,
                   end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """docs (doc_id, text) -> one row per piece: doc_id, start, length,
    ids_crc32, doc_tokens, sequence_id, offset, bucket and, with
    ``keep_ids``, ids (little-endian unsigned 32-bit)."""
    if max_length < 1 or max_length & (max_length - 1):
        raise ValueError("max_length must be a power of two")
    ship_code(docs.sparkSession)
    vocabulary = vocabulary or vocabulary_path()
    schema = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part int, nth long"
              + (", ids binary" if keep_ids else ""))

    def cut(batches):
        part = TaskContext.get().partitionId()
        encode = encoder(vocabulary).encode
        seen: dict[int, int] = {}
        for doc_ids, ids, first, lengths in token_batches(batches, encode, end_id):
            rows: list[list] = [[] for _ in range(7 + keep_ids)]
            for doc, a, n in zip(doc_ids.to_pylist(), first.tolist(), lengths.tolist()):
                raw = memoryview(ids[a:a + n].astype("<u4", copy=False)).cast("B")
                at = 0
                for size in piece_lengths(n, max_length):
                    nth = seen.get(size, 0)
                    seen[size] = nth + 1
                    piece = raw[4 * at:4 * (at + size)]
                    for column, value in zip(rows, (doc, at, size, zlib.crc32(piece), n, part, nth, *([bytes(piece)] * keep_ids))):
                        column.append(value)
                    at += size
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "nth"] + ["ids"] * keep_ids
            kinds = [pa.int64()] * 5 + [pa.int32(), pa.int64()] + [pa.binary()] * keep_ids
            yield pa.record_batch([pa.array(c, k) for c, k in zip(rows, kinds)], names=names)

    pieces = written(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
                     .mapInArrow(cut, schema), "pieces")
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    base = running_start(counts, [F.desc("length"), "part"], "n", "base").drop("n")
    # base: a row per partition and length, of which there are log2(max_length) + 1
    return (pieces.join(F.broadcast(base), ["length", "part"])
            .withColumn("sequence_id", F.col("base") + F.col("nth"))
            .withColumn("offset", F.lit(0).cast("long"))
            .withColumn("bucket", F.col("length"))
            .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "bucket",
                    *(["ids"] if keep_ids else [])))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
