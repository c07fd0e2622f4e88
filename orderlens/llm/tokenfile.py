"""Token-id files by bit-plane shuffling.

A chunk holds whole documents. Its ids are cut into blocks of ``BLOCK`` ids
(the last one shorter); each block is transposed into bit planes (plane k: bit
k of every id of the block, up to the block's highest bit) and each plane is
compressed by zstandard on its own. A plane of zeros only is stored as nothing.
A block can thus be read without the others. Beside the planes a
chunk carries its index: documents, their lengths, first document, number of
ids, block size, bytes of each plane of each block. Chunks lie in a Parquet
table in the shared folder, so that Spark's
commit makes a lost executor's chunks appear once or not at all; the chunk
index with each chunk's place in the whole sequence of ids is a second, small
table. ``read_token_ids`` reads a stretch of ids by it: only files that hold
the stretch, and of their chunks only the blocks that meet it.

Documents stand in ascending doc_id order (rows of one doc_id in the order
of their text's hash): a range shuffle of the texts, then a sort within each
partition.

Edge cases: a null or empty text is just the end id; a null doc_id sorts
first; a very long document makes a chunk of its own; repeated rows are kept
each; an empty table gives an empty file and no rows; further columns are
ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm.packing import END_ID, token_batches
from orderlens.llm.shared import running_start, shared_path, ship_code, table
from orderlens.llm.wordbpe import encoder, vocabulary_path

BLOCK = 16384                # ids of a block; a multiple of 8
CHUNK_IDS = 1 << 18          # a chunk is closed once it holds as many ids
LEVEL = 1
CHUNK_SCHEMA = ("part int, chunk int, n_docs int, n_ids long, first_doc long, before long, block int, "
                "plane_bytes array<array<int>>, doc_ids array<long>, lengths array<long>, planes array<array<binary>>")


def block_planes(ids: np.ndarray, squeeze: zstandard.ZstdCompressor) -> list[bytes]:
    """The compressed bit planes of one block (b"" for a plane of zeros)."""
    out = []
    for k in range(int(ids.max()).bit_length()):
        bits = np.packbits(((ids >> np.uint32(k)) & np.uint32(1)).astype(np.uint8), bitorder="little")
        out.append(squeeze.compress(bits.tobytes()) if bits.any() else b"")
    return out


def block_ids(planes: list[bytes], n_ids: int, expand: zstandard.ZstdDecompressor) -> np.ndarray:
    """The inverse of block_planes."""
    out = np.zeros(n_ids, np.uint32)
    for k, plane in enumerate(planes):
        if plane:
            raw = np.frombuffer(expand.decompress(plane, max_output_size=-(-n_ids // 8)), np.uint8)
            out |= np.unpackbits(raw, count=n_ids, bitorder="little").astype(np.uint32) << np.uint32(k)
    return out


def to_planes(ids: np.ndarray, block: int = BLOCK, level: int = LEVEL) -> list[list[bytes]]:
    """ids -> the planes of each block."""
    squeeze, ids = zstandard.ZstdCompressor(level=level), np.asarray(ids, np.uint32)
    return [block_planes(ids[a:a + block], squeeze) for a in range(0, len(ids), block)]


def from_planes(blocks: list[list[bytes]], n_ids: int, block: int = BLOCK, first: int = 0, stop: int | None = None) -> np.ndarray:
    """ids first..stop (all by default) of a chunk; of its blocks only those
    that hold some of them are expanded."""
    stop = n_ids if stop is None else min(stop, n_ids)
    if first >= stop:
        return np.zeros(0, np.uint32)
    expand, lead = zstandard.ZstdDecompressor(), first // block
    ids = np.concatenate([block_ids(blocks[k], min(block, n_ids - k * block), expand) for k in range(lead, -(-stop // block))])
    return ids[first - lead * block:stop - lead * block]


def write_token_file(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = END_ID,
                     block: int = BLOCK, chunk_ids: int = CHUNK_IDS) -> None:
    """Encode docs (doc_id, text) and write ``path``/chunks and ``path``/index."""
    if block < 8 or block % 8:
        raise ValueError("a block holds a multiple of 8 ids")
    spark = docs.sparkSession
    ship_code(spark)
    vocabulary = vocabulary or vocabulary_path()

    def chunks(batches):
        part = TaskContext.get().partitionId()
        encode = encoder(vocabulary).encode
        number, docs_, lens, ids_, held, before = 0, [], [], [], 0, 0

        def close():
            ids = np.concatenate(ids_)
            blocks = to_planes(ids, block)
            sizes = [[len(p) for p in planes] for planes in blocks]
            columns = [[part], [number], [len(docs_)], [len(ids)], [docs_[0]], [before], [block], [sizes], [docs_], [lens], [blocks]]
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.list_(pa.int32())),
                     pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.list_(pa.binary()))]
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)],
                                   names=["part", "chunk", "n_docs", "n_ids", "first_doc", "before", "block", "plane_bytes",
                                          "doc_ids", "lengths", "planes"])

        for doc_ids, ids, first, lengths in token_batches(batches, encode, end_id):
            for doc, a, n in zip(doc_ids.to_pylist(), first.tolist(), lengths.tolist()):
                docs_.append(doc)
                lens.append(n)
                ids_.append(ids[a:a + n])
                held += n
                if held >= chunk_ids:
                    yield close()
                    number, docs_, lens, ids_, held, before = number + 1, [], [], [], 0, before + held
        if docs_:
            yield close()

    key = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
     .repartitionByRange(*key).sortWithinPartitions(*key)
     .mapInArrow(chunks, CHUNK_SCHEMA)
     .write.option("compression", "none").parquet(f"{path}/chunks"))
    chunk = spark.read.schema(CHUNK_SCHEMA).parquet(f"{path}/chunks")
    sizes = chunk.select("part", "chunk", "n_docs", "n_ids", "first_doc", "before", "block", "plane_bytes")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    base = running_start(parts, ["part"], "n", "base").drop("n")
    (sizes.join(F.broadcast(base), "part")            # a row per partition
     .withColumn("start", F.col("base") + F.col("before")).drop("base", "before")
     .write.parquet(f"{path}/index"))


def read_token_file(spark: SparkSession, path: str, keep_ids: bool = False) -> DataFrame:
    """``path`` -> doc_id, start, n_tokens, ids_crc32 and, with ``keep_ids``,
    ids (little-endian unsigned 32-bit), read from the files."""
    ship_code(spark)
    index = spark.read.schema("part int, chunk int, start long").parquet(f"{path}/index")
    base = index.filter("chunk = 0").select("part", F.col("start").alias("base"))
    chunk = spark.read.schema(CHUNK_SCHEMA).parquet(f"{path}/chunks")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if keep_ids else "")

    def documents(batches):
        for b in batches:
            for row in range(b.num_rows):
                start, n_ids, block, docs, lens, planes = (b.column(c)[row].as_py() for c in range(6))
                ids = from_planes(planes, n_ids, block).astype("<u4", copy=False)
                stop = np.cumsum(lens)
                raw = [memoryview(ids[z - n:z]).cast("B") for z, n in zip(stop.tolist(), lens)]
                columns = [pa.array(docs, pa.int64()), pa.array(start + stop - lens, pa.int64()), pa.array(lens, pa.int64()),
                           pa.array([zlib.crc32(r) for r in raw], pa.int64())]
                if keep_ids:
                    columns.append(pa.array([bytes(r) for r in raw], pa.binary()))
                yield pa.record_batch(columns, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][:len(columns)])

    return (chunk.join(F.broadcast(base), "part")        # a row per partition that was written
            .select((F.col("base") + F.col("before")).alias("start"), "n_ids", "block", "doc_ids", "lengths", "planes")
            .mapInArrow(documents, schema))


def read_token_ids(spark: SparkSession, path: str, first: int, stop: int) -> DataFrame:
    """The ids first..stop (stop excluded) of the whole file: rows start,
    n_ids, ids (little-endian unsigned 32-bit), one per chunk that holds some
    of them. Parts follow each other, so that the parts of the stretch bound
    the files that are read."""
    ship_code(spark)
    index = (spark.read.schema("part int, chunk int, n_ids long, start long").parquet(f"{path}/index")
             .filter((F.col("start") < stop) & (F.col("start") + F.col("n_ids") > first) & F.lit(first < stop)))
    low, high = index.agg(F.min("part"), F.max("part")).first()
    chunk = spark.read.schema(CHUNK_SCHEMA).parquet(f"{path}/chunks").filter(F.col("part").between(low, high))

    def stretches(batches):
        for b in batches:
            for row in range(b.num_rows):
                start, n_ids, block, planes = (b.column(c)[row].as_py() for c in range(4))
                at = max(first - start, 0)
                ids = from_planes(planes, n_ids, block, at, stop - start).astype("<u4", copy=False)
                yield pa.record_batch([pa.array([start + at], pa.int64()), pa.array([len(ids)], pa.int64()),
                                       pa.array([ids.tobytes()], pa.binary())], names=["start", "n_ids", "ids"])

    return (chunk.drop("n_ids").join(index, ["part", "chunk"]).select("start", "n_ids", "block", "planes")
            .mapInArrow(stretches, "start long, n_ids long, ids binary"))


def op5_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "tokens")
    write_token_file(table(spark, sf_dir, "documents"), path)
    return read_token_file(spark, path)
