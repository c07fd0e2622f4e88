"""Exact top-k search with block-at-a-time pruning.

Components of a vector are the weights of its terms. Rows are ordered by id
and cut into blocks; a block carries its forward index (the weights of its
rows, row by row) and, per term, the largest and smallest weight. For a query
the sum over its terms of weight times the better of the two bounds every
score in the block, so blocks are visited in order of that bound and left as
soon as it falls below the k-th best score so far (a bound equal to it may
still hide a tie with a smaller id, so it is visited).

Queries form chunks and blocks form groups of bounded size; every chunk meets
every group in a task of its own, and the k best of each meeting are merged
per query. Nothing is broadcast or collected except two row counts.

Edge cases: null vectors, and vectors that hold null or non-finite
components, take no part, nor do rows with a null id; vectors may differ in
length (missing terms weigh 0); empty vectors score 0; ties go to the smaller
id; of several query rows with one id the smallest vector asks; rows with the
query's own id are no candidates; repeated candidate rows are ranked each;
scores beyond 64 bits are exact in order and shown clipped; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlens.llm.shared import ship_code, table, written

BLOCK_ROWS = 512
GROUP_BLOCKS = 32
CHUNK_QUERIES = 1024
SCALE = 64
_MAX = (1 << 63) - 1
_COMPLEMENT = str.maketrans("0123456789", "9876543210")


def quantised(vectors: list, scale: int) -> np.ndarray:
    """floor(scale * x) of every component; shorter vectors end in zeros.
    64-bit integers, or Python's where those don't do."""
    width = max(map(len, vectors), default=0)
    real = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        real[i, :len(v)] = v
    with np.errstate(over="ignore"):
        real = np.floor(real * scale)
    if (np.abs(real) < 2.0 ** 62).all():
        return real.astype(np.int64)
    out = np.zeros(real.shape, object)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = [math.floor(scale * x) if math.isfinite(scale * x) else int(x) * scale for x in map(float, v)]
    return out


def _pack(a: np.ndarray) -> bytes:
    """Integers in the narrowest type that holds them; pickled if none does."""
    if a.dtype == object:
        import pickle
        return b"o" + pickle.dumps(a)
    top = int(np.abs(a).max()) if a.size else 0
    code, kind = next((c, k) for c, k, m in (("b", "<i1", 127), ("h", "<i2", 32767), ("i", "<i4", 2**31 - 1), ("q", "<i8", _MAX)) if top <= m)
    return code.encode() + a.astype(kind).tobytes()


def _unpack(raw: bytes, rows: int) -> np.ndarray:
    if raw[:1] == b"o":
        import pickle
        return pickle.loads(raw[1:]).reshape(rows, -1)
    flat = np.frombuffer(raw, {b"b": "<i1", b"h": "<i2", b"i": "<i4", b"q": "<i8"}[raw[:1]], offset=1).astype(np.int64)
    return flat.reshape(rows, -1) if rows else flat.reshape(0, 0)


def usable(id_col: str, vector: str) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.col(id_col).isNotNull() & F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False))


def blocks_of(rows: DataFrame, size: int, scale: int) -> DataFrame:
    """(id, vector) sorted within partitions -> one row per ``size`` rows."""
    def cut(batches):
        part, number = TaskContext.get().partitionId(), 0
        ids, vectors = [], []

        def block():
            m = quantised(vectors, scale)
            return pa.record_batch([pa.array([part], pa.int64()), pa.array([number], pa.int64()), pa.array([len(ids)], pa.int32()),
                                    pa.array([np.array(ids, "<i8").tobytes()]), pa.array([_pack(m)]),
                                    pa.array([_pack(m.max(axis=0))]),
                                    pa.array([_pack(m.min(axis=0))])],
                                   names=["part", "number", "n", "ids", "weights", "most", "least"])

        for b in batches:
            for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids.append(i)
                vectors.append(v)
                if len(ids) == size:
                    yield block()
                    number, ids, vectors = number + 1, [], []
        if ids:
            yield block()

    return rows.mapInArrow(cut, "part long, number long, n int, ids binary, weights binary, most binary, least binary")


def _wider(a: np.ndarray, width: int) -> np.ndarray:
    return np.hstack((a, np.zeros((a.shape[0], width - a.shape[1]), a.dtype))) if a.shape[1] < width else a


def best_of_cell(queries: tuple, blocks: list[tuple], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One chunk of queries (ids, weights) against one group of blocks (ids,
    weights, most, least) -> (row of the query, id, score) of the k best."""
    width = max([queries[1].shape[1], *(b[1].shape[1] for b in blocks)])
    q_ids, q = queries[0], _wider(queries[1], width)
    blocks = [(i, _wider(w, width), *(_wider(x, width) for x in (a, z))) for i, w, a, z in blocks]
    # A row shorter than the block's widest has zeros there, and they count in the bounds.
    top = max([int(abs(x).max()) if x.size else 0 for _, *w in blocks for x in w[1:]], default=0)
    top *= int(abs(q).max()) if q.size else 0
    kind = np.float64 if top * max(width, 1) < 2 ** 52 else np.int64 if top * max(width, 1) < 2 ** 62 else object
    q = q.astype(kind)
    most = np.vstack([b[2] for b in blocks]).astype(kind)
    least = np.vstack([b[3] for b in blocks]).astype(kind)
    bound = np.maximum(q, 0) @ most.T + np.minimum(q, 0) @ least.T
    visit = np.argsort(-bound, axis=1, kind="stable")
    n = len(q_ids)
    none = -(2 ** 62) if kind is not object else -(1 << 200)
    scores = np.full((n, k), none, np.int64 if kind is not object else object)
    ids = np.full((n, k), _MAX, np.int64)
    for turn in range(len(blocks)):
        at = visit[:, turn]
        live = bound[np.arange(n), at] >= scores[:, -1]
        for j in np.unique(at[live]).tolist():
            rows = np.flatnonzero(live & (at == j))
            b_ids, weights = blocks[j][0], blocks[j][1].astype(kind)
            found = q[rows] @ weights.T
            found = found.astype(np.int64) if kind is not object else found
            own = q_ids[rows][:, None] == b_ids[None, :]
            found[own] = none
            if kind is np.float64 and len(b_ids) > k:       # rows stand by id: break ties by place
                key = found * len(b_ids) + np.arange(len(b_ids))[::-1]
                key[own] = none
                pick = np.argpartition(key, len(b_ids) - k, axis=1)[:, -k:]
                found, cand = np.take_along_axis(found, pick, 1), b_ids[pick]
            else:
                cand = np.broadcast_to(b_ids, found.shape)
            s = np.hstack((scores[rows], found))
            c = np.hstack((ids[rows], cand))
            if kind is object:
                order = np.array([sorted(range(s.shape[1]), key=lambda x: (-a[x], b[x]))[:k] for a, b in zip(s, c)])
            else:
                order = np.lexsort((c, -s), axis=1)[:, :k]
            scores[rows], ids[rows] = np.take_along_axis(s, order, 1), np.take_along_axis(c, order, 1)
    real = scores > none
    r, _ = np.nonzero(real)
    return r, ids[real], scores[real]


def shown(scores: np.ndarray) -> tuple[np.ndarray, list[str | None]]:
    """Scores clipped to 64 bits, and a text for those at or beyond the limits
    whose descending order is theirs: cells are merged by both."""
    if scores.dtype != object:
        return scores.astype(np.int64), [None] * len(scores)
    beyond: list[str | None] = []
    for x in scores.tolist():
        digits = str(abs(x))
        if -_MAX - 1 < x < _MAX:
            beyond.append(None)
        elif x > 0:
            beyond.append(f"{len(digits):06d}{digits}")
        else:
            beyond.append(f"{999999 - len(digits):06d}{digits.translate(_COMPLEMENT)}")
    return np.array([max(-_MAX - 1, min(_MAX, x)) for x in scores.tolist()], np.int64), beyond


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, scale: int = SCALE, id_col: str = "vec_id",
          vector_col: str = "embedding", block_rows: int = BLOCK_ROWS, group_blocks: int = GROUP_BLOCKS,
          chunk_queries: int = CHUNK_QUERIES) -> DataFrame:
    """For each row of ``queries`` the k rows of ``vectors`` with the highest
    integer inner product: query_id, rank, vec_id, score."""
    ship_code(vectors.sparkSession)
    pick = [F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")]
    rows = vectors.filter(usable(id_col, vector_col)).select(*pick)
    asked = queries.filter(usable(id_col, vector_col)).select(*pick).groupBy("id").agg(F.min("v").alias("v"))
    block = written(blocks_of(rows.repartitionByRange("id").sortWithinPartitions("id"), block_rows, scale), "blocks")
    chunk = written(blocks_of(asked, chunk_queries, scale), "queries")
    n_groups, n_chunks = max(1, -(-block.count() // group_blocks)), max(1, chunk.count())
    place = F.pmod(F.xxhash64("part", "number"), F.lit(n_groups))
    block_cells = block.withColumn("g", place).withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))))
    seat = Window.orderBy("part", "number")
    numbers = chunk.select("part", "number").withColumn("c", F.row_number().over(seat) - 1)      # a row per chunk
    chunk_cells = (chunk.join(numbers, ["part", "number"])
                   .withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1)))))

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        out, beyond = ([], [], []), []
        group = [(np.frombuffer(r["ids"], "<i8"), _unpack(r["weights"], r["n"]), _unpack(r["most"], 1), _unpack(r["least"], 1))
                 for r in right.to_pylist()]
        for r in left.to_pylist() if group else []:
            q_ids = np.frombuffer(r["ids"], "<i8")
            at, ids, scores = best_of_cell((q_ids, _unpack(r["weights"], r["n"])), group, k)
            clipped, order = shown(scores)
            beyond += order
            for column, value in zip(out, (q_ids[at], ids, clipped)):
                column.append(value)
        return pa.table([*[pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64()) for x in out],
                         pa.array(beyond, pa.string())], names=["query_id", "vec_id", "score", "beyond"])

    columns = ["ids", "weights", "n", "most", "least"]
    found = (chunk_cells.select(F.col("c").cast("long"), F.col("g").cast("long"), "ids", "weights", "n").groupBy("c", "g")
             .cogroup(block_cells.select(F.col("c").cast("long"), F.col("g").cast("long"), *columns).groupBy("c", "g"))
             .applyInArrow(cell, "query_id long, vec_id long, score long, beyond string"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc("beyond"), "vec_id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return top_k(rows, rows.filter("vec_id % 20 = 0"))


OP1_SQL = """
WITH q AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         CAST(list_sum(list_transform(list_zip(a.w, b.w), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM q a JOIN q b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
