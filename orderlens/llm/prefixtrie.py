"""The prefix trie of conversations, and totals of its subtrees by tree contraction.

Each distinct sequence of first d turns is a node at depth d; conversations that
start with it are its members. Nodes are named by the smallest member's id and
the depth, found by the sum of hashes of (turn number, role, text) over the
first d turns: two sums of 60 bits each stand for the sequence.

Totals of whole subtrees come by parallel tree contraction, in rounds of joins:

* rake: every leaf gives its total to its parent and goes;
* compress: of the nodes with a single child, those whose random number of the
  round is above their parent's and their child's go: the child takes their
  place and carries what they hold. About a third of a chain goes per round, so
  that the rounds grow with the logarithm of the number of nodes, however deep
  the trie is.

Then contracted nodes are expanded again: a compressed node's total is that of
the child it was merged with plus what stood between, and these references are
followed by pointer doubling.

No group is gathered: turns are numbered, and hashes summed, within the parts of
a range partition with the sums of earlier parts added; counts are combined
before shuffles; ids of a node's ended conversations are hashed as a stream of
pieces of text (SHA-256 of one node is sequential by definition, its memory is
one piece). Only 40 bytes per turn are shuffled, never texts. Each round is
written to the shared folder.

Edge cases: rows without a conversation id take no part; null roles and texts
are empty; turns are ordered with null first, equal turn numbers by the hashes
of role and text; repeated rows are turns of their own; an empty table has no
nodes; a conversation without turns is a member of the root alone; further
columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlens.llm.shared import ship_code, table, written

NODES_PER_PARTITION = 200_000
PIECE = 1 << 20                        # characters of joined ids that a task holds at once
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def hashes(*what: Column) -> list[Column]:
    """Two numbers of 60 bits from one digest, as decimals whose sums don't overflow."""
    digest = F.sha2(F.to_json(F.struct(*what)).cast("binary"), 256)
    return [F.conv(F.substring(digest, at, 15), 16, 10).cast("decimal(38,0)") for at in (1, 16)]


def numbered(turns: DataFrame) -> DataFrame:
    """turns (conv, turn, a, b, size) -> with part and pos, each conversation's
    turns counted from 0. Rows are sorted over range partitions, so that a
    conversation of any length is spread; the parts' counts are added up."""
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("a"), F.col("b")]
    cut = turns.withColumn("_tie", F.monotonically_increasing_id())
    ranged = written(cut.repartitionByRange(*order, "_tie").withColumn("part", F.spark_partition_id()).drop("_tie"), "turns")
    local = Window.partitionBy("conv", "part").orderBy(*order[1:])
    before = running(ranged.groupBy("conv", "part").agg(F.count("*").alias("n")), ["n"])
    return (ranged.withColumn("_rn", F.row_number().over(local) - 1).join(before, ["conv", "part"])
            .withColumn("pos", F.col("n_before") + F.col("_rn")).drop("_rn", "n", "n_before"))


def running(parts: DataFrame, values: list[str]) -> DataFrame:
    """Sums of the earlier parts of a conversation: a row per conversation and
    partition it lies in, so that a window over them is small."""
    w = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    for v in values:
        parts = parts.withColumn(f"{v}_before", F.coalesce(F.sum(v).over(w), F.lit(0)))
    return parts


def sequences(turns: DataFrame) -> DataFrame:
    """turns (conv, part, pos from 0, a, b, size) with one row of pos null for
    a conversation without turns -> conv, depth (from 0), last turn's size and
    the sums (a, b) of the first ``depth`` turns and (a0, b0) of one turn less,
    and ``length``, the conversation's."""
    at = F.col("pos").cast("string")
    ha, hb = hashes(at, F.col("a"), F.col("b"))
    rows = turns.filter("pos IS NOT NULL").select("conv", "part", "pos", "size", ha.alias("ha"), hb.alias("hb"))
    rows = written(rows, "hashed")
    sums = rows.groupBy("conv", "part").agg(F.sum("ha").cast("decimal(38,0)").alias("sa"), F.sum("hb").cast("decimal(38,0)").alias("sb"))
    before = running(sums, ["sa", "sb"]).select("conv", "part", "sa_before", "sb_before")
    local = Window.partitionBy("conv", "part").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    lengths = turns.groupBy("conv").agg(F.coalesce(F.max("pos") + 1, F.lit(0)).cast("long").alias("length"))

    def total(h: str, s: str) -> Column:
        return (F.sum(h).over(local) + F.col(s)).cast("decimal(38,0)")

    summed = (rows.join(before, ["conv", "part"])
              .withColumn("a", total("ha", "sa_before")).withColumn("b", total("hb", "sb_before")))
    nodes = summed.select("conv", (F.col("pos") + 1).alias("depth"), "size", "a", "b",
                          (F.col("a") - F.col("ha")).cast("decimal(38,0)").alias("a0"),
                          (F.col("b") - F.col("hb")).cast("decimal(38,0)").alias("b0")).join(lengths, "conv")
    zero = F.lit(0).cast("decimal(38,0)")
    roots = lengths.select("conv", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("size"),
                           zero.alias("a"), zero.alias("b"), F.lit(None).cast("decimal(38,0)").alias("a0"),
                           F.lit(None).cast("decimal(38,0)").alias("b0"), "length")
    return nodes.unionByName(roots)


def ended(ends: DataFrame) -> DataFrame:
    """ends (a, b, depth, conv), a row for each conversation at the node where
    it ends -> a, b, depth, ends_sha256 of the ascending ids. Sorted over range
    partitions and joined to pieces of text there; a node's pieces go through
    one hasher in order."""
    key = ["a", "b", "depth"]

    def pieces(batches):
        last, ids, size, first = None, [], 0, None
        def row():  # noqa: E306
            return pa.record_batch([pa.array([v], t) for v, t in zip(
                (*last, first, ",".join(ids)), (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()))],
                names=["a", "b", "depth", "first", "text"])
        for batch in batches:
            for *node, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if node != last or size > PIECE:
                    if last is not None:
                        yield row()
                    last, ids, size, first = node, [], 0, conv
                ids.append(str(conv))
                size += len(ids[-1]) + 1
        if last is not None:
            yield row()

    def hashed(batches):
        last, state = None, None
        for batch in batches:
            rows = []
            for *node, _, text in zip(*(c.to_pylist() for c in batch.columns)):
                if node != last:
                    if last is not None:
                        rows.append((*last, state.hexdigest()))
                    last, state = node, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(text.encode())
            if rows:
                yield out(rows)
        if last is not None:
            yield out([(*last, state.hexdigest())])

    def out(rows):
        kinds = (pa.string(), pa.string(), pa.int64(), pa.string())
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["a", "b", "depth", "ends_sha256"])

    text = ends.select(F.col("a").cast("string").alias("a"), F.col("b").cast("string").alias("b"), "depth", "conv")
    ranged = text.repartitionByRange(*key, "conv").sortWithinPartitions(*key, "conv")
    cut = ranged.mapInArrow(pieces, "a string, b string, depth long, first long, text string")
    whole = cut.repartition(*key).sortWithinPartitions(*key, "first").mapInArrow(
        hashed, "a string, b string, depth long, ends_sha256 string")
    return whole.withColumns({c: F.col(c).cast("decimal(38,0)") for c in ("a", "b")})


def trie(turns: DataFrame) -> DataFrame:
    """turns as for ``sequences`` -> a row per node: conv_id, depth,
    parent_conv_id, n_convs, size (of the last turn's text), ends_sha256."""
    seqs = written(sequences(turns), "sequences")
    key = ["a", "b", "depth"]
    nodes = written(seqs.groupBy(*key).agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.max("size").alias("size"),
                                           F.max("a0").alias("a0"), F.max("b0").alias("b0")), "nodes")
    ends = ended(seqs.filter("depth = length").select(*key, "conv"))
    above = nodes.select(F.col("a").alias("a0"), F.col("b").alias("b0"), (F.col("depth") + 1).alias("depth"),
                         F.col("conv_id").alias("parent_conv_id"))
    return (nodes.join(above, ["a0", "b0", "depth"], "left").join(ends, key, "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "size",
                    F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256")))


def subtree_totals(nodes: DataFrame, values: dict[str, Column], leaf_values: dict[str, Column]) -> DataFrame:
    """nodes (conv_id, depth, parent_conv_id) -> conv_id, depth, n_children and,
    for each name of ``values`` and ``leaf_values``, the sum over the node's
    subtree (itself included) of that expression over nodes, or over nodes
    without children. Contraction in rounds, then expansion."""
    names = [*values, *leaf_values]
    up = nodes.filter("parent_conv_id IS NOT NULL").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"))
    start = nodes.join(up.agg(F.count("*").alias("_kids")), ["conv_id", "depth"], "left")
    own = {**values, **{k: F.when(F.col("_kids").isNull(), v).otherwise(0) for k, v in leaf_values.items()}}
    # c, d: the node; p: the conversation of its parent, at depth q, which may
    # be far above once nodes between are gone; e_: what stood between them.
    moved = written(start.select(
        F.col("conv_id").alias("c"), F.col("depth").alias("d"), F.col("parent_conv_id").alias("p"), (F.col("depth") - 1).alias("q"),
        F.coalesce("_kids", F.lit(0)).cast("long").alias("n_children"), F.lit(False).alias("leaf"), F.lit(False).alias("merged"),
        F.lit(None).cast("long").alias("kc"), F.lit(None).cast("long").alias("kd"),
        *[v.cast("long").alias(k) for k, v in own.items()], *[F.lit(0).cast("long").alias(f"e_{k}") for k in names]), "live")
    counts = moved.select("c", "d", "n_children")
    gone, n_round = [], 0

    def chance(c: str, d: str) -> Column:
        return F.xxhash64(F.col(c), F.col(d), F.lit(n_round))

    while True:
        # What goes to a node from its leaves, and its other children.
        stays = ~F.col("leaf")
        below = moved.filter("NOT merged AND p IS NOT NULL").groupBy(F.col("p").alias("c"), F.col("q").alias("d")).agg(
            F.count_if(stays).alias("kids"), F.min(F.when(stays, F.col("c"))).alias("kc"), F.min(F.when(stays, F.col("d"))).alias("kd"),
            *[F.sum(F.when(stays, F.col(f"e_{k}"))).alias(f"k_{k}") for k in names],
            *[F.sum(F.when(~stays, F.col(k) + F.col(f"e_{k}"))).alias(f"g_{k}") for k in names])
        kept = moved.filter("NOT merged AND NOT leaf").drop("leaf", "merged", "kc", "kd").join(below, ["c", "d"], "left")
        state = kept.select("c", "d", "p", "q", F.coalesce("kids", F.lit(0)).alias("kids"), "kc", "kd", *[f"k_{k}" for k in names],
                            *[(F.col(k) + F.coalesce(f"g_{k}", F.lit(0))).cast("long").alias(k) for k in names], *[f"e_{k}" for k in names])
        # Neighbours on a chain never go in the same round.
        merged = ((F.col("kids") == 1) & F.col("p").isNotNull() & (chance("c", "d") > chance("p", "q"))
                  & (chance("c", "d") > chance("kc", "kd")))
        state = written(state.withColumn("merged", F.coalesce(merged, F.lit(False))), "state")
        n_live = state.count()
        parts = 1 + n_live // NODES_PER_PARTITION
        skips = state.filter("merged").select(F.col("kc").alias("c"), F.col("kd").alias("d"), F.col("p").alias("np"), F.col("q").alias("nq"),
                                              *[(F.col(k) + F.col(f"e_{k}")).alias(f"s_{k}") for k in names])
        after = state.join(skips, ["c", "d"], "left").select(
            "c", "d", F.coalesce("np", "p").alias("p"), F.coalesce("nq", "q").alias("q"),
            ((F.col("kids") == 0) & F.col("p").isNotNull()).alias("leaf"), "merged", "kc", "kd", *names,
            *[(F.col(f"e_{k}") + F.coalesce(f"s_{k}", F.lit(0))).cast("long").alias(f"e_{k}") for k in names],
            *[f"k_{k}" for k in names])
        moved = written(after.coalesce(parts), "moved")
        none = F.lit(None).cast("long")
        gone.append(moved.filter("merged").select("c", "d", F.col("kc").alias("nc"), F.col("kd").alias("nd"),
                                                  *[(F.col(k) + F.col(f"k_{k}")).alias(k) for k in names]))
        gone.append(moved.filter("leaf" if n_live > 1 else "NOT merged").select("c", "d", none.alias("nc"), none.alias("nd"), *names))
        if n_live <= 1:
            break
        moved = moved.drop(*[f"k_{k}" for k in names])
        n_round += 1
    totals = expanded(reduce(DataFrame.unionByName, gone), names)
    return totals.join(counts, ["c", "d"]).select(F.col("c").alias("conv_id"), F.col("d").alias("depth"), "n_children", *names)


def expanded(rows: DataFrame, names: list[str]) -> DataFrame:
    """rows (c, d, next node or null, values): each value plus those of the
    nodes that follow. The references double their reach with every round."""
    known = written(rows, "expanded")
    while not known.filter("nc IS NOT NULL").isEmpty():
        then = known.select(F.col("c").alias("nc"), F.col("d").alias("nd"), F.col("nc").alias("nc2"), F.col("nd").alias("nd2"),
                            *[F.col(k).alias(f"t_{k}") for k in names])
        known = written(known.join(then, ["nc", "nd"], "left").select(
            "c", "d", F.col("nc2").alias("nc"), F.col("nd2").alias("nd"),
            *[(F.col(k) + F.coalesce(f"t_{k}", F.lit(0))).alias(k) for k in names]), "expanded")
    return known


def prefix_trie(turns: DataFrame) -> DataFrame:
    """turns (conv, part, pos, a, b, size): see ``sequences`` -> a row per node
    with its members, children, and its subtree's leaves and tokens that
    shared prefixes save (n_convs - 1 times the size of the last turn)."""
    nodes = written(trie(turns), "trie")
    totals = subtree_totals(nodes, {"saved_tokens": (F.col("n_convs") - 1) * F.col("size")}, {"n_leaves": F.lit(1)})
    return nodes.join(totals, ["conv_id", "depth"]).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def turns_of(conversations: DataFrame) -> DataFrame:
    """conversations (conv_id, turn, role, text) -> conv, part, pos, a, b, size."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    a, b = hashes(role, text)
    return numbered(conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long"), a.alias("a"), b.alias("b"),
        F.char_length(text).cast("long").alias("size")))


def rebuilt(turns: DataFrame) -> DataFrame:
    """The query's conversations: conversation c has the first h turns of
    conversation c - c % 100, then its own after the first h, h = crc32(c) % 6.
    The first turns taken over are at most five rows for a hundred ids."""
    turns = written(turns, "numbered")
    h = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(6))
    base = F.col("conv") - F.col("conv") % 100
    heads = turns.filter("pos < 5 AND conv % 100 = 0").select(F.col("conv").alias("base"), F.col("pos").alias("at"), "a", "b", "size")
    n_heads = heads.groupBy("base").agg(F.count("*").alias("n_head"))
    convs = (turns.groupBy("conv").agg(F.count("*").alias("n")).select("conv", h.alias("h"), base.alias("base"))
             .join(n_heads, "base", "left").withColumn("taken", F.least("h", F.coalesce("n_head", F.lit(0)))))
    convs = written(convs.select("conv", "base", "h", "taken"), "convs")
    first = (convs.join(heads, "base").filter("at < taken")
             .select("conv", F.lit(-1).alias("part"), F.col("at").alias("pos"), "a", "b", "size"))
    own = (turns.join(convs, "conv").filter("pos >= h")
           .select("conv", "part", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "a", "b", "size"))
    none = convs.select("conv", F.lit(-1).alias("part"), F.lit(None).cast("long").alias("pos"),
                        *[F.lit(None).cast("decimal(38,0)").alias(c) for c in "ab"], F.lit(None).cast("long").alias("size"))
    return written(first.unionByName(own).unionByName(none), "rebuilt")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of the rebuilt ``conversations``."""
    ship_code(spark)
    return prefix_trie(rebuilt(turns_of(table(spark, sf_dir, "conversations"))))


OP11_SQL = """
WITH ordered AS (SELECT conv_id AS c, {'r': COALESCE(role, ''), 't': COALESCE(text, '')} AS turn,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS nth
  FROM conversations WHERE conv_id IS NOT NULL),
 original AS (SELECT c, list(turn ORDER BY nth) AS turns,
    xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
      lambda s, x: list_reduce(list_concat([xor(s, x)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
        lambda v, i: xor(v >> 1, (v & 1) * 3988292384))), 4294967295) % 6 AS h
  FROM ordered GROUP BY c),
 rebuilt AS (SELECT o.c, list_concat(COALESCE(b.turns, [])[:o.h], o.turns[o.h + 1:]) AS turns
  FROM original o LEFT JOIN original b ON b.c = o.c - o.c % 100),
 prefix AS (SELECT c, unnest(range(len(turns) + 1)) AS depth, turns FROM rebuilt),
 placed AS (SELECT c, depth, len(turns) AS total, len(turns[depth].t) AS size,
    MIN(c) OVER w AS node, COUNT(*) OVER w AS n_convs
  FROM prefix WINDOW w AS (PARTITION BY depth, turns[:depth])),
 node AS (SELECT p.node, p.depth, MAX(q.node) AS parent, MAX(p.n_convs) AS n_convs, MAX(IF(p.depth = 0, 0, p.size)) AS size,
    sha256(COALESCE(string_agg(CAST(p.c AS VARCHAR), ',' ORDER BY p.c) FILTER (WHERE p.total = p.depth), '')) AS ends_sha256
  FROM placed p LEFT JOIN placed q ON q.c = p.c AND q.depth = p.depth - 1 GROUP BY p.node, p.depth),
 kids AS (SELECT n.*, (SELECT COUNT(*) FROM node k WHERE k.parent = n.node AND k.depth = n.depth + 1) AS n_children FROM node n),
 below AS (SELECT u.node, u.depth, SUM((k.n_convs - 1) * k.size) AS saved_tokens, COUNT(*) FILTER (WHERE k.n_children = 0) AS n_leaves
  FROM kids k JOIN placed u ON u.c = k.node AND u.depth <= k.depth GROUP BY u.node, u.depth)
SELECT n.node AS conv_id, n.depth, n.parent AS parent_conv_id, n.n_convs, n.n_children, n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
FROM kids n JOIN below USING (node, depth)
"""
