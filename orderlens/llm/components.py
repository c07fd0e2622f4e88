"""Connected components of a graph that is never gathered in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.shared import written

EDGES_PER_PARTITION = 100_000


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b) -> node, component (the smallest node reachable).

    Large-star and small-star steps in turn: every node's larger neighbours,
    then its smaller ones, are linked to the smallest of its neighbours, until
    nothing changes (logarithmic rounds). A hub's rows are joined to a small
    written table, so that a skewed join can be split. Tables have as many
    partitions as their edges need, however many the session's shuffles have.
    """
    now = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(),
                  "edges")
    state = None
    while True:
        after = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if after == state or not after[0]:
            break
        state, parts = after, 1 + after[0] // EDGES_PER_PARTITION

        def kept(df: DataFrame, name: str) -> DataFrame:
            return written(df.coalesce(parts), name)

        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = kept(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = kept(large.filter("a <> b").distinct(), "large")
        least = kept(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = (large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))))
        now = kept(small.filter("a <> b").distinct(), "edges")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
