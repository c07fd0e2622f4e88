"""Ranks, row numbers and running totals that are spread over tasks, against
pandas; a hot entity holds a third of all rows or distinct keys."""

import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from orderlens.operators.prefix import _part, _placed, global_row_number, running_total
from orderlens.operators.ranking import dense_rank_keys, dense_rank_rows, keep_rank_one, rank_one


@pytest.fixture
def wide(spark):
    """More partitions, none of them merged."""
    keys = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def hot(spark, n=6000):
    """Entity 0 has a third of all rows, all with different keys."""
    return spark.range(n).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50 + 1).alias("e"),
                                 F.when(F.col("id") % 3 == 0, F.col("id") * 7 % 5000).otherwise(F.col("id") % 40).alias("k"),
                                 (F.col("id") % 7).alias("v"))


@pytest.mark.parametrize("descending", [False, True])
def test_dense_rank_of_a_hot_entity(wide, descending):
    df = hot(wide)
    p = df.toPandas()
    p["rank"] = p.groupby("e").k.rank(method="dense", ascending=not descending).astype(int)
    got = dense_rank_rows(df, ["e"], "k", descending)
    assert rows(got) == rows(wide.createDataFrame(p))
    # the hot entity's keys were numbered in several tasks
    keys = dense_rank_keys(df, ["e"], "k", descending).filter("e = 0")
    assert keys.select(F.spark_partition_id().alias("t")).distinct().count() > 2
    assert keys.count() == p[p.e == 0].k.nunique()


def test_dense_rank_with_nulls(spark):
    df = spark.createDataFrame([("a", None), ("a", 1), ("a", 1), ("a", 5), (None, 2), (None, None)], "e string, k int")
    assert rows(dense_rank_rows(df, ["e"], "k"))[:4] == [("a", 1, 2), ("a", 1, 2), ("a", 5, 3), ("a", None, 1)]
    assert ("a", None, 3) in rows(dense_rank_rows(df, ["e"], "k", descending=True))
    assert (None, None, 1) in rows(dense_rank_rows(df, ["e"], "k"))
    assert dense_rank_rows(df.limit(0), ["e"], "k").collect() == []


def test_global_row_number(wide):
    df = hot(wide).select("e", "k")
    got = global_row_number(df, [F.col("e"), F.col("k")], "n").toPandas().sort_values("n")
    assert got.n.tolist() == list(range(1, 6001))
    want = df.toPandas().sort_values(["e", "k"])
    assert (got[["e", "k"]].values == want.values).all()
    plan = global_row_number(df, [F.col("e")], "n")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange SinglePartition" not in plan.split("FileScan")[0].split("BroadcastExchange")[0]
    assert global_row_number(df.limit(0), [F.col("e")], "n").collect() == []


def test_numbers_of_equal_rows(wide):
    """A third of the rows are equal, and still dealt over partitions."""
    df = wide.range(3000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("k"))
    got = global_row_number(df, [F.col("k")], "n")
    assert sorted(r["n"] for r in got.collect()) == list(range(1, 3001))
    placed = _placed(df, [F.col("k")], "equal")
    assert placed.filter("k = 5").select(_part()).distinct().count() > 2


def test_running_total(wide):
    df = hot(wide).withColumn("id", F.monotonically_increasing_id())
    got = running_total(df, ["e"], [F.col("k"), F.col("id")], F.col("v"), "before").toPandas()
    p = got.sort_values(["e", "k", "id"])
    assert (p.groupby("e").v.cumsum() - p.v == p.before).all()
    assert isinstance(got, pd.DataFrame) and len(got) == 6000


def test_rank_one_in_one_reading(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "x"), ("a", 1, "y"), ("a", 2, "z"), (None, None, "n"), (None, 3, "m")],
                               "e string, k int, v string")
    assert rows(rank_one(df, ["e"], "k")) == [("a", 1, "x", 2), ("a", 1, "y", 1), (None, None, "n", 1)]
    assert rows(rank_one(df, ["e"], "k", descending=True)) == [("a", 2, "z", 1), (None, 3, "m", 1)]
    assert rows(keep_rank_one(df, ["e"], "k")) == [("a", 1, "x"), ("a", 1, "x"), ("a", 1, "y"), (None, None, "n")]


def test_rank_one_ties_of_a_hot_entity(wide):
    """A third of all rows are tied in one entity: equal rows are counted
    before the shuffle, and the group limit stands on both sides of it."""
    df = wide.range(30000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("e"), F.lit(1).alias("k"),
                                  (F.col("id") % 4).alias("v"))
    best = rank_one(df, ["e"], "k")
    assert best.filter("e = 0").agg(F.sum("times"), F.count("*")).first() == (10000, 4)
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
