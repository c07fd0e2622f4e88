import datetime as dt

from conftest import rows

from orderlens.functions.text import list_length, list_tokens
from orderlens.functions.time import week_bucket, weekday_name
from orderlens.operators.calendar import key_range, weekday_list, zero_fill
from orderlens.operators.lists import explode_list
from orderlens.operators.ranking import keep_rank_one, top_one

D = dt.date


def test_list_tokens_trim_each_token(spark):
    df = spark.createDataFrame([(" 1, 2 ,3 ",), ("4,",), ("",), (None,), ("5",)], "t string")
    got = [r[0] for r in df.select(list_tokens("t")).collect()]
    assert got == [["1", "2", "3"], ["4", ""], [""], None, ["5"]]
    assert [r[0] for r in df.select(list_length("t")).collect()] == [3, 2, 1, None, 1]


def test_explode_lists(spark):
    texts = spark.createDataFrame([("3, 1",), ("2, 9",), ("9",), ("3, 1",), (None,), ("1, 1",)], "t string")
    ex = rows(explode_list(texts, "t", ["t"], position="pos"))
    assert ("3, 1", 1, "1") in ex and len(ex) == 2 + 2 + 1 + 2 + 2


def test_rank_operators_keep_ties(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("a", 2, "z"), ("b", 5, "x"), ("b", None, "w")],
                               "k string, v int, item string")
    assert rows(keep_rank_one(df, ["k"], "v"), "k", "item") == [("a", "x"), ("a", "y"), ("b", "w")]
    assert rows(keep_rank_one(df, ["k"], "v", descending=True), "k", "item") == [("a", "z"), ("b", "x")]
    from pyspark.sql import functions as F
    assert rows(top_one(df.filter("v is not null"), [F.col("v").desc(), F.col("item")]), "item") == [("x",)]


def test_calendars(spark):
    days = [r[0] for r in weekday_list(spark, "d").collect()]
    assert days == ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
    counts = spark.createDataFrame([(2, 5)], "k int, n long")
    got = rows(zero_fill(key_range(spark, "w", 1, 3), "w", counts, "k", "n", "cnt"))
    assert got == [(1, 0), (2, 5), (3, 0)]


def test_week_bucket_edges(spark):
    df = spark.createDataFrame([(D(2021, 1, d),) for d in (1, 7, 8, 14, 15, 28, 29, 31)] + [(D(2021, 2, 1),),
                               (D(2020, 12, 31),)], "d date")
    got = [r[0] for r in df.select(week_bucket("d", D(2021, 1, 1), D(2021, 1, 31))).collect()]
    assert got == [1, 1, 2, 2, 3, 4, 5, 5, None, None]
    assert df.select(weekday_name("d")).first()[0] == "Friday"


def test_weekday_name_of_null_is_null(spark):
    df = spark.createDataFrame([(None,), (D(2021, 1, 3),)], "d date")
    assert [r[0] for r in df.select(weekday_name("d")).collect()] == [None, "Sunday"]


def test_nothing_is_cut_off(spark):
    """Large numbers, fractions of a second, long totals, counts beyond 32 bits."""
    from decimal import Decimal

    import pytest
    from pyspark.sql import functions as F

    from orderlens.functions.agg import collect_counted, expand_counted
    from orderlens.functions.text import extract_number
    from orderlens.plans.registry import present

    df = spark.createDataFrame([("123456789.5 m",), ("99999999999999999999km",)], "t string")
    assert [r[0] for r in df.select(extract_number("t")).collect()] == [Decimal("123456789.5"), Decimal("99999999999999999999")]
    one = spark.sql("select timestamp_ntz '2024-01-02 10:00:00.654321' as a, timestamp '2024-01-02 10:00:00.5' as b, "
                    "cast('90071992547409930.01' as decimal(38,2)) as c, date '2024-01-02' as d")
    assert tuple(present(one).first()) == ("2024-01-02 10:00:00.654321", "2024-01-02 10:00:00.5", "90071992547409930.01", "2024-01-02")

    many = spark.createDataFrame([("k", "a", 3_000_000_000), ("k", "b", 2)], "k string, v string, n long")
    counted = many.groupBy("k").agg(collect_counted("v", "n").alias("c"))
    assert counted.first()["c"][0]["n"] == 3_000_000_000
    with pytest.raises(Exception, match="2 GB"):
        counted.select(expand_counted(F.col("c"))).collect()
    few = spark.createDataFrame([("k", "b", 1), ("k", None, 4), ("k", "a", 3), ("m", None, 2)], "k string, v string, n long")
    got = dict(rows(few.groupBy("k").agg(expand_counted(collect_counted("v", "n")))))
    assert got == {"k": "a,a,a,b", "m": None}


def test_broadcast_is_left_to_spark(spark):
    counts = spark.range(10).selectExpr("cast(id as int) as k", "id as n")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = zero_fill(key_range(spark, "w", 1, 3), "w", counts, "k", "n", "cnt")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Broadcast" not in plan
