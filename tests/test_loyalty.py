import datetime as dt
from decimal import Decimal

from conftest import rows
from fixtures import loyalty

from orderlens.operators.joins import not_in
from orderlens.plans import loyalty as L

D = dt.date


def test_spend_and_visits(spark):
    sales, menu, _ = loyalty(spark)
    assert rows(L.spend_by_customer(sales, menu)) == [
        ("A", Decimal("96.00")), ("B", Decimal("74.00")), ("C", Decimal("20.00")), ("E", Decimal("20.00"))]
    assert rows(L.visit_days(sales)) == [("A", 6), ("B", 5), ("C", 2), ("E", 1)]


def test_first_items_ties_and_null_names(spark):
    sales, menu, _ = loyalty(spark)
    assert rows(L.first_items(sales, menu)) == [("A", "curry,sushi"), ("B", "sushi"), ("C", "sushi"),
                                                ("E", "curry")]


def test_top_item(spark):
    sales, menu, _ = loyalty(spark)
    assert rows(L.top_item(sales, menu)) == [(1, "sushi", 7)]


def test_favourite_items_keeps_all_ties(spark):
    sales, menu, _ = loyalty(spark)
    assert rows(L.favourite_items(sales, menu)) == [
        ("A", "ramen,sushi"), ("B", "curry,ramen,sushi"), ("C", "sushi"), ("E", "curry")]


def test_before_after_anchor(spark):
    sales, menu, members = loyalty(spark)
    assert rows(L.first_after_join(sales, menu, members)) == [("A", "ramen"), ("B", "ramen")]
    assert rows(L.last_before_join(sales, menu, members)) == [("A", "curry,sushi"), ("B", "curry")]
    assert rows(L.totals_before_join(sales, menu, members)) == [
        ("A", 2, Decimal("25.00")), ("B", 2, Decimal("25.00"))]
    assert rows(L.tried_before_join(sales, menu, members)) == [("A", "curry,sushi", 1), ("B", "curry,sushi", 2)]


def test_first_after_join_one_row_per_sale(spark):
    sales, menu, members = loyalty(spark)
    extra = spark.createDataFrame([("A", D(2021, 1, 10), 3)], sales.schema)
    got = rows(L.first_after_join(sales.unionByName(extra), menu, members))
    assert got == [("A", "ramen"), ("A", "ramen"), ("B", "ramen")]


def test_points(spark):
    sales, menu, members = loyalty(spark)
    pts = {c: p for c, p in rows(L.points_basic(sales, menu, "sushi"))}
    assert pts == {"A": Decimal("1260.00"), "B": Decimal("940.00"), "C": Decimal("400.00"),
                   "E": Decimal("150.00")}
    # join date and +6 days are doubled, +7 is not; January of any year counts
    win = {c: p for c, p in rows(L.points_promo_window(sales, menu, members, "sushi"))}
    assert win == {"A": Decimal("1570.00"), "B": Decimal("1210.00")}


def test_join_all_flags(spark):
    sales, menu, members = loyalty(spark)
    out = L.join_all(sales, menu, members)
    got = rows(out, "customer_id", "order_date", "member")
    assert len(got) == 18
    assert ("A", D(2021, 1, 7), "Y") in got and ("A", D(2021, 1, 1), "N") in got
    assert {m for c, _, m in got if c in ("C", "E")} == {"N"}
    # the output is sorted by customer and date
    keys = [(r["customer_id"], r["order_date"]) for r in out.collect()]
    assert keys == sorted(keys)


def test_join_all_not_in_null_rules(spark):
    sales, menu, members = loyalty(spark)
    with_null = members.unionByName(spark.createDataFrame([(None, D(2021, 1, 1))], members.schema))
    got = rows(L.join_all(sales, menu, with_null), "customer_id")
    assert {c for (c,) in got} == {"A", "B"}          # NOT IN with a NULL empties the rest


def test_not_in_semantics(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1,)], "k int")
    right_null = spark.createDataFrame([(1,), (None,)], "k int")
    empty = spark.createDataFrame([], "k int")
    assert rows(not_in(left, "k", right)) == [(2,)]
    assert rows(not_in(left, "k", right_null)) == []
    assert rows(not_in(left, "k", empty)) == [(1,), (2,), (None,)]
    assert rows(not_in(left, "k", right_null, null_aware=False)) == [(2,), (None,)]


def test_rank_all_text_rank(spark):
    sales, menu, members = loyalty(spark)
    got = rows(L.rank_all(sales, menu, members), "customer_id", "order_date", "member", "ranking")
    a = [(d, r) for c, d, m, r in got if c == "A" and m == "Y"]
    assert a == [(D(2021, 1, 7), "1"), (D(2021, 1, 10), "2"), (D(2021, 1, 11), "3"), (D(2021, 1, 11), "3"),
                 (D(2021, 1, 14), "4"), (D(2021, 2, 1), "5")]
    assert {r for c, d, m, r in got if m == "N"} == {"null"}
    assert dict(L.rank_all(sales, menu, members).dtypes)["ranking"] == "string"


def test_visit_calendar(spark):
    sales, _, _ = loyalty(spark)
    got = rows(L.visit_calendar(sales), "customer_id", "order_date", "day")
    assert ("A", D(2021, 1, 1), "Friday") in got and ("A", D(2021, 1, 7), "Thursday") in got
    assert len(got) == 6 + 5 + 2 + 1


def test_null_join_date_rows(spark):
    """A member with a NULL join date: its sales get a NULL flag in join_all
    (no CASE branch applies) and belong to neither part of rank_all."""
    sales, menu, members = loyalty(spark)
    members = members.unionByName(spark.createDataFrame([("E", None)], members.schema))
    flags = rows(L.join_all(sales, menu, members), "customer_id", "member")
    assert [m for c, m in flags if c == "E"] == [None, None]
    ranked = rows(L.rank_all(sales, menu, members), "customer_id")
    assert "E" not in {c for (c,) in ranked} and len(ranked) == 16
