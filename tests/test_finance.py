import os
import tempfile
from decimal import Decimal

from conftest import rows
from pyspark.sql import functions as F
from fixtures import delivery

from orderlens.operators.cleaning import clean_customer_orders, clean_runner_orders
from orderlens.plans import finance as P
from orderlens.plans.registry import NEW_PRODUCT_NAME, NEW_PRODUCT_TOPPINGS
from orderlens.sources.sinks import read_written, write_table

PRICES = {"Harvest Bowl": 14, "Garden Wrap": 9}


def _tables(spark):
    t = delivery(spark)
    t["runner_orders"] = clean_runner_orders(t["runner_orders_raw"])
    t["customer_orders"] = clean_customer_orders(t["customer_orders_raw"])
    return t


def test_revenue_variants(spark):
    t = _tables(spark)
    co, pn, ro = t["customer_orders"], t["pizza_names"], t["runner_orders"]
    assert rows(P.revenue(co, pn, ro, PRICES)) == [(120,)]          # 6 x 14 + 4 x 9
    assert rows(P.revenue_with_extras(co, pn, ro, PRICES)) == [(127,)]   # + 7 listed extras
    assert rows(P.net_revenue(co, pn, ro, PRICES)) == [(Decimal("74.91"),)]   # - 0.3 x 150.3


def test_revenue_with_extras_null_without_extras(spark):
    t = _tables(spark)
    co = t["customer_orders"].withColumn("extras", F.lit(None).cast("string"))
    out = P.revenue_with_extras(co, t["pizza_names"], t["runner_orders"], PRICES)
    assert rows(out) == [(None,)]


def test_ratings_table_schema_and_write(spark):
    t = _tables(spark)
    orders = t["customer_orders"].select("order_id", "customer_id").distinct()
    r = P.ratings_table(t["runner_orders"], orders)
    assert r.schema == P.RATINGS_SCHEMA
    assert {x["order_id"] for x in r.collect()} == {21, 22, 23, 25, 26, 27}
    assert all(1 <= x["rating"] <= 5 for x in r.collect())
    path = os.path.join(tempfile.mkdtemp(prefix="orderlens-ratings-"), "runner_ratings")
    write_table(r, path, P.RATINGS_SCHEMA)
    write_table(r, path, P.RATINGS_SCHEMA, mode="overwrite")
    back = read_written(spark, path, P.RATINGS_SCHEMA)
    assert rows(back) == rows(r)


def test_delivery_report(spark):
    t = _tables(spark)
    orders = t["customer_orders"].select("order_id", "customer_id").distinct()
    ratings = P.ratings_table(t["runner_orders"], orders)
    rep = {r["order_id"]: r for r in P.delivery_report(t["customer_orders"], ratings, t["runner_orders"]).collect()}
    assert set(rep) == {21, 22, 23, 25, 26, 27}
    assert rep[22]["Total_number_of_pizzas"] == 3 and rep[22]["Time_between_order_and_pickup"] == 18
    assert rep[27]["Average_speed"] is None and rep[21]["Delivery_duration"] == Decimal("12")


def test_add_product(spark):
    t = _tables(spark)
    names, recipes = P.add_product(t["pizza_names"], t["pizza_recipes"], NEW_PRODUCT_NAME,
                                   NEW_PRODUCT_TOPPINGS)
    assert rows(names)[-1] == (3, NEW_PRODUCT_NAME)
    out = rows(P.menu_after_new_product(t["pizza_names"], t["pizza_recipes"], t["pizza_toppings"], NEW_PRODUCT_NAME,
                                        NEW_PRODUCT_TOPPINGS))
    assert len([r for r in out if r[0] == 3]) == 12 and len(out) == 23


def test_ratings_of_any_id_and_of_repeated_customers(spark):
    runs = spark.createDataFrame([(-8, 1, None), (-8, 2, None), (5, 1, None), (6, 1, "Cancelled")],
                                 "order_id long, runner_id long, cancellation string")
    customers = spark.createDataFrame([(-8, 7), (-8, 7), (5, 9), (6, 9)], "order_id long, customer_id long")
    assert rows(P.ratings_table(runs, customers)) == [(-8, 7, 1, 3), (-8, 7, 2, 3), (5, 9, 1, 1)]


def test_given_ratings_are_checked_created_added_and_read_back(spark, tmp_path):
    given = spark.createDataFrame([(1, 10, 100, 3), (2, 11, 101, 5), (4, 12, 100, None)],
                                  "order_id int, customer_id int, runner_id int, rating int")
    back = P.ratings_written(spark, P.rated(given), str(tmp_path / "ratings"))
    assert back.schema == P.RATINGS_SCHEMA and rows(back) == [(1, 10, 100, 3), (2, 11, 101, 5), (4, 12, 100, None)]
    for wrong in (0, 6, -2):
        bad = given.withColumn("rating", F.lit(wrong))
        try:
            P.rated(bad).collect()
        except Exception as e:  # noqa: BLE001
            assert "outside 1..5" in str(e)
        else:
            raise AssertionError("a rating outside the range passed")
