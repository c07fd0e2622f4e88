"""Invented micro-tables in the role schemas, with the trap rows they need."""

import datetime as dt
from decimal import Decimal

D = dt.date
T = dt.datetime


def loyalty(spark):
    menu = spark.createDataFrame(
        [(1, "sushi", Decimal("10.00")), (2, "curry", Decimal("15.00")), (3, "ramen", Decimal("12.00")),
         (4, None, Decimal("5.00"))],
        "product_id int, product_name string, price decimal(10,2)")
    sales = spark.createDataFrame([
        # A: two items on the first date; sushi and curry tied on count
        ("A", D(2021, 1, 1), 1), ("A", D(2021, 1, 1), 2), ("A", D(2021, 1, 7), 2),
        ("A", D(2021, 1, 10), 3), ("A", D(2021, 1, 11), 3), ("A", D(2021, 1, 11), 3),
        ("A", D(2021, 1, 14), 1), ("A", D(2021, 2, 1), 1),
        # B: member; sales on, one day before, 6 and 7 days after the anchor
        ("B", D(2021, 1, 8), 2), ("B", D(2021, 1, 9), 2), ("B", D(2021, 1, 9), 1),
        ("B", D(2021, 1, 15), 3), ("B", D(2021, 1, 16), 3), ("B", D(2020, 1, 20), 1),
        # C: non-member, only the doubled item; E: never buys it, NULL name item
        ("C", D(2021, 1, 1), 1), ("C", D(2021, 1, 7), 1),
        ("E", D(2021, 1, 3), 2), ("E", D(2021, 1, 3), 4),
    ], "customer_id string, order_date date, product_id int")
    members = spark.createDataFrame([("A", D(2021, 1, 7)), ("B", D(2021, 1, 9))],
                                    "customer_id string, join_date date")
    return sales, menu, members


def delivery(spark):
    runner_orders_raw = spark.createDataFrame([
        (21, 5, "2022-03-02 08:14:10", "7km", "12 minutes", ""),
        (22, 5, "2022-03-02 09:40:00", "3.6 km", "9 mins", None),
        (23, 6, "2022-03-03 10:05:31", "18.27km", "26", "null"),
        (24, 6, "null", "null", "null", "Customer Cancellation"),
        (25, 7, "2022-03-05 19:30:05", "42", "50minutes", ""),
        (26, 7, "2022-03-05 20:00:00", "10 5", "9", ""),
        (27, 8, "2022-03-06 12:00:00", "64", "0", None),
        (28, 8, "null", "null", "null", "Restaurant Cancellation"),
        (29, 5, "2022-03-07 11:11:11", "15.5km", "31min", "null"),     # an order without lines
    ], "order_id int, runner_id int, pickup_time string, distance string, duration string, cancellation string")
    customer_orders_raw = spark.createDataFrame([
        (21, 301, 1, "", "", T(2022, 3, 2, 8, 2, 40)),
        (22, 302, 1, "3", "", T(2022, 3, 2, 9, 21, 15)),
        (22, 302, 1, "3", "", T(2022, 3, 2, 9, 21, 15)),              # exact duplicate line
        (22, 302, 2, "null", None, T(2022, 3, 2, 9, 21, 15)),
        (23, 301, 2, "", "4", T(2022, 3, 3, 9, 59, 59)),
        (24, 303, 1, "9, 2", "5", T(2022, 3, 4, 17, 30, 0)),          # cancelled
        (25, 304, 1, "2, 7", "3, 11", T(2022, 3, 5, 19, 5, 6)),
        (26, 305, 1, "5, 5", "9, 9", T(2022, 3, 5, 19, 50, 0)),       # repeated ids
        (26, 305, 2, "88", "", T(2022, 3, 5, 19, 50, 0)),             # unknown token only
        (27, 302, 2, "1, 4, 6, 8, 10", "", T(2022, 3, 6, 11, 45, 0)),  # all excluded
        (27, 302, 1, "11,", "6", T(2022, 3, 6, 11, 45, 0)),           # trailing comma; extra outside recipe
        (28, 306, 2, "null", "null", T(2022, 3, 6, 13, 0, 0)),        # cancelled
        (30, 307, 1, None, None, T(2022, 3, 8, 9, 0, 0)),             # order with no runner row
    ], "order_id int, customer_id int, pizza_id int, exclusions string, extras string, order_time timestamp_ntz")
    pizza_names = spark.createDataFrame([(1, "Harvest Bowl"), (2, "Garden Wrap")], "pizza_id int, pizza_name string")
    pizza_recipes = spark.createDataFrame([(1, "2, 3, 5, 7, 9, 11"), (2, "1, 4, 6, 8, 10")],
                                          "pizza_id int, toppings string")
    pizza_toppings = spark.createDataFrame([
        (1, "Walnut"), (2, "Apple"), (3, "Barley"), (4, "Carrot"), (5, "Date"), (6, "Fennel"),
        (7, "Ginger"), (8, "Hazelnut"), (9, "Kale"), (10, "Lentil"), (11, "Mint"),
        (12, "Olive")], "topping_id int, topping_name string")
    runners = spark.createDataFrame(
        [(1, D(2022, 5, 1)), (2, D(2022, 5, 7)), (3, D(2022, 5, 15)), (4, D(2022, 5, 28)),
         (5, D(2022, 5, 29)), (6, D(2022, 5, 31)), (7, D(2022, 6, 1))],
        "runner_id int, registration_date date")
    return dict(runner_orders_raw=runner_orders_raw, customer_orders_raw=customer_orders_raw,
                pizza_names=pizza_names, pizza_recipes=pizza_recipes, pizza_toppings=pizza_toppings,
                runners=runners)
