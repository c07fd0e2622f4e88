import datetime as dt
from decimal import Decimal

from conftest import rows
from fixtures import delivery

from orderlens.functions.text import NUMBER_TYPE, STRICT_NUMBER_PATTERN
from orderlens.operators.cleaning import clean_customer_orders, clean_runner_orders
from orderlens.plans import delivery as V
from orderlens.plans import orders as O


def _tables(spark):
    t = delivery(spark)
    t["runner_orders"] = clean_runner_orders(t["runner_orders_raw"])
    t["customer_orders"] = clean_customer_orders(t["customer_orders_raw"])
    return t


def test_clean_runner_orders(spark):
    t = _tables(spark)
    got = {r["order_id"]: r for r in t["runner_orders"].collect()}
    assert got[21]["distance"] == Decimal("7") and got[21]["duration"] == Decimal("12")
    assert got[22]["distance"] == Decimal("3.6") and got[22]["duration"] == Decimal("9")
    assert got[23]["distance"] == Decimal("18.2")            # "18.27km": one digit after the dot
    assert got[26]["distance"] is None                       # "10 5" is not a number
    assert got[27]["distance"] == Decimal("64") and got[27]["duration"] == Decimal("0")
    assert got[24]["distance"] is None and got[24]["duration"] is None and got[24]["pickup_time"] is None
    assert got[24]["cancellation"] == "Customer Cancellation"
    assert {k for k, r in got.items() if r["cancellation"] is None} == {21, 22, 23, 25, 26, 27, 29}
    assert got[21]["pickup_time"] == dt.datetime(2022, 3, 2, 8, 14, 10)
    assert dict(t["runner_orders"].dtypes)["distance"] == NUMBER_TYPE


def test_cleaning_is_idempotent(spark):
    t = _tables(spark)
    once = t["runner_orders"]
    assert rows(clean_runner_orders(once)) == rows(once)
    co = t["customer_orders"]
    assert rows(clean_customer_orders(co)) == rows(co)
    assert {r["exclusions"] for r in co.collect()} >= {None, "3"}
    assert "" not in {r["extras"] for r in co.collect()} and "null" not in {r["extras"] for r in co.collect()}


def test_strict_number_pattern(spark):
    raw = delivery(spark)["runner_orders_raw"]
    got = {r["order_id"]: r["distance"] for r in clean_runner_orders(raw, STRICT_NUMBER_PATTERN).collect()}
    assert got[23] == Decimal("18.27") and got[26] == Decimal("10")


def test_order_metrics(spark):
    t = _tables(spark)
    co, ro, pn = t["customer_orders"], t["runner_orders"], t["pizza_names"]
    assert rows(O.order_lines_total(co)) == [(13,)]
    assert rows(O.unique_customers(co)) == [(7,)]
    assert rows(O.deliveries_by_runner(ro)) == [(5, 3), (6, 1), (7, 2), (8, 1)]
    assert rows(O.delivered_by_product(co, ro, pn)) == [(1, "Harvest Bowl", 6), (2, "Garden Wrap", 4)]
    assert rows(O.max_lines_per_order(co, ro)) == [(3,)]
    # lines with both lists in delivered orders 25, 26, 27 (order 24 is cancelled)
    assert rows(O.both_modifiers(co, ro)) == [(3,)]
    ch = dict(((c, k), n) for c, k, n in rows(O.changed_vs_unchanged(co, ro)))
    assert ch[(301, "no change")] == 1 and ch[(302, "at least 1 change")] == 4 and ch[(302, "no change")] == 1


def test_volume_by_weekday_zero_filled(spark):
    t = _tables(spark)
    out = O.volume_by_weekday(spark, t["customer_orders"]).collect()
    assert sorted(r["name_week"] for r in out) == sorted(["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday",
                                                          "Friday", "Saturday"])
    d = {r["name_week"]: r["no_of_orders"] for r in out}
    assert d["Monday"] == 0 and d["Saturday"] == 3 and sum(d.values()) == 13


def test_volume_by_order_time_grains(spark):
    co = _tables(spark)["customer_orders"]
    by_time = rows(O.volume_by_order_time(co))
    by_hour = rows(O.volume_by_order_time(co, grain="hour"))
    assert sum(n for *_, n in by_time) == sum(n for *_, n in by_hour) == 13
    assert len(by_hour) < len(by_time)


def test_signups_by_week(spark):
    t = _tables(spark)
    got = rows(V.signups_by_week(spark, t["runners"], dt.date(2022, 5, 1), dt.date(2022, 5, 31)))
    assert got == [(1, 2), (2, 0), (3, 1), (4, 1), (5, 2)]


def test_runner_times_and_speeds(spark):
    t = _tables(spark)
    co, ro = t["customer_orders"], t["runner_orders"]
    prep = {o: (n, m) for o, n, m in rows(V.prep_time_by_order(co, ro))}
    assert prep[21] == (1, 11)           # 08:02:40 -> 08:14:10 is 11 whole minutes
    assert prep[22] == (3, 18)
    assert 30 not in prep and 24 not in prep
    spread = rows(V.duration_spread(ro))
    assert spread == [(Decimal("50"),)]   # numeric, not text ("9" > "50")
    speed = {o: s for r, o, d, du, s in rows(V.speed_by_delivery(ro))}
    assert speed[27] is None and speed[26] is None and abs(speed[21] - 7 / 12) < 1e-12
    pct = dict(rows(V.delivery_success_pct(ro)))
    assert pct == {5: 100.0, 6: 50.0, 7: 100.0, 8: 50.0}
    avg_pick = dict(rows(V.avg_pickup_minutes(co, ro)))
    assert set(avg_pick) == {5, 6, 7, 8} and avg_pick[7] == 17.0
    dist = dict(rows(V.avg_distance_by_customer(co, ro)))
    assert abs(dist[301] - 12.6) < 1e-12 and dist[305] is None


def test_elapsed_minutes_truncates_toward_zero(spark):
    from orderlens.functions.time import elapsed_minutes
    df = spark.createDataFrame([(dt.datetime(2021, 1, 1, 0, 0, 0), dt.datetime(2021, 1, 1, 0, 10, 59))],
                               "a timestamp_ntz, b timestamp_ntz")
    r = df.select(elapsed_minutes("a", "b").alias("f"), elapsed_minutes("b", "a").alias("r")).first()
    assert (r["f"], r["r"]) == (10, -10)


def test_wall_clock_under_other_session_zone(spark):
    """timestamp_ntz values are wall-clock times: minutes and presented text
    do not move when the session zone has a DST gap at that time."""
    from orderlens.functions.time import elapsed_minutes
    from orderlens.plans.registry import present
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame([(dt.datetime(2001, 4, 1, 7, 23), dt.datetime(2001, 4, 1, 2, 33))],
                                   "a timestamp_ntz, b timestamp_ntz")
        r = present(df.select("b", elapsed_minutes("a", "b").alias("m"))).first()
        assert (r["b"], r["m"]) == ("2001-04-01 02:33:00", -290)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
