"""Entry contract, differential check against the DuckDB oracle, plan shape."""

import os
import re
import sys

import pytest

import __spark_entry__ as E
from orderlens.plans.oracle import ORACLE
from orderlens.plans.registry import QUERIES

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

SMALL = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["customer_id", "most_popular_item"]
    assert df.count() > 0


def test_every_query_has_oracle():
    assert set(ORACLE) == set(QUERIES) and set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())
    assert len(QUERIES) == 59


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="test data not present")
def test_all_queries_match_oracle(spark):
    from check_oracle import compare
    rep = compare(spark, SMALL, sorted(QUERIES), verbose=False)
    bad = {k: v for k, v in rep.items() if v != "OK"}
    assert not bad, bad


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def large_tables(spark):
    """Plans as with tables of any size: nothing is broadcast unless a hint
    in the library says so."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


# Hinted broadcasts are of aggregates with one row.
# (rank_all and the four after it: also of a row per range partition)
ONE_ROW_BROADCASTS = {"join_all": 1, "rank_all": 2, "order_lines_numbered": 1, "item_ranks": 2,
                      "last_before_join_chunks": 1, "tried_before_join_chunks": 1, "revenue_with_extras": 1, "net_revenue": 1}
NESTED_LOOPS = {"rank_all": 1, "order_lines_numbered": 0, "item_ranks": 0, "last_before_join_chunks": 0,
                "tried_before_join_chunks": 0}
GLOBAL_AGGREGATES = {"order_lines_total", "unique_customers", "both_modifiers", "duration_spread", "revenue",
                     "revenue_with_extras", "net_revenue", "add_product", "join_all", "rank_all",
                     "order_lines_numbered", "delivered_by_product_extended", "ingredient_usage_extended",
                     "revenue_extended"}


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="test data not present")
def test_plan_shapes_without_broadcasts(large_tables):
    """No broadcast but of one row, no nested loops but against one row, no
    single partition but for global aggregates, no Python."""
    bad = []
    for k, q in QUERIES.items():
        plan = _plan(q(large_tables, SMALL))
        hinted = ONE_ROW_BROADCASTS.get(k, 0)
        if plan.count("BroadcastExchange") != hinted:
            bad.append((k, "broadcasts", plan.count("BroadcastExchange")))
        if len(re.findall("BroadcastNestedLoopJoin|CartesianProduct", plan)) != NESTED_LOOPS.get(k, hinted):
            bad.append((k, "nested loops"))
        if "SinglePartition" in plan and k not in GLOBAL_AGGREGATES:
            bad.append((k, "single partition"))
        if re.search("BatchEvalPython|ArrowEvalPython|InPandas|InArrow", plan):
            bad.append((k, "python"))
    assert not bad, bad


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="test data not present")
@pytest.mark.parametrize("key,scans", [("order_item_text", 1), ("ingredient_list_text", 2), ("ingredient_usage", 2),
                                       ("revenue", 1), ("net_revenue", 1), ("join_all", 1), ("rank_all", 1),
                                       ("tried_before_join", 1), ("first_items", 1), ("favourite_items", 1),
                                       ("first_after_join", 1), ("last_before_join", 1)])
def test_reads_of_the_line_table(large_tables, key, scans):
    """The recipes are a second reading of the lines (their role's binding).
    Counted in the plan that ran, which shares equal readings."""
    df = QUERIES[key](large_tables, SMALL)
    df.collect()
    plan = _plan(df).split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet[^\n]*l_orderkey", plan)) + len(
        re.findall(r"FileScan parquet \[l_partkey[^\n]*", plan)) == scans


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="test data not present")
def test_priced_products_are_joined_before_the_orders(large_tables):
    """The join of the delivered runs stands above the inner join of lines and
    priced products."""
    plan = _plan(QUERIES["revenue"](large_tables, SMALL))
    joins = re.findall(r"(?:SortMergeJoin|ShuffledHashJoin) \[(\w+?)#\d+L?\], \[\w+?#\d+L?\], (\w+)", plan)
    assert [j for j in joins if j[0] == "pizza_id"] == [("pizza_id", "Inner")]
    assert [j[0] for j in joins].index("order_id") < [j[0] for j in joins].index("pizza_id")


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="test data not present")
def test_scans_are_pruned(spark):
    plan = _plan(E.queries()["deliveries_by_runner"](spark, SMALL))
    # only the orders columns the runner role needs are read
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan
    plan = _plan(E.queries()["totals_before_join"](spark, SMALL))
    assert "PushedFilters: [IsNotNull(c_mktsegment), EqualTo(c_mktsegment,BUILDING)" in plan


def test_tables_are_checked_on_load(spark, tmp_path):
    from orderlens.sources.tables import read_table
    spark.createDataFrame([("1", "x")], "s_suppkey string, s_name string").write.parquet(str(tmp_path / "supplier.parquet"))
    with pytest.raises(ValueError, match="s_suppkey"):
        read_table(spark, str(tmp_path), "supplier")
    spark.createDataFrame([(1,)], "c_custkey long").write.parquet(str(tmp_path / "customer.parquet"))
    with pytest.raises(ValueError, match="c_mktsegment"):
        read_table(spark, str(tmp_path), "customer")


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="test data not present")
def test_ingredient_texts_are_moved_by_the_order_alone(large_tables):
    """No shuffle of lines or texts by their lists."""
    plan = _plan(QUERIES["ingredient_list_text"](large_tables, SMALL))
    assert not re.search(r"Exchange hashpartitioning\([^)]*(exclusions|extras)", plan)
