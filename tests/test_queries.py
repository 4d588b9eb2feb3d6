"""Queries against the independent SQL. A spread of them by default; all with ALL_QUERIES=1."""

import os

import pytest

from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
DEFAULT = ["date_slice", "scope_items", "item_hierarchy", "next_promo_detail", "weekly_sales", "rolling_means", "last_year_sales",
           "demand_without_bulk", "coupon_dummies", "promo_history", "promo_lunar", "week_to_day", "error_curve", "item_profile"]


def _names():
    from tillcast.plans import SQL
    return list(SQL) if os.environ.get("ALL_QUERIES") else DEFAULT


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", _names())
def test_query_equals_sql(name, spark, con):
    from tillcast.plans import QUERIES, SQL
    assert compare(QUERIES[name](spark, FOLDER), con, SQL[name]) == ""


@pytest.mark.parametrize("name", ["current_promo", "next_promo_detail", "shipment_candidates", "promo_lunar", "coupon_link", "coupon_rows",
                                  "regular_days", "cap_forecast", "densify_weeks", "item_code_fill"])
def test_plans_have_no_nested_loops(name, spark):
    from tillcast.plans import QUERIES
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_hot_key_is_spread_over_days(spark, make):
    """One key with a third of all rows: results are whole and its rows meet the plan by day."""
    from pyspark.sql import functions as F
    from tillcast.operators import promo_join
    hot = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string"))).alias("k"),
        F.date_add(F.lit("2019-01-01").cast("date"), (F.col("id") % 365).cast("int")).alias("sale_date"))
    plan = make("k string, promo_id int, promo_start date, promo_end date", [("hot", 1, "2019-03-01", "2019-03-31")])
    out = promo_join.current_promo(hot, plan, ["k"], [])
    assert out.count() == 30000
    want = hot.where("k = 'hot' and sale_date between '2019-03-01' and '2019-03-31'").count()
    assert out.where("on_promo = 1").count() == want > 0
    nxt = promo_join.next_promo(hot, plan, ["k"])
    assert nxt.where("k = 'hot'").count() <= 365


def test_entry_points(spark):
    import __spark_entry__ as entry
    assert set(entry.oracle_sql()) <= set(entry.queries())
    from tillcast.plans import QUERIES
    assert len(QUERIES) == 122 and set(QUERIES) <= set(entry.queries())
    assert entry.entry(spark).limit(1).count() == 1
