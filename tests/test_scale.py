"""Plans and results that must hold for hot keys, any shuffle width, and tables too big to broadcast."""

import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from shopmarts import registry
from shopmarts.plans.intermediate import order_money
from shopmarts.plans.marts import fct_order_items
from shopmarts.plans.reports import REPORTS

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    changed = {}

    def put(**options):
        for name, value in options.items():
            key = "spark.sql." + name.replace("__", ".")
            changed.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield put
    for key, value in changed.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def exchanges(frame) -> int:
    return len(re.findall(r"Exchange hashpartitioning", plan_of(frame)))


@pytest.fixture
def no_broadcast(conf):
    conf(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")


def test_counting_orders_reuses_the_joins_shuffle(spark, no_broadcast):
    marts = registry.marts(spark, FOLDER)
    assert exchanges(REPORTS["headline"](marts)) == 2  # orders, line money
    assert exchanges(REPORTS["cancel_summary"](marts)) == 2
    assert exchanges(REPORTS["revenue_by_channel"](marts)) == 3  # and the four channels


def test_a_checked_order_key_saves_the_shuffle_and_changes_nothing(spark):
    marts = registry.marts(spark, FOLDER)
    # Read back, as a report does: the join's partitioning is gone.
    stored = replace(marts, orders=marts.orders.repartition(8, "ordered_at"))
    checked = replace(stored, order_key_holds=True)
    for name in ("headline", "cancel_by_month", "revenue_by_channel", "order_status_mix"):
        slow, fast = REPORTS[name](stored), REPORTS[name](checked)
        assert exchanges(fast) == exchanges(slow) - 1
        assert [tuple(map(str, row)) for row in fast.collect()] == [
            tuple(map(str, row)) for row in slow.collect()
        ]


def test_reports_that_need_no_money_skip_the_lines(spark):
    marts = registry.marts(spark, FOLDER)
    for name in ("order_status_mix", "fulfilment_speed"):
        plan = plan_of(REPORTS[name](marts))
        assert "l_orderkey" not in plan and "Join" not in plan


def test_no_report_multiplies_rows_or_sorts_everything(spark):
    marts = registry.marts(spark, FOLDER)
    for name, report in REPORTS.items():
        plan = plan_of(report(marts))
        assert "Expand" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
        if name in ("top_products", "top_customers", "cancel_by_product"):
            assert "TakeOrderedAndProject" in plan


def test_products_join_sums_not_lines(spark, no_broadcast):
    plan = plan_of(REPORTS["top_products"](registry.marts(spark, FOLDER)))
    join = plan.index("SortMergeJoin [product_id")
    partial = plan.index("partial_sum(realised_net_amount_eur")
    assert join < partial  # the plan is printed from the top


def test_scans_read_only_what_a_report_needs(spark):
    plan = plan_of(REPORTS["order_status_mix"](registry.marts(spark, FOLDER)))
    assert re.findall(r"ReadSchema: struct<([^>]*)>", plan) == ["o_orderkey:bigint"]


def hot_shop(spark, lines=60_000):
    """One order and one product hold a third of all lines."""
    ids = spark.range(lines)
    hot = F.col("id") % 3 == 0
    items = ids.select(
        F.col("id").alias("order_item_id"),
        F.when(hot, 7).otherwise(F.col("id") % 2000).cast("long").alias("order_id"),
        F.when(hot, 7).otherwise(F.col("id") % 100).cast("long").alias("product_id"),
        F.lit(1).alias("quantity"),
        F.lit(1000).cast("long").alias("unit_price_cents"),
        F.lit(0).cast("long").alias("discount_cents"),
    )
    orders = spark.range(2000).select(
        F.col("id").alias("order_id"),
        (F.col("id") % 10).alias("customer_id"),
        F.lit("paid").alias("order_status"),
        F.lit("web").alias("sales_channel"),
        F.lit("2026-01-01 10:00:00").cast("timestamp_ntz").alias("ordered_at"),
    )
    return items, orders


def test_a_hot_order_is_split_and_stays_whole(spark, conf, no_broadcast):
    conf(
        adaptive__skewJoin__skewedPartitionThresholdInBytes="1KB",
        adaptive__skewJoin__skewedPartitionFactor="1.5",
        adaptive__advisoryPartitionSizeInBytes="16KB",
    )
    items, orders = hot_shop(spark)
    joined = fct_order_items(items.repartition(16), orders)
    totals = joined.groupBy("order_id").agg(
        F.sum("net_amount_eur").alias("money"), F.count_distinct("order_item_id").alias("lines")
    )
    for frame in (joined, totals):
        frame.collect()
        assert "SortMergeJoin(skew=true)" in plan_of(frame)
    rows = totals.collect()
    assert len(rows) == 2000
    assert sum(row.money for row in rows) == 600_000 and sum(row.lines for row in rows) == 60_000


def test_a_hot_key_is_summed_before_the_shuffle(spark, no_broadcast):
    items, _ = hot_shop(spark)
    plan = plan_of(order_money(items))
    assert plan.index("Exchange") < plan.index("partial_sum")


@pytest.mark.parametrize("partitions", ["1", "7"])
@pytest.mark.parametrize("name", ["rpt_headline", "rpt_top_products", "dim_customers", "chk_unique"])
def test_results_do_not_depend_on_the_shuffle_width(spark, conf, no_broadcast, name, partitions):
    query = registry.QUERIES[name]
    conf(shuffle__partitions="4")
    wanted = sorted(map(str, query(spark, FOLDER).collect()))
    conf(shuffle__partitions=partitions)
    assert sorted(map(str, query(spark, FOLDER).collect())) == wanted
