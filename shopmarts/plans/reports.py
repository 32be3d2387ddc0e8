"""The thirteen report queries. They read marts only; they group and sum, and define nothing.

Two rules keep them cheap on large marts:

* ``count(distinct order_id)`` is written as a group-by on the order followed by a count. The first
  step reuses the partitioning that the mart's join left behind, and no row is multiplied the way
  several filtered distinct counts in one aggregate would. Over stored marts whose key has been
  checked the first step falls away.
* Lines are summed per product before they meet the product dimension, so the join moves one row
  per product, and a best-seller with a third of all lines is combined before any shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopmarts.functions.money import ratio, total
from shopmarts.functions.time import month_start
from shopmarts.plans.marts import HOURS_PER_DAY, Marts

def _net() -> Column:
    return total(F.col("realised")).alias("net_revenue_eur")


def _booked() -> Column:
    return total(F.col("booked")).alias("booked_revenue_eur")


def _lost() -> Column:
    return (total(F.col("booked")) - total(F.col("realised"))).alias("revenue_lost_eur")


def _order_count() -> Column:
    return F.count("order_id").alias("order_count")


def _cancelled() -> Column:
    return F.count(F.when(F.col("any_cancelled"), F.col("order_id")))


def _kept() -> Column:
    return F.count(F.when(F.col("any_kept"), F.col("order_id")))


def _cancellation_rate() -> Column:
    return ratio(_cancelled(), F.count("order_id")).alias("cancellation_rate")


def _per_order(marts: Marts, **by: Column) -> DataFrame:
    """One row per order within ``by``: money, and whether any row of it is (not) cancelled.

    Orders already stand one to a row once that has been checked; then nothing is shuffled.
    """
    keys = [column.alias(name) for name, column in by.items()]
    booked, realised = F.col("net_amount_eur"), F.col("realised_net_amount_eur")
    cancelled = F.col("is_cancelled")
    if marts.order_key_holds:
        return marts.orders.select(
            *keys,
            "order_id",
            booked.alias("booked"),
            realised.alias("realised"),
            cancelled.alias("any_cancelled"),
            (~cancelled).alias("any_kept"),
        )
    return marts.orders.groupBy(*keys, "order_id").agg(
        total(booked).alias("booked"),
        total(realised).alias("realised"),
        F.max(cancelled).alias("any_cancelled"),
        F.max(~cancelled).alias("any_kept"),
    )


def _month() -> Column:
    return month_start(F.col("ordered_at"))


def headline(marts: Marts) -> DataFrame:
    return _per_order(marts).agg(
        _net(),
        _booked(),
        _lost(),
        _order_count(),
        ratio(total(F.col("realised")), _kept()).alias("average_order_value_eur"),
        _cancellation_rate(),
    )


def revenue_by_month(marts: Marts) -> DataFrame:
    return (
        _per_order(marts, month=_month())
        .groupBy("month")
        .agg(_net(), _booked(), _order_count())
        .orderBy(F.asc_nulls_last("month"))
    )


def revenue_by_channel(marts: Marts) -> DataFrame:
    return (
        _per_order(marts, channel_label=F.col("channel_label"))
        .groupBy("channel_label")
        .agg(_net(), _order_count())
        .orderBy(F.desc("net_revenue_eur"), "channel_label")
    )


def order_status_mix(marts: Marts) -> DataFrame:
    return (
        _per_order(marts, order_status_label=F.col("order_status_label"))
        .groupBy("order_status_label")
        .agg(_order_count())
        .orderBy(F.desc("order_count"), "order_status_label")
    )


def fulfilment_speed(marts: Marts) -> DataFrame:
    """Mean days to ship. Hours are whole numbers, so their sum is exact in any order of rows."""
    hours = F.sum(F.round(F.col("days_to_ship") * HOURS_PER_DAY).cast("bigint"))
    shipped = F.count("days_to_ship") * F.lit(HOURS_PER_DAY)
    return (
        marts.orders.where(F.col("days_to_ship").isNotNull())
        .groupBy(_month().alias("month"))
        .agg((hours / shipped).alias("avg_days_to_ship"))
        .orderBy(F.asc_nulls_last("month"))
    )


def product_totals(marts: Marts) -> DataFrame:
    """Line totals per product. Two reports need them, so an export keeps them while it runs."""
    live_units = F.when(~F.col("is_cancelled"), F.col("quantity").cast("bigint"))
    return marts.order_items.groupBy("product_id").agg(
        total(F.col("net_amount_eur")).alias("booked"),
        total(F.col("realised_net_amount_eur")).alias("realised"),
        F.sum(live_units).alias("live_units"),
    )


def _per_product(marts: Marts, *shown: str) -> DataFrame:
    """Line totals per product, joined to the product's ``shown`` columns."""
    return product_totals(marts).join(marts.products.select("product_id", *shown), "product_id")


def top_products(marts: Marts) -> DataFrame:
    shown = ("product_name", "origin_label", "roast_label")
    return (
        _per_product(marts, *shown)
        .groupBy(*shown)
        .agg(_net(), F.sum("live_units").alias("units"))
        .orderBy(F.desc("net_revenue_eur"), *shown)
        .limit(10)
    )


def top_customers(marts: Marts) -> DataFrame:
    return (
        marts.customers.where("has_ordered")
        .orderBy(F.desc("lifetime_realised_net_revenue_eur"), "customer_id")
        .limit(20)
        .select(
            "full_name",
            "city",
            "segment_label",
            "lifetime_order_count",
            "lifetime_realised_net_revenue_eur",
        )
    )


def revenue_by_segment(marts: Marts) -> DataFrame:
    return (
        marts.customers.where("has_ordered")
        .groupBy("segment_label")
        .agg(
            F.count("*").alias("customers"),
            total(F.col("lifetime_realised_net_revenue_eur")).alias("net_revenue_eur"),
        )
        .orderBy(F.desc("net_revenue_eur"), "segment_label")
    )


def cancel_summary(marts: Marts) -> DataFrame:
    booked = total(F.col("booked"))
    return _per_order(marts).agg(
        _cancelled().alias("cancelled_orders"),
        _order_count(),
        _cancellation_rate(),
        _lost(),
        ratio(booked - total(F.col("realised")), booked).alias("revenue_lost_share"),
    )


def cancel_by_month(marts: Marts) -> DataFrame:
    return (
        _per_order(marts, month=_month())
        .groupBy("month")
        .agg(_cancellation_rate(), _lost())
        .orderBy(F.asc_nulls_last("month"))
    )


def cancel_by_channel(marts: Marts) -> DataFrame:
    return (
        _per_order(marts, channel_label=F.col("channel_label"))
        .groupBy("channel_label")
        .agg(_order_count(), _cancellation_rate(), _lost())
        .orderBy(F.desc("cancellation_rate"), "channel_label")
    )


def cancel_by_product(marts: Marts) -> DataFrame:
    return (
        _per_product(marts, "product_name")
        .groupBy("product_name")
        .agg(_lost(), total(F.col("realised")).alias("realised_revenue_eur"))
        .where("revenue_lost_eur > 0")
        .orderBy(F.desc("revenue_lost_eur"), "product_name")
        .limit(10)
    )


def shape(marts: Marts) -> DataFrame:
    per_customer = marts.orders.groupBy("customer_id").agg(
        F.count("*").alias("orders"),
        total(F.col("realised_net_amount_eur")).alias("realised"),
        total(F.col("net_amount_eur")).alias("booked"),
        F.count_if("is_cancelled").alias("cancelled"),
        F.min("order_date").alias("first"),
        F.max("order_date").alias("last"),
    )
    # A sum over no rows is NULL where a count is 0.
    orders = F.coalesce(F.sum("orders"), F.lit(0))
    return per_customer.agg(
        orders.alias("orders"),
        F.count("customer_id").alias("customers"),
        total(F.col("realised")).alias("revenue_eur"),
        total(F.col("booked")).alias("booked_eur"),
        ratio(F.sum("cancelled"), orders).alias("cancellation_rate"),
        F.min("first").alias("from_date"),
        F.max("last").alias("to_date"),
    )


REPORTS: dict[str, Callable[[Marts], DataFrame]] = {
    "headline": headline,
    "revenue_by_month": revenue_by_month,
    "revenue_by_channel": revenue_by_channel,
    "order_status_mix": order_status_mix,
    "fulfilment_speed": fulfilment_speed,
    "top_products": top_products,
    "top_customers": top_customers,
    "revenue_by_segment": revenue_by_segment,
    "cancel_summary": cancel_summary,
    "cancel_by_month": cancel_by_month,
    "cancel_by_channel": cancel_by_channel,
    "cancel_by_product": cancel_by_product,
    "shape": shape,
}
