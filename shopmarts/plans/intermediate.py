"""Intermediate: the one piece of arithmetic that two marts need."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def gross_cents() -> Column:
    """Price times quantity, as BIGINT: two INTs would overflow."""
    return F.col("quantity").cast("bigint") * F.col("unit_price_cents").cast("bigint")


def order_money(order_items: DataFrame) -> DataFrame:
    """One row per order that has lines. Sums combine before the shuffle, so a huge order is cheap."""
    return order_items.groupBy("order_id").agg(
        F.count("*").alias("line_item_count"),
        F.sum(F.col("quantity").cast("bigint")).alias("units"),
        F.sum(gross_cents()).alias("gross_amount_cents"),
        F.sum(F.col("discount_cents").cast("bigint")).alias("discount_cents"),
        F.sum(gross_cents() - F.col("discount_cents")).alias("net_amount_cents"),
    )
