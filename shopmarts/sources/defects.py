"""Tables broken on purpose, so that every check can be seen to fail.

The broken tables keep all rows of the given ones; some values are spoiled and some rows doubled.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopmarts.plans.marts import Marts


def _spoil(table: DataFrame, column: str, where: Column, value: Column) -> DataFrame:
    kind = table.schema[column].dataType
    spoiled = F.when(where, value.cast(kind)).otherwise(F.col(column))
    return table.withColumn(column, spoiled)


def _double(table: DataFrame, where: Column) -> DataFrame:
    return table.unionByName(table.where(where))


def broken_raw(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Missing, unknown, repeated and dangling values in all four source tables."""
    key, nothing = F.col("id"), F.lit(None)

    customers = _spoil(raw["customers"], "email", key % 50 == 1, nothing)
    customers = _spoil(customers, "segment", key % 40 == 2, F.lit("vip"))
    customers = _double(customers, key % 60 == 3)

    products = _spoil(raw["products"], "sku", key % 70 == 5, nothing)
    products = _spoil(products, "category", key % 45 == 4, F.lit("tea"))
    products = _double(products, key % 80 == 6)

    orders = _spoil(raw["orders"], "customer_id", key % 33 == 6, -key - 1)
    orders = _spoil(orders, "customer_id", key % 34 == 7, nothing)
    orders = _spoil(orders, "status", key % 35 == 8, F.lit("lost"))
    orders = _spoil(orders, "ordered_at", key % 36 == 9, nothing)
    orders = _spoil(orders, "channel", key % 38 == 11, F.lit("kiosk"))
    orders = _double(orders, key % 37 == 10)

    product, order = F.col("product_id"), F.col("order_id")
    lines = _spoil(raw["order_items"], "quantity", order % 63 == 2, nothing)
    lines = _spoil(lines, "order_id", product % 61 == 0, nothing)
    lines = _spoil(lines, "order_id", product % 62 == 1, -order - 1)
    lines = _spoil(lines, "product_id", product % 64 == 3, -product - 1)
    lines = _double(lines, product % 65 == 4)

    return {"customers": customers, "products": products, "orders": orders, "order_items": lines}


def lost_parentheses(marts: Marts) -> Marts:
    """Line money with only the discount converted to euros: gross stays in cents."""
    wrong = F.col("gross_amount_eur") * 100 - F.col("discount_eur")
    lines = marts.order_items.withColumn("net_amount_eur", wrong.cast("decimal(18,2)"))
    return replace(marts, order_items=lines)


def cancellations_count(marts: Marts) -> Marts:
    """Realised money that forgets to drop cancelled orders, on both facts."""

    def forget(table: DataFrame) -> DataFrame:
        return table.withColumn("realised_net_amount_eur", F.col("net_amount_eur"))

    return replace(marts, orders=forget(marts.orders), order_items=forget(marts.order_items))


def floating_money(marts: Marts) -> Marts:
    """Two money columns turned into doubles."""
    products = marts.products.withColumn("unit_margin_eur", F.col("unit_margin_eur").cast("double"))
    orders = marts.orders.withColumn("net_amount_eur", F.col("net_amount_eur").cast("double"))
    return replace(marts, orders=orders, products=products)


def later_orders(orders: DataFrame) -> DataFrame:
    """The order mart as another build might leave it: rows changed, gone and new, one column
    dropped, one added and one retyped."""
    key = F.col("order_id")
    kept = orders.where(key % 97 != 0)
    changed = kept.withColumn(
        "realised_net_amount_eur",
        F.when(key % 13 == 0, F.lit(0).cast("decimal(18,2)")).otherwise(
            F.col("realised_net_amount_eur")
        ),
    )
    extra = orders.where(key % 89 == 0).withColumn("order_id", -key - 1)
    return (
        changed.unionByName(extra)
        .drop("shipping_city")
        .withColumn("is_large", F.col("units") > 100)
        .withColumn("line_item_count", F.col("line_item_count").cast("int"))
    )
