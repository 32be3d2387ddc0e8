"""Webshop source tables derived from a TPC-H-like trade schema.

Gives the pipeline a source of any size. Everything is row-wise arithmetic on the given tables; the
only joins are customer to nation to region. Facts the trade tables lack (cancelled orders, shipping
times, missing phones, customers who never order) follow from the keys by modulus.
"""

from __future__ import annotations

import os
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmarts.operators.upsert import with_lineage
from shopmarts.schemas import COFFEE_ORIGINS

LANDED_BY = "1788961669.673802"  # load id given to tables that no loader has landed
LISTED_AT = "1994-06-01 00:00:00"

# Part type to product category.
CATEGORY_OF = {
    "ECONOMY": "beans",
    "STANDARD": "beans",
    "SMALL": "beans",
    "MEDIUM": "ground",
    "LARGE": "capsules",
    "PROMO": "equipment",
}


def _later(moment: Column, hours: Column, minutes: Column) -> Column:
    step = F.make_dt_interval(F.lit(0), hours.cast("int"), minutes.cast("int"))
    return moment + step


def _nearest(value: Column) -> Column:
    """Whole number closest to a value above zero. ``round`` goes through BigDecimal for every row."""
    return F.floor(value + 0.5)


def _listed_at() -> Column:
    return F.lit(LISTED_AT).cast("timestamp_ntz")


def customers(trade: dict[str, DataFrame]) -> DataFrame:
    key = F.col("c_custkey")
    serial = F.substr("c_name", F.lit(10))
    places = trade["nation"].join(
        trade["region"], F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )
    return (
        trade["customer"]
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            key.alias("id"),
            F.lit("Customer").alias("first_name"),
            serial.alias("last_name"),
            F.concat(F.lit("CUST"), serial, F.lit("@Example.org")).alias("email"),
            F.when(key % 10 >= 3, F.concat(F.lit("+32"), serial)).alias("phone"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("country"),
            F.when(key % 9 == 0, "business").otherwise("consumer").alias("segment"),
            (key % 20 < 9).alias("is_marketing_opt_in"),
            _listed_at().alias("created_at"),
            _listed_at().alias("updated_at"),
        )
    )


def _within(key: Column, limit: int) -> Column:
    """The key as text; an error where it would be cut."""
    too_long = F.raise_error(F.concat(F.lit("no room for key "), key.cast("string")))
    return F.when(key < limit, key.cast("string")).otherwise(too_long.cast("string"))


def products(trade: dict[str, DataFrame]) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    origins = F.array(*[F.lit(origin) for origin in COFFEE_ORIGINS])
    categories = F.create_map(*[F.lit(text) for pair in CATEGORY_OF.items() for text in pair])

    def cents(share: int) -> Column:
        return _nearest(F.col("p_retailprice") * share)

    roast = F.when(size % 7 < 3, "medium").when(size % 7 < 5, "light").otherwise("dark")
    return trade["part"].select(
        key.alias("id"),
        F.lpad(_within(key, 10**13), 13, "0").alias("sku"),
        F.get(origins, (key % len(COFFEE_ORIGINS)).cast("int")).alias("origin"),
        roast.alias("roast"),
        F.element_at(categories, F.col("p_type")).alias("category"),
        (size * 15 + 250).alias("weight_grams"),
        cents(100).alias("unit_price_cents"),
        cents(45).alias("cost_cents"),
        (key % 20 < 17).alias("is_active"),
        _listed_at().alias("created_at"),
        _listed_at().alias("updated_at"),
    )


def orders(trade: dict[str, DataFrame]) -> DataFrame:
    key, customer, day = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")
    turn = key % 21  # 14 delivered : 3 shipped : 2 paid : 1 pending : 1 cancelled
    lane = (key * 7 + customer) % 12  # 6 web : 3 mobile : 2 marketplace : 1 store
    status = (
        F.when(turn < 14, "delivered")
        .when(turn < 17, "shipped")
        .when(turn < 19, "paid")
        .when(turn == 19, "pending")
        .otherwise("cancelled")
    )
    channel = (
        F.when(lane < 6, "web")
        .when(lane < 9, "mobile_app")
        .when(lane < 11, "marketplace")
        .otherwise("store")
    )
    ordered = _later(day, key % 24, key % 60)
    shipped = F.when(key % 5 != 0, _later(day, key % 24 + key % 97, (key * 13) % 60 + 60))
    delivered = F.when(key % 10 >= 3, _later(shipped, key % 72, F.lit(0)))
    return trade["orders"].select(
        key.alias("id"),
        # Customers 7, 15, 23 ... hand their orders to a neighbour and so never order.
        F.when(customer % 8 == 7, customer - 1).otherwise(customer).alias("customer_id"),
        status.alias("status"),
        channel.alias("channel"),
        ordered.alias("ordered_at"),
        shipped.alias("shipped_at"),
        delivered.alias("delivered_at"),
        F.concat(F.lit("City "), (customer % 25).cast("string")).alias("shipping_city"),
        F.concat(F.lit("Country "), (customer % 5).cast("string")).alias("shipping_country"),
        ordered.alias("created_at"),
        F.coalesce(delivered, shipped, ordered).alias("updated_at"),
    )


def order_items(trade: dict[str, DataFrame]) -> DataFrame:
    """Order lines. The trade lines have no key, so their identifying columns are written side by
    side as one number: unique, ordered by order, and made without numbering the lines of an order
    in one task. From the left: order, line number (2 digits), part (11), supplier (10), quantity (2).
    """
    front = (F.col("l_orderkey") * 100 + F.col("l_linenumber")).cast("decimal(15,0)")
    with_part = front * F.lit(Decimal(10**11)) + F.col("l_partkey").cast("decimal(11,0)")
    back = F.col("l_suppkey") * 100 + F.col("l_quantity").cast("bigint")
    line_key = with_part.cast("decimal(26,0)") * F.lit(Decimal(10**12)) + back.cast("decimal(12,0)")
    return trade["lineitem"].select(
        line_key.cast("decimal(38,0)").alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        _nearest(F.col("l_extendedprice") * 100 / F.col("l_quantity")).alias("unit_price_cents"),
        (_nearest(F.col("l_discount") * 100) * 60).alias("discount_cents"),
    )


SOURCES = {
    "customers": customers,
    "products": products,
    "orders": orders,
    "order_items": order_items,
}


def read_trade(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    names = ("region", "nation", "customer", "part", "orders", "lineitem")
    return {name: spark.read.parquet(os.path.join(folder, f"{name}.parquet")) for name in names}


def source_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    trade = read_trade(spark, folder)
    return {name: derive(trade) for name, derive in SOURCES.items()}


def raw_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The derived tables as if one load had landed them."""
    tables = source_tables(spark, folder)
    return {name: with_lineage(table, LANDED_BY) for name, table in tables.items()}
