"""Marts: two facts, two dimensions. The only layer a report may read.

Revenue has one definition each: *booked* is the order as placed, *realised* is the same money
with cancelled orders at zero. Both are stored per row, so both add up at every grain.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopmarts.functions.money import EURO, cents_to_eur
from shopmarts.functions.text import sentence_case
from shopmarts.functions.time import hour_boundaries
from shopmarts.plans import intermediate, staging

HOURS_PER_DAY = 24.0  # a double: an exact decimal would make days_to_ship a decimal too


@dataclass(frozen=True)
class Marts:
    """The four marts. ``order_key_holds`` says that these are a published build, whose checks have
    found one row per order, so that counting rows counts orders."""

    orders: DataFrame
    order_items: DataFrame
    customers: DataFrame
    products: DataFrame
    order_key_holds: bool = False
    build: str | None = None  # which stored build these are

    def named(self) -> dict[str, DataFrame]:
        return {
            "fct_orders": self.orders,
            "fct_order_items": self.order_items,
            "dim_customers": self.customers,
            "dim_products": self.products,
        }


def _enum(name: str, label: str) -> Column:
    """A raw enum column that names the label column which reports must show in its place."""
    return F.col(name).alias(name, metadata={"display_label": label})


def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def _zero_if_cancelled(amount: Column) -> Column:
    # A NULL status is not a cancellation: its money stays.
    return F.when(F.col("order_status") == "cancelled", F.lit(0).cast(EURO)).otherwise(amount)


def fct_orders(orders: DataFrame, order_money: DataFrame) -> DataFrame:
    """One row per order. An order without lines keeps its row, with zero money."""
    net = cents_to_eur(_or_zero("net_amount_cents"))
    shipped_hours = hour_boundaries(F.col("ordered_at"), F.col("shipped_at"))
    return orders.join(order_money, "order_id", "left").select(
        "order_id",
        "customer_id",
        "ordered_at",
        F.to_date("ordered_at").alias("order_date"),
        _enum("order_status", "order_status_label"),
        _enum("sales_channel", "channel_label"),
        sentence_case(F.col("order_status")).alias("order_status_label"),
        sentence_case(F.col("sales_channel")).alias("channel_label"),
        "shipping_city",
        "shipping_country",
        "shipped_at",
        "delivered_at",
        _or_zero("line_item_count").alias("line_item_count"),
        _or_zero("units").alias("units"),
        cents_to_eur(_or_zero("gross_amount_cents")).alias("gross_amount_eur"),
        cents_to_eur(_or_zero("discount_cents")).alias("discount_eur"),
        net.alias("net_amount_eur"),
        _zero_if_cancelled(net).alias("realised_net_amount_eur"),
        (F.col("order_status") == "cancelled").alias("is_cancelled"),
        (F.col("order_status") == "delivered").alias("is_delivered"),
        # Follows the shipping time alone; NULL hours give NULL days.
        (shipped_hours / F.lit(HOURS_PER_DAY)).alias("days_to_ship"),
    )


def fct_order_items(order_items: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per line of a known order, carrying the order's customer, channel and status."""
    parent = orders.select("order_id", "customer_id", "ordered_at", "order_status", "sales_channel")
    gross = intermediate.gross_cents()
    net = cents_to_eur(gross - F.col("discount_cents"))
    return order_items.join(parent, "order_id").select(
        "order_item_id",
        "order_id",
        "product_id",
        "customer_id",
        "ordered_at",
        _enum("order_status", "order_status_label"),
        _enum("sales_channel", "channel_label"),
        sentence_case(F.col("order_status")).alias("order_status_label"),
        sentence_case(F.col("sales_channel")).alias("channel_label"),
        "quantity",
        cents_to_eur(F.col("unit_price_cents")).alias("unit_price_eur"),
        cents_to_eur(gross).alias("gross_amount_eur"),
        cents_to_eur(F.col("discount_cents")).alias("discount_eur"),
        net.alias("net_amount_eur"),
        _zero_if_cancelled(net).alias("realised_net_amount_eur"),
        (F.col("order_status") == "cancelled").alias("is_cancelled"),
    )


def dim_customers(customers: DataFrame, orders: DataFrame, order_money: DataFrame) -> DataFrame:
    """One row per customer, with lifetime figures over the orders that were not cancelled.

    The join to money is a left one: an order without lines still counts as an order.
    """
    kept = (
        orders.where(F.col("order_status") != "cancelled")
        .select("order_id", "customer_id", "ordered_at")
        .join(order_money.select("order_id", "net_amount_cents"), "order_id", "left")
    )
    return _with_lifetime(customers, kept, cents_to_eur(_or_zero("net_cents")), net_cents="net_amount_cents")


def dim_customers_of(customers: DataFrame, fct_orders: DataFrame) -> DataFrame:
    """``dim_customers`` out of the stored orders, which hold their money: nothing is joined again."""
    kept = fct_orders.where(F.col("order_status") != "cancelled")
    return _with_lifetime(customers, kept, _or_zero("net_eur").cast(EURO), net_eur="net_amount_eur")


def _with_lifetime(customers: DataFrame, kept: DataFrame, revenue: Column, **net: str) -> DataFrame:
    lifetime = kept.groupBy("customer_id").agg(
        F.count("*").alias("order_count"),
        F.min("ordered_at").alias("first_order_at"),
        F.max("ordered_at").alias("last_order_at"),
        *[F.sum(amount).alias(name) for name, amount in net.items()],
    )
    return customers.join(lifetime, "customer_id", "left").select(
        "customer_id",
        F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
        "email",
        "phone",
        "city",
        "country",
        _enum("customer_segment", "segment_label"),
        sentence_case(F.col("customer_segment")).alias("segment_label"),
        "is_marketing_opt_in",
        F.col("created_at").alias("customer_since_at"),
        "first_order_at",
        "last_order_at",
        _or_zero("order_count").alias("lifetime_order_count"),
        revenue.alias("lifetime_realised_net_revenue_eur"),
        F.col("order_count").isNotNull().alias("has_ordered"),
    )


def dim_products(products: DataFrame) -> DataFrame:
    """One row per product, named after its attributes and priced in euros."""
    labelled = products.withColumns(
        {
            "origin_label": sentence_case(F.col("coffee_origin")),
            "roast_label": sentence_case(F.col("roast_level")),
            "category_label": sentence_case(F.col("product_category")),
        }
    )
    name = F.concat(
        "origin_label",
        F.lit(" · "),
        "roast_label",
        F.lit(" roast · "),
        "category_label",
        F.lit(" "),
        F.col("weight_grams").cast("string"),
        F.lit("g"),
    )
    price, cost = F.col("unit_price_cents"), F.col("cost_cents")
    return labelled.select(
        "product_id",
        "sku",
        name.alias("product_name"),
        _enum("coffee_origin", "origin_label"),
        _enum("roast_level", "roast_label"),
        _enum("product_category", "category_label"),
        "origin_label",
        "roast_label",
        "category_label",
        "weight_grams",
        cents_to_eur(price).alias("unit_price_eur"),
        cents_to_eur(cost).alias("unit_cost_eur"),
        cents_to_eur(price - cost).alias("unit_margin_eur"),
        "is_active",
        F.col("created_at").alias("listed_at"),
    )


def stage(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The four staging models over the four raw tables."""
    return {
        "stg_webshop__customers": staging.customers(raw["customers"]),
        "stg_webshop__products": staging.products(raw["products"]),
        "stg_webshop__orders": staging.orders(raw["orders"]),
        "stg_webshop__order_items": staging.order_items(raw["order_items"]),
    }


def marts_of(staged: dict[str, DataFrame], order_money: DataFrame | None = None) -> Marts:
    """The four marts as lazy plans. Pass a stored ``order_money`` to compute it once for two marts."""
    orders, lines = staged["stg_webshop__orders"], staged["stg_webshop__order_items"]
    money = intermediate.order_money(lines) if order_money is None else order_money
    return Marts(
        orders=fct_orders(orders, money),
        order_items=fct_order_items(lines, orders),
        customers=dim_customers(staged["stg_webshop__customers"], orders, money),
        products=dim_products(staged["stg_webshop__products"]),
    )
