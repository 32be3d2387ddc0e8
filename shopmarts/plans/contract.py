"""What the models promise: 56 column checks, and the rules that hold between marts.

A check is only worth something if it can fail, so the tests run each of these over tables that were
broken on purpose.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopmarts.functions.time import load_second
from shopmarts.operators import checks
from shopmarts.plans.marts import Marts
from shopmarts.schemas import (
    CUSTOMER_SEGMENTS,
    LOAD_ID,
    ORDER_STATUSES,
    PRODUCT_CATEGORIES,
    SALES_CHANNELS,
)

# The declared checks, by model.
UNIQUE = {
    "stg_webshop__customers": ["customer_id", "email"],
    "stg_webshop__products": ["product_id", "sku"],
    "stg_webshop__orders": ["order_id"],
    "stg_webshop__order_items": ["order_item_id"],
    "int_orders__items_aggregated": ["order_id"],
    "fct_orders": ["order_id"],
    "fct_order_items": ["order_item_id"],
    "dim_customers": ["customer_id", "email"],
    "dim_products": ["product_id", "sku"],
}
NOT_NULL = {
    "stg_webshop__customers": ["customer_id", "email"],
    "stg_webshop__products": ["product_id", "sku"],
    "stg_webshop__orders": ["order_id", "customer_id", "ordered_at"],
    "stg_webshop__order_items": ["order_item_id", "order_id", "product_id", "quantity"],
    "int_orders__items_aggregated": ["order_id", "net_amount_cents"],
    "fct_orders": [
        "order_id",
        "customer_id",
        "ordered_at",
        "net_amount_eur",
        "realised_net_amount_eur",
    ],
    "fct_order_items": [
        "order_item_id",
        "order_id",
        "product_id",
        "quantity",
        "net_amount_eur",
        "realised_net_amount_eur",
    ],
    "dim_customers": [
        "customer_id",
        "email",
        "lifetime_order_count",
        "lifetime_realised_net_revenue_eur",
    ],
    "dim_products": ["product_id", "sku"],
}
ACCEPTED = {
    "stg_webshop__customers": {"customer_segment": CUSTOMER_SEGMENTS},
    "stg_webshop__products": {"product_category": PRODUCT_CATEGORIES},
    "stg_webshop__orders": {"order_status": ORDER_STATUSES, "sales_channel": SALES_CHANNELS},
    "fct_orders": {"order_status": ORDER_STATUSES, "sales_channel": SALES_CHANNELS},
    "dim_customers": {"customer_segment": CUSTOMER_SEGMENTS},
    "dim_products": {"product_category": PRODUCT_CATEGORIES},
}
RELATIONSHIPS = [
    ("stg_webshop__orders", "customer_id", "stg_webshop__customers", "customer_id"),
    ("stg_webshop__order_items", "order_id", "stg_webshop__orders", "order_id"),
    ("stg_webshop__order_items", "product_id", "stg_webshop__products", "product_id"),
    ("fct_orders", "customer_id", "dim_customers", "customer_id"),
    ("fct_order_items", "order_id", "fct_orders", "order_id"),
]
FRESH_TABLES = ["customers", "products", "orders"]  # lines follow their orders

HALF_A_CENT = Decimal("0.005")
# Wide enough for any order's or customer's total, and narrow enough to leave room for the third
# decimal of the tolerance: next to decimal(38,2) Spark would round it to a whole cent.
COMPARED = "decimal(30,2)"


def unique(models: dict[str, DataFrame]) -> DataFrame:
    """Thirteen columns of nine models; every model is read once."""
    return checks.unique(UNIQUE, models)


def not_null(models: dict[str, DataFrame]) -> DataFrame:
    return checks.stack(
        checks.scan(model, models[model], not_null=columns) for model, columns in NOT_NULL.items()
    )


def accepted_values(models: dict[str, DataFrame]) -> DataFrame:
    return checks.stack(
        checks.scan(model, models[model], accepted=columns) for model, columns in ACCEPTED.items()
    )


def relationships(models: dict[str, DataFrame]) -> DataFrame:
    return checks.stack(
        checks.relationship(child, models[child], column, models[parent], key)
        for child, column, parent, key in RELATIONSHIPS
    )


def scans(models: dict[str, DataFrame]) -> DataFrame:
    """The not-null and accepted-value checks together, one scan per model."""
    return checks.stack(
        checks.scan(model, models[model], columns, ACCEPTED.get(model))
        for model, columns in NOT_NULL.items()
    )


def column_checks(models: dict[str, DataFrame]) -> DataFrame:
    """All 56."""
    return checks.stack([scans(models), unique(models), relationships(models)])


def _compared(name: str, key: str, left: str, right: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check_name"),
        F.col(key).cast("string").alias("row_key"),
        F.col(left).cast(COMPARED).alias("left_value"),
        F.coalesce(right, F.lit(0)).cast(COMPARED).alias("right_value"),
    )


def reconciled(marts: Marts) -> DataFrame:
    """Every pair of figures that two marts compute independently and must agree on.

    The lines are summed per order once, for booked and realised alike. Left joins keep an order
    whose lines are missing, so that it fails.
    """
    per_order = marts.order_items.groupBy("order_id").agg(
        F.sum("net_amount_eur").alias("line_booked"),
        F.sum("realised_net_amount_eur").alias("line_realised"),
    )
    of_orders = F.array(
        _compared(
            "fct_orders vs fct_order_items (booked)",
            "order_id",
            "net_amount_eur",
            F.col("line_booked"),
        ),
        _compared(
            "fct_orders vs fct_order_items (realised)",
            "order_id",
            "realised_net_amount_eur",
            F.col("line_realised"),
        ),
    )
    per_customer = marts.orders.groupBy("customer_id").agg(
        F.sum("realised_net_amount_eur").alias("order_realised")
    )
    of_customers = F.array(
        _compared(
            "dim_customers vs fct_orders (realised)",
            "customer_id",
            "lifetime_realised_net_revenue_eur",
            F.col("order_realised"),
        )
    )
    pairs = checks.stack(
        [
            marts.orders.join(per_order, "order_id", "left").select(F.inline(of_orders)),
            marts.customers.join(per_customer, "customer_id", "left").select(
                F.inline(of_customers)
            ),
        ]
    )
    difference = F.col("left_value") - F.col("right_value")
    return pairs.withColumn("difference", difference.cast(COMPARED))


def unreconciled(marts: Marts) -> DataFrame:
    """The pairs more than half a cent apart."""
    return reconciled(marts).where(F.abs("difference") > F.lit(HALF_A_CENT))


def reconcile(marts: Marts) -> DataFrame:
    apart = F.abs("difference") > F.lit(HALF_A_CENT)
    return (
        reconciled(marts)
        .groupBy("check_name")
        .agg(F.count("*").alias("rows_checked"), F.count_if(apart).alias("failures"))
    )


def _realised_rows(marts: Marts) -> DataFrame:
    def rows(model: str, table: DataFrame, key: str) -> DataFrame:
        return table.select(
            F.lit(model).alias("model"),
            F.col(key).cast("string").alias("row_key"),
            "net_amount_eur",
            "realised_net_amount_eur",
            "is_cancelled",
        )

    return checks.stack(
        [
            rows("fct_orders", marts.orders, "order_id"),
            rows("fct_order_items", marts.order_items, "order_item_id"),
        ]
    )


def _breaks_realised_rule() -> Column:
    expected = F.when(F.col("is_cancelled"), F.lit(0)).otherwise(F.col("net_amount_eur"))
    return F.col("realised_net_amount_eur") != expected


def misrealised(marts: Marts) -> DataFrame:
    """Fact rows whose realised money is neither the net amount nor a cancellation's zero."""
    return _realised_rows(marts).where(_breaks_realised_rule())


def realised(marts: Marts) -> DataFrame:
    return (
        _realised_rows(marts)
        .groupBy(F.concat(F.lit("realised "), "model").alias("check_name"))
        .agg(
            F.count("*").alias("rows_checked"),
            F.count_if(_breaks_realised_rule()).alias("failures"),
        )
    )


def money_is_exact(marts: Marts) -> DataFrame:
    return checks.stack(checks.inexact_money(model, table) for model, table in marts.named().items())


def freshness(raw: dict[str, DataFrame], now_second: int) -> DataFrame:
    return checks.freshness(
        {name: raw[name] for name in FRESH_TABLES}, load_second(F.col(LOAD_ID)), now_second
    )
