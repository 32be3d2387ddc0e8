"""Staging: one model per source table, rename and clean only, no joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmarts.schemas import LOAD_ID


# The names and the order of the columns of each model.


def customers(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("customer_id"),
        "first_name",
        "last_name",
        F.lower("email").alias("email"),
        "phone",
        "city",
        "country",
        F.col("segment").alias("customer_segment"),
        "is_marketing_opt_in",
        "created_at",
        "updated_at",
        F.col(LOAD_ID).alias("dlt_load_id"),
    )


def products(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("product_id"),
        "sku",
        F.col("origin").alias("coffee_origin"),
        F.col("roast").alias("roast_level"),
        F.col("category").alias("product_category"),
        "weight_grams",
        "unit_price_cents",
        "cost_cents",
        "is_active",
        "created_at",
        "updated_at",
        F.col(LOAD_ID).alias("dlt_load_id"),
    )


def orders(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("order_id"),
        "customer_id",
        F.col("status").alias("order_status"),
        F.col("channel").alias("sales_channel"),
        "ordered_at",
        "shipped_at",
        "delivered_at",
        "shipping_city",
        "shipping_country",
        "created_at",
        "updated_at",
        F.col(LOAD_ID).alias("dlt_load_id"),
    )


def order_items(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("order_item_id"),
        "order_id",
        "product_id",
        "quantity",
        "unit_price_cents",
        "discount_cents",
        F.col(LOAD_ID).alias("dlt_load_id"),
    )
