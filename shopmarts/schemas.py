"""Source tables: column types, keys, cursors and enum values."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

LONG, INT, TEXT, BOOL, TIME = (
    T.LongType(),
    T.IntegerType(),
    T.StringType(),
    T.BooleanType(),
    T.TimestampNTZType(),
)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


@dataclass(frozen=True)
class TableSpec:
    """A source table: what identifies a row and which column says that it is new.

    ``bucket_width`` is the span of key values stored together in the raw layer. Keys are handed
    out in rising order, so recent changes touch the few newest buckets, and a bucket of an integer
    key can never hold more than ``bucket_width`` rows however large the table grows. Within a bucket
    files are sorted by key and hold at most ``file_rows`` rows, so that a change of scattered old keys
    rewrites files and not buckets.
    """

    name: str
    key: str
    cursor: str
    schema: T.StructType
    bucket_width: int = 5_000_000
    file_rows: int = 500_000


CUSTOMERS = TableSpec(
    "customers",
    key="id",
    cursor="updated_at",
    schema=_struct(
        id=LONG,
        first_name=TEXT,
        last_name=TEXT,
        email=TEXT,
        phone=TEXT,
        city=TEXT,
        country=TEXT,
        segment=TEXT,
        is_marketing_opt_in=BOOL,
        created_at=TIME,
        updated_at=TIME,
    ),
)

PRODUCTS = TableSpec(
    "products",
    key="id",
    cursor="updated_at",
    schema=_struct(
        id=LONG,
        sku=TEXT,
        origin=TEXT,
        roast=TEXT,
        category=TEXT,
        weight_grams=INT,
        unit_price_cents=LONG,
        cost_cents=LONG,
        is_active=BOOL,
        created_at=TIME,
        updated_at=TIME,
    ),
)

ORDERS = TableSpec(
    "orders",
    key="id",
    cursor="updated_at",
    schema=_struct(
        id=LONG,
        customer_id=LONG,
        status=TEXT,
        channel=TEXT,
        ordered_at=TIME,
        shipped_at=TIME,
        delivered_at=TIME,
        shipping_city=TEXT,
        shipping_country=TEXT,
        created_at=TIME,
        updated_at=TIME,
    ),
)

# Lines are only ever appended, so their rising key is the cursor.
ORDER_ITEMS = TableSpec(
    "order_items",
    key="id",
    cursor="id",
    schema=_struct(
        id=LONG,
        order_id=LONG,
        product_id=LONG,
        quantity=INT,
        unit_price_cents=LONG,
        discount_cents=LONG,
    ),
)

TABLES = {spec.name: spec for spec in (CUSTOMERS, PRODUCTS, ORDERS, ORDER_ITEMS)}

# The source's enums.
CUSTOMER_SEGMENTS = ["consumer", "business"]
ORDER_STATUSES = ["pending", "paid", "shipped", "delivered", "cancelled"]
SALES_CHANNELS = ["web", "mobile_app", "marketplace", "store"]
PRODUCT_CATEGORIES = ["beans", "ground", "capsules", "equipment"]
ROAST_LEVELS = ["light", "medium", "dark"]
COFFEE_ORIGINS = [
    "ethiopia",
    "colombia",
    "brazil",
    "kenya",
    "guatemala",
    "honduras",
    "peru",
    "rwanda",
]

# Lineage columns every landed row carries: the load that brought it, and the row's own id.
LOAD_ID = "_dlt_load_id"
ROW_ID = "_dlt_id"
