"""Synthetic source tables that look like a business, made row by row on the executors.

Every column is a function of the row's id, so nothing is shuffled and any number of rows can be
made; order lines are unfolded from their order. The same seed and date give the same rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tests import draws
from shopmarts.schemas import COFFEE_ORIGINS

# The source's column hints.
SEGMENT_WEIGHTS = {"consumer": 8, "business": 1}
ROAST_WEIGHTS = {"medium": 3, "light": 2, "dark": 2}
CATEGORY_WEIGHTS = {"beans": 6, "ground": 3, "capsules": 2, "equipment": 1}
STATUS_WEIGHTS = {"delivered": 14, "shipped": 3, "paid": 2, "pending": 1, "cancelled": 1}
CHANNEL_WEIGHTS = {"web": 6, "mobile_app": 3, "marketplace": 2, "store": 1}
PHONE_NULL_RATE, SHIPPED_NULL_RATE, DELIVERED_NULL_RATE = 0.3, 0.2, 0.3
OPT_IN_RATE, ACTIVE_RATE = 0.45, 0.85
CUSTOMER_SKEW, ORDER_SKEW, PRODUCT_SKEW = 0.7, 0.3, 0.6

# Our own words; the hints ask for a locale only.
FIRST_NAMES = ["Anna", "Bram", "Elise", "Femke", "Jonas", "Lotte", "Milan", "Noor", "Stijn", "Wout"]
LAST_NAMES = ["Aerts", "Claes", "De Smet", "Jacobs", "Maes", "Mertens", "Peeters", "Wouters"]
CITIES = ["Antwerpen", "Brugge", "Brussel", "Gent", "Hasselt", "Kortrijk", "Leuven", "Mechelen"]
COUNTRY = "Belgium"

SECONDS_PER_DAY = 86_400
MEAN_DELAY_DAYS = 2.0


@dataclass(frozen=True)
class Shop:
    """The knobs. Rows of a table are numbered from 1."""

    seed: int = 42
    as_of: date = date(2026, 9, 1)
    growth: float = 0.6
    seasonality: float = 0.4
    default_rows: int = 100
    rows: dict[str, int] = field(
        default_factory=lambda: {
            "customers": 600,
            "products": 48,
            "orders": 4000,
            "order_items": 9000,
        }
    )

    def count(self, table: str) -> int:
        return self.rows.get(table, self.default_rows)


def ids(spark: SparkSession, rows: int) -> DataFrame:
    return spark.range(1, rows + 1)


class _Row:
    """Named draws of the current row."""

    def __init__(self, table: str) -> None:
        self.table = table

    def __getitem__(self, name: str) -> Column:
        return draws.uniform(F.col("_base"), f"{self.table}.{name}")

    def price(self, name: str, low: int, high: int, median: float) -> Column:
        """Whole cents, lognormal with spread 0.4, within the bounds."""
        value = draws.lognormal(self[name], self[f"{name}.angle"], median, 0.4)
        return draws.clipped(value, low, high)


def _numbered(shop: Shop, table_ids: DataFrame) -> DataFrame:
    return table_ids.select("id", draws.base(F.col("id"), shop.seed).alias("_base"))


def _at(start: date, seconds: Column) -> Column:
    """``seconds`` after midnight of ``start``, without a time zone."""
    day = F.date_add(F.lit(start), F.floor(seconds / SECONDS_PER_DAY).cast("int"))
    second = F.pmod(seconds, F.lit(SECONDS_PER_DAY)).cast("decimal(16,6)")
    clock = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), second)
    return day.cast("timestamp_ntz") + clock


def months(shop: Shop) -> list[tuple[date, int, float]]:
    """The twelve months before the anchor: first day, days, weight. Sales grow and peak in November."""
    result = []
    for back in range(12, 0, -1):
        serial = shop.as_of.year * 12 + shop.as_of.month - 1 - back
        first = date(serial // 12, serial % 12 + 1, 1)
        following = date((serial + 1) // 12, (serial + 1) % 12 + 1, 1)
        trend = 1.0 + shop.growth * (12 - back) / 11.0
        season = 1.0 + shop.seasonality * math.cos(2.0 * math.pi * (first.month - 11) / 12.0)
        result.append((first, (following - first).days, trend * season))
    return result


def _order_seconds(shop: Shop, row: _Row) -> Column:
    """Order time in seconds after the first month began: by month weight, few on weekends, by day."""
    window = months(shop)
    origin, chosen = window[0][0], row["month"]
    ends = draws.cuts([weight for _, _, weight in window])
    day = F.when(F.lit(False), F.lit(0))
    for (first, days, _), end in zip(window, [*ends[:-1], 1.0], strict=True):
        day = day.when(chosen < end, F.floor(row["day"] * float(days)) + (first - origin).days)
    # Half of the weekend orders move two days up, from Saturday and Sunday to Thursday and Friday.
    weekday = F.pmod(day + origin.weekday(), F.lit(7))
    moved = (weekday >= 5) & (row["weekend"] < 0.5) & (day >= 2)
    day = day - F.when(moved, 2).otherwise(0)
    hour = F.floor((row["hour"] + row["hour.late"]) * 8.0) + 7  # 7 to 22, most around 15
    second = F.floor(row["second"] * 3600.0)
    return (day * SECONDS_PER_DAY + hour * 3600 + second).cast("bigint")


def _registered(shop: Shop, row: _Row) -> Column:
    """Some time in the three years before the first order month."""
    return -draws.whole(row["created_at"], 1, 3 * 365 * SECONDS_PER_DAY)


def customers(shop: Shop, table_ids: DataFrame) -> DataFrame:
    row, start = _Row("customers"), months(shop)[0][0]
    created = _registered(shop, row)
    changed = created + draws.whole(row["updated_at"], 0, 365 * SECONDS_PER_DAY)
    first = draws.pick(row["first_name"], FIRST_NAMES)
    last = draws.pick(row["last_name"], LAST_NAMES)
    number = F.lpad(draws.whole(row["phone"], 0, 99_999_999).cast("string"), 8, "0")
    has_phone = ~draws.chance(row["phone.null"], PHONE_NULL_RATE)
    return _numbered(shop, table_ids).select(
        "id",
        first.alias("first_name"),
        last.alias("last_name"),
        F.concat(F.lower(first), F.lit("."), F.col("id").cast("string"), F.lit("@example.be")).alias(
            "email"
        ),
        F.when(has_phone, F.concat(F.lit("+324"), number)).alias("phone"),
        draws.pick(row["city"], CITIES).alias("city"),
        F.lit(COUNTRY).alias("country"),
        draws.weighted(row["segment"], SEGMENT_WEIGHTS).alias("segment"),
        draws.chance(row["is_marketing_opt_in"], OPT_IN_RATE).alias("is_marketing_opt_in"),
        _at(start, created).alias("created_at"),
        _at(start, changed).alias("updated_at"),
    )


def products(shop: Shop, table_ids: DataFrame) -> DataFrame:
    row, start = _Row("products"), months(shop)[0][0]
    created = _registered(shop, row)
    return _numbered(shop, table_ids).select(
        "id",
        _ean13(F.col("id")).alias("sku"),
        draws.pick(row["origin"], COFFEE_ORIGINS).alias("origin"),
        draws.weighted(row["roast"], ROAST_WEIGHTS).alias("roast"),
        draws.weighted(row["category"], CATEGORY_WEIGHTS).alias("category"),
        draws.whole(row["weight_grams"], 250, 1000).cast("int").alias("weight_grams"),
        row.price("unit_price_cents", 899, 4999, 1450.0).alias("unit_price_cents"),
        row.price("cost_cents", 300, 2200, 650.0).alias("cost_cents"),
        draws.chance(row["is_active"], ACTIVE_RATE).alias("is_active"),
        _at(start, created).alias("created_at"),
        _at(start, created).alias("updated_at"),
    )


def _ean13(number: Column) -> Column:
    """A Belgian barcode (prefix 54) with its check digit. It has room for ten digits; more are an error."""
    fits = F.when(number < 10**10, number.cast("string")).otherwise(
        F.raise_error(F.lit("a barcode has no room for this id")).cast("string")
    )
    body = F.concat(F.lit("54"), F.lpad(fits, 10, "0"))
    weights = [1, 3] * 6
    parts = [F.substring(body, i + 1, 1).cast("int") * weight for i, weight in enumerate(weights)]
    check = F.pmod(F.lit(10) - F.pmod(sum(parts[1:], parts[0]), F.lit(10)), F.lit(10))
    return F.concat(body, check.cast("string"))


def orders(shop: Shop, table_ids: DataFrame) -> DataFrame:
    row, start = _Row("orders"), months(shop)[0][0]
    buyers = shop.count("customers")
    buyer = draws.shuffled(draws.skewed_rank(row["customer_id"], buyers, CUSTOMER_SKEW), buyers) + 1

    def delay(name: str) -> Column:
        return F.ceil(draws.exponential(row[name], MEAN_DELAY_DAYS) * float(SECONDS_PER_DAY))

    is_shipped = ~draws.chance(row["shipped_at.null"], SHIPPED_NULL_RATE)
    is_delivered = ~draws.chance(row["delivered_at.null"], DELIVERED_NULL_RATE)
    timed = _numbered(shop, table_ids).withColumn("_ordered", _order_seconds(shop, row))
    timed = timed.withColumn("_shipped", F.when(is_shipped, F.col("_ordered") + delay("shipped_at")))
    timed = timed.withColumn(
        "_delivered", F.when(is_delivered, F.col("_shipped") + delay("delivered_at"))
    )
    return timed.select(
        "id",
        buyer.alias("customer_id"),
        draws.weighted(row["status"], STATUS_WEIGHTS).alias("status"),
        draws.weighted(row["channel"], CHANNEL_WEIGHTS).alias("channel"),
        _at(start, F.col("_ordered")).alias("ordered_at"),
        _at(start, F.col("_shipped")).alias("shipped_at"),
        _at(start, F.col("_delivered")).alias("delivered_at"),
        draws.pick(row["shipping_city"], CITIES).alias("shipping_city"),
        F.lit(COUNTRY).alias("shipping_country"),
        _at(start, F.col("_ordered")).alias("created_at"),
        _at(start, F.coalesce("_delivered", "_shipped", "_ordered")).alias("updated_at"),
    )


def orders_with_lines(shop: Shop) -> int:
    """Lines that picked their order blindly would leave ``e^-(lines/orders)`` of the orders empty."""
    total, lines = shop.count("orders"), shop.count("order_items")
    return max(1, min(lines, total - round(total * math.exp(-lines / total))))


def order_items(shop: Shop, order_ids: DataFrame) -> DataFrame:
    """Exactly the asked number of lines, unfolded from the orders.

    Orders are ranked in shuffled order. The rank's share of a power law says where its lines begin
    and end in ``1 .. lines``, so line ids are dense and unique without counting anything. The lines
    of an order take products from different residue classes, so no product repeats within it.
    """
    row, lines, goods = _Row("order_items"), shop.count("order_items"), shop.count("products")
    total, filled = shop.count("orders"), orders_with_lines(shop)

    def before(rank: Column) -> Column:
        share = F.pow(rank / F.lit(float(filled)), F.lit(1.0 - ORDER_SKEW))
        return F.floor(share * float(lines)).cast("bigint")

    widest = math.floor(lines * (1.0 / filled) ** (1.0 - ORDER_SKEW)) + 1
    if widest > goods:
        raise ValueError(f"an order would have up to {widest} lines but there are {goods} products")
    rank = draws.shuffled(F.col("id") - 1, total)
    opened = draws.skewed_rank(row["class"], widest, PRODUCT_SKEW)
    bounds = (
        _numbered(shop, order_ids)
        .select(F.col("id").alias("order_id"), rank.alias("_rank"), opened.alias("_opened"))
        .where(F.col("_rank") < filled)
        .withColumns({"_from": before(F.col("_rank")), "_to": before(F.col("_rank") + 1)})
        .where("_to > _from")
    )
    unfolded = bounds.withColumn("id", F.explode(F.sequence(F.col("_from") + 1, F.col("_to"))))
    placed = unfolded.select(
        "id",
        "order_id",
        draws.base(F.col("id"), shop.seed).alias("_base"),
        F.pmod(F.col("_opened") + F.col("id") - F.col("_from") - 1, F.lit(widest)).alias("_class"),
    )
    in_class = F.floor((F.lit(goods - 1) - F.col("_class")) / F.lit(widest)) + 1
    rank_in_class = F.least(
        F.floor(F.pow(row["product_id"], F.lit(1.0 / (1.0 - PRODUCT_SKEW))) * in_class), in_class - 1
    )
    return placed.select(
        "id",
        "order_id",
        (rank_in_class * widest + F.col("_class") + 1).cast("bigint").alias("product_id"),
        draws.clipped(draws.exponential(row["quantity"], 1.6), 1, 6).cast("int").alias("quantity"),
        row.price("unit_price_cents", 899, 4999, 1450.0).alias("unit_price_cents"),
        draws.clipped(draws.exponential(row["discount_cents"], 60.0), 0, 600).alias("discount_cents"),
    )


def source_tables(spark: SparkSession, shop: Shop | None = None) -> dict[str, DataFrame]:
    """All four tables of a shop."""
    shop = shop or Shop()
    return {
        "customers": customers(shop, ids(spark, shop.count("customers"))),
        "products": products(shop, ids(spark, shop.count("products"))),
        "orders": orders(shop, ids(spark, shop.count("orders"))),
        "order_items": order_items(shop, ids(spark, shop.count("orders"))),
    }
