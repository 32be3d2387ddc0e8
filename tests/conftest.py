from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import DataFrame, SparkSession

from shopmarts.plans.marts import Marts, marts_of, stage
from shopmarts.schemas import TABLES
from shopmarts.session import local_session
from shopmarts.sources.trade_tables import with_lineage

LOAD = "1788961669.673802"


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    session = local_session(4, shuffle_partitions=4, memory="6g")
    yield session
    session.stop()


def at(text: str | None) -> datetime | None:
    return None if text is None else datetime.fromisoformat(text)


class Source:
    """Builds source tables from the few columns a test cares about."""

    DEFAULTS = {
        "customers": {
            "first_name": "Mia",
            "last_name": "Janssens",
            "phone": None,
            "city": "Gent",
            "country": "Belgium",
            "segment": "consumer",
            "is_marketing_opt_in": True,
            "created_at": at("2026-01-01 09:00"),
            "updated_at": at("2026-01-01 09:00"),
        },
        "products": {
            "origin": "ethiopia",
            "roast": "light",
            "category": "beans",
            "weight_grams": 250,
            "unit_price_cents": 1450,
            "cost_cents": 650,
            "is_active": True,
            "created_at": at("2026-01-01"),
            "updated_at": at("2026-01-01"),
        },
        "orders": {
            "customer_id": 1,
            "status": "delivered",
            "channel": "web",
            "ordered_at": at("2026-03-01 10:00"),
            "shipped_at": None,
            "delivered_at": None,
            "shipping_city": "Gent",
            "shipping_country": "Belgium",
            "created_at": at("2026-03-01 10:00"),
            "updated_at": at("2026-03-01 10:00"),
        },
        "order_items": {
            "product_id": 1,
            "quantity": 1,
            "unit_price_cents": 1000,
            "discount_cents": 0,
        },
    }

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark

    def table(self, name: str, *rows: dict) -> DataFrame:
        schema = TABLES[name].schema
        full = []
        for row in rows:
            values = {**self.DEFAULTS[name], **row}
            if name == "customers":
                values.setdefault("email", f"C{values['id']}@Example.be")
            if name == "products":
                values.setdefault("sku", f"{values['id']:013d}")
            full.append(tuple(values[field] for field in schema.names))
        return self.spark.createDataFrame(full, schema)

    def raw(self, **tables: list[dict]) -> dict[str, DataFrame]:
        return {
            name: with_lineage(self.table(name, *tables.get(name, [])), LOAD) for name in TABLES
        }

    def marts(self, **tables: list[dict]) -> Marts:
        return marts_of(stage(self.raw(**tables)))


@pytest.fixture(scope="session")
def source(spark: SparkSession) -> Source:
    return Source(spark)
