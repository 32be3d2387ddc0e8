from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from tests import draws
from tests import generate
from tests.generate import Shop
from shopmarts.schemas import TABLES

SHOP = Shop()


@pytest.fixture(scope="module")
def tables(spark):
    return {name: table.cache() for name, table in generate.source_tables(spark, SHOP).items()}


def test_types_match_the_source(tables):
    for name, spec in TABLES.items():
        got = [(f.name, f.dataType) for f in tables[name].schema]
        assert got == [(f.name, f.dataType) for f in spec.schema]


def test_rows_per_table(tables):
    assert {name: table.count() for name, table in tables.items()} == SHOP.rows
    assert Shop(rows={}).count("orders") == 100


def test_required_columns_are_filled(tables):
    optional = {"phone", "shipped_at", "delivered_at"}
    for table in tables.values():
        filled = [c for c in table.columns if c not in optional]
        row = table.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in filled]).first()
        assert set(row) == {0}


def test_keys_and_declared_unique_columns(tables):
    for name, columns in {
        "customers": ["email"],
        "products": ["sku"],
        "orders": ["id"],
        "order_items": ["order_id", "product_id"],
    }.items():
        table = tables[name]
        assert table.select("id").distinct().count() == table.count()
        assert table.select(*columns).distinct().count() == table.count()


def test_no_foreign_key_dangles(tables):
    for child, key, parent in [
        ("orders", "customer_id", "customers"),
        ("order_items", "order_id", "orders"),
        ("order_items", "product_id", "products"),
    ]:
        known = tables[parent].select(F.col("id").alias(key))
        assert tables[child].join(known, key, "left_anti").count() == 0


def test_some_parents_have_no_child(tables):
    empty = tables["orders"].count() - tables["order_items"].select("order_id").distinct().count()
    assert empty == 422  # 4000 / e^2.25
    never = tables["customers"].count() - tables["orders"].select("customer_id").distinct().count()
    assert 0 < never < 120


def test_children_concentrate_on_few_parents(tables):
    def top_tenth(table, key, parents):
        counts = sorted((r[1] for r in table.groupBy(key).count().collect()), reverse=True)
        return sum(counts[: parents // 10]) / sum(counts)

    assert top_tenth(tables["orders"], "customer_id", 600) > 0.4
    assert 0.12 < top_tenth(tables["order_items"], "order_id", 4000) < 0.4
    assert top_tenth(tables["order_items"], "product_id", 48) > 0.2


@pytest.mark.parametrize(
    ("table", "test", "rate"),
    [
        ("customers", "phone is null", 0.3),
        ("customers", "is_marketing_opt_in", 0.45),
        ("customers", "segment = 'business'", 1 / 9),
        ("products", "is_active", 0.85),
        ("orders", "shipped_at is null", 0.2),
        ("orders", "delivered_at is null", 1 - 0.8 * 0.7),
        ("orders", "status = 'cancelled'", 1 / 21),
        ("orders", "status = 'delivered'", 14 / 21),
        ("orders", "channel = 'mobile_app'", 3 / 12),
    ],
)
def test_rates(tables, table, test, rate):
    share = tables[table].agg(F.avg(F.expr(f"int({test})"))).first()[0]
    rows = SHOP.rows[table]
    assert abs(share - rate) < 4 * (rate * (1 - rate) / rows) ** 0.5


def test_distributions_stay_in_bounds(tables):
    row = (
        tables["order_items"]
        .selectExpr(
            "min(quantity)",
            "max(quantity)",
            "min(unit_price_cents)",
            "max(unit_price_cents)",
            "min(discount_cents)",
            "max(discount_cents)",
            "percentile(unit_price_cents, 0.5)",
            "avg(discount_cents)",
        )
        .first()
    )
    assert tuple(row[:4]) == (1, 6, 899, 4999)
    assert row[4] == 0 and 400 < row[5] <= 600
    assert abs(row[6] - 1450) < 30 and abs(row[7] - 60) < 3


def test_orders_grow_peak_late_in_the_year_and_keep_business_hours(tables):
    orders = tables["orders"]
    span = orders.selectExpr("min(ordered_at)", "max(ordered_at)").first()
    assert span[0].date() >= date(2025, 9, 1) and span[1].date() < SHOP.as_of
    months = {
        r[0]: r[1] for r in orders.groupBy(F.date_format("ordered_at", "yyyy-MM")).count().collect()
    }
    assert len(months) == 12
    assert months["2025-12"] > 1.5 * months["2026-05"]
    assert months["2026-08"] > months["2025-09"]
    hours = orders.select(F.hour("ordered_at").alias("h")).agg(F.min("h"), F.max("h")).first()
    assert hours[0] >= 7 and hours[1] <= 22
    weekend = orders.where(F.weekday("ordered_at") >= 5).count() / orders.count()
    assert weekend < 0.2


def test_later_events_come_later(tables):
    wrong = "shipped_at <= ordered_at or delivered_at <= shipped_at or updated_at < ordered_at"
    assert tables["orders"].where(wrong).count() == 0


def test_barcodes_check(tables):
    for row in tables["products"].collect():
        digits = [int(d) for d in row.sku]
        assert len(digits) == 13
        assert sum(d * (3 if i % 2 else 1) for i, d in enumerate(digits)) % 10 == 0


def test_rows_do_not_depend_on_the_partitioning(spark, tables):
    for name in ("customers", "products", "orders", "order_items"):
        parent = "orders" if name == "order_items" else name
        ids = generate.ids(spark, SHOP.count(parent))
        make = getattr(generate, name)
        wanted = sorted(tables[name].collect())
        for parts in (3, 7):
            assert sorted(make(SHOP, ids.repartition(parts)).collect()) == wanted


def test_another_seed_gives_other_rows(spark, tables):
    other = generate.customers(replace(SHOP, seed=43), generate.ids(spark, 600))
    assert other.exceptAll(tables["customers"]).count() > 590


def test_too_few_products_is_an_error(spark):
    shop = Shop(rows={"customers": 10, "products": 3, "orders": 50, "order_items": 400})
    with pytest.raises(ValueError, match="3 products"):
        generate.order_items(shop, generate.ids(spark, 50))


@pytest.mark.parametrize(("orders", "lines"), [(1, 1), (7, 3), (500, 1300), (97, 97)])
def test_line_ids_are_dense_at_any_size(spark, orders, lines):
    shop = Shop(rows={"customers": 5, "products": 200, "orders": orders, "order_items": lines})
    made = generate.order_items(shop, generate.ids(spark, orders)).collect()
    assert sorted(row.id for row in made) == list(range(1, lines + 1))
    assert len({(row.order_id, row.product_id) for row in made}) == lines
    assert {row.product_id for row in made} <= set(range(1, 201))


def test_draws_are_uniform_and_independent(spark):
    draw = spark.range(200_000).select(
        draws.uniform(draws.base(F.col("id"), 42), "a").alias("a"),
        draws.uniform(draws.base(F.col("id"), 42), "b").alias("b"),
        draws.uniform(draws.base(F.col("id") + (1 << 32), 42), "a").alias("c"),
    )
    row = draw.selectExpr(
        "avg(a)", "var_pop(a)", "corr(a, b)", "corr(a, c)", "min(a)", "max(a)"
    ).first()
    assert abs(row[0] - 0.5) < 0.003 and abs(row[1] - 1 / 12) < 0.001
    assert abs(row[2]) < 0.01 and abs(row[3]) < 0.01
    assert 0 < row[4] < row[5] < 1
    bins = [r[1] for r in draw.groupBy(F.floor(F.col("a") * 100)).count().collect()]
    chi = sum((n - 2000) ** 2 / 2000 for n in bins)
    assert len(bins) == 100 and chi < 160
