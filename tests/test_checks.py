from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shopmarts.operators import checks
from shopmarts.plans import contract
from shopmarts.registry import models_of
from shopmarts.sources.trade_tables import with_lineage

GOOD = {
    "customers": [{"id": 1}, {"id": 2}],
    "products": [{"id": 1}],
    "orders": [{"id": 10}, {"id": 11, "status": "cancelled", "customer_id": 2}, {"id": 12}],
    "order_items": [
        {"id": 1, "order_id": 10, "discount_cents": 50},
        {"id": 2, "order_id": 10},
        {"id": 3, "order_id": 11, "discount_cents": 25},
    ],
}


@pytest.fixture(scope="module")
def good(source):
    return source.marts(**GOOD)


def failing(results):
    return {row.check_name: row.failures for row in results.where("failures > 0").collect()}


def test_all_declared_checks_run_and_pass(source):
    results = contract.column_checks(models_of(source.raw(**GOOD))).collect()
    kinds = [row.check_name.split()[0] for row in results]
    assert {kind: kinds.count(kind) for kind in set(kinds)} == {
        "unique": 13,
        "not_null": 30,
        "accepted_values": 8,
        "relationships": 5,
    }
    assert not [row for row in results if row.failures]


@pytest.mark.parametrize(
    ("table", "row", "expected"),
    [
        ("customers", {"id": 2, "email": "x@y"}, {"unique stg_webshop__customers.customer_id": 1}),
        ("customers", {"id": 3, "email": None}, {"not_null dim_customers.email": 1}),
        (
            "customers",
            {"id": 3, "segment": "vip"},
            {"accepted_values stg_webshop__customers.customer_segment": 1},
        ),
        ("products", {"id": 2, "sku": "0000000000001"}, {"unique dim_products.sku": 1}),
        ("products", {"id": 2, "category": "tea"}, {"accepted_values dim_products.product_category": 1}),
        ("orders", {"id": 13, "customer_id": None}, {"not_null fct_orders.customer_id": 1}),
        ("orders", {"id": 13, "customer_id": 9}, {"relationships fct_orders.customer_id": 1}),
        ("orders", {"id": 13, "channel": "kiosk"}, {"accepted_values fct_orders.sales_channel": 1}),
        ("orders", {"id": 13, "ordered_at": None}, {"not_null stg_webshop__orders.ordered_at": 1}),
        (
            "order_items",
            {"id": 4, "order_id": 99},
            {"relationships stg_webshop__order_items.order_id": 1},
        ),
        (
            "order_items",
            {"id": 4, "order_id": 10, "product_id": 9},
            {"relationships stg_webshop__order_items.product_id": 1},
        ),
        ("order_items", {"id": 4, "order_id": None}, {"not_null int_orders__items_aggregated.order_id": 1}),
    ],
)
def test_every_kind_of_defect_is_found(source, table, row, expected):
    tables = {**GOOD, table: [*GOOD[table], row]}
    found = failing(contract.column_checks(models_of(source.raw(**tables))))
    assert expected.items() <= found.items()


def test_null_passes_accepted_values_and_relationships(source):
    tables = {**GOOD, "orders": [*GOOD["orders"], {"id": 13, "status": None, "customer_id": None}]}
    models = models_of(source.raw(**tables))
    assert not failing(contract.accepted_values(models))
    assert not failing(contract.relationships(models))


def test_an_empty_table_still_reports(source):
    results = contract.column_checks(models_of(source.raw())).collect()
    assert len(results) == 56
    assert {(row.rows_checked, row.failures) for row in results} == {(0, 0)}


def test_a_repeated_parent_does_not_multiply_orphans(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (1,)], "id int")
    row = checks.relationship("m", child, "k", parent, "id").first()
    assert (row.rows_checked, row.failures) == (3, 1)


def test_marts_reconcile_until_the_parentheses_go(good):
    assert contract.unreconciled(good).count() == 0
    wrong = good.order_items.withColumn(
        "net_amount_eur",
        (F.col("gross_amount_eur") * 100 - F.col("discount_eur")).cast("decimal(18,2)"),
    )
    failed = contract.unreconciled(replace(good, order_items=wrong)).collect()
    assert {(row.check_name, row.row_key) for row in failed} == {
        ("fct_orders vs fct_order_items (booked)", "10"),
        ("fct_orders vs fct_order_items (booked)", "11"),
    }
    one = next(row for row in failed if row.row_key == "11")
    assert one.left_value == Decimal("9.75") and one.right_value == Decimal("999.75")


def test_lost_lines_and_lost_orders_fail(good):
    fewer_lines = replace(good, order_items=good.order_items.where("order_id <> 10"))
    assert {row.row_key for row in contract.unreconciled(fewer_lines).collect()} == {"10"}
    fewer_orders = replace(good, orders=good.orders.where("order_id <> 10"))
    failed = contract.unreconciled(fewer_orders).collect()
    assert [row.check_name for row in failed] == ["dim_customers vs fct_orders (realised)"]


def test_a_whole_cent_is_not_tolerated(good):
    nudged = good.customers.withColumn(
        "lifetime_realised_net_revenue_eur",
        F.col("lifetime_realised_net_revenue_eur") + F.lit(Decimal("0.01")),
    )
    assert contract.unreconciled(replace(good, customers=nudged)).count() == 2


def test_realised_rule(good):
    assert contract.misrealised(good).count() == 0
    forgot = replace(
        good, orders=good.orders.withColumn("realised_net_amount_eur", F.col("net_amount_eur"))
    )
    failed = contract.misrealised(forgot).collect()
    assert [(row.model, row.row_key) for row in failed] == [("fct_orders", "11")]
    assert failing(contract.realised(forgot)) == {"realised fct_orders": 1}


def test_floating_money_fails_even_when_the_table_is_empty(good):
    floating = good.products.withColumn("unit_cost_eur", F.col("unit_cost_eur").cast("double"))
    for table in (floating, floating.where("false")):
        rows = contract.money_is_exact(replace(good, products=table)).where("not is_exact").collect()
        assert [(row.table_name, row.column_name, row.data_type) for row in rows] == [
            ("dim_products", "unit_cost_eur", "DOUBLE")
        ]
    assert contract.money_is_exact(good).count() == 13


@pytest.mark.parametrize(
    ("seconds", "status"),
    [
        (35 * 3600, "pass"),
        (36 * 3600, "pass"),
        (36 * 3600 + 1, "warn"),
        (72 * 3600, "warn"),
        (72 * 3600 + 1, "error"),
    ],
)
def test_freshness(source, seconds, status):
    now = 1_788_961_669
    orders = source.table("orders", {"id": 1})
    older = with_lineage(orders, f"{now - 10**6}.9")
    raw = {name: older.unionByName(with_lineage(orders, f"{now - seconds}.5")) for name in contract.FRESH_TABLES}
    assert {row.status for row in contract.freshness(raw, now).collect()} == {status}


def test_a_table_never_loaded_is_stale(source):
    raw = {name: with_lineage(source.table("orders"), "1.5") for name in contract.FRESH_TABLES}
    assert {row.status for row in contract.freshness(raw, 100).collect()} == {"error"}


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_uniqueness_reads_a_table_once_and_shuffles_hashes(spark):
    table = spark.createDataFrame([(i, f"mail {i}") for i in range(9)], "id int, email string")
    counts = checks.hash_counts("m", table, ["id", "email"]).groupBy("check_name", "hash").count()
    plan = plan_of(counts)
    assert plan.count("Scan ") == 1 and "email" not in plan[: plan.index("Exchange")]
    results = checks.unique({"m": ["id", "email"]}, {"m": table})
    assert "Exchange" not in plan_of(results)  # settled by the hashes alone
    assert sorted(map(tuple, results.collect())) == [("unique m.email", 9, 0), ("unique m.id", 9, 0)]


def test_a_repeated_hash_is_settled_by_its_values(spark, monkeypatch):
    """With a hash that falls together often, only values that are equal count."""
    rows = [(i, f"mail {i % 7}", None) for i in range(9)] + [(None, None, None)]
    table = spark.createDataFrame(rows, "id int, email string, nothing string")
    monkeypatch.setattr(checks.F, "xxhash64", lambda column: F.length(F.col(column).cast("string")).cast("long"))
    results = checks.unique({"m": ["id", "email", "nothing"]}, {"m": table})
    assert sorted(map(tuple, results.collect())) == [
        ("unique m.email", 9, 2), ("unique m.id", 9, 0), ("unique m.nothing", 0, 0),
    ]


def test_uniqueness_of_empty_tables(spark):
    table = spark.createDataFrame([], "id int, email string")
    results = checks.unique({"m": ["id", "email"]}, {"m": table})
    assert sorted(map(tuple, results.collect())) == [("unique m.email", 0, 0), ("unique m.id", 0, 0)]
