"""One run: stage, model, store, check, and export, from raw tables to report results."""

from __future__ import annotations

import os
import warnings
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, Row, SparkSession

from shopmarts.operators import checks
from shopmarts.plans import contract
from shopmarts.plans.intermediate import order_money
from shopmarts.plans.marts import Marts, dim_customers_of, marts_of, stage
from shopmarts.plans.reports import REPORTS, product_totals
from shopmarts.session import STORED, together
from shopmarts.sources.exposure import require_exposed
from shopmarts.sources.layout import Layout, new_name, open_marts, publish, publish_export

MONEY = "int_orders__items_aggregated"


class ChecksFailed(RuntimeError):
    """The tables were built but break their contract."""


def _store(table: DataFrame, path: str) -> None:
    """Write a table as its last stage left it: adaptive execution has already joined small
    partitions and split skewed ones, so one more shuffle would only cost."""
    table.write.options(**STORED).mode("overwrite").parquet(path)


def build(spark: SparkSession, raw: dict[str, DataFrame], layout: Layout) -> Marts:
    """Build the marts of a target in full, beside the builds there are; ``verify`` publishes them.

    Staging stays a set of views, named by target. Order money is stored, because two marts read it and a plan can
    share a shuffle only within one query. Customers are summed from the stored orders.
    """
    name = new_name()
    staged = stage(raw)
    for model, table in staged.items():
        table.createOrReplaceTempView(layout.view(model))
    lines = staged["stg_webshop__order_items"]
    _store(order_money(lines), layout.stored(MONEY, name))
    money = spark.read.parquet(layout.stored(MONEY, name))
    money.createOrReplaceTempView(layout.view(MONEY))
    marts = marts_of(staged, money).named()
    paths = {model: layout.stored(model, name) for model in marts}

    def orders_and_customers() -> None:
        _store(marts["fct_orders"], paths["fct_orders"])
        orders = spark.read.parquet(paths["fct_orders"])
        customers = dim_customers_of(staged["stg_webshop__customers"], orders)
        _store(customers, paths["dim_customers"])

    jobs = {model: partial(_store, marts[model], paths[model]) for model in ("fct_order_items", "dim_products")}
    together(spark, {**jobs, "fct_orders": orders_and_customers})
    return open_marts(spark, layout, name)


def models(
    spark: SparkSession, raw: dict[str, DataFrame], layout: Layout, build: str
) -> dict[str, DataFrame]:
    """Every model of a build: staging lazily, the rest as stored."""
    stored = open_marts(spark, layout, build).named()
    return {**stage(raw), MONEY: spark.read.parquet(layout.stored(MONEY, build)), **stored}


def verify(
    spark: SparkSession, raw: dict[str, DataFrame], layout: Layout, build: str, now_second: int
) -> DataFrame:
    """Run every check over a build. Publish it when all pass; else raise, and readers keep the former
    build. A source whose last load is too long before ``now_second`` fails the run as well; one that is
    getting old is a warning."""
    marts, built = open_marts(spark, layout, build), models(spark, raw, layout, build)
    exact = contract.money_is_exact(marts).selectExpr(
        "concat('exact ', table_name, '.', column_name) as check_name",
        "rows_checked",
        # The type is wrong also where no row shows it.
        "if(is_exact, 0, greatest(failures, 1)) as failures",
    )
    results: dict[str, Callable[[], DataFrame]] = {
        "scans": partial(contract.scans, built),
        "unique": partial(contract.unique, built),
        "relationships": partial(contract.relationships, built),
        "reconcile": partial(contract.reconcile, marts),
        "realised": partial(contract.realised, marts),
        "exact": lambda: exact,
        "fresh": partial(contract.freshness, raw, now_second),
    }
    # One short row per declared check comes back, however large the tables.
    found = together(spark, {name: lambda make=make: make().collect() for name, make in results.items()}, width=1)
    aged = found.pop("fresh")
    for row in aged:
        if row.status == "warn":
            warnings.warn(f"{row.table_name} was loaded {row.age_seconds // 3600} hours ago", stacklevel=2)
    rows = [row for group in found.values() for row in group]
    rows += [
        Row(check_name=f"fresh {row.table_name}", rows_checked=1, failures=int(row.status == "error"))
        for row in aged
    ]
    failed = [f"{row.check_name}: {row.failures}" for row in rows if row.failures]
    if failed:
        raise ChecksFailed("; ".join(failed))
    publish(spark, layout, build)
    return spark.createDataFrame(rows, checks.RESULT)


def export(
    spark: SparkSession, layout: Layout, reports: dict[str, Callable[[Marts], DataFrame]] = REPORTS
) -> dict[str, str]:
    """Write the extract of every mart and the result of every report, from the published build.

    Parts are written to a folder of their own, and one record publishes them together: a report that
    fails leaves the former set readable, and no reader sees two builds. A report that reads anything
    but marts is refused first.
    """
    marts = open_marts(spark, layout)
    tables = {f"extracts/{name}": table for name, table in marts.named().items()}
    tables |= {f"reports/{name}": report(marts) for name, report in reports.items()}
    require_exposed(spark, layout, marts.build, tables)
    name = new_name()
    paths = {part: os.path.join(layout.exports(), name, part) for part in tables}
    shared = product_totals(marts).persist()
    try:
        together(spark, {part: partial(_store, table, paths[part]) for part, table in tables.items()})
    finally:
        shared.unpersist()
    publish_export(spark, layout, name)
    return {os.path.basename(part): path for part, path in paths.items()}
