"""Every operator of the library as a query over the trade tables in a folder."""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import replace
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmarts.functions.money import cents_to_eur
from shopmarts.functions.text import sentence_case
from shopmarts.functions.time import hour_boundaries, load_second, month_start
from shopmarts.operators import diff
from shopmarts.plans import contract
from shopmarts.plans.build import MONEY, build, export, verify
from shopmarts.plans.intermediate import order_money
from shopmarts.plans.load import RawTable, load_tables, loads_by_id, read_raw
from shopmarts.plans.marts import Marts, marts_of, stage
from shopmarts.plans.reports import REPORTS
from shopmarts.schemas import LOAD_ID, ROW_ID, TABLES
from shopmarts.session import scratch_dir
from shopmarts.sources import defects, trade_tables
from shopmarts.sources.folders import stamp
from shopmarts.sources.layout import Layout, open_marts
from shopmarts.streaming.landing import land_new_files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Line keys of the trade tables carry 25 digits below the order number.
SPECS = {
    **TABLES,
    "order_items": replace(TABLES["order_items"], bucket_width=1_000_000 * 10**25),
}
LANDED_BY = trade_tables.LANDED_BY
FIRST, SECOND, THIRD = "1788900000.1", "1788930000.2", "1788960000.3"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def marts(spark: SparkSession, folder: str) -> Marts:
    return marts_of(stage(trade_tables.raw_tables(spark, folder)))


def models_of(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    views = stage(raw)
    money = order_money(views["stg_webshop__order_items"])
    return {**views, MONEY: money, **marts_of(views, money).named()}


def models(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return models_of(trade_tables.raw_tables(spark, folder))


def broken_models(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return models_of(defects.broken_raw(trade_tables.raw_tables(spark, folder)))


# Models ---------------------------------------------------------------------------------------


def _register_models() -> None:
    names = {
        "stg_customers": "stg_webshop__customers",
        "stg_products": "stg_webshop__products",
        "stg_orders": "stg_webshop__orders",
        "stg_order_items": "stg_webshop__order_items",
        "int_order_money": MONEY,
        "fct_orders": "fct_orders",
        "fct_order_items": "fct_order_items",
        "dim_customers": "dim_customers",
        "dim_products": "dim_products",
    }
    for key, model in names.items():
        QUERIES[key] = lambda spark, folder, model=model: models(spark, folder)[model]
    for name, report in REPORTS.items():
        QUERIES[f"rpt_{name}"] = lambda spark, folder, report=report: report(marts(spark, folder))


_register_models()


# Functions ------------------------------------------------------------------------------------


@query
def fn_cents_to_eur(spark: SparkSession, folder: str) -> DataFrame:
    price, cost = F.col("unit_price_cents"), F.col("cost_cents")
    return trade_tables.source_tables(spark, folder)["products"].select(
        "id",
        cents_to_eur(price).alias("price_eur"),
        cents_to_eur(price - cost).alias("margin_eur"),
        cents_to_eur(cost - price * 3).alias("below_zero_eur"),
    )


@query
def fn_sentence_case(spark: SparkSession, folder: str) -> DataFrame:
    return trade_tables.source_tables(spark, folder)["orders"].select(
        "id",
        sentence_case(F.col("channel")).alias("channel_label"),
        sentence_case(F.upper("status")).alias("status_label"),
        sentence_case(F.substr("status", F.lit(20))).alias("empty_label"),
        sentence_case(F.when(F.col("id") % 2 == 0, F.col("status"))).alias("optional_label"),
    )


@query
def fn_time(spark: SparkSession, folder: str) -> DataFrame:
    ordered, shipped = F.col("ordered_at"), F.col("shipped_at")
    return trade_tables.raw_tables(spark, folder)["orders"].select(
        "id",
        hour_boundaries(ordered, shipped).cast("bigint").alias("hours_to_ship"),
        hour_boundaries(shipped, ordered).cast("bigint").alias("hours_back"),
        month_start(ordered).alias("month"),
        load_second(F.col(LOAD_ID)).alias("load_second"),
    )


# Checks ---------------------------------------------------------------------------------------


@query
def chk_unique(spark: SparkSession, folder: str) -> DataFrame:
    return contract.unique(models(spark, folder))


@query
def chk_not_null(spark: SparkSession, folder: str) -> DataFrame:
    return contract.not_null(models(spark, folder))


@query
def chk_accepted_values(spark: SparkSession, folder: str) -> DataFrame:
    return contract.accepted_values(models(spark, folder))


@query
def chk_relationships(spark: SparkSession, folder: str) -> DataFrame:
    return contract.relationships(models(spark, folder))


@query
def chk_reconcile(spark: SparkSession, folder: str) -> DataFrame:
    return contract.reconcile(marts(spark, folder))


@query
def chk_realised(spark: SparkSession, folder: str) -> DataFrame:
    return contract.realised(marts(spark, folder))


@query
def chk_money_exact(spark: SparkSession, folder: str) -> DataFrame:
    return contract.money_is_exact(marts(spark, folder))


@query
def chk_freshness(spark: SparkSession, folder: str) -> DataFrame:
    """Tables loaded 35, 37 and 73 hours before the question is asked."""
    now = 1_788_961_669
    hours = {"customers": 35, "products": 37, "orders": 73}
    sources = trade_tables.source_tables(spark, folder)
    raw = {
        name: trade_tables.with_lineage(sources[name], f"{now - age * 3600}.25")
        for name, age in hours.items()
    }
    return contract.freshness(raw, now)


@query
def chk_unique_broken(spark: SparkSession, folder: str) -> DataFrame:
    return contract.unique(broken_models(spark, folder))


@query
def chk_not_null_broken(spark: SparkSession, folder: str) -> DataFrame:
    return contract.not_null(broken_models(spark, folder))


@query
def chk_accepted_values_broken(spark: SparkSession, folder: str) -> DataFrame:
    return contract.accepted_values(broken_models(spark, folder))


@query
def chk_relationships_broken(spark: SparkSession, folder: str) -> DataFrame:
    return contract.relationships(broken_models(spark, folder))


@query
def chk_reconcile_broken(spark: SparkSession, folder: str) -> DataFrame:
    return contract.unreconciled(defects.lost_parentheses(marts(spark, folder)))


@query
def chk_realised_broken(spark: SparkSession, folder: str) -> DataFrame:
    return contract.misrealised(defects.cancellations_count(marts(spark, folder)))


@query
def chk_money_exact_broken(spark: SparkSession, folder: str) -> DataFrame:
    return contract.money_is_exact(defects.floating_money(marts(spark, folder)))


# Loads: each writes its tables to a new folder below the shared one ------------------------------


def _load(spark: SparkSession, root: str, load_id: str, **sources: DataFrame) -> None:
    load_tables(spark, sources, root, load_id, SPECS)


def _landed(spark: SparkSession, root: str, table: str) -> DataFrame:
    return RawTable(spark, root, SPECS[table]).read()


def _moment(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


@query
def load_full(spark: SparkSession, folder: str) -> DataFrame:
    """First load of all four tables: every landed key with its lineage."""
    root = scratch_dir(spark, "load_full")
    _load(spark, root, FIRST, **trade_tables.source_tables(spark, folder))
    parts = [
        table.select(
            F.lit(name).alias("table_name"), F.col("id").cast("string").alias("id"), LOAD_ID, ROW_ID
        )
        for name, table in read_raw(spark, root, SPECS).items()
    ]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


def _register_landed() -> None:
    """Every landed column of the tables that no other load query compares."""

    def landed(spark: SparkSession, folder: str, name: str) -> DataFrame:
        root = scratch_dir(spark, f"load_{name}")
        _load(spark, root, FIRST, **{name: trade_tables.source_tables(spark, folder)[name]})
        return _landed(spark, root, name)

    for name in ("customers", "products", "order_items"):
        QUERIES[f"load_{name}"] = partial(landed, name=name)


_register_landed()


@query
def load_rerun(spark: SparkSession, folder: str) -> DataFrame:
    """The same source twice: no row is doubled, and none is taken for new."""
    root = scratch_dir(spark, "load_rerun")
    source = trade_tables.source_tables(spark, folder)["orders"]
    _load(spark, root, FIRST, orders=source)
    _load(spark, root, SECOND, orders=source)
    return _landed(spark, root, "orders")


@query
def load_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """Lines are appended: the second load brings those above the highest key of the first."""
    root = scratch_dir(spark, "load_incremental")
    lines = trade_tables.source_tables(spark, folder)["order_items"]
    half = lines.agg(F.max("order_id")).first()[0] // 2
    _load(spark, root, FIRST, order_items=lines.where(F.col("order_id") <= half))
    _load(spark, root, SECOND, order_items=lines)
    return _landed(spark, root, "order_items").drop(ROW_ID)


def _three_loads(spark: SparkSession, folder: str, purpose: str) -> DataFrame:
    """Orders in three loads: the past, the rest, and a round of changes.

    The second source also holds rows below the mark that the first lacked: they are not seen. The
    third holds newer versions (the newest wins), changes without a newer ``updated_at`` (not seen),
    and lacks some rows (they stay).
    """
    root = scratch_dir(spark, purpose)
    source = trade_tables.source_tables(spark, folder)["orders"]
    key, changed_at = F.col("id"), F.col("updated_at")
    _load(spark, root, FIRST, orders=source.where(F.col("ordered_at") < _moment("1998-01-01")))
    _load(spark, root, SECOND, orders=source)

    def version(rows: Column, status: str, at: Column) -> DataFrame:
        return source.where(rows).withColumns({"status": F.lit(status), "updated_at": at})

    third = (
        version(key % 10 == 0, "cancelled", _moment("2002-01-02"))
        .unionByName(version(key % 20 == 0, "shipped", _moment("2002-01-01")))
        .unionByName(version(key % 10 == 1, "paid", changed_at))
        .unionByName(source.where(key % 10 > 2))
    )
    _load(spark, root, THIRD, orders=third)
    return _landed(spark, root, "orders")


@query
def load_merge(spark: SparkSession, folder: str) -> DataFrame:
    return _three_loads(spark, folder, "load_merge")


@query
def load_lineage(spark: SparkSession, folder: str) -> DataFrame:
    return loads_by_id(_three_loads(spark, folder, "load_lineage"))


@query
def load_evolve(spark: SparkSession, folder: str) -> DataFrame:
    """The source gains a column: new and changed rows carry it, older ones read NULL."""
    root = scratch_dir(spark, "load_evolve")
    source = trade_tables.source_tables(spark, folder)["customers"]
    _load(spark, root, FIRST, customers=source.drop("phone"))
    changed = F.when(F.col("id") % 3 == 0, _moment("2002-01-01")).otherwise(F.col("updated_at"))
    _load(spark, root, SECOND, customers=source.withColumn("updated_at", changed))
    return _landed(spark, root, "customers")


@query
def load_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The order files as a stream, run twice: the second run finds no new file."""
    root = scratch_dir(spark, "load_stream")
    path = os.path.join(folder, "orders.parquet")
    schema = spark.read.parquet(path).schema
    for epoch in (1_788_900_000, 1_788_930_000):
        land_new_files(
            spark,
            files=f"{path}*",  # a pattern fits one file as well as a folder of files
            schema=schema,
            raw_root=root,
            spec=SPECS["orders"],
            checkpoint=os.path.join(root, "_stream"),
            epoch=epoch,
            derive=lambda batch: trade_tables.orders({"orders": batch}),
        ).awaitTermination()
    return _landed(spark, root, "orders")


@query
def run_headline(spark: SparkSession, folder: str) -> DataFrame:
    """A whole run, and the headline out of the exported reports."""
    return spark.read.parquet(_run(spark, folder)["headline"])


def _run(spark: SparkSession, folder: str, load_id: str = LANDED_BY) -> dict[str, str]:
    """Load, build, check, publish and export; the checks ask an hour after the load."""
    layout = Layout(scratch_dir(spark, "run"), "prod")
    _load(spark, layout.raw, load_id, **trade_tables.source_tables(spark, folder))
    raw = read_raw(spark, layout.raw, SPECS)
    made = build(spark, raw, layout)
    verify(spark, raw, layout, made.build, now_second=int(float(load_id)) + 3600)
    return export(spark, layout)


# Where an application's run over given files has exported what, so that the queries below share it.
_EXPORTED: dict[tuple, dict[str, str]] = {}


def _register_exports() -> None:
    """The reports and extracts as a run exports them: from stored, checked and published marts."""

    def exported(spark: SparkSession, folder: str, name: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, folder, stamp(spark, folder))
        if key not in _EXPORTED:
            _EXPORTED[key] = _run(spark, folder)
        return spark.read.parquet(_EXPORTED[key][name])

    for name in (*REPORTS, "fct_orders", "fct_order_items", "dim_customers", "dim_products"):
        QUERIES[f"exported_{name}"] = partial(exported, name=name)


_register_exports()


@query
def stored_marts(spark: SparkSession, folder: str) -> DataFrame:
    """The marts of a target as stored: rows and booked or listed money of each."""
    layout = Layout(scratch_dir(spark, "marts"), "dev")
    made = build(spark, trade_tables.raw_tables(spark, folder), layout)
    stored = open_marts(spark, layout, made.build)
    money = {
        "fct_orders": (stored.orders, "net_amount_eur"),
        "fct_order_items": (stored.order_items, "net_amount_eur"),
        "dim_customers": (stored.customers, "lifetime_realised_net_revenue_eur"),
        "dim_products": (stored.products, "unit_price_eur"),
    }
    parts = [
        table.agg(
            F.lit(name).alias("table_name"),
            F.count("*").alias("row_count"),
            F.sum(column).cast("decimal(38,2)").alias("money_eur"),
        )
        for name, (table, column) in money.items()
    ]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


# Comparison of two builds -----------------------------------------------------------------------


@query
def diff_schema(spark: SparkSession, folder: str) -> DataFrame:
    before = marts(spark, folder).orders
    return diff.schema_diff(before, defects.later_orders(before)).select(
        "column_name", "change", "filled_before", "filled_after"
    )


@query
def diff_rows(spark: SparkSession, folder: str) -> DataFrame:
    before = marts(spark, folder).orders
    return diff.row_diff(before, defects.later_orders(before), key="order_id")


@query
def diff_rows_keyless(spark: SparkSession, folder: str) -> DataFrame:
    before = marts(spark, folder).orders
    return diff.row_diff(before, defects.later_orders(before))


@query
def diff_metrics(spark: SparkSession, folder: str) -> DataFrame:
    before = marts(spark, folder).orders
    metrics = {
        "orders": F.count("*"),
        "booked revenue": F.sum("net_amount_eur"),
        "realised revenue": F.sum("realised_net_amount_eur"),
    }
    return diff.metric_diff(before, defects.later_orders(before), metrics)
