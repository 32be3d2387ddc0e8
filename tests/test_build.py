import duckdb
import pytest
from pyspark.sql import functions as F

from shopmarts.plans import contract
from shopmarts.plans.build import ChecksFailed, build, export, models, verify
from shopmarts.plans.load import load_tables, read_raw
from shopmarts.plans.marts import Marts
from shopmarts.plans.reports import REPORTS
from shopmarts.schemas import CUSTOMERS, LOAD_ID, TABLES
from shopmarts.sources import readers
from shopmarts.sources.exposure import NotExposed
from shopmarts.sources.folders import children
from shopmarts.sources.layout import (
    EXPOSED_LAYERS,
    KEPT,
    MODEL_LAYERS,
    Layout,
    open_export,
    open_marts,
    publish,
)
from tests.conftest import LOAD
from tests.test_checks import GOOD

NOW = 60  # a minute after load "1.5"
LANDED = int(float(LOAD))


@pytest.fixture(scope="module")
def built(spark, source, tmp_path_factory):
    layout = Layout(str(tmp_path_factory.mktemp("warehouse")), "prod")
    sources = {name: source.table(name, *rows) for name, rows in GOOD.items()}
    load_tables(spark, sources, layout.raw, "1.5")
    raw = read_raw(spark, layout.raw)
    return layout, raw, build(spark, raw, layout)


def test_targets_have_their_own_databases():
    assert Layout("/w", "dev").path("fct_orders") == "/w/shop_dev_marts/fct_orders"
    assert Layout("/w", "prod").path("stg_webshop__orders").startswith("/w/shop_staging/")
    assert Layout("/w", "dev").raw == Layout("/w", "prod").raw == "/w/raw_webshop"
    with pytest.raises(ValueError, match="unknown target"):
        Layout("/w", "test")


def test_only_marts_are_exposed(source):
    exposed = {model for model, layer in MODEL_LAYERS.items() if layer in EXPOSED_LAYERS}
    assert exposed == set(source.marts().named())
    assert set(MODEL_LAYERS) == set(contract.NOT_NULL)


def test_stored_marts_equal_lazy_ones(source, built):
    lazy = source.marts(**GOOD)
    for name, table in built[2].named().items():
        assert sorted(map(str, table.collect())) == sorted(map(str, lazy.named()[name].collect()))
        assert table.columns == lazy.named()[name].columns


def test_reports_read_nothing_but_marts(built):
    layout, _, stored = built
    root = f"/{layout.database('marts')}/"
    for report in REPORTS.values():
        files = report(stored).inputFiles()
        assert files and all(root in name for name in files)


def test_labels_survive_the_store(built):
    for table in built[2].named().values():
        for field in table.schema:
            if "display_label" in field.metadata:
                assert field.metadata["display_label"] in table.columns
    assert built[2].orders.schema["sales_channel"].metadata == {"display_label": "channel_label"}


def test_reports_need_a_build_first(spark, built):
    with pytest.raises(FileNotFoundError, match="build target 'dev'"):
        open_marts(spark, Layout(built[0].warehouse, "dev"))


def test_verify_passes_and_covers_everything(spark, built):
    layout, raw, _ = built
    names = [r.check_name for r in verify(spark, raw, layout, built[2].build, NOW).collect()]
    assert len(names) == len(set(names)) == 56 + 3 + 2 + 13 + 3
    assert open_marts(spark, layout).build == built[2].build


def test_verify_raises_on_broken_marts(spark, source, tmp_path):
    layout = Layout(str(tmp_path))
    broken = {**GOOD, "orders": [*GOOD["orders"], {"id": 13, "customer_id": 99}]}
    good = source.raw(**GOOD)
    former = build(spark, good, layout).build
    verify(spark, good, layout, former, LANDED)
    raw = source.raw(**broken)
    made = build(spark, raw, layout)
    with pytest.raises(ChecksFailed, match="relationships fct_orders.customer_id: 1"):
        verify(spark, raw, layout, made.build, LANDED)
    readers_have = open_marts(spark, layout)
    assert readers_have.build == former and readers_have.orders.count() == 3


def test_a_stale_source_fails_the_run(spark, source, tmp_path):
    layout = Layout(str(tmp_path))
    raw = source.raw(**GOOD)
    made = build(spark, raw, layout)
    with pytest.raises(ChecksFailed, match="fresh orders: 1"):
        verify(spark, raw, layout, made.build, LANDED + 80 * 3600)
    with pytest.raises(FileNotFoundError, match="no published build"):
        open_marts(spark, layout)


def test_views_of_the_upstream_layers(spark, built):
    layout, raw, _ = built
    made = build(spark, raw, layout)
    assert spark.table("shop_staging__stg_webshop__orders").count() == 3
    assert spark.table("shop_intermediate__int_orders__items_aggregated").count() == 2
    other = Layout(layout.warehouse, "dev")
    build(spark, {**raw, "orders": raw["orders"].limit(1)}, other)
    assert spark.table(layout.view("stg_webshop__orders")).count() == 3
    assert spark.table(other.view("stg_webshop__orders")).count() == 1
    assert set(models(spark, raw, layout, made.build)) == set(MODEL_LAYERS)


def test_export_is_refreshed(spark, source, tmp_path):
    layout = Layout(str(tmp_path))
    for orders in (GOOD["orders"], GOOD["orders"][:1]):
        raw = source.raw(**{**GOOD, "orders": orders})
        made = build(spark, raw, layout)
        publish(spark, layout, made.build)
        export(spark, layout)
    written = export(spark, layout)
    assert len(written) == 4 + 13
    assert spark.read.parquet(written["headline"]).first().order_count == 1
    assert spark.read.parquet(written["fct_orders"]).count() == 1


def test_a_failing_report_leaves_the_former_export(spark, source, tmp_path):
    layout = Layout(str(tmp_path))
    raw = source.raw(**GOOD)
    publish(spark, layout, build(spark, raw, layout).build)
    with pytest.raises(FileNotFoundError, match="nothing was exported"):
        open_export(spark, layout)
    written = export(spark, layout)
    assert open_export(spark, layout) == written

    def fails(marts):
        return marts.orders.select(F.raise_error(F.lit("no report")).alias("x"))

    publish(spark, layout, build(spark, source.raw(**{**GOOD, "orders": GOOD["orders"][:1]}), layout).build)
    with pytest.raises(Exception, match="no report"):
        export(spark, layout, {"headline": REPORTS["headline"], "broken": fails})
    assert open_export(spark, layout) == written
    assert spark.read.parquet(written["headline"]).first().order_count == 3


def test_old_builds_and_exports_go(spark, source, tmp_path):
    layout = Layout(str(tmp_path))
    raw = source.raw(**GOOD)
    headline = {"headline": REPORTS["headline"]}
    unpublished = build(spark, raw, layout).build
    builds, exports = [], []
    for _ in range(KEPT + 2):
        made = build(spark, raw, layout)
        publish(spark, layout, made.build)
        builds.append(made.build)
        exports.append(export(spark, layout, headline)["headline"].split("/")[-3])
    for model in ("fct_orders", "dim_products", "int_orders__items_aggregated"):
        assert children(spark, layout.path(model)) == builds[-KEPT:]
    assert unpublished < builds[0]
    assert [n for n in children(spark, layout.exports()) if n != "_published"] == exports[-KEPT:]
    assert open_marts(spark, layout).orders.count() == 3


def test_a_report_that_reads_anything_else_is_refused(spark, source, built):
    layout, raw, stored = built
    publish(spark, layout, stored.build)
    other = build(spark, raw, layout)  # a build that nobody has checked
    staged = spark.table(layout.view("stg_webshop__orders"))
    hidden = {
        "staging": lambda marts: staged,
        "raw": lambda marts: raw["orders"],
        "a join": lambda marts: marts.orders.join(staged.select("order_id"), "order_id"),
        "a view": lambda marts: spark.sql(f"select count(*) from {layout.view('stg_webshop__orders')}"),
        "another build": lambda marts: other.orders,
        "an RDD": lambda marts: spark.createDataFrame(spark.sparkContext.parallelize([(1,)]), "a int"),
    }
    marts_view = stored.orders.createOrReplaceTempView("orders_mart")
    assert marts_view is None
    for name, report in hidden.items():
        with pytest.raises(NotExposed, match=name):
            export(spark, layout, {name: report})
    subquery = f"select * from orders_mart where order_id in (select order_id from {layout.view('stg_webshop__orders')})"
    with pytest.raises(NotExposed):
        export(spark, layout, {"subquery": lambda marts: spark.sql(subquery)})
    allowed = {"view": lambda marts: spark.sql("select count(*) as n from orders_mart")}
    assert spark.read.parquet(export(spark, layout, allowed)["view"]).first().n == 3


def test_an_aging_source_is_a_warning(spark, source, tmp_path):
    layout = Layout(str(tmp_path))
    raw = source.raw(**GOOD)
    made = build(spark, raw, layout)
    with pytest.warns(UserWarning, match="orders was loaded 40 hours ago"):
        verify(spark, raw, layout, made.build, LANDED + 40 * 3600)
    assert open_marts(spark, layout).build == made.build


def test_csv_seeds_have_declared_types(spark, source, tmp_path):
    seeds = tmp_path / "customers.csv"
    rows = source.table("customers", {"id": 1, "phone": "0470"}, {"id": 2})
    header = ",".join(CUSTOMERS.schema.names)
    lines = [
        ",".join("" if value is None else str(value).lower() if value is True else str(value) for value in row)
        for row in rows.collect()
    ]
    seeds.write_text("\n".join([header, *lines]))
    read = readers.read_csv(spark, str(tmp_path), CUSTOMERS)
    assert read.schema == CUSTOMERS.schema
    assert read.collect() == rows.collect()
    seeds.write_text("\n".join([header.replace("email", "mail"), *lines]))
    with pytest.raises(Exception, match="header"):
        readers.read_csv(spark, str(tmp_path), CUSTOMERS).collect()


def test_every_source_table_has_its_key_and_cursor():
    for spec in TABLES.values():
        assert spec.key in spec.schema.names and spec.cursor in spec.schema.names


def test_parquet_source(spark, source, tmp_path):
    source.table("orders", {"id": 1}).write.parquet(str(tmp_path / "orders"))
    assert readers.read_parquet(spark, str(tmp_path), TABLES["orders"]).count() == 1


@pytest.mark.parametrize("partitions", [1, 2, 7, 64])
def test_database_scan_is_cut_into_equal_parts(partitions):
    """Run in the process's own SQL engine: keys with wide gaps, and one far away from all others."""
    keys = [*range(100), *range(10**6, 10**6 + 50), 10**12, 10**12 + 1]
    con = duckdb.connect()
    con.execute("create schema raw; create table raw.orders (id bigint)")
    con.executemany("insert into raw.orders values (?)", [(k,) for k in [*keys, None, None]])
    cuts = [row[0] for row in con.sql(readers.cut_query(TABLES["orders"], "raw", partitions)).fetchall()]
    parts = readers.key_predicates("id", cuts)
    assert len(parts) == partitions
    con.execute("insert into raw.orders values (-5), (500), (2000000000000)")  # after the cuts were taken
    rows = [con.sql(f"from raw.orders where {part}").fetchall() for part in parts]
    assert sorted(str(r) for own in rows for r in own) == sorted(
        str((k,)) for k in [*keys, None, None, -5, 500, 2 * 10**12]
    )
    assert max(map(len, rows)) <= -(-len(keys) // partitions) + 5  # and those without a part of their own


def test_database_scan_of_few_or_no_keys():
    assert readers.key_predicates("id", []) == readers.key_predicates("id", [7]) == ["1 = 1"]
    assert readers.key_predicates("id", [7, 7, 9]) == ["id < 9 or id is null", "id >= 9"]


def test_a_new_table_leaves_the_others_alone(spark, source, built):
    layout, raw, _ = built
    before = {name: sorted(map(str, t.collect())) for name, t in raw.items()}
    extra = TABLES["orders"].__class__("returns", "id", "updated_at", TABLES["orders"].schema)
    load_tables(
        spark, {"returns": source.table("orders", {"id": 1})}, layout.raw, "2.5", {"returns": extra}
    )
    after = read_raw(spark, layout.raw)
    assert before == {name: sorted(map(str, t.collect())) for name, t in after.items()}
    assert after["orders"].select(LOAD_ID).distinct().count() == 1
    assert isinstance(built[2], Marts)
