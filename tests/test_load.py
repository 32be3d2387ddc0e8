import hashlib
import os
import re
import subprocess
import sys
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shopmarts.operators.upsert import merge, newest_per_key, unseen
from shopmarts.plans.load import KEPT, LoadError, RawTable, load_tables, loads_by_id, read_raw
from shopmarts.schemas import ORDERS, TABLES
from shopmarts.streaming.landing import land_new_files
from tests.conftest import at

NARROW = {name: replace(spec, bucket_width=10, file_rows=4) for name, spec in TABLES.items()}


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "raw")


@pytest.fixture
def shop(source):
    """A small shop. Its customers have no phone column."""
    return {
        "customers": source.table("customers", {"id": 1}, {"id": 2}).drop("phone"),
        "products": source.table("products", {"id": 1}),
        "orders": source.table(
            "orders",
            {"id": 10, "updated_at": at("2026-03-04 10:00")},
            {"id": 11, "status": "pending", "updated_at": at("2026-03-05 10:00")},
        ),
        "order_items": source.table(
            "order_items", {"id": 100, "order_id": 10}, {"id": 101, "order_id": 11}
        ),
    }


def counts(spark, root):
    return {name: table.count() for name, table in read_raw(spark, root, NARROW).items()}


def orders(spark, root):
    return RawTable(spark, root, NARROW["orders"])


def test_first_load_brings_every_table(spark, root, shop):
    load_tables(spark, shop, root, "1.5", NARROW)
    assert counts(spark, root) == {"customers": 2, "products": 1, "orders": 2, "order_items": 2}
    raw = read_raw(spark, root, NARROW)
    for table in raw.values():
        assert {row._dlt_load_id for row in table.collect()} == {"1.5"}
        assert table.select("_dlt_id").distinct().count() == table.count()
    assert "phone" not in raw["customers"].columns


def test_rerun_changes_nothing(spark, root, shop):
    first = load_tables(spark, shop, root, "1.5", NARROW)
    before = {name: sorted(t.collect()) for name, t in read_raw(spark, root, NARROW).items()}
    assert load_tables(spark, shop, root, "2.5", NARROW) == first
    after = {name: sorted(t.collect()) for name, t in read_raw(spark, root, NARROW).items()}
    assert after == before


def test_update_and_append(spark, root, shop, source):
    load_tables(spark, shop, root, "1.5", NARROW)
    changed = {
        "orders": source.table(
            "orders",
            {"id": 10, "updated_at": at("2026-03-04 10:00")},
            {"id": 11, "status": "paid", "updated_at": at("2026-04-01")},
        ),
        "order_items": shop["order_items"].unionByName(
            source.table("order_items", {"id": 102, "order_id": 11, "quantity": 3})
        ),
    }
    states = load_tables(spark, changed, root, "2.5", NARROW)
    assert counts(spark, root)["orders"] == 2 and counts(spark, root)["order_items"] == 3
    landed = {row.id: row for row in orders(spark, root).read().collect()}
    assert landed[11].status == "paid" and landed[11]._dlt_load_id == "2.5"
    assert landed[10]._dlt_load_id == "1.5"
    assert states["orders"].mark == at("2026-04-01") and states["orders"].rows == 1
    assert states["order_items"].mark == 102
    by_load = {r._dlt_load_id: r.row_count for r in loads_by_id(orders(spark, root).read()).collect()}
    assert by_load == {"1.5": 1, "2.5": 1}


def test_late_changes_and_deletes_are_not_seen(spark, root, source):
    def table(*rows):
        return source.table("orders", *rows)

    raw = orders(spark, root)
    raw.load(table({"id": 1}, {"id": 2, "updated_at": at("2026-05-01")}), "1.5")
    late = {"id": 1, "status": "paid", "updated_at": at("2026-04-30")}
    on_mark = {"id": 2, "status": "paid", "updated_at": at("2026-05-01")}
    raw.load(table(late, on_mark), "2.5")
    raw.load(table({"id": 3, "updated_at": at("2026-05-01")}), "3.5")  # 1 and 2 are gone
    landed = {row.id: (row.status, row._dlt_load_id) for row in raw.read().collect()}
    assert landed == {1: ("delivered", "1.5"), 2: ("delivered", "1.5"), 3: ("delivered", "3.5")}


def test_the_newest_version_in_a_batch_wins(spark, source):
    versions = source.table(
        "orders",
        {"id": 1, "status": "paid", "updated_at": at("2026-03-02")},
        {"id": 1, "status": "shipped", "updated_at": at("2026-03-03")},
        {"id": 1, "status": "pending", "updated_at": at("2026-03-01")},
        {"id": 2, "status": "paid", "updated_at": at("2026-03-01")},
        {"id": 2, "status": "shipped", "updated_at": at("2026-03-01")},
    )
    for frame in (versions, versions.orderBy("status"), versions.repartition(5)):
        best = newest_per_key(frame, "id", "updated_at")
        assert {row.id: row.status for row in best.collect()} == {1: "shipped", 2: "shipped"}


def test_versions_are_cut_before_the_shuffle(spark, source):
    plan = newest_per_key(source.table("orders", {"id": 1}), "id", "updated_at")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_new_columns_read_null_in_old_rows(spark, root, shop, source):
    load_tables(spark, shop, root, "1.5", NARROW)
    grown = source.table("customers", {"id": 25, "phone": "+32", "updated_at": at("2026-06-01")})
    load_tables(spark, {"customers": grown}, root, "2.5", NARROW)
    without = grown.drop("city").withColumn("id", F.lit(26)).withColumn("phone", F.lit("+33"))
    load_tables(spark, {"customers": without}, root, "3.5", NARROW)
    landed = RawTable(spark, root, NARROW["customers"]).read()
    got = {row.id: (row.phone, row.city) for row in landed.collect()}
    assert got == {1: (None, "Gent"), 2: (None, "Gent"), 25: ("+32", "Gent"), 26: ("+33", None)}


def test_a_narrower_type_is_widened_to_the_stored_one(spark, root, source):
    raw = orders(spark, root)
    raw.load(source.table("orders", {"id": 1}), "1.5")
    later = source.table("orders", {"id": 2, "updated_at": at("2027-01-01")})
    raw.load(later.withColumn("customer_id", F.col("customer_id").cast("int")), "2.5")
    assert raw.read().schema["customer_id"].dataType.simpleString() == "bigint"
    assert raw.read().count() == 2


def listed(raw):
    """The files of the current state, with the keys they span."""
    rows = raw._listed(raw.state().step).collect()
    assert sum(row.n for row in rows) == raw.read().count()
    return {(row._bucket, row._file): (row._bucket, row.low, row.high) for row in rows}


def stored(tmp_path):
    """Every file there is, with its bucket."""
    found = (tmp_path / "raw" / "orders").rglob("*.parquet")
    return {(int(p.parent.name.removeprefix("_bucket=")), p.name) for p in found}


def named(raw, steps):
    return {(row._bucket, row._file) for step in steps for row in raw._listed(step).collect()}


def paid(source, *keys, when="2027-01-01"):
    return source.table("orders", *[{"id": i, "status": "paid", "updated_at": at(when)} for i in keys])


def test_only_files_that_hold_a_key_are_rewritten(spark, root, source):
    """Old keys scattered over the table: the files between them stay as they are."""
    raw = orders(spark, root)
    raw.load(source.table("orders", *[{"id": i * 2} for i in range(20)]), "1.5")
    before = listed(raw)
    assert sorted(before.values()) == [
        (0, 0, 6), (0, 8, 8), (1, 10, 16), (1, 18, 18), (2, 20, 26), (2, 28, 28), (3, 30, 36), (3, 38, 38),
    ]
    raw.load(paid(source, 2, 24, 34), "2.5")
    after = listed(raw)
    gone = {before[name] for name in before.keys() - after.keys()}
    # The files of the keys, and the short files beside them, which join what is written anew.
    assert gone == {(0, 0, 6), (0, 8, 8), (2, 20, 26), (2, 28, 28), (3, 30, 36), (3, 38, 38)}
    landed = {row.id: row.status for row in raw.read().collect()}
    assert len(landed) == 20 and {i for i, status in landed.items() if status == "paid"} == {2, 24, 34}


def test_a_new_key_between_old_ones_rewrites_no_full_file(spark, root, source):
    raw = orders(spark, root)
    raw.load(source.table("orders", *[{"id": i * 2} for i in range(10)]), "1.5")
    before = listed(raw)
    raw.load(paid(source, 3, 11), "2.5")  # in the spans of full files, but in none of them
    after = listed(raw)
    assert {before[name] for name in before.keys() - after.keys()} == {(0, 8, 8), (1, 18, 18)}
    assert raw.read().count() == 12


def test_files_stay_sorted_and_full(spark, root, source):
    """Short files of a touched bucket are taken up, so that many small loads leave few of them."""
    raw = orders(spark, root)
    for i in range(10):
        raw.load(paid(source, i, when=f"2027-01-{i + 1:02d}"), f"{i}.5")
    found = sorted(listed(raw).values())
    assert len(found) <= 5 and all(bucket == 0 for bucket, _, _ in found)
    assert raw.read().count() == 10


def test_a_reader_keeps_what_it_opened(spark, root, source, tmp_path):
    raw = orders(spark, root)
    raw.load(source.table("orders", *[{"id": i} for i in range(25)]), "1.5")
    opened = raw.read()
    wanted = sorted(opened.collect())
    for load in range(1, KEPT):
        raw.load(paid(source, 3, 14, when=f"2027-01-0{load}"), f"{load + 1}.5")
        assert sorted(opened.collect()) == wanted
    assert sorted(raw.read().collect()) != wanted
    first = named(raw, [1])
    assert first <= stored(tmp_path)
    raw.load(paid(source, 3, 14, when="2027-02-01"), "9.5")  # the first state is one too many now
    left = stored(tmp_path)
    assert first - left and first & left == first & set(listed(raw))
    states = sorted(int(p.name) for p in (tmp_path / "raw" / "_files" / "orders").iterdir())
    assert states == [raw.state().step - i for i in range(KEPT - 1, -1, -1)]
    assert left == named(raw, states)
    assert raw.read().count() == 25


def test_rows_are_written_once_after_one_exchange(spark, root, source, monkeypatch):
    raw = orders(spark, root)
    written = []
    original = RawTable._write

    def watched(self, rows):
        written.append(rows.hint("rebalance", F.col("_bucket"))._jdf.queryExecution().executedPlan().toString())
        return original(self, rows)

    monkeypatch.setattr(RawTable, "_write", watched)
    raw.load(source.table("orders", {"id": 1}, {"id": 2}), "1.5")
    raw.load(paid(source, 2), "2.5")
    assert len(written) == 2
    assert [len(re.findall(r"\bExchange ", plan)) for plan in written] == [1, 1]  # beside broadcasts
    # Versions of one key are rare, and only then are rows compared before the write.
    twice = paid(source, 2, when="2027-01-02").unionByName(paid(source, 2, when="2027-01-03"))
    raw.load(twice, "3.5")
    assert len(written) == 3 and "Window" not in written[1] and "Window" in written[2]


def test_buckets_of_negative_and_wide_keys(spark, root):
    spec = replace(ORDERS, bucket_width=10**30)
    keys = [-(10**31), -1, 0, 10**30 - 1, 10**30, 5 * 10**36]
    frame = spark.createDataFrame([(Decimal(k),) for k in keys], "id decimal(38,0)")
    table = RawTable(spark, root, spec)
    got = [row[1] for row in frame.select("id", table._bucket()).collect()]
    assert got == [-10, -1, 0, 0, 1, 5 * 10**6]


def test_touched_buckets_far_apart(spark, root, source):
    raw = orders(spark, root)
    raw.load(source.table("orders", *[{"id": i} for i in range(45)]), "1.5")
    changed = [{"id": i, "status": "paid", "updated_at": at("2027-01-01")} for i in (3, 33, 50)]
    raw.load(source.table("orders", *changed), "2.5")
    landed = {row.id: row.status for row in raw.read().collect()}
    assert len(landed) == 46
    assert {i for i, status in landed.items() if status == "paid"} == {3, 33, 50}


def test_a_batch_reads_no_other_bucket(spark, root, source):
    """Neither to find rows that are new nor to merge."""
    raw = orders(spark, root)
    raw.load(source.table("orders", *[{"id": i} for i in range(45)]), "1.5")
    state = raw.state()
    batch, seen = raw._land(paid(source, 21), "2.5", state, True)
    assert (seen.rows, seen.low, seen.high, seen.repeated) == (1, 2, 2, False)
    touched = raw._touched(raw._listed(state.step), batch, seen).collect()
    assert {row._bucket for row in touched} == {2}
    typed = source.table("orders", {"id": 1})
    read = unseen(typed, raw._on_mark(state, typed), "id", "updated_at").inputFiles()
    assert read and all("/_marked/" in file for file in read)


def test_only_keys_are_read_to_find_files(spark, root, source):
    raw = orders(spark, root)
    raw.load(source.table("orders", {"id": 1}), "1.5")
    plan = raw._keys(raw._paths(raw._listed(1)))._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"ReadSchema: struct<([^>]*)>", plan) == ["id:bigint"]


def test_data_without_a_journal_are_not_replaced(spark, root, source):
    frame = source.table("orders", *[{"id": i} for i in range(25)])
    frame.write.parquet(orders(spark, root).path)
    with pytest.raises(LoadError, match="restore the journal"):
        orders(spark, root).load(source.table("orders", {"id": 1}), "2.5")
    assert spark.read.parquet(orders(spark, root).path).count() == 25


ZONES = """
import sys
from shopmarts import registry
from shopmarts.session import local_session

spark = local_session(2, shuffle_partitions=2, memory="2g")
for name in ("load_merge", "load_rerun"):
    rows = sorted(map(str, registry.QUERIES[name](spark, "/root/testdata/sf0.001").collect()))
    print(name, len(rows), hash_of(rows))
"""


def test_loads_do_not_depend_on_the_systems_time_zone():
    """In processes of their own: the zone is the operating system's, not the session's."""
    script = "import hashlib\nhash_of = lambda x: hashlib.md5(repr(x).encode()).hexdigest()" + ZONES
    found = set()
    for zone in ("UTC", "America/New_York", "Asia/Tokyo"):
        run = subprocess.run(
            [sys.executable, "-c", script],
            env=os.environ | {"TZ": zone, "PYTHONPATH": os.getcwd()},
            capture_output=True,
            text=True,
            check=True,
        )
        found.add("\n".join(x for x in run.stdout.splitlines() if x.startswith("load_")))
    assert len(found) == 1 and "load_rerun" in found.pop()


@pytest.mark.parametrize(
    "step, after",
    [("_land", False), ("_write", False), ("_list", False), ("_list", True), ("_record", False), ("_trim", False)],
)
def test_a_crash_at_any_step_is_healed_by_the_next_load(
    spark, root, source, monkeypatch, tmp_path, step, after
):
    raw = orders(spark, root)
    first = source.table("orders", *[{"id": i} for i in range(25)])
    raw.load(first, "1.5")
    second = first.unionByName(paid(source, 3, 40))
    original = getattr(RawTable, step)

    def dies(self, *arguments):
        if after:
            original(self, *arguments)
        raise RuntimeError("driver lost")

    monkeypatch.setattr(RawTable, step, dies)
    with pytest.raises(RuntimeError):
        raw.load(second, "2.5")
    monkeypatch.undo()
    recorded = step == "_trim"
    landed = {row.id: row.status for row in raw.read().collect()}
    assert len(landed) == (26 if recorded else 25)  # the old state or the new one, never a mixture
    state = raw.load(second, "3.5")
    assert state.phase == "done" and state.mark == at("2027-01-01")
    landed = {row.id: row.status for row in raw.read().collect()}
    assert len(landed) == 26 and {i for i, s in landed.items() if s == "paid"} == {3, 40}
    assert raw.load(second, "4.5") == state
    for month in (3, 4):  # what the crash has left goes when old states do
        raw.load(paid(source, 7, when=f"2027-{month:02d}-01"), f"{month + 2}.5")
    states = [int(p.name) for p in (tmp_path / "raw" / "_files" / "orders").iterdir()]
    assert stored(tmp_path) == named(raw, states)


def test_a_crashed_first_load_starts_over(spark, root, source, monkeypatch):
    raw = orders(spark, root)

    def dies(self, state):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(RawTable, "_record", dies)
    with pytest.raises(RuntimeError):
        raw.load(source.table("orders", {"id": 1}, {"id": 2}), "1.5")
    monkeypatch.undo()
    with pytest.raises(LoadError):
        raw.read()
    raw.load(source.table("orders", {"id": 2}, {"id": 3}), "2.5")
    assert sorted(row.id for row in raw.read().collect()) == [2, 3]


def test_rows_without_a_cursor_stop_the_load(spark, root, source):
    raw = orders(spark, root)
    with pytest.raises(LoadError, match="lack id or updated_at"):
        raw.load(source.table("orders", {"id": 1, "updated_at": None}), "1.5")
    with pytest.raises(LoadError):
        raw.read()


def test_an_empty_source_can_be_loaded(spark, root, source):
    raw = orders(spark, root)
    assert raw.load(source.table("orders"), "1.5").mark is None
    assert raw.read().count() == 0
    raw.load(source.table("orders", {"id": 1}), "2.5")
    assert raw.read().count() == 1


def test_merge_is_a_set_operation(source):
    target = source.table("orders", {"id": 1}, {"id": 2})
    batch = source.table("orders", {"id": 2, "status": "paid"}, {"id": 3})
    once = merge(target, batch, "id")
    assert sorted(row.id for row in once.collect()) == [1, 2, 3]
    assert sorted(merge(once, batch, "id").collect()) == sorted(once.collect())


def test_files_arrive_as_a_stream(spark, root, source, tmp_path):
    landing = str(tmp_path / "landing")

    def drop(*rows):
        source.table("orders", *rows).coalesce(1).write.mode("append").parquet(landing)

    def run(epoch):
        land_new_files(
            spark, landing, ORDERS.schema, root, NARROW["orders"], str(tmp_path / "cp"), epoch
        ).awaitTermination()
        return orders(spark, root).read()

    drop({"id": 1}, {"id": 2})
    assert run(100).count() == 2
    drop({"id": 2, "status": "paid", "updated_at": at("2027-01-01")}, {"id": 3, "updated_at": at("2027-01-02")})
    landed = {row.id: (row.status, row._dlt_load_id) for row in run(200).collect()}
    assert landed == {
        1: ("delivered", "100.000000"),
        2: ("paid", "200.000001"),
        3: ("delivered", "200.000001"),
    }
    assert run(300).count() == 3


def test_a_backlog_out_of_order_stays_whole(spark, root, source, tmp_path):
    """One file per batch, the newest rows first: nothing is lost and nothing goes back in time."""
    landing = str(tmp_path / "landing")

    def drop(*rows):
        source.table("orders", *rows).coalesce(1).write.mode("append").parquet(landing)

    drop({"id": 1, "status": "shipped", "updated_at": at("2026-06-03")})
    drop({"id": 1, "status": "paid", "updated_at": at("2026-06-02")}, {"id": 2})
    drop({"id": 2, "status": "paid", "updated_at": at("2026-06-01")}, {"id": 30})
    for epoch in (100, 200):
        land_new_files(
            spark,
            landing,
            ORDERS.schema,
            root,
            NARROW["orders"],
            str(tmp_path / "cp"),
            epoch,
            files_per_batch=1,
        ).awaitTermination()
    raw = orders(spark, root)
    landed = {row.id: row.status for row in raw.read().collect()}
    assert landed == {1: "shipped", 2: "paid", 30: "delivered"}
    assert raw.state().mark == at("2026-06-03")
    once = sorted(raw.read().collect())
    again = source.table("orders", {"id": 2}, {"id": 30})
    raw.load(again, "300.5", in_order=False)
    assert sorted(raw.read().collect()) == once


def test_an_unreadable_journal_is_no_first_load(spark, root, source, tmp_path):
    raw = orders(spark, root)
    raw.load(source.table("orders", {"id": 1}), "1.5")
    for file in (tmp_path / "raw" / "_journal" / "orders").glob("*.json"):
        file.write_bytes(b"not a record")
    with pytest.raises(Exception):  # noqa: B017
        raw.load(source.table("orders", {"id": 2}), "2.5")
    assert spark.read.parquet(raw.path).count() == 1


def test_a_failing_table_is_raised_and_leaves_the_others_loaded(spark, root, shop, source):
    shop["orders"] = source.table("orders", {"id": 1, "updated_at": None})
    with pytest.raises(LoadError, match="orders"):
        load_tables(spark, shop, root, "1.5", NARROW)
    assert RawTable(spark, root, NARROW["customers"]).read().count() == 2


def test_keys_are_counted_only_where_a_hash_is_repeated(spark, root, source, monkeypatch):
    """A first load shuffles neither row ids nor, to count them, the keys; what it stores is the same."""
    raw = orders(spark, root)
    plans = []
    original = RawTable._write

    def watched(self, rows):
        plans.append(sorted(rows.columns))
        return original(self, rows)

    monkeypatch.setattr(RawTable, "_write", watched)
    keys = [-11, -10, -1, 0, 9, 10, 10, 31]
    raw.load(source.table("orders", *[{"id": i} for i in keys]), "1.5")
    assert raw.state().rows == 7 and len(plans) == 2  # the second time without the repeated key
    rows = raw.read().collect()
    assert sorted(row.id for row in rows) == sorted(set(keys))
    for row in rows:
        assert row._dlt_id == hashlib.md5(f"{row.id}|{row._dlt_load_id}".encode()).hexdigest()
    assert {bucket for bucket, _ in listed(raw)} == {-2, -1, 0, 1, 3}
    assert "_slice" not in raw.read().columns


def test_neighbouring_keys_of_a_first_load_share_a_file(spark, root, source):
    """However they are dealt in the source, so that sums by key are combined before a shuffle."""
    spec = replace(NARROW["orders"], bucket_width=4_000, file_rows=4_000)
    raw = RawTable(spark, root, spec)
    conf = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(conf, "false")
    try:
        rows = spark.range(4_000).selectExpr("(id * 1237) % 4000 as id").repartition(8)
        raw.load(rows.selectExpr("id", "timestamp_ntz'2026-01-01' as updated_at"), "1.5")
    finally:
        spark.conf.set(conf, "true")
    held = dict(raw.read().select("id", "_metadata.file_name").collect())
    assert len(held) == 4_000
    for first in range(0, 4_000, 1_000):
        assert len({held[key] for key in range(first, first + 1_000)}) == 1
