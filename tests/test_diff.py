from decimal import Decimal

from pyspark.sql import functions as F

from shopmarts.operators.diff import metric_diff, row_diff, schema_diff


def frame(spark, *rows):
    return spark.createDataFrame(rows, "id int, name string, amount decimal(18,2)")


def counts(before, after, key=None):
    return tuple(row_diff(before, after, key).first())


def test_rows_with_a_key(spark):
    before = frame(spark, (1, "a", Decimal(1)), (2, None, Decimal(2)), (3, "c", None), (4, "d", Decimal(4)))
    after = frame(spark, (1, "a", Decimal(1)), (2, None, Decimal(2)), (3, "c", Decimal(0)), (5, "e", Decimal(5)))
    assert counts(before, after, "id") == (4, 4, 1, 1, 1)
    assert counts(before, after) == (4, 4, 0, 2, 2)


def test_equal_tables_and_empty_ones(spark):
    table = frame(spark, (1, None, None), (1, None, None))
    assert counts(table, table, "id") == (2, 2, 0, 0, 0)
    assert counts(table, table.where("false"), "id") == (2, 0, 0, 2, 0)
    empty = table.where("false")
    assert counts(empty, empty, "id") == (0, 0, 0, 0, 0)


def test_repeated_and_null_keys_are_counted_not_paired(spark):
    many = frame(spark, *[(1, "a", None)] * 50, *[(None, "n", None)] * 3)
    fewer = frame(spark, *[(1, "a", None)] * 20, *[(1, "b", None)] * 40, (None, "n", None), (None, "m", None))
    # Key 1 lost 30 and gained 40 rows; the NULL key lost 2 and gained 1.
    assert counts(many, fewer, "id") == (53, 62, 31, 1, 10)


def test_the_diff_never_joins(spark):
    table = frame(spark, (1, "a", None))
    plan = row_diff(table, table, "id")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_no_row_is_shuffled_whole(spark):
    """Equal or not, only keys and digests move."""
    table = frame(spark, *[(i, "a" * 100, None) for i in range(20)])
    for key in ("id", None):
        plan = row_diff(table, table, key)._jdf.queryExecution().executedPlan().toString()
        moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        assert moved and all("_digest_1" in moved[-1] and "name#" not in line for line in moved)
        assert "SortAggregate" not in plan


def test_where_nulls_are_is_part_of_a_row(spark):
    kind = "id int, a string, b string"
    one = spark.createDataFrame([(1, None, "x")], kind)
    other = spark.createDataFrame([(1, "x", None)], kind)
    assert counts(one, other, "id") == (1, 1, 1, 0, 0)
    split = spark.createDataFrame([(1, "xy", "z")], kind), spark.createDataFrame([(1, "x", "yz")], kind)
    assert counts(*split, "id") == (1, 1, 1, 0, 0)


def test_a_retyped_column_with_equal_values_is_no_change(spark):
    before = frame(spark, (1, "a", Decimal(1)), (2, None, None))
    after = before.withColumn("id", F.col("id").cast("long")).withColumn("amount", F.col("amount").cast("decimal(20,4)"))
    assert counts(before, after, "id") == counts(before, after) == (2, 2, 0, 0, 0)


def test_columns_added_removed_and_retyped(spark):
    before = frame(spark, (1, "a", None), (2, None, None))
    after = before.drop("name").withColumn("id", F.col("id").cast("long")).withColumn("new", F.lit(1))
    rows = {row.column_name: row for row in schema_diff(before, after).collect()}
    assert {name: row.change for name, row in rows.items()} == {
        "id": "retyped",
        "name": "removed",
        "amount": "same",
        "new": "added",
    }
    assert (rows["id"].type_before, rows["id"].type_after) == ("int", "bigint")
    assert (rows["name"].filled_before, rows["name"].filled_after) == (1, None)
    assert rows["new"].filled_after == 2


def test_metrics_on_both_sides(spark):
    before = frame(spark, (1, "a", Decimal("10.00")), (2, "b", Decimal("30.00")))
    after = frame(spark, (1, "a", Decimal("10.00")), (2, "b", Decimal("31.60")))
    metrics = {"rows": F.count("*"), "amount": F.sum("amount"), "none": F.sum(F.lit(0))}
    rows = {row.metric: row for row in metric_diff(before, after, metrics).collect()}
    assert rows["rows"]["shift"] == 0 and rows["rows"].shift_pct == 0.0
    assert rows["amount"]["shift"] == Decimal("1.60") and rows["amount"].shift_pct == 4.0
    assert rows["none"].shift_pct is None
