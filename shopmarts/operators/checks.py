"""Data-quality checks as Spark jobs.

Every check yields ``(check_name, rows_checked, failures)``, one row also when its table is empty.
The not-null and accepted-value checks of a table share one scan, and so do its uniqueness checks, which
shuffle hashes instead of values. Uniqueness and relationship checks count per value before they
compare, so a value that fills a third of the table stays cheap.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULT = "check_name string, rows_checked bigint, failures bigint"


def stack(results: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, results)


def _name(kind: str, model: str, column: str) -> str:
    return f"{kind} {model}.{column}"


def _unpivot(counted: DataFrame, names: list[str], checked: list[str], failed: list[str]) -> DataFrame:
    """One output row per check, out of the single row that counted them all."""
    results = [
        F.struct(
            F.lit(name).alias("check_name"),
            F.col(rows).alias("rows_checked"),
            F.col(bad).alias("failures"),
        )
        for name, rows, bad in zip(names, checked, failed, strict=True)
    ]
    return counted.select(F.inline(F.array(*results)))


def _hash(table: DataFrame, column: str) -> Column:
    """64 bits that tell values apart. Whole numbers are their own, and take less room in a shuffle."""
    whole = isinstance(table.schema[column].dataType, T.IntegralType)
    return F.col(column).cast("bigint") if whole else F.xxhash64(column)


def hash_counts(model: str, table: DataFrame, columns: list[str]) -> DataFrame:
    """``check_name, hash`` over all given columns in one pass. NULL is no value."""
    return _hashes(table, "check_name", {_name("unique", model, c): c for c in columns})


def _hashes(table: DataFrame, label: str, columns: dict[Any, str]) -> DataFrame:
    hashes = [
        F.struct(
            F.lit(known_as).alias(label),
            F.when(F.col(c).isNotNull(), _hash(table, c)).alias("hash"),
        )
        for known_as, c in columns.items()
    ]
    return table.select(F.inline(F.array(*hashes))).where("hash IS NOT NULL")


def unique(declared: dict[str, list[str]], models: dict[str, DataFrame]) -> DataFrame:
    """Failures are values that occur more than once, in the declared columns of each model.

    One job reads every model once and counts 64-bit hashes. A hash that occurs once belongs to a value
    that does; only where one is repeated are the values themselves compared, and only those with such
    a hash. That first job runs when this is called, and one row a check comes back from it.
    """
    names = {_name("unique", model, c): (model, c) for model, columns in declared.items() for c in columns}
    # Checks go by their numbers: beside so many hashes a name would fill the tasks' memory.
    number = {check: i for i, check in enumerate(names.values())}
    hashes = stack(
        _hashes(models[model], "check", {number[model, c]: c for c in columns})
        for model, columns in declared.items()
    )
    counts = hashes.groupBy("check", "hash").agg(F.count("*").alias("n"))
    seen = counts.groupBy("check").agg(
        F.sum("n").alias("rows_checked"), F.count_if(F.col("n") > 1).alias("repeated")
    )
    found = {row["check"]: row for row in seen.collect()}
    spark = hashes.sparkSession
    settled, open_checks = [], []
    for i, (name, (model, column)) in enumerate(names.items()):
        rows, repeated = found[i][1:] if i in found else (0, 0)
        if not repeated:
            settled.append((name, rows, 0))
        else:
            open_checks.append(_repeated_values(name, models[model], column, rows))
    return stack([spark.createDataFrame(settled, RESULT), *open_checks])


def _repeated_values(name: str, table: DataFrame, column: str, rows: int) -> DataFrame:
    hashed = table.where(F.col(column).isNotNull()).select(column, _hash(table, column).alias("hash"))
    again = hashed.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
    values = hashed.join(again, "hash", "left_semi").groupBy(column).agg(F.count("*").alias("n"))
    return values.agg(
        F.lit(name).alias("check_name"),
        F.lit(rows).cast("bigint").alias("rows_checked"),
        F.count_if(F.col("n") > 1).alias("failures"),
    )


def scan(
    model: str,
    table: DataFrame,
    not_null: Iterable[str] = (),
    accepted: dict[str, list[str]] | None = None,
) -> DataFrame:
    """All not-null and accepted-value checks of a table in one pass. NULL is an accepted value."""
    bad: dict[str, Column] = {_name("not_null", model, c): F.col(c).isNull() for c in not_null}
    for column, values in (accepted or {}).items():
        bad[_name("accepted_values", model, column)] = ~F.col(column).isin(values)
    failed = [f"bad_{i}" for i in range(len(bad))]
    counted = table.agg(
        F.count("*").alias("rows"),
        *[F.count_if(test).alias(name) for name, test in zip(failed, bad.values(), strict=True)],
    )
    return _unpivot(counted, list(bad), ["rows"] * len(bad), failed)


def relationship(
    model: str, child: DataFrame, column: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    """Failures are child rows whose key has no parent row. NULL points nowhere and passes."""
    per_key = (
        child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    )
    known = parent.select(F.col(parent_key).alias("_known")).distinct()
    matched = per_key.join(known, F.col(column) == F.col("_known"), "left")
    orphans = F.sum(F.when(F.col("_known").isNull(), F.col("n")))
    return matched.agg(
        F.lit(_name("relationships", model, column)).alias("check_name"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_checked"),
        F.coalesce(orphans, F.lit(0)).alias("failures"),
    )


def inexact_money(model: str, table: DataFrame) -> DataFrame:
    """The mart's ``*_eur`` columns with their types: any that is not DECIMAL fails in every row.

    The verdict depends on the declared type alone; the row count shows how much money it covers.
    """
    money = [field for field in table.schema if field.name.endswith("_eur")]
    results = [
        F.struct(
            F.lit(model).alias("table_name"),
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString().upper()).alias("data_type"),
            F.col("rows").alias("rows_checked"),
            (F.lit(0) if isinstance(field.dataType, T.DecimalType) else F.col("rows"))
            .cast("bigint")
            .alias("failures"),
            F.lit(isinstance(field.dataType, T.DecimalType)).alias("is_exact"),
        )
        for field in money
    ]
    return table.agg(F.count("*").alias("rows")).select(F.inline(F.array(*results)))


def freshness(
    loaded: dict[str, DataFrame],
    load_second: Column,
    now_second: int,
    warn_after_hours: int = 36,
    error_after_hours: int = 72,
) -> DataFrame:
    """Age of the newest load of each table. A table never loaded is an error."""

    def verdict(name: str, table: DataFrame) -> DataFrame:
        latest = table.agg(F.max(load_second).alias("loaded_second"))
        age = F.lit(now_second) - F.col("loaded_second")
        status = (
            F.when(age <= warn_after_hours * 3600, "pass")
            .when(age <= error_after_hours * 3600, "warn")
            .otherwise("error")
        )
        return latest.select(
            F.lit(name).alias("table_name"),
            "loaded_second",
            age.cast("bigint").alias("age_seconds"),
            status.alias("status"),
        )

    return stack(verdict(name, table) for name, table in loaded.items())
