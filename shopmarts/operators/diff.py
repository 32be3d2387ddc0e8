"""What a change does to a table: columns, rows and named figures of two builds side by side.

Rows are compared by counting equal ones on both sides, not by joining them. That treats NULL as
equal to NULL, works with and without a key, and cannot blow up on repeated rows: copies are
counted before the shuffle. Only a row's key and a digest of 128 bits are shuffled, however wide it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

METRIC = "decimal(38,6)"


def schema_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row per column of either side: its types, its filled values, and what happened to it."""

    def side(table: DataFrame, when: str) -> DataFrame:
        filled = table.agg(*[F.count(name).alias(name) for name in table.columns])
        facts = [
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(kind).alias(f"type_{when}"),
                F.col(name).alias(f"filled_{when}"),
            )
            for name, kind in table.dtypes
        ]
        return filled.select(F.inline(F.array(*facts)))

    old, new = F.col("type_before"), F.col("type_after")
    change = (
        F.when(old.isNull(), "added")
        .when(new.isNull(), "removed")
        .when(old != new, "retyped")
        .otherwise("same")
    )
    both = side(before, "before").join(side(after, "after"), "column_name", "full")
    return both.withColumn("change", change)


def _digest(columns: list[str]) -> list[Column]:
    """128 bits that stand for a row. A hash passes over NULLs, so where they are is hashed as well."""
    content = [F.col(name) for name in columns] + [F.col(name).isNull() for name in columns]
    return [F.xxhash64(F.lit(seed), *content).alias(f"_digest_{seed}") for seed in (1, 2)]


def _counted(before: DataFrame, after: DataFrame, key: str | None) -> DataFrame:
    """The distinct rows of both sides over the shared columns, as keys and digests, and how often
    each side has them."""
    shared = [name for name in before.columns if name in after.columns]

    def side(table: DataFrame, is_after: int) -> DataFrame:
        flags = [F.lit(1 - is_after).alias("_before"), F.lit(is_after).alias("_after")]
        return table.select(*shared, *flags)

    # The union comes first: it brings columns that were retyped to one type.
    both = side(before, 0).union(side(after, 1))
    named = [F.col(key).alias("_key")] if key else []
    short = both.select(*named, *_digest(shared), "_before", "_after")
    return short.groupBy(*short.columns[:-2]).agg(
        F.sum("_before").alias("_before"), F.sum("_after").alias("_after")
    )


def row_diff(before: DataFrame, after: DataFrame, key: str | None = None) -> DataFrame:
    """Row counts of both sides and how many rows differ, over the columns they share.

    With a key, a row gone on one side and back with other values on the other counts as changed;
    without one, it counts as removed and added.
    """
    counted = _counted(before, after, key)
    old, new = F.col("_before"), F.col("_after")
    differs = old != new
    # Equal rows fold into one group before the second shuffle; only differing ones keep their key.
    groups = [differs.alias("_differs")]
    if key:
        groups.append(F.when(differs, F.col("_key")).alias("_key"))
    per_key = counted.groupBy(*groups).agg(
        F.sum(old).alias("rows_before"),
        F.sum(new).alias("rows_after"),
        F.sum(F.greatest(old - new, F.lit(0))).alias("gone"),
        F.sum(F.greatest(new - old, F.lit(0))).alias("come"),
    )
    changed = F.least("gone", "come") if key else F.lit(0)
    figures = {
        "rows_before": F.col("rows_before"),
        "rows_after": F.col("rows_after"),
        "rows_changed": changed,
        "rows_removed": F.col("gone") - changed,
        "rows_added": F.col("come") - changed,
    }
    return per_key.agg(
        *[F.coalesce(F.sum(value), F.lit(0)).alias(name) for name, value in figures.items()]
    )


def metric_diff(before: DataFrame, after: DataFrame, metrics: dict[str, Column]) -> DataFrame:
    """Named aggregates evaluated on both sides, with the shift in percent of the old figure."""

    def side(table: DataFrame, alias: str) -> DataFrame:
        figures = table.agg(*[value.cast(METRIC).alias(name) for name, value in metrics.items()])
        pairs = [
            F.struct(F.lit(name).alias("metric"), F.col(name).alias(alias)) for name in metrics
        ]
        return figures.select(F.inline(F.array(*pairs)))

    old, new = F.col("value_before"), F.col("value_after")
    shift = (new - old).cast("double") / F.nullif(old, F.lit(0)).cast("double")
    return (
        side(before, "value_before")
        .join(side(after, "value_after"), "metric")
        .select(
            "metric",
            old,
            new,
            (new - old).cast(METRIC).alias("shift"),
            (shift * 100).alias("shift_pct"),
        )
    )
