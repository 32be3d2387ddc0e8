"""Set operations of an incremental load: what is new, which version wins, how it merges.

All of them are plain joins and windows on the key; none looks at a bucket, a file or a state.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopmarts.schemas import LOAD_ID, ROW_ID


def newest_per_key(batch: DataFrame, key: str, cursor: str) -> DataFrame:
    """One row per key, the one with the highest cursor; the rest of the row settles a tie.

    Spark keeps only the best row per key before it shuffles (``WindowGroupLimit``), so a key with
    very many versions costs one row per map task.
    """
    rest = [name for name in sorted(batch.columns) if name not in (key, cursor)]
    best_first = Window.partitionBy(key).orderBy(
        F.desc_nulls_last(cursor), *[F.desc_nulls_last(name) for name in rest]
    )
    ranked = batch.withColumn("_rank", F.row_number().over(best_first))
    return ranked.where("_rank = 1").drop("_rank")


def cursor_literal(mark: Any, kind: T.DataType) -> Column:
    """A collected cursor value as a literal of the cursor's type.

    A datetime literal passes through the operating system's time zone. That undoes what collecting a
    zoned time did; a time without a zone was not changed, so it goes by its text.
    """
    if isinstance(kind, T.TimestampNTZType):
        return F.lit(mark.isoformat(sep=" ")).cast(kind)
    return F.lit(mark)


def since(source: DataFrame, cursor: str, mark: Any | None) -> DataFrame:
    """Rows at or above the high-water mark; all rows when nothing was loaded before.

    A row changed without a newer cursor stays below the mark and is not seen again.
    """
    if mark is None:
        return source
    return source.where(F.col(cursor) >= cursor_literal(mark, source.schema[cursor].dataType))


def unseen(batch: DataFrame, on_mark: DataFrame, key: str, cursor: str) -> DataFrame:
    """The batch without the rows that sit exactly on the mark and were loaded with it.

    ``on_mark`` holds keys and cursors of the loaded rows on the mark, and no others.
    """
    loaded = on_mark.select(F.col(key).alias("_seen_key"), F.col(cursor).alias("_seen_cursor"))
    again = (F.col(key) == F.col("_seen_key")) & (F.col(cursor) == F.col("_seen_cursor"))
    return batch.join(loaded, again, "left_anti")


def newer(batch: DataFrame, target: DataFrame, key: str, cursor: str) -> DataFrame:
    """The batch without the rows of which the target holds a version at least as new."""
    held = target.select(F.col(key).alias("_held_key"), F.col(cursor).alias("_held_cursor"))
    as_new = (F.col(key) == F.col("_held_key")) & (F.col("_held_cursor") >= F.col(cursor))
    return batch.join(held, as_new, "left_anti")


def row_id(key: str, load_id: Column) -> Column:
    """A row's own id, which a replay of the load would repeat."""
    return F.md5(F.concat_ws("|", F.col(key).cast("string"), load_id).cast("binary"))


def with_lineage(table: DataFrame, load_id: str, key: str = "id") -> DataFrame:
    """The two lineage columns: the load, and the row id."""
    return table.withColumns({LOAD_ID: F.lit(load_id), ROW_ID: row_id(key, F.lit(load_id))})


def merge(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """The target with the batch's rows in place of its own. Columns new to either side read NULL
    in the other's rows; rows gone from the source stay."""
    kept = target.join(batch.select(key), key, "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True)
