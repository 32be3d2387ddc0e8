"""The same load for a source that arrives as files: each micro-batch is one load.

Files come in any order and a backlog is split into several batches, so no row is judged by the
mark: the newest version of a key stays, whichever batch brought it. A batch that is replayed after
a failure finds its rows in the table and changes nothing; its load id is the same if the caller passes
the same epoch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shopmarts.plans.load import RawTable
from shopmarts.schemas import TableSpec


def land_new_files(
    spark: SparkSession,
    files: str,
    schema: T.StructType,
    raw_root: str,
    spec: TableSpec,
    checkpoint: str,
    epoch: int,
    derive: Callable[[DataFrame], DataFrame] = lambda batch: batch,
    files_per_batch: int = 1_000,
) -> StreamingQuery:
    """Load all files not seen by an earlier run, then stop. ``epoch`` is the load id's second.

    ``files_per_batch`` only says where a backlog is cut; all of it is loaded.
    """
    table = RawTable(spark, raw_root, spec)

    def land(batch: DataFrame, number: int) -> None:
        table.load(derive(batch), f"{epoch}.{number:06d}", in_order=False)

    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(files)
        .writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
