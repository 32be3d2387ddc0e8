"""Session settings the plans rely on, and the shared folder for written intermediates."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")

# Runtime settings only: memory, cores and shuffle width belong to the cluster.
SETTINGS = {
    "spark.sql.ansi.enabled": "true",  # an overflow is an error, never a wrapped number
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when the aggregate above then needs a shuffle of its own.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Options of the tables that are written in full. Text ids and wide keys, which Snappy leaves as they
# are, take about half the room.
STORED = {"compression": "zstd"}


def tune(spark: SparkSession) -> SparkSession:
    """Apply ``SETTINGS`` to a session made elsewhere and hand it back."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "12g"
) -> SparkSession:
    """A local session for tests and benches. Clusters bring their own and call ``tune``."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("shopmarts")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        # Call sites for error messages cost a few calls into the JVM for every column made.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, ``spark.checkpoint.dir``.

    A local session without one gets a new temporary folder; a cluster without one is an error,
    because executors could not read each other's files.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="shopmarts-")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unused folder below the shared one."""
    return os.path.join(shared_dir(spark), f"{purpose}-{uuid.uuid4().hex[:12]}")


def together(
    spark: SparkSession, jobs: dict[str, Callable[[], T]], width: int = 2
) -> dict[str, T]:
    """Run independent Spark jobs side by side, so that small ones fill what large ones leave idle.

    All are awaited; then the first failure, if any, is raised.
    """
    with ThreadPoolExecutor(max_workers=width) as pool:
        inherit = inheritable_thread_target(spark)
        running = {name: pool.submit(inherit(job)) for name, job in jobs.items()}
    return {name: job.result() for name, job in running.items()}
