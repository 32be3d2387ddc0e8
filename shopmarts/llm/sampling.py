"""Bounded samples for training, chosen by a hash of each row's key.

A threshold on the hash is a filter: no task sorts rows for it and none gathers them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _bound(count: Column, rows: int) -> Column:
    """So that about ``rows`` of ``count`` hashes lie below; four standard deviations fewer, so that
    more than ``rows`` hardly ever do."""
    aim = max(rows - 4 * math.sqrt(rows), rows / 2)
    share = F.least(F.lit(aim) / count, F.lit(1.0))
    top = F.lit(float((1 << 63) - 1024))  # the largest double below 2^63
    some = F.least(F.lit(-(2.0**63)) + share * F.lit(2.0**64), top).cast("bigint")
    return F.when(count <= rows, F.lit((1 << 63) - 1)).otherwise(some)


def bounded_sample(frame: DataFrame, key: str, rows: int) -> DataFrame:
    """At most ``rows`` rows; all if there are no more. The same ones whenever the keys are the same,
    unless one key has very many rows."""
    count = frame.count()
    if count <= rows:
        return frame
    return frame.where(F.xxhash64(key) <= _bound(F.lit(count), rows)).limit(rows)


def bounded_sample_by(frame: DataFrame, group: str, key: str, rows: int) -> DataFrame:
    """About ``rows`` rows of each group at most; all of a group that has no more.

    One number a group is broadcast, so groups are to be few, as languages are; no row is shuffled.
    """
    counts = frame.groupBy(group).agg(F.count("*").alias("_rows"))
    bounds = counts.select(group, _bound(F.col("_rows"), rows).alias("_bound"))
    return frame.join(F.broadcast(bounds), group).where(F.xxhash64(key) <= F.col("_bound")).drop("_bound")
