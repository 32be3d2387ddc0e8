"""Zone-free helpers for ``timestamp_ntz`` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hour_boundaries(start: Column, end: Column) -> Column:
    """Whole-hour marks crossed from ``start`` to ``end``: 10:59 to 11:01 is 1, backwards is negative."""
    days = F.datediff(F.to_date(end), F.to_date(start)).cast("bigint")
    return days * 24 + F.hour(end) - F.hour(start)


def month_start(moment: Column) -> Column:
    """First instant of the month. ``date_trunc`` would go through the session time zone."""
    return F.trunc(F.to_date(moment), "month").cast("timestamp_ntz")


def load_second(load_id: Column) -> Column:
    """Epoch second of a load id such as ``1788961669.673802``."""
    return F.split_part(load_id, F.lit("."), F.lit(1)).cast("bigint")
