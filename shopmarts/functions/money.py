"""Exact money: integer cents in, DECIMAL euros out, no float on the way."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

EURO = "decimal(18,2)"
EURO_TOTAL = "decimal(38,2)"  # a sum over any number of rows


def cents_to_eur(cents: Column) -> Column:
    """Euros of a cents expression. A Column is already one value, so precedence cannot bite."""
    return (cents.cast(EURO) * F.lit(Decimal("0.01"))).cast(EURO)


def total(amount: Column) -> Column:
    """``sum`` with the widest exact type, so partial sums can be summed again."""
    return F.sum(amount).cast(EURO_TOTAL)


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double; NULL when the whole is zero or NULL."""
    return part.cast("double") / F.nullif(whole, F.lit(0)).cast("double")
