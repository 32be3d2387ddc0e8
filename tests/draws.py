"""Random draws that depend on nothing but a seed, a column name and a row's id.

``rand()`` changes with the partitioning; these do not, so the same ids give the same rows on any
cluster. Each draw is a 64-bit hash inside generated code.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

RANGE = 2.0**53


def base(row_id: Column, seed: int) -> Column:
    """The row's own 64-bit hash. Compute it once per row."""
    return F.xxhash64(row_id.cast("bigint"), F.lit(seed).cast("bigint"))


def uniform(row_base: Column, stream: str) -> Column:
    """Uniform in the open interval (0, 1)."""
    number = F.shiftrightunsigned(F.xxhash64(row_base, F.lit(stream)), 11)
    return (number + F.lit(0.5)) / F.lit(RANGE)


def whole(u: Column, low: int, high: int) -> Column:
    """Uniform whole number in ``low .. high``."""
    return (F.floor(u * float(high - low + 1)) + low).cast("bigint")


def chance(u: Column, rate: float) -> Column:
    return u < rate


def pick(u: Column, values: Sequence[str]) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), F.floor(u * float(len(values))).cast("int"))


def cuts(weights: Sequence[float]) -> list[float]:
    """Upper ends of the shares of (0, 1) that the weights ask for."""
    whole_weight, running, ends = sum(weights), 0.0, []
    for weight in weights:
        running += weight
        ends.append(running / whole_weight)
    return ends


def weighted(u: Column, weights: dict[str, float]) -> Column:
    names, ends = list(weights), cuts(list(weights.values()))
    choice = F.when(u < ends[0], names[0])
    for name, end in zip(names[1:-1], ends[1:-1], strict=True):
        choice = choice.when(u < end, name)
    return choice.otherwise(names[-1])


def exponential(u: Column, mean: float) -> Column:
    return F.log(F.lit(1.0) - u) * F.lit(-mean)


def lognormal(u: Column, angle: Column, median: float, spread: float) -> Column:
    """Two uniform draws make one normal one (Box and Muller)."""
    normal = F.sqrt(F.log(u) * -2.0) * F.cos(angle * (2.0 * math.pi))
    return F.exp(normal * spread) * median


def clipped(value: Column, low: int, high: int) -> Column:
    """Nearest whole number within the bounds."""
    return F.least(F.greatest(F.round(value), F.lit(float(low))), F.lit(float(high))).cast("bigint")


def skewed_rank(u: Column, parents: int, skew: float) -> Column:
    """A parent's rank in ``0 .. parents - 1``; the higher the skew, the more the low ranks get."""
    return F.least(
        F.floor(F.pow(u, F.lit(1.0 / (1.0 - skew))) * float(parents)), F.lit(parents - 1)
    ).cast("bigint")


def step(size: int) -> int:
    """A multiplier that shuffles ``0 .. size - 1``: it shares no factor with the size."""
    return next(prime for prime in (48271, 69621, 40693, 16807) if math.gcd(prime, size) == 1)


def shuffled(rank: Column, size: int) -> Column:
    """A one-to-one rearrangement of ``0 .. size - 1``, so that a rank says nothing about an id."""
    return F.pmod(rank * step(size), F.lit(size)).cast("bigint")
