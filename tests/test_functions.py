from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shopmarts.functions.money import cents_to_eur, ratio, total
from shopmarts.functions.text import sentence_case
from shopmarts.functions.time import hour_boundaries, load_second, month_start
from tests.conftest import at


def one(spark, column, **values):
    """The value of a column expression over one row; a value is (python value, type)."""
    row = tuple(value for value, _ in values.values())
    schema = ", ".join(f"{name} {kind}" for name, (_, kind) in values.items())
    return spark.createDataFrame([row], schema).select(column.alias("r")).first().r


def test_euros_of_a_compound_expression(spark):
    margin = cents_to_eur(F.col("a") - F.col("b"))
    assert one(spark, margin, a=(1450, "bigint"), b=(650, "bigint")) == Decimal("8.00")


def test_euros_keep_their_type_and_half_cent_totals(spark):
    frame = spark.range(3).select(cents_to_eur(F.lit(310450)).alias("e"))
    assert frame.schema["e"].dataType.simpleString() == "decimal(18,2)"
    assert frame.agg(total(F.col("e")).alias("t")).first().t == Decimal("9313.50")


def test_cents_above_an_int(spark):
    product = F.col("q").cast("bigint") * F.col("p")
    assert one(spark, cents_to_eur(product), q=(6, "int"), p=(2**31, "bigint")) == Decimal(
        "128849018.88"
    )


@settings(max_examples=20, deadline=None)
@given(st.lists(st.integers(-(10**12), 10**12), min_size=1, max_size=30))
def test_summing_euros_equals_summing_cents(spark, cents):
    frame = spark.createDataFrame([(c,) for c in cents], "c bigint")
    got = frame.agg(total(cents_to_eur(F.col("c"))).alias("t")).first().t
    assert got == Decimal(sum(cents)) / 100


@pytest.mark.parametrize(
    ("code", "label"),
    [
        ("mobile_app", "Mobile app"),
        ("LIGHT", "Light"),
        ("", ""),
        (None, None),
        ("a", "A"),
        ("_x", " x"),
    ],
)
def test_sentence_case(spark, code, label):
    assert one(spark, sentence_case(F.col("c")), c=(code, "string")) == label


@pytest.mark.parametrize(
    ("start", "end", "hours"),
    [
        ("2026-03-01 10:59", "2026-03-01 11:01", 1),
        ("2026-03-01 11:00", "2026-03-01 11:59", 0),
        ("2026-03-01 11:01", "2026-03-01 10:59", -1),
        ("2026-02-28 23:30", "2026-03-01 00:30", 1),
        ("2026-03-01 10:00", "2026-03-04 09:59", 71),
        ("2026-03-01 10:00", None, None),
    ],
)
def test_hour_boundaries(spark, start, end, hours):
    crossed = hour_boundaries(F.col("a"), F.col("b"))
    values = {"a": (at(start), "timestamp_ntz"), "b": (at(end), "timestamp_ntz")}
    assert one(spark, crossed, **values) == hours


def test_time_helpers_ignore_the_session_zone(spark):
    moment = (at("2026-03-29 02:30"), "timestamp_ntz")  # does not exist in Brussels
    later = (at("2026-03-29 04:10"), "timestamp_ntz")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "Europe/Brussels", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", name)
            assert one(spark, month_start(F.col("a")), a=moment) == at("2026-03-01")
            assert one(spark, hour_boundaries(F.col("a"), F.col("b")), a=moment, b=later) == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_ratio_over_zero_is_null(spark):
    share = ratio(F.col("a"), F.col("b"))
    assert one(spark, share, a=(1, "bigint"), b=(0, "bigint")) is None
    assert one(spark, share, a=(1, "bigint"), b=(4, "bigint")) == 0.25


def test_load_second(spark):
    assert one(spark, load_second(F.col("l")), l=("1788961669.673802", "string")) == 1788961669
