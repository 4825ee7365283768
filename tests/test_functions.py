"""Edge cases of the column expressions."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from clientele.functions.lookups import (
    CUSTOMER_STATES,
    STORE_STATES,
    resolution_bucket,
    satisfaction_category,
    session_category,
    state_name,
)
from clientele.functions.numeric import mean, percent
from clientele.functions.temporal import (
    date_key,
    date_of,
    hour_boundaries,
    lenient_timestamp,
    serial_to_timestamp,
    whole_seconds,
)
from clientele.functions.text import (
    CITY_PATTERN,
    STATE_PATTERN,
    comma_part,
    extract_or,
    initcap_punct,
    token,
)


def one(spark, expr, value, ddl):
    return spark.createDataFrame([(value,)], f"v {ddl}").select(expr(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "name, first, last",
    [
        ("Cher", "Cher", "Unknown"),
        ("", "", "Unknown"),
        (None, "Unknown", "Unknown"),
        ("Mary Ann Smith", "Mary", "Ann"),
    ],
)
def test_name_tokens(spark, name, first, last):
    df = spark.createDataFrame([(name,)], "v string")
    row = df.select(token(F.col("v"), 0, "Unknown"), token(F.col("v"), 1, "Unknown")).first()
    assert tuple(row) == (first, last)


@pytest.mark.parametrize(
    "text, want",
    [
        ("ts: 2024-01-02 03:04:05.123456", datetime(2024, 1, 2, 3, 4, 5)),
        ("2024-01-02 03:04:05", datetime(2024, 1, 2, 3, 4, 5)),
        ("2024-01-02", datetime(2024, 1, 2)),
        ("x", None),
        (None, None),
    ],
)
def test_lenient_timestamp(spark, text, want):
    assert one(spark, lenient_timestamp, text, "string") == want


def test_whole_seconds(spark):
    full, cut = datetime(2024, 1, 2, 3, 4, 5, 999999), datetime(2024, 1, 2, 3, 4, 5)
    assert one(spark, whole_seconds, full, "timestamp_ntz") == cut


@pytest.mark.parametrize(
    "serial, want",
    [
        ("45292", datetime(2024, 1, 1)),
        ("45292.5", datetime(2024, 1, 1, 12)),
        ("0", datetime(1899, 12, 30)),
        ("bad", None),
        ("1e12", None),
        ("NaN", None),
        (None, None),
    ],
)
def test_serial_day(spark, serial, want):
    assert one(spark, serial_to_timestamp, serial, "string") == want


def test_serial_range(spark):
    late = "200000"  # in 2447
    assert one(spark, serial_to_timestamp, late, "string") == datetime(2447, 7, 30)
    assert one(spark, lambda c: serial_to_timestamp(c, strict=True), late, "string") is None


@pytest.mark.parametrize(
    "start, end, hours",
    [
        (datetime(2024, 1, 1, 10, 59), datetime(2024, 1, 1, 12, 1), 2),
        (datetime(2024, 1, 1, 10, 0), datetime(2024, 1, 1, 10, 59), 0),
        (datetime(2024, 1, 1, 23, 59), datetime(2024, 1, 2, 0, 0), 1),
        (datetime(2024, 1, 2), datetime(2024, 1, 1), -24),
    ],
)
def test_hour_boundaries(spark, start, end, hours):
    df = spark.createDataFrame([(start, end)], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(hour_boundaries(F.col("a"), F.col("b"))).first()[0] == hours


@pytest.mark.parametrize("d", [date(1677, 9, 22), date(2024, 2, 29), date(1999, 12, 31), None])
def test_date_key_is_reversible(spark, d):
    assert one(spark, lambda c: date_of(date_key(c)), d, "date") == d


@pytest.mark.parametrize(
    "text, want",
    [
        ("smart-tv x2 old_phone", "Smart-Tv X2 Old_Phone"),
        ("DESKTOP", "Desktop"),
        ("éCRAN plat", "Écran Plat"),
        ("", ""),
        (None, None),
    ],
)
def test_initcap_punct(spark, text, want):
    assert one(spark, initcap_punct, text, "string") == want


@pytest.mark.parametrize(
    "text, city, state",
    [
        ("Austin, TX", "Austin", "TX"),
        ("Austin,TX", "Austin", "TX"),
        ("Austin, tx", "Unknown", "Unknown"),
        ("Nowhere", "Unknown", "Unknown"),
        ("A, B, TX", "Unknown", "TX"),
        (None, "Unknown", "Unknown"),
    ],
)
def test_city_and_state(spark, text, city, state):
    df = spark.createDataFrame([(text,)], "v string")
    v = F.col("v")
    row = df.select(
        extract_or(v, CITY_PATTERN, "Unknown"), extract_or(v, STATE_PATTERN, "Unknown")
    ).first()
    assert tuple(row) == (city, state)


def test_comma_part(spark):
    assert one(spark, lambda c: comma_part(c, 2), "Austin ,  TX ", "string") == "TX"
    assert one(spark, lambda c: comma_part(c, 2), "Boston", "string") == ""
    assert one(spark, lambda c: comma_part(c, 1), None, "string") is None


def test_washington_is_known_to_stores_only(spark):
    assert one(spark, lambda c: state_name(c, STORE_STATES), "WA", "string") == "Washington"
    assert one(spark, lambda c: state_name(c, CUSTOMER_STATES), "WA", "string") == "Unknown"
    assert one(spark, lambda c: state_name(c, STORE_STATES), None, "string") == "Unknown"


@pytest.mark.parametrize(
    "seconds, want",
    [
        (0, "Unknown"),
        (1, "Short"),
        (10, "Short"),
        (11, "Medium"),
        (60, "Medium"),
        (61, "Long"),
        (120, "Long"),
        (121, "Very Long"),
        (180, "Very Long"),
        (181, "Unknown"),
    ],
)
def test_session_category(spark, seconds, want):
    assert one(spark, session_category, seconds, "int") == want


@pytest.mark.parametrize(
    "score, want",
    [(None, "Low"), ("1.5", "Low"), ("2", "Medium"), ("3.9", "Medium"), ("4", "High")],
)
def test_satisfaction_category(spark, score, want):
    score = score and Decimal(score)
    assert one(spark, satisfaction_category, score, "decimal(3,1)") == want


@pytest.mark.parametrize(
    "days, want",
    [
        ("0.5", "0-12 hours"),
        ("0.51", "12-24 hours"),
        ("1", "12-24 hours"),
        ("2", "1-2 days"),
        ("5", "2-5 days"),
        ("5.1", "5+ days"),
    ],
)
def test_resolution_bucket(spark, days, want):
    assert one(spark, resolution_bucket, Decimal(days), "decimal(10,2)") == want


def test_month_back_clamps(spark):
    assert one(spark, lambda c: F.add_months(c, -3), date(2024, 5, 31), "date") == date(
        2024, 2, 29
    )


@pytest.mark.parametrize(
    "part, whole, want",
    [(201, 20000, 1.01), (1, 8, 12.5), (1, 3, 33.33), (2, 3, 66.67), (-1, 3, -33.33), (1, 0, None)],
)
def test_percent_rounds_the_exact_quotient(spark, part, whole, want):
    df = spark.createDataFrame([(part, whole)], "a long, b long")
    assert df.select(percent(F.col("a"), F.col("b"))).first()[0] == want


def test_mean(spark):
    df = spark.createDataFrame([(Decimal("1.00"), 3)], "a decimal(18,2), b long")
    assert df.select(mean(F.col("a"), F.col("b"))).first()[0] == 0.333333
