"""Date and time expressions. Everything is zone-less, so no result depends on the session zone."""

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day zero of spreadsheet serial dates; the serial days of years 1 to 9999, and those
# that a nanosecond clock can hold.
SERIAL_ORIGIN = "1899-12-30"
SERIAL_MIN, SERIAL_MAX = -693593, 2958465
CLOCK_MIN, CLOCK_MAX = -81182, 132320


def serial_to_timestamp(c: Column, strict: bool = False) -> Column:
    """Spreadsheet serial day (fraction = time of day) to timestamp; unusable input gives null.

    `strict` takes the days of a nanosecond clock only.
    """
    first, last = (CLOCK_MIN, CLOCK_MAX) if strict else (SERIAL_MIN, SERIAL_MAX)
    days = c.try_cast("double")
    # to the nearest millisecond: a serial day holds a second only approximately
    millis = F.floor(days * 86_400_000 + 0.5)
    usable = F.when(days.between(first, last), millis)
    origin = F.lit(SERIAL_ORIGIN).cast("timestamp_ntz")
    return origin + F.lit(timedelta(milliseconds=1)) * usable


def lenient_timestamp(c: Column) -> Column:
    """Timestamp from text with leading junk or fractional seconds; unparsable text gives null."""
    # What is stripped before parsing.
    bare = F.regexp_replace(c.cast("string"), r"^[^0-9]+", "")
    bare = F.regexp_replace(bare, r"\.\d{3,9}", "")
    return bare.try_cast("timestamp_ntz")


def whole_seconds(c: Column) -> Column:
    """A timestamp without its fraction of a second."""
    # the session zone shifts by whole seconds, so it does not show in the remainder
    micros = F.pmod(F.unix_micros(c.cast("timestamp")), F.lit(1_000_000))
    return c - F.lit(timedelta(microseconds=1)) * micros


def hour_boundaries(start: Column, end: Column) -> Column:
    """Number of clock-hour boundaries crossed: 10:59 to 12:01 is 2."""
    return F.datediff(end, start) * 24 + F.hour(end) - F.hour(start)


def date_key(c: Column) -> Column:
    """Calendar key yyyymmdd of a date.

    The key is computed from the date, so a row gets it without a join with the calendar, it is
    the same in every batch, and its order is the order of dates.
    """
    return F.year(c) * 10000 + F.month(c) * 100 + F.day(c)


def date_of(key: Column) -> Column:
    """The date a calendar key stands for."""
    return F.make_date((key / 10000).cast("int"), (key / 100).cast("int") % 100, key % 100)
