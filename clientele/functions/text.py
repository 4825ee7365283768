"""Text expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# How a 'City, ST' text splits.
CITY_PATTERN = r"^([^,]+),\s*[A-Z]{2}$"
STATE_PATTERN = r",\s*([A-Z]{2})$"


def extract_or(c: Column, pattern: str, default: str) -> Column:
    """First regex group, or `default` when the text is null or does not match."""
    return F.coalesce(F.nullif(F.regexp_extract(c, pattern, 1), F.lit("")), F.lit(default))


def token(c: Column, i: int, default: str) -> Column:
    """The i-th blank-separated token; a missing token gives `default`."""
    return F.coalesce(F.get(F.split(c, " "), i), F.lit(default))


def comma_part(c: Column, n: int) -> Column:
    """The n-th comma-separated part, trimmed; '' when missing, null for null."""
    return F.trim(F.split_part(c, F.lit(","), F.lit(n)))


def initcap_punct(c: Column) -> Column:
    """Capitalise every run of letters and digits, so 'smart-tv' gives 'Smart-Tv'.

    `F.initcap` starts a word at blanks only.
    """
    runs = F.regexp_extract_all(c, F.lit(r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def business_key(c: Column) -> Column:
    """A key as joined on: text, trimmed, upper case."""
    return F.upper(F.trim(c.cast("string")))
