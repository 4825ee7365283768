"""Number expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    """100 * part / whole, rounded half up from the exact quotient; null when whole is 0.

    Both inputs are counts. The division is decimal: a binary quotient can fall on the wrong
    side of a half.
    """
    whole = F.nullif(whole, F.lit(0)).cast("decimal(20,0)")
    return F.round(part.cast("decimal(20,0)") * 100 / whole, places).cast("double")


def mean(total: Column, count: Column, places: int = 6) -> Column:
    """total / count in double, from an exact total, so the order of rows does not show."""
    return F.round(total.cast("double") / count, places)
