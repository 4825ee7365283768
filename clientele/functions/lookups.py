"""Lookup tables and bucket rules."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# State codes the customer feed knows. Washington is absent on purpose; the
# transaction feed knows it.
CUSTOMER_STATES = {
    "NY": "New York",
    "MA": "Massachusetts",
    "CA": "California",
    "AZ": "Arizona",
    "FL": "Florida",
    "CO": "Colorado",
    "IL": "Illinois",
    "GA": "Georgia",
    "TX": "Texas",
}
STORE_STATES = {**CUSTOMER_STATES, "WA": "Washington"}


def state_name(code: Column, states: dict[str, str]) -> Column:
    pairs = ", ".join(f"'{short}', '{name}'" for short, name in states.items())
    return F.coalesce(F.try_element_at(F.expr(f"map({pairs})"), code), F.lit("Unknown"))


def satisfaction_category(score: Column) -> Column:
    """A missing score counts as Low."""
    return F.when(score >= 4, "High").when(score >= 2, "Medium").otherwise("Low")


def session_category(seconds: Column) -> Column:
    return (
        F.when(seconds.between(1, 10), "Short")
        .when(seconds.between(11, 60), "Medium")
        .when(seconds.between(61, 120), "Long")
        .when(seconds.between(121, 180), "Very Long")
        .otherwise("Unknown")
    )


def resolution_bucket(days: Column) -> Column:
    return (
        F.when(days <= 0.5, "0-12 hours")
        .when(days <= 1, "12-24 hours")
        .when(days <= 2, "1-2 days")
        .when(days <= 5, "2-5 days")
        .otherwise("5+ days")
    )
