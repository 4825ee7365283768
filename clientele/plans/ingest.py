"""Feed to raw row: serial dates become timestamps, 'City, ST' texts are split."""

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.functions.temporal import serial_to_timestamp
from clientele.functions.text import CITY_PATTERN, STATE_PATTERN, extract_or
from clientele.sources.audit import with_audit

ACTOR = "INGEST_PIPELINE"


def _dated(df: DataFrame, column: str) -> DataFrame:
    """Serial days to timestamp; a column that already is a date or timestamp is kept."""
    c = F.col(column)
    dated = isinstance(df.schema[column].dataType, T.DatetimeType)
    return df.withColumn(column, c.cast("timestamp_ntz") if dated else serial_to_timestamp(c))


def _located(df: DataFrame, column: str) -> DataFrame:
    return df.withColumns(
        {
            "city": extract_or(F.col(column), CITY_PATTERN, "Unknown"),
            "state_code": extract_or(F.col(column), STATE_PATTERN, "Unknown"),
        }
    )


def ingest_customers(df: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return with_audit(_located(_dated(df, "signup_date"), "location"), ACTOR, as_of).drop(
        "location"
    )


def ingest_transactions(df: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """`store_location` stays: the cleansing derives its own city and state from it."""
    return with_audit(
        _located(_dated(df, "transaction_date"), "store_location"), ACTOR, as_of
    )


def ingest_web(df: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return with_audit(_dated(df, "interaction_date"), ACTOR, as_of)


def ingest_support(df: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return with_audit(df, ACTOR, as_of)


INGEST = {
    "customers": ingest_customers,
    "transactions": ingest_transactions,
    "support": ingest_support,
    "web": ingest_web,
}
