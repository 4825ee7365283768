"""Audit columns."""

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def stamp(as_of: datetime | None = None) -> Column:
    """`as_of`, or the clock of the session."""
    if as_of is None:
        return F.localtimestamp()
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")


def session_now(spark: SparkSession) -> datetime:
    """The time that `stamp()` writes, in the zone of the session."""
    return spark.range(1).select(F.localtimestamp()).first()[0]


def with_audit(df: DataFrame, actor: str | None = None, as_of: datetime | None = None) -> DataFrame:
    """Add ingested_at, updated_at, created_by, updated_by. The actor defaults to the Spark user."""
    who = F.current_user() if actor is None else F.lit(actor)
    return df.withColumns(
        {
            "ingested_at": stamp(as_of),
            "updated_at": stamp(as_of),
            "created_by": who,
            "updated_by": who,
        }
    )
