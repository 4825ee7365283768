"""Bronze to silver: cleanse, categorise, attach the customer key.

`strict` reproduces load casts and placeholders that lose information; the default keeps the
evident intent. A customers table, when given, must be silver: one row per customer_id.
"""

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.functions.lookups import (
    CUSTOMER_STATES,
    STORE_STATES,
    satisfaction_category,
    session_category,
    state_name,
)
from clientele.functions.temporal import hour_boundaries, lenient_timestamp, whole_seconds
from clientele.functions.text import business_key, comma_part, initcap_punct, token
from clientele.operators.joins import lookup_join
from clientele.schemas import DAYS, MONEY

# What stands in for a missing entry.
NO_EMAIL = "unknown@example.com"
NO_PHONE = "0000000000"
NO_STATE = "XX"
NO_DATE = "1970-01-01"
UNKNOWN_CUSTOMER = -1
UNKNOWN_CUSTOMER_STRICT = 0  # tickets only

# Rows of these feeds are dropped when one of these is missing.
REQUIRED = {
    "transactions": [
        "transaction_id",
        "customer_id",
        "transaction_date",
        "amount",
        "payment_method",
        "store_location",
    ],
    "web": [
        "session_id",
        "customer_id",
        "page_views",
        "session_duration",
        "device",
        "interaction_date",
    ],
}


def _carried(df: DataFrame) -> list[str]:
    """The load time travels along, to order versions of a row."""
    return [c for c in ("ingested_at",) if c in df.columns]


def all_given(columns: list[str]) -> Column:
    """No column is null, in the form a scan can filter by."""
    return reduce(and_, [F.col(c).isNotNull() for c in columns])


def customer_key_column(customers: DataFrame) -> str:
    """The surrogate, or the business key of a table that has not been through the upsert."""
    return "customer_id_sk" if "customer_id_sk" in customers.columns else "customer_id"


def attach_customer(
    df: DataFrame,
    customers: DataFrame | None,
    name: str,
    missing: int = UNKNOWN_CUSTOMER,
    match: Callable[[Column], Column] = F.trim,
) -> DataFrame:
    """Add the customer's key as `name`; unknown customers get `missing`."""
    if customers is None:
        return df
    key = customer_key_column(customers)
    table = customers.select(match(F.col("customer_id")).alias("_match"), F.col(key).alias(name))
    joined = lookup_join(
        df.withColumn("_match", match(F.col("customer_id"))), table, "_match", "left"
    ).drop("_match")
    dtype = customers.schema[key].dataType
    return joined.withColumn(name, F.coalesce(name, F.lit(missing).cast(dtype)))


def clean_customers(df: DataFrame, strict: bool = False) -> DataFrame:
    name, code = F.col("name"), F.nullif(F.col("state_code"), F.lit("Unknown"))
    key = F.col("customer_id").cast("string") if strict else business_key(F.col("customer_id"))
    return df.select(
        key.alias("customer_id"),
        token(name, 0, "Unknown").alias("first_name"),
        token(name, 1, "Unknown").alias("last_name"),
        F.coalesce("email", F.lit(NO_EMAIL)).alias("email"),
        F.coalesce("phone", F.lit(NO_PHONE)).alias("phone"),
        F.coalesce("city", F.lit("Unknown")).alias("city"),
        F.coalesce(code, F.lit(NO_STATE)).alias("state_code"),
        state_name(code, CUSTOMER_STATES).alias("state_name"),
        F.to_date("signup_date").alias("signup_date"),
        *_carried(df),
    )


def clean_transactions(
    df: DataFrame,
    customers: DataFrame | None = None,
    strict: bool = False,
    id_length: int | None = None,
) -> DataFrame:
    """Rows without one of the six required fields are dropped.

    The id stays whole; `id_length` cuts it, for ids that carry a suffix of known place.
    """
    place, code = F.trim("store_location"), F.col("_code")
    key = F.trim("customer_id") if strict else business_key(F.col("customer_id"))
    when = F.col("transaction_date")
    # loaded rows carry the date as text; a typed one needs no parsing
    typed = isinstance(df.schema["transaction_date"].dataType, T.DatetimeType)
    when = whole_seconds(when.cast("timestamp_ntz")) if typed else lenient_timestamp(when)
    # raw columns are tested, so the filter does not evaluate what the projection computes
    given = df.where(all_given(REQUIRED["transactions"]))
    tx_id = F.trim("transaction_id")
    # a column of its own: used twice below, split once
    rows = given.withColumn("_code", comma_part(place, 2)).select(
        (tx_id if id_length is None else F.substring(tx_id, 1, id_length)).alias("transaction_id"),
        key.alias("customer_id"),
        when.alias("transaction_date"),
        F.col("amount").try_cast(MONEY).alias("amount"),
        F.trim("payment_method").alias("payment_method"),
        comma_part(place, 1).alias("city"),
        state_name(code, STORE_STATES).alias("state"),
        F.upper(F.coalesce(F.nullif(code, F.lit("")), F.lit("NA"))).alias("state_code"),
        *_carried(df),
    )
    if not typed:
        rows = rows.dropna(subset=["transaction_date"])
    if isinstance(df.schema["amount"].dataType, T.StringType):
        rows = rows.dropna(subset=["amount"])
    return attach_customer(rows, customers, "customer_sk")


def clean_support(
    df: DataFrame, customers: DataFrame | None = None, strict: bool = False
) -> DataFrame:
    """`resolution_time_hours` holds days: hour boundaries crossed / 24.

    An open ticket has no resolution date and time; strict gives it 1970-01-01 and 0.
    """
    score = F.col("satisfaction_score")
    days = hour_boundaries(F.col("created_at"), F.col("resolved_at")) / 24
    created, resolved = F.to_date("created_at"), F.to_date("resolved_at")
    key = business_key(F.col("customer_id"))
    if strict:
        key = F.col("customer_id").cast("string")
        score = F.round(score)
        days = F.coalesce(days, F.lit(0.0))
        created = F.coalesce(created, F.lit(NO_DATE).cast("date"))
        resolved = F.coalesce(resolved, F.lit(NO_DATE).cast("date"))
    rows = df.select(
        "ticket_id",
        F.coalesce(key, F.lit("UNKNOWN")).alias("customer_id"),
        created.alias("created_at"),
        resolved.alias("resolved_at"),
        F.round(days, 2).cast(DAYS).alias("resolution_time_hours"),
        F.coalesce("issue_type", F.lit("Unknown")).alias("issue_type"),
        F.coalesce(F.round(score).cast("int"), F.lit(0)).alias("satisfaction_score"),
        satisfaction_category(score).alias("satisfaction_category"),
        *_carried(df),
    )
    missing = UNKNOWN_CUSTOMER_STRICT if strict else UNKNOWN_CUSTOMER
    return attach_customer(rows, customers, "customer_id_sk", missing)


def clean_web(
    df: DataFrame, customers: DataFrame | None = None, strict: bool = False
) -> DataFrame:
    """All six fields are required."""
    seconds = F.col("session_duration").cast("int")
    key = F.upper("customer_id") if strict else business_key(F.col("customer_id"))
    rows = df.where(all_given(REQUIRED["web"])).select(
        F.upper("session_id").alias("session_id"),
        key.alias("customer_id"),
        F.col("page_views").cast("int").alias("page_views"),
        seconds.alias("session_duration"),
        initcap_punct(F.col("device")).alias("device"),
        F.col("interaction_date").cast("timestamp_ntz").alias("interaction_date"),
        session_category(seconds).alias("session_category"),
        *_carried(df),
    )
    return attach_customer(rows, customers, "customer_id_sk", match=F.upper)


CLEAN = {
    "customers": clean_customers,
    "transactions": clean_transactions,
    "support": clean_support,
    "web": clean_web,
}
