"""Table schemas. Timestamps carry no zone; money is DECIMAL(18,2) so sums are exact in any order."""

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
SCORE = T.DecimalType(3, 1)
DAYS = T.DecimalType(10, 2)
_S, _L, _I, _TS, _D = (
    T.StringType(),
    T.LongType(),
    T.IntegerType(),
    T.TimestampNTZType(),
    T.DateType(),
)


def _struct(*fields):
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


AUDIT = [
    ("ingested_at", _TS),
    ("updated_at", _TS),
    ("created_by", _S),
    ("updated_by", _S),
]

# What the feeds deliver. Dates of three feeds are spreadsheet serial days.
RAW = {
    "customers": _struct(
        ("customer_id", _S),
        ("name", _S),
        ("email", _S),
        ("phone", _S),
        ("signup_date", T.DoubleType()),
        ("location", _S),
    ),
    "transactions": _struct(
        ("transaction_id", _S),
        ("customer_id", _S),
        ("transaction_date", T.DoubleType()),
        ("amount", MONEY),
        ("payment_method", _S),
        ("store_location", _S),
    ),
    "support": _struct(
        ("ticket_id", _S),
        ("customer_id", _S),
        ("created_at", _TS),
        ("resolved_at", _TS),
        ("issue_type", _S),
        ("satisfaction_score", SCORE),
    ),
    "web": _struct(
        ("session_id", _S),
        ("customer_id", _S),
        ("page_views", _L),
        ("session_duration", _L),
        ("device", _S),
        ("interaction_date", T.DoubleType()),
    ),
}

# What ingest leaves in the landing folders, without audit columns.
LANDING = {
    "customers": _struct(
        ("customer_id", _S),
        ("name", _S),
        ("email", _S),
        ("phone", _S),
        ("signup_date", _TS),
        ("city", _S),
        ("state_code", _S),
    ),
    "transactions": _struct(
        ("transaction_id", _S),
        ("customer_id", _S),
        ("transaction_date", _TS),
        ("amount", MONEY),
        ("payment_method", _S),
        ("store_location", _S),
        ("city", _S),
        ("state_code", _S),
    ),
    "support": RAW["support"],
    "web": _struct(
        ("session_id", _S),
        ("customer_id", _S),
        ("page_views", _L),
        ("session_duration", _L),
        ("device", _S),
        ("interaction_date", _TS),
    ),
}

# Loaded rows: typed source columns, then audit columns.
BRONZE = {
    "customers": _struct(
        ("customer_id", _S),
        ("name", _S),
        ("email", _S),
        ("phone", _S),
        ("signup_date", _TS),
        ("city", _S),
        ("state_code", _S),
        *AUDIT,
    ),
    "transactions": _struct(
        ("transaction_id", _S),
        ("customer_id", _S),
        ("transaction_date", _S),
        ("amount", _S),
        ("payment_method", _S),
        ("store_location", _S),
        *AUDIT,
    ),
    "support": _struct(
        ("ticket_id", _S),
        ("customer_id", _S),
        ("created_at", _TS),
        ("resolved_at", _TS),
        ("issue_type", _S),
        ("satisfaction_score", SCORE),
        *AUDIT,
    ),
    "web": _struct(
        ("session_id", _S),
        ("customer_id", _S),
        ("page_views", _L),
        ("session_duration", _L),
        ("device", _S),
        ("interaction_date", _TS),
        *AUDIT,
    ),
}

# Business key of each feed.
KEYS = {
    "customers": "customer_id",
    "transactions": "transaction_id",
    "support": "ticket_id",
    "web": "session_id",
}

# Surrogate key column of each silver table.
SURROGATES = {
    "customers": "customer_id_sk",
    "transactions": "transaction_id_sk",
    "support": "ticket_id_sk",
    "web": "session_id_sk",
}

# Cleansed columns of each silver table, without surrogate and stamps.
SILVER = {
    "customers": _struct(
        ("customer_id", _S),
        ("first_name", _S),
        ("last_name", _S),
        ("email", _S),
        ("phone", _S),
        ("city", _S),
        ("state_code", _S),
        ("state_name", _S),
        ("signup_date", _D),
    ),
    "transactions": _struct(
        ("transaction_id", _S),
        ("customer_id", _S),
        ("customer_sk", _L),
        ("transaction_date", _TS),
        ("amount", MONEY),
        ("payment_method", _S),
        ("city", _S),
        ("state", _S),
        ("state_code", _S),
    ),
    "support": _struct(
        ("ticket_id", _S),
        ("customer_id", _S),
        ("customer_id_sk", _L),
        ("created_at", _D),
        ("resolved_at", _D),
        ("resolution_time_hours", DAYS),
        ("issue_type", _S),
        ("satisfaction_score", _I),
        ("satisfaction_category", _S),
    ),
    "web": _struct(
        ("session_id", _S),
        ("customer_id", _S),
        ("customer_id_sk", _L),
        ("page_views", _I),
        ("session_duration", _I),
        ("device", _S),
        ("interaction_date", _TS),
        ("session_category", _S),
    ),
}

# Created / updated stamp columns of each silver table.
STAMPS = {
    "customers": ("created_at", "updated_at"),
    "transactions": ("created_timestamp", "updated_timestamp"),
    "support": ("created_timestamp", "updated_timestamp"),
    "web": ("created_timestamp", "updated_timestamp"),
}

# Gold. Calendar keys are yyyymmdd.
GOLD = {
    "dim_date": _struct(
        ("date_id_sk", _I),
        ("dates", _D),
        ("months", _I),
        ("month_name", _S),
        ("quarters", _I),
        ("years", _I),
        ("days", _S),
    ),
    "dim_customers": _struct(
        ("customer_sk", _L),
        ("customer_id", _S),
        ("first_name", _S),
        ("last_name", _S),
        ("full_name", _S),
        ("email", _S),
        ("phone", _S),
        ("city", _S),
        ("state_code", _S),
        ("state_name", _S),
        ("signup_date_sk", _I),
    ),
    "dim_support": _struct(
        ("ticket_sk", _L),
        ("ticket_id", _S),
        ("customer_id_sk", _L),
        ("created_date_sk", _I),
        ("issue_type", _S),
        ("resolution_time_days", DAYS),
        ("resolved_date_sk", _I),
        ("satisfaction_category", _S),
        ("satisfaction_score", _I),
    ),
    "dim_sessions": _struct(
        ("session_sk", _L),
        ("session_id", _S),
        ("customer_id_sk", _L),
        ("session_duration", _I),
        ("page_views", _I),
        ("interaction_date_sk", _I),
        ("device_type", _S),
        ("session_category", _S),
    ),
    "fact_transactions": _struct(
        ("transaction_id_sk", _L),
        ("transaction_id", _S),
        ("customer_id_sk", _L),
        ("support_id_sk", _L),
        ("session_id_sk", _L),
        ("transaction_date", _I),
        ("amount", MONEY),
        ("payment_method", _S),
        ("city", _S),
        ("state", _S),
        ("state_code", _S),
    ),
}

RUN_LOG = _struct(
    ("run_id", _S),
    ("task_name", _S),
    ("execution_start", _TS),
    ("execution_end", _TS),
    ("status", _S),
    ("rows_processed", _L),
    ("error_message", _S),
)
