"""The four raw feeds derived from the test tables; rules in FIXTURES.md."""

from pyspark.sql import DataFrame, SparkSession

# Fixed values of the derivation.
PLACES = [
    "New York, NY",
    "Boston, MA",
    "Los Angeles, CA",
    "Phoenix, AZ",
    "Miami, FL",
    "Denver, CO",
    "Chicago, IL",
    "Atlanta, GA",
    "Austin, TX",
    "Seattle, WA",
]
PAYMENTS = ["UPI", "Credit Card", "Debit Card", "Cash", " Wallet "]
DEVICES = ["mobile", "DESKTOP", "tablet", "smart-tv"]
ISSUES = ["Billing", "Delivery", "Refund", "Login"]
GUEST = "GUEST"  # no customer can have it: theirs are numbers

TABLES = {
    "customer": "c_custkey long, c_nationkey int",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, "
    "value double, props string",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _padded(number: str, width: int) -> str:
    """Digits padded with zeros to at least `width`; longer numbers stay whole."""
    text = f"cast({number} AS string)"
    return f"lpad({text}, greatest({width}, length({text})), '0')"


def _pick(values: list[str], index: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"get(array({listed}), cast({index} AS int))"


def _serial(moment: str) -> str:
    return f"cast(datediff({moment}, date'1899-12-30') AS double)"


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = "c_custkey"
    return _table(spark, sf_dir, "customer").selectExpr(
        f"{_padded(k, 5)} AS customer_id",
        f"CASE {k} % 50 WHEN 7 THEN null WHEN 8 THEN 'Mono' WHEN 9 THEN 'Mary Ann Last' || {k} "
        f"ELSE 'First' || c_nationkey || ' Last' || {k} END AS name",
        f"CASE WHEN {k} % 20 <> 3 THEN 'c' || {k} || '@example.com' END AS email",
        f"CASE WHEN {k} % 20 <> 4 THEN '555' || {_padded(k, 7)} END AS phone",
        f"cast(43831 + {k} % 1400 AS double) AS signup_date",
        f"CASE WHEN {k} % 40 = 5 THEN 'Nowhere' ELSE {_pick(PLACES, 'c_nationkey % 10')} END "
        "AS location",
    )


def transactions(spark: SparkSession, sf_dir: str, corrected: bool = False) -> DataFrame:
    """`corrected`: the table as sent again later, with 1.00 more for every finished order."""
    k, amount = "o_orderkey", "cast(o_totalprice AS decimal(18,2))"
    if corrected:
        more = f"cast({amount} + 1 AS decimal(18,2))"
        amount = f"CASE WHEN o_orderstatus = 'F' THEN {more} ELSE {amount} END"
    payment = _pick(PAYMENTS, "cast(substring(o_orderpriority, 1, 1) AS int) - 1")
    return _table(spark, sf_dir, "orders").selectExpr(
        f"{_padded(k, 6)} AS transaction_id",
        f"CASE WHEN {k} % 97 = 0 OR o_custkey % 25 = 0 THEN '{GUEST}' "
        f"ELSE {_padded('o_custkey', 5)} END AS customer_id",
        f"{_serial('o_orderdate')} + 8218 AS transaction_date",
        f"CASE WHEN {k} % 101 <> 0 THEN {amount} END AS amount",
        f"{payment} AS payment_method",
        f"CASE WHEN {k} % 60 = 11 THEN 'Nowhere' ELSE {_pick(PLACES, f'{k} % 10')} END "
        "AS store_location",
    )


def support(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = "event_id"
    seconds = "cast(floor(value * 3600) AS bigint)"
    events = _table(spark, sf_dir, "events").where("event_type = 'error'")
    return events.selectExpr(
        f"'T' || {_padded(k, 6)} AS ticket_id",
        f"CASE WHEN {k} % 89 = 0 THEN '{GUEST}' ELSE {_padded('user_id', 5)} END AS customer_id",
        "ts AS created_at",
        f"CASE WHEN {k} % 53 <> 0 THEN ts + INTERVAL '1' SECOND * {seconds} END AS resolved_at",
        f"CASE WHEN {k} % 31 <> 0 THEN {_pick(ISSUES, f'{k} % 4')} END AS issue_type",
        f"CASE WHEN {k} % 37 <> 0 THEN cast(({k} % 9) / 2 + 1 AS decimal(3,1)) END "
        "AS satisfaction_score",
    )


def web(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = "event_id"
    events = _table(spark, sf_dir, "events").where("event_type IN ('view', 'click')")
    return events.selectExpr(
        f"'s' || {k} AS session_id",
        f"{_padded('user_id', 5)} AS customer_id",
        "cast(get_json_object(props, '$.k') AS bigint) + 1 AS page_views",
        "cast(floor(value) AS bigint) AS session_duration",
        f"{_pick(DEVICES, f'{k} % 4')} AS device",
        f"CASE WHEN {k} % 61 <> 0 THEN {_serial('ts')} END AS interaction_date",
    )
