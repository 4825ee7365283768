"""Cleansing rules on hand-made rows."""

from datetime import date, datetime
from decimal import Decimal

from clientele.plans.ingest import ingest_customers, ingest_transactions, ingest_web
from clientele.plans.silver import (
    clean_customers,
    clean_support,
    clean_transactions,
    clean_web,
)
from clientele.schemas import BRONZE, RAW

NOON = datetime(2024, 2, 1, 12)
STAMPS = (NOON, NOON, "me", "me")


def bronze(spark, feed, *rows):
    return spark.createDataFrame([(*r, *STAMPS) for r in rows], BRONZE[feed])


def test_customer_defaults_and_unknown_state(spark):
    rows = clean_customers(
        bronze(
            spark,
            "customers",
            (" c1 ", None, None, None, NOON, None, "Unknown"),
            ("c2", "A B", "a@b", "1", NOON, "Seattle", "WA"),
        )
    ).collect()
    a, b = sorted(rows, key=lambda r: r.customer_id)
    assert (a.customer_id, a.first_name, a.last_name) == ("C1", "Unknown", "Unknown")
    assert (a.email, a.phone, a.city) == ("unknown@example.com", "0000000000", "Unknown")
    assert (a.state_code, a.state_name) == ("XX", "Unknown")
    assert (b.state_code, b.state_name, b.signup_date) == ("WA", "Unknown", date(2024, 2, 1))


def test_transactions_from_loaded_text(spark):
    good = "ts: 2024-01-02 03:04:05.123456"
    df = clean_transactions(
        bronze(
            spark,
            "transactions",
            (" 1234567 ", " c1 ", good, "10.5", " Cash ", "Boston"),
            ("2", "c1", good, "1", "UPI", "Austin, tx"),
            ("3", "c1", "x", "1", "UPI", "Austin, TX"),
            ("4", "c1", good, "abc", "UPI", "Austin, TX"),
            ("5", "c1", good, "1", "UPI", None),
            ("6", None, good, "1", "UPI", "Austin, TX"),
            ("7", "c1", good, "1", None, "Austin, TX"),
            ("8", "c1", good, "1", "UPI", "Seattle, WA"),
        )
    )
    rows = {r.transaction_id: r for r in df.collect()}
    assert sorted(rows) == ["1234567", "2", "8"]
    boston, austin, seattle = rows["1234567"], rows["2"], rows["8"]
    assert (boston.city, boston.state_code, boston.state) == ("Boston", "NA", "Unknown")
    assert (boston.customer_id, boston.payment_method) == ("C1", "Cash")
    assert boston.amount == Decimal("10.50")
    assert boston.transaction_date == datetime(2024, 1, 2, 3, 4, 5)
    assert (austin.city, austin.state_code, austin.state) == ("Austin", "TX", "Unknown")
    assert (seattle.state_code, seattle.state) == ("WA", "Washington")


def test_id_length_is_a_parameter(spark):
    raw = ("1234567", "c", "2024-01-01", "1", "UPI", "A, TX")
    for length, want in ((12, "1234567"), (None, "1234567"), (3, "123")):
        df = clean_transactions(bronze(spark, "transactions", raw), id_length=length)
        assert df.first().transaction_id == want


def test_support_open_ticket_and_score(spark):
    opened = datetime(2024, 1, 1, 10, 59)
    df = bronze(
        spark,
        "support",
        ("T1", "c1", opened, datetime(2024, 1, 1, 13, 1), None, Decimal("3.5")),
        ("T2", None, opened, None, "Login", None),
        ("T3", "c1", opened, opened, "Login", Decimal("1.5")),
    )
    t1, t2, t3 = clean_support(df).orderBy("ticket_id").collect()
    assert (t1.resolution_time_hours, t1.issue_type) == (Decimal("0.13"), "Unknown")
    assert (t1.satisfaction_score, t1.satisfaction_category) == (4, "Medium")
    assert (t2.customer_id, t2.resolved_at, t2.resolution_time_hours) == ("UNKNOWN", None, None)
    assert (t2.satisfaction_score, t2.satisfaction_category) == (0, "Low")
    assert (t3.satisfaction_score, t3.satisfaction_category) == (2, "Low")
    s1, s2, s3 = clean_support(df, strict=True).orderBy("ticket_id").collect()
    assert (s1.satisfaction_score, s1.satisfaction_category) == (4, "High")
    assert (s2.resolved_at, s2.resolution_time_hours) == (date(1970, 1, 1), Decimal("0.00"))
    assert s3.satisfaction_category == "Medium"


def test_web_requires_all_fields(spark):
    full = ("s1", " c1", 3, 61, "smart-tv", NOON)
    holes = [tuple(None if i == j else v for j, v in enumerate(full)) for i in range(6)]
    rows = clean_web(bronze(spark, "web", full, *holes)).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row.session_id, row.customer_id, row.device) == ("S1", "C1", "Smart-Tv")
    assert row.session_category == "Long"


def test_unknown_customer_keys(spark):
    customers = spark.createDataFrame([(7, "C1")], "customer_id_sk long, customer_id string")
    tx = bronze(
        spark,
        "transactions",
        ("1", " c1 ", "2024-01-01", "1", "UPI", "A, TX"),
        ("2", "zz", "2024-01-01", "1", "UPI", "A, TX"),
    )
    keys = {r.transaction_id: r.customer_sk for r in clean_transactions(tx, customers).collect()}
    assert keys == {"1": 7, "2": -1}
    tickets = bronze(spark, "support", ("T1", "zz", NOON, None, "x", None))
    assert clean_support(tickets, customers).first().customer_id_sk == -1
    assert clean_support(tickets, customers, strict=True).first().customer_id_sk == 0


def test_ingest_splits_places_and_dates(spark):
    raw = spark.createDataFrame(
        [("c1", "A B", None, None, 45292.25, "Austin, TX"), ("c2", None, None, None, None, "x")],
        RAW["customers"],
    )
    a, b = ingest_customers(raw, NOON).orderBy("customer_id").collect()
    assert (a.signup_date, a.city, a.state_code) == (datetime(2024, 1, 1, 6), "Austin", "TX")
    assert (b.signup_date, b.city, b.state_code) == (None, "Unknown", "Unknown")
    assert (a.ingested_at, a.created_by) == (NOON, "INGEST_PIPELINE")
    assert "location" not in a.asDict()


def test_ingest_keeps_dates_that_are_dates(spark):
    df = spark.createDataFrame([("s", NOON)], "session_id string, interaction_date timestamp_ntz")
    assert ingest_web(df, NOON).first().interaction_date == NOON
    tx = spark.createDataFrame(
        [("1", date(2024, 1, 1), "A, TX")],
        "transaction_id string, transaction_date date, store_location string",
    )
    row = ingest_transactions(tx, NOON).first()
    assert (row.transaction_date, row.city) == (datetime(2024, 1, 1), "A")
    assert row.store_location == "A, TX"
