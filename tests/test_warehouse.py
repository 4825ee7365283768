"""Streams from landing files to gold: equal to the batch, safe to restart, late customers heal."""

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

import pytest
from conftest import SF, values
from pyspark.sql import functions as F

from clientele import queries
from clientele.operators import files
from clientele.operators.runlog import run_history, run_logged
from clientele.plans.views import VIEWS
from clientele.schemas import BRONZE, LANDING
from clientele.streaming.warehouse import FEEDS, Warehouse

FOLDERS = {"recursiveFileLookup": "true"}


def landing_rows(spark, feed):
    return queries.INGEST[feed](queries.raw(spark, SF, feed)).select(LANDING[feed].names)


def drop(spark, folder, feed, name, rows):
    df = spark.createDataFrame(rows, LANDING[feed])
    df.coalesce(1).write.parquet(f"{folder}/{feed}/{name}")


@pytest.fixture
def landing(tmp_path):
    return {feed: f"{tmp_path}/landing/{feed}" for feed in FEEDS}


def test_two_drops_equal_the_batch(spark, tmp_path, landing):
    wh = Warehouse(spark, f"{tmp_path}/wh", buckets=3)
    for part in (0, 1):
        for feed in FEEDS:
            rows = landing_rows(spark, feed)
            key = F.xxhash64(rows.columns[0])
            half = rows.where(F.pmod(key, F.lit(2)) == part)
            half.coalesce(1).write.parquet(f"{landing[feed]}/drop{part}")
        wh.cycle(landing, **FOLDERS)
    gold, batch = wh.gold(), queries.star(spark, SF)
    for name in ("monthly_churn_and_retention", "churned_customers_by_location"):
        assert values(VIEWS[name](gold)) == values(VIEWS[name](batch)), name
    for name, form in queries.GOLD.items():
        keyless = [c for c in form(batch).columns if c != "customer_id" or name[4:] == "customers"]
        got = form(gold).select(keyless)
        assert values(got) == values(form(batch).select(keyless)), name
    # children point at the customer they belong to
    owners = gold.fact_transactions.join(
        gold.dim_customers, F.col("customer_id_sk") == F.col("customer_sk")
    )
    assert owners.count() == batch.fact_transactions.count()
    # nothing new: nothing happens
    before = {t: getattr(wh, "_silver")[t].manifest().version for t in FEEDS}
    bronze_rows = wh.bronze("web").count()
    wh.cycle(landing, **FOLDERS)
    assert {t: getattr(wh, "_silver")[t].manifest().version for t in FEEDS} == before
    assert wh.bronze("web").count() == bronze_rows == landing_rows(spark, "web").count()
    log = wh.history([f"merge_{feed}" for feed in FEEDS])
    assert log.count() == 8 and {r.status for r in log.collect()} == {"SUCCESS"}
    assert log.agg(F.sum("rows_processed")).first()[0] == sum(
        landing_rows(spark, feed).count() for feed in FEEDS
    )


AT = datetime(2024, 1, 5, 10)


def customer(i, name="A B"):
    return (i, name, None, None, AT, "Austin", "TX")


def ticket(i, customer, resolved=None):
    return (i, customer, AT, resolved, "Login", None)


def test_late_customer_and_correction_reach_gold(spark, tmp_path, landing):
    wh = Warehouse(spark, f"{tmp_path}/wh", buckets=2)
    folder = f"{tmp_path}/landing"
    drop(spark, folder, "customers", "a", [customer("c1")])
    drop(spark, folder, "support", "a", [ticket("T1", "c1"), ticket("T2", "c2")])
    feeds = {f: landing[f] for f in ("customers", "support")}
    wh.cycle(feeds, **FOLDERS)
    assert [r.ticket_id for r in wh.gold().dim_support.collect()] == ["T1"]
    assert wh.silver().support.where("customer_id_sk = -1").count() == 1

    drop(spark, folder, "customers", "b", [customer("c2"), customer("c1", "New Name")])
    drop(spark, folder, "support", "b", [ticket("T1", "c1", AT + timedelta(days=2))])
    wh.cycle(feeds, **FOLDERS)
    gold = wh.gold()
    tickets = {r.ticket_id: r for r in gold.dim_support.collect()}
    names = {r.customer_id: r.full_name for r in gold.dim_customers.collect()}
    assert sorted(tickets) == ["T1", "T2"]
    assert names == {"C1": "New Name", "C2": "A B"}
    assert tickets["T1"].resolved_date_sk == 20240107 and tickets["T2"].resolved_date_sk is None
    assert {r.date_id_sk for r in gold.dim_date.collect()} == {20240105, 20240107}


def test_strict_keeps_the_first_version(spark, tmp_path, landing):
    wh = Warehouse(spark, f"{tmp_path}/wh", buckets=2, strict=True)
    folder = f"{tmp_path}/landing"
    feeds = {f: landing[f] for f in ("customers", "support")}
    drop(spark, folder, "customers", "a", [customer("c1")])
    drop(spark, folder, "support", "a", [ticket("T1", "c1"), ticket("T2", "c2")])
    wh.cycle(feeds, **FOLDERS)
    assert wh.silver().support.where("customer_id_sk = 0").count() == 1
    drop(spark, folder, "customers", "b", [customer("c2"), customer("c1", "New Name")])
    drop(spark, folder, "support", "b", [ticket("T1", "c1", AT + timedelta(days=2))])
    wh.cycle(feeds, **FOLDERS)
    gold = wh.gold()
    (only,) = gold.dim_support.collect()
    assert (only.ticket_id, only.resolved_date_sk) == ("T1", 19700101)
    assert {r.full_name for r in gold.dim_customers.collect()} == {"A B"}


def test_rejects_and_bad_values(spark, tmp_path):
    wh = Warehouse(spark, f"{tmp_path}/wh", buckets=2, lengths={"customers": {"customer_id": 5}})
    folder = f"{tmp_path}/landing/customers"
    good = '{"customer_id": "c1", "signup_date": "2024-01-05", "state_code": "TX"}'
    lines = [
        good,
        '{"customer_id": "c2", "signup_date": "someday"}',
        '{"customer_id": "toolong", "signup_date": "2024-01-05"}',
        '{"customer_id": "c3"}',
    ]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(f"{folder}/a")
    wh.cycle({"customers": folder}, fmt="json", **FOLDERS)
    assert [r.customer_id for r in wh.silver().customers.collect()] == ["C1"]
    assert [r.customer_id for r in wh.rejects("load", "customers").collect()] == ["c2"]
    reasons = {r.customer_id: r._reason for r in wh.rejects("merge", "customers").collect()}
    assert reasons == {"TOOLONG": "customer_id longer than 5", "C3": "signup_date is null"}


def test_file_with_a_bad_row_is_skipped(spark, tmp_path):
    wh = Warehouse(spark, f"{tmp_path}/wh", buckets=2)
    folder = f"{tmp_path}/landing/web"
    row = '{"session_id": "%s", "customer_id": "c", "page_views": "%s"}'
    for name, views in (("a", ("1", "2")), ("b", ("3", "many"))):
        lines = [(row % (f"{name}{v}", v),) for v in views]
        spark.createDataFrame(lines, "value string").coalesce(1).write.text(f"{folder}/{name}")
    wh.load("web", folder, fmt="json", **FOLDERS).awaitTermination()
    assert sorted(r.session_id for r in wh.bronze("web").collect()) == ["a1", "a2"]
    assert wh.rejects("load", "web").count() == 2


def test_failed_merge_is_logged_raised_and_repeated(spark, tmp_path, landing, monkeypatch):
    wh = Warehouse(spark, f"{tmp_path}/wh", buckets=2)
    drop(spark, f"{tmp_path}/landing", "customers", "a", [customer("c1")])
    wh.load("customers", landing["customers"], **FOLDERS).awaitTermination()

    def broken(*_):
        raise RuntimeError("no luck")

    with monkeypatch.context() as m:
        m.setattr(wh, "_clean", broken)
        with pytest.raises(Exception, match="no luck"):
            wh.merge("customers").awaitTermination()
    assert wh.silver().customers.count() == 0
    wh.merge("customers").awaitTermination()
    assert wh.silver().customers.count() == 1
    log = wh.history(["merge_customers"]).orderBy("execution_start").collect()
    assert [(r.status, r.rows_processed) for r in log] == [("ERROR", None), ("SUCCESS", 1)]
    assert log[0].error_message == "no luck"


def test_bronze_has_audit_columns(spark, tmp_path, landing):
    wh = Warehouse(spark, f"{tmp_path}/wh")
    drop(spark, f"{tmp_path}/landing", "customers", "a", [customer("c1")])
    wh.load("customers", landing["customers"], **FOLDERS).awaitTermination()
    row = wh.bronze("customers").first()
    assert row.ingested_at is not None and row.created_by
    assert wh.bronze("customers").schema.names == BRONZE["customers"].names


def test_long_ids_all_arrive(spark, tmp_path, landing):
    """Orders of seven digits that share six, customers of six digits: no row is cut or set aside."""
    wh = Warehouse(spark, f"{tmp_path}/wh", buckets=2)
    folder = f"{tmp_path}/landing"
    drop(spark, folder, "customers", "a", [customer("123456"), customer("7")])
    orders = [(str(1_000_000 + k), "123456", "2024-01-05", "10", "UPI", "Austin, TX") for k in range(30)]
    spark.createDataFrame(orders, "a string, b string, c string, d string, e string, f string").toDF(
        *LANDING["transactions"].names[:6]
    ).coalesce(1).write.json(f"{folder}/transactions/a")
    wh.load("customers", landing["customers"], **FOLDERS).awaitTermination()
    wh.load("transactions", landing["transactions"], fmt="json", **FOLDERS).awaitTermination()
    for step in (wh.merge, wh.refresh):
        for feed in ("customers", "transactions"):
            step(feed).awaitTermination()
    assert wh.silver().transactions.count() == 30
    (best,) = VIEWS["customer_lifetime_value"](wh.gold()).collect()
    assert float(best[[c for c in best.__fields__ if "lifetime" in c][0]]) == 300.0
    assert not files.exists(spark, f"{tmp_path}/wh/rejects")


def test_runs_side_by_side_are_all_logged(spark, tmp_path):
    path = str(tmp_path / "log")

    def runs(task):
        for _ in range(6):
            run_logged(spark, path, task, 1, lambda: None)

    with ThreadPoolExecutor(3) as pool:
        list(pool.map(runs, ["a", "b", "c"]))
    assert run_history(spark, path, ["a", "b", "c"]).count() == 18


def test_a_log_that_cannot_be_written_changes_no_result(spark, tmp_path):
    blocked = tmp_path / "log"
    blocked.write_text("a file where the log's folder should be")
    done = []
    with pytest.warns(UserWarning, match="not in the log"):
        run_logged(spark, str(blocked), "a", 1, lambda: done.append(1))
    assert done == [1]

    def broken():
        raise RuntimeError("the task's own")

    with pytest.warns(UserWarning), pytest.raises(RuntimeError, match="the task's own"):
        run_logged(spark, str(blocked), "a", 1, broken)


def test_a_lost_checkpoint_loses_no_rows(spark, tmp_path, landing):
    wh = Warehouse(spark, f"{tmp_path}/wh", buckets=2)
    feeds = {"customers": landing["customers"]}
    drop(spark, f"{tmp_path}/landing", "customers", "a", [customer("c1")])
    wh.cycle(feeds, **FOLDERS)
    for task in ("load_customers", "merge_customers", "refresh_customers"):
        files.remove(spark, f"{tmp_path}/wh/checkpoints/{task}")
    files.remove(spark, f"{tmp_path}/landing/customers/a")
    drop(spark, f"{tmp_path}/landing", "customers", "b", [customer("c2")])
    wh.cycle(feeds, **FOLDERS)
    assert {r.customer_id for r in wh.gold().dim_customers.collect()} == {"C1", "C2"}


def test_a_broken_file_is_set_aside_and_the_others_are_loaded(spark, tmp_path, landing):
    wh = Warehouse(spark, f"{tmp_path}/wh", buckets=2)
    folder = f"{tmp_path}/landing"
    drop(spark, folder, "customers", "a", [customer(f"c{k}") for k in range(50)])
    files.copy_start(spark, f"{folder}/customers/a", f"{folder}/customers/cut", 0.7)
    (tmp_path / "landing/customers/junk").mkdir()
    (tmp_path / "landing/customers/junk/x.parquet").write_bytes(b"PAR1 this is no table PAR1")
    # a damaged page behind a good footer
    (whole,) = (tmp_path / "landing/customers/a").glob("*.parquet")
    data = bytearray(whole.read_bytes())
    data[60:90] = b"\xff" * 30
    (tmp_path / "landing/customers/page").mkdir()
    (tmp_path / "landing/customers/page/x.parquet").write_bytes(data)
    wh.load("customers", landing["customers"], **FOLDERS).awaitTermination()
    assert sorted(r.customer_id for r in wh.bronze("customers").collect()) == sorted(f"c{k}" for k in range(50))
    broken = wh.rejects("quarantine", "customers").collect()
    assert sorted(r.path.split("/")[-2] for r in broken) == ["cut", "junk", "page"] and all(r.error for r in broken)
    # later files come in, the broken ones do not come again
    drop(spark, folder, "customers", "b", [customer("late")])
    wh.load("customers", landing["customers"], **FOLDERS).awaitTermination()
    assert wh.bronze("customers").count() == 51 and wh.rejects("quarantine", "customers").count() == 3


def test_types_may_widen_and_columns_come_and_go(spark, tmp_path, landing):
    wh = Warehouse(spark, f"{tmp_path}/wh", buckets=2)
    at = "timestamp_ntz'2024-01-05 10:00:00' AS interaction_date"
    for name, columns in (
        ("a", f"'s1' AS session_id, 'c' AS customer_id, 3 AS page_views, 10L AS session_duration, 'x' AS device, {at}"),
        ("b", f"'s2' AS session_id, 'c' AS customer_id, 4L AS page_views, 10 AS session_duration, {at}, 1 AS extra"),
        ("c", f"'s3' AS session_id, 'c' AS customer_id, 4.6BD AS page_views, 'y' AS device, {at}"),
    ):
        spark.range(1).selectExpr(*columns.split(", ")).coalesce(1).write.parquet(f"{landing['web']}/{name}")
    wh.load("web", landing["web"], **FOLDERS).awaitTermination()
    got = {r.session_id: (r.page_views, r.session_duration, r.device) for r in wh.bronze("web").collect()}
    assert got == {"s1": (3, 10, "x"), "s2": (4, 10, None), "s3": (5, None, "y")}
