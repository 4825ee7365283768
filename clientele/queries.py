"""The registered queries: every transform and operator over whole test tables.

Frames here are composed lazily from the feeds, so a plan reaches down to the Parquet scans. A
table that has not been through the keyed upsert has no surrogates; its business keys stand in.
"""

import uuid
from collections.abc import Callable
from contextlib import suppress
from dataclasses import replace
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.functions.temporal import date_of
from clientele.operators import files, quality
from clientele.operators.joins import estimated_bytes
from clientele.operators.keyed_table import KeyedTable, Upkeep
from clientele.operators.rollup import Rollup
from clientele.operators.runlog import Run, run_history, run_logged
from clientele.operators.surrogate import assign_sk, dense_sk
from clientele.operators.upsert import (
    SPECS,
    buckets_for,
    empty_table,
    merge_rows,
    newest_per_key,
)
from clientele.plans.gold import build_gold
from clientele.plans.ingest import INGEST
from clientele.plans.silver import CLEAN
from clientele.plans.tables import Tables
from clientele.plans.views import VIEWS, register_views
from clientele.schemas import AUDIT
from clientele.session import scratch_dir, tune
from clientele.sources import feeds
from clientele.sources.audit import session_now, with_audit
from clientele.sources.readers import append_drop, append_raw, read_drops
from clientele.streaming.warehouse import Warehouse

Query = Callable[[SparkSession, str], DataFrame]

FIRST_LOAD = datetime(2024, 2, 1)
SECOND_LOAD = datetime(2024, 2, 2)
SECOND_MERGE = datetime(2024, 2, 2, 12)
BUCKETS = 64


def raw(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    return getattr(feeds, feed)(spark, sf_dir)


def bronze(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    return INGEST[feed](raw(spark, sf_dir, feed), FIRST_LOAD)


def silver(spark: SparkSession, sf_dir: str, feed: str, strict: bool = False) -> DataFrame:
    return CLEAN[feed](bronze(spark, sf_dir, feed), strict=strict).drop("ingested_at")


def star(spark: SparkSession, sf_dir: str, strict: bool = False) -> Tables:
    """Gold over the feeds."""

    def child(feed: str, linked: bool = False) -> DataFrame:
        # strict tickets and sessions reach customers through the key attached in silver
        customers = tables.customers if linked else None
        rows = CLEAN[feed](bronze(spark, sf_dir, feed), customers, strict=strict)
        return rows.drop("ingested_at")

    tables = Tables(
        customers=lambda: silver(spark, sf_dir, "customers", strict),
        transactions=lambda: child("transactions"),
        support=lambda: child("support", linked=strict),
        web=lambda: child("web", linked=strict),
    )
    return build_gold(tables, strict)


# ---- business-key forms of gold ----------------------------------------------------------------


def _dim_date(gold: Tables) -> DataFrame:
    return gold.dim_date.drop("date_id_sk")


def _dim_customers(gold: Tables) -> DataFrame:
    return gold.dim_customers.withColumn(
        "signup_date", date_of(F.col("signup_date_sk"))
    ).drop("customer_sk", "signup_date_sk")


def _dim_support(gold: Tables) -> DataFrame:
    return gold.dim_support.select(
        "ticket_id",
        F.col("customer_id_sk").alias("customer_id"),
        date_of(F.col("created_date_sk")).alias("created_date"),
        "issue_type",
        "resolution_time_days",
        date_of(F.col("resolved_date_sk")).alias("resolved_date"),
        "satisfaction_category",
        "satisfaction_score",
    )


def _dim_sessions(gold: Tables) -> DataFrame:
    return gold.dim_sessions.select(
        "session_id",
        F.col("customer_id_sk").alias("customer_id"),
        "session_duration",
        "page_views",
        date_of(F.col("interaction_date_sk")).alias("interaction_date"),
        "device_type",
        "session_category",
    )


def _fact_transactions(gold: Tables) -> DataFrame:
    return gold.fact_transactions.select(
        "transaction_id",
        F.col("customer_id_sk").alias("customer_id"),
        date_of(F.col("transaction_date")).alias("transaction_date"),
        "amount",
        "payment_method",
        "city",
        "state",
        "state_code",
    )


GOLD = {
    "dim_date": _dim_date,
    "dim_customers": _dim_customers,
    "dim_support": _dim_support,
    "dim_sessions": _dim_sessions,
    "fact_transactions": _fact_transactions,
}

# ---- operators ---------------------------------------------------------------------------------


def _linked(feed: str, id_column: str, key_column: str, strict: bool = False) -> Query:
    """Left join of a feed to its customers; the unknown member for no match."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        customers = silver(spark, sf_dir, "customers", strict)
        rows = CLEAN[feed](bronze(spark, sf_dir, feed), customers, strict=strict)
        return rows.select(id_column, F.col(key_column).alias("customer_key"))

    return query


def ticket_row_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    tickets = star(spark, sf_dir).dim_support.select("ticket_id")
    return dense_sk(tickets, "ticket_id", "ticket_sk")


def session_row_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    sessions = star(spark, sf_dir).dim_sessions.select("session_id")
    return dense_sk(sessions, "session_id", "session_sk")


def transaction_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, distinct surrogates and the smallest one, of the gap-tolerant assignment."""
    loaded = bronze(spark, sf_dir, "transactions")
    rows = CLEAN["transactions"](loaded, id_length=None).select("transaction_id")
    keyed = assign_sk(rows, "transaction_id", "transaction_id_sk", BUCKETS)
    return keyed.agg(
        F.count("*").alias("row_count"),
        F.count_distinct("transaction_id_sk").alias("distinct_keys"),
        F.min("transaction_id_sk").alias("smallest"),
    )


def upsert_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First the old transactions, then the whole table again with corrected amounts."""
    spec, clean = SPECS["transactions"], CLEAN["transactions"]
    # whole ids: cut ones would meet in a large table
    loaded = clean(bronze(spark, sf_dir, "transactions"), id_length=None)
    first = loaded.where("transaction_date < '2021-01-01'")
    corrected = feeds.transactions(spark, sf_dir, corrected=True)
    second = clean(INGEST["transactions"](corrected, SECOND_LOAD), id_length=None)
    table = merge_rows(empty_table(spark, spec), first, spec, BUCKETS, FIRST_LOAD)
    merged = merge_rows(table, second, spec, BUCKETS, SECOND_LOAD)
    return merged.drop("_bucket", spec.surrogate).withColumnRenamed("_change", "change")


def upsert_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First the early customers, then all of them twice in one batch; the newer row counts."""
    spec = SPECS["customers"]
    early = CLEAN["customers"](bronze(spark, sf_dir, "customers"))
    early = early.where("signup_date < '2022-01-01'")
    older = CLEAN["customers"](bronze(spark, sf_dir, "customers"))
    newer = CLEAN["customers"](
        INGEST["customers"](raw(spark, sf_dir, "customers"), SECOND_LOAD)
    ).withColumn("phone", F.concat(F.lit("1"), "phone"))
    second = newest_per_key(older.unionByName(newer), spec.key, "ingested_at")
    table = merge_rows(empty_table(spark, spec), early, spec, BUCKETS, FIRST_LOAD)
    merged = merge_rows(table, second, spec, BUCKETS, SECOND_MERGE)
    return merged.drop("_bucket", spec.surrogate).withColumnRenamed("_change", "change")


def _upsert_twice(feed: str, first: str, column: str, changed: str) -> Query:
    """First the rows that meet a condition, then all of them with a column changed."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        spec = SPECS[feed]
        early = CLEAN[feed](bronze(spark, sf_dir, feed)).where(first)
        again = CLEAN[feed](INGEST[feed](raw(spark, sf_dir, feed), SECOND_LOAD))
        again = again.withColumn(column, F.expr(changed).cast(again.schema[column].dataType))
        table = merge_rows(empty_table(spark, spec), early, spec, BUCKETS, FIRST_LOAD)
        merged = merge_rows(table, again, spec, BUCKETS, SECOND_MERGE)
        return merged.drop("_bucket", spec.surrogate).withColumnRenamed("_change", "change")

    return query


def _folder(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _in_small_batches(spark: SparkSession, sf_dir: str, batches: int) -> KeyedTable:
    """Half of the tickets in one load, then small batches, each of new ones and of corrections.

    A batch has its share of the other half, and as many of the first half again, of which only those
    without an issue differ.
    """
    upkeep = Upkeep(share=0.25, least_rows=1, most_folders=8)
    spec = SPECS["support"]
    spec = replace(spec, when_changed=("issue_type",))
    table = KeyedTable(spark, _folder(spark, "small-batches"), spec, 8, upkeep)
    whole = CLEAN["support"](bronze(spark, sf_dir, "support")).drop("ingested_at")
    whole = whole.withColumn("ingested_at", F.lit(FIRST_LOAD).cast("timestamp_ntz"))
    path = f"{table.path}-feed"
    number = F.expr("cast(substring(ticket_id, 2) as bigint)")
    whole.withColumn("part", F.pmod(F.floor(number / 2), F.lit(batches))).withColumn(
        "half", F.pmod(number, F.lit(2))
    ).write.parquet(path)
    rows = spark.read.parquet(path)
    table.upsert(rows.where("half = 0").drop("part", "half"), "load", 0, FIRST_LOAD)
    for k in range(batches):
        batch = rows.where(F.col("part") == k).drop("part", "half")
        batch = batch.withColumn("issue_type", F.coalesce("issue_type", F.lit("Other")))
        table.upsert(batch, "load", k + 1, SECOND_LOAD)
    return table


def upsert_small_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table after many small batches, some of them compacted."""
    table = _in_small_batches(spark, sf_dir, 20)
    return table.read().drop("ticket_id_sk", "customer_id_sk")


def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the feed of those batches holds: rows by kind of change and issue."""
    table = _in_small_batches(spark, sf_dir, 4)
    return table.changes().groupBy("_change", "issue_type").agg(F.count("*").alias("row_count")).select(
        F.col("_change").alias("change"), "issue_type", "row_count"
    )


def keys_after_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions in a table that grows from 8 to 64 buckets: surrogates stay, later ones are new."""
    spec = SPECS["web"]
    table = KeyedTable(spark, _folder(spark, "growth"), spec, 8)
    rows = CLEAN["web"](bronze(spark, sf_dir, "web"))
    early = F.col("interaction_date") < "2024-01-20"
    table.upsert(rows.where(early), as_of=FIRST_LOAD)
    before = table.read().select("session_id", F.col(spec.surrogate).alias("old"))
    for buckets in (16, 40, 64):
        table.grow(buckets)
    table.upsert(rows.where(~early), as_of=SECOND_LOAD)
    after = table.read().select("session_id", F.col(spec.surrogate).alias("new"))
    both = after.join(before, "session_id", "left")
    return both.agg(
        F.count("*").alias("row_count"),
        F.count_distinct("new").alias("distinct_keys"),
        F.count_if(F.col("old") == F.col("new")).alias("kept_keys"),
        F.count_if(F.col("old") != F.col("new")).alias("changed_keys"),
        F.lit(table.manifest().buckets).alias("bucket_count"),
    )


def rolled_up_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases per customer and month after three batches with corrections, from their changes alone."""
    spec = SPECS["transactions"]
    table = KeyedTable(spark, _folder(spark, "rollup"), spec, 8)

    def month(rows: DataFrame) -> DataFrame:
        return rows.withColumn("month", F.date_format("transaction_date", "yyyy-MM"))

    rollup = Rollup(
        spark, f"{table.path}-rollup", table, ["customer_id", "month"], ["amount"], "payment_method", month
    )
    clean = CLEAN["transactions"]
    loaded = clean(bronze(spark, sf_dir, "transactions"))
    corrected = clean(INGEST["transactions"](feeds.transactions(spark, sf_dir, corrected=True), SECOND_LOAD))
    moved = corrected.withColumn(
        "payment_method", F.when(F.col("payment_method") == "UPI", "Cash").otherwise(F.col("payment_method"))
    )
    early = "transaction_date < '2021-01-01'"
    for k, batch in enumerate([loaded.where(early), corrected, moved.where(early)]):
        table.upsert(batch, "load", k, SECOND_LOAD)
        rollup.refresh()
    total = F.col("sum_amount").cast("decimal(18,2)").alias("amount")
    return rollup.read().select("customer_id", "month", "row_count", "distinct_count", total)


def load_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing files of which some cannot be read and some have a bad value: what becomes of them.

    Each feed has a good file, the start of one, as a transfer that broke off leaves it, and one in which
    every tenth row has a value that does not fit: of customers these rows are rejected, of tickets the
    file.
    """
    root = _folder(spark, "policies")
    counts = []
    warehouse = Warehouse(spark, f"{root}/warehouse")
    for feed, column in (("customers", "signup_date"), ("support", "created_at")):
        landing = f"{root}/landing/{feed}"
        rows = INGEST[feed](raw(spark, sf_dir, feed)).coalesce(1)
        rows.write.parquet(f"{landing}/good")
        text = rows.withColumn(column, F.col(column).cast("string"))
        key = rows.columns[0]
        odd = F.regexp_extract(F.col(key), "([0-9]+)", 1).cast("bigint") % 10 == 0
        text.withColumn(column, F.when(odd, "someday").otherwise(F.col(column))).withColumn(
            key, F.concat(F.lit("x"), key)
        ).write.parquet(f"{landing}/bad")
        files.copy_start(spark, f"{landing}/good", f"{landing}/broken", 0.5)
        warehouse.load(feed, landing, recursiveFileLookup="true").awaitTermination()
        loaded, rejected = warehouse.bronze(feed), warehouse.rejects("load", feed)
        quarantined = warehouse.rejects("quarantine", feed)
        for kind, found in (("loaded", loaded), ("rejected", rejected), ("quarantined", quarantined)):
            counts.append(found.agg(F.lit(feed).alias("feed"), F.lit(kind).alias("outcome"), F.count("*").alias("row_count")))
    return reduce(DataFrame.unionByName, counts)


def raw_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three drops of the web feed: the first with narrow numbers, a column more, that column gone again."""
    path = _folder(spark, "drops")
    rows = raw(spark, sf_dir, "web").select("session_id", "page_views", "device")
    number = F.expr("cast(substring(session_id, 2) as bigint) % 3")
    narrow = rows.where(number == 0).select("session_id", F.col("page_views").cast("int").alias("page_views"))
    append_drop(narrow, path)
    append_drop(rows.where(number == 1), path)
    append_drop(rows.where(number == 2).drop("device"), path)
    return read_drops(spark, path).withColumnRenamed("_drop", "drop_number")


def run_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run that ends well, one that fails on what it finds, one that is broken off, one long ago."""
    path = _folder(spark, "run-log")
    rows = bronze(spark, sf_dir, "transactions")

    def check() -> None:
        missing = rows.where("amount IS NULL").count()
        if missing:
            raise ValueError(f"{missing} amounts are missing")

    run_logged(spark, path, "load_transactions", rows.count(), lambda: None)
    with suppress(ValueError):
        run_logged(spark, path, "check_amounts", rows.count(), check)
    Run(spark, path, "merge_transactions")  # whose driver dies here
    tasks = ["load_transactions", "check_amounts", "merge_transactions"]
    now = run_history(spark, path, tasks, hours=24)
    later = session_now(spark) + timedelta(days=3)
    then = run_history(spark, path, ["merge_transactions"], hours=24 * 7, as_of=later)
    return now.unionByName(then).select("task_name", "status", "rows_processed", "error_message")


def clock_and_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit columns at their defaults: set by the session's clock and user, alike in all rows."""
    rows = with_audit(raw(spark, sf_dir, "customers"))
    return rows.agg(
        F.count("*").alias("row_count"),
        F.count_if(F.col("ingested_at").isNotNull() & (F.col("ingested_at") <= F.col("updated_at"))).alias("stamped"),
        F.count_if(F.col("created_by") == F.col("updated_by")).alias("signed"),
        F.count_distinct("created_by").alias("actors"),
    )


def audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer feed with its audit columns, actor and time given."""
    rows = raw(spark, sf_dir, "customers").drop("signup_date")
    return with_audit(rows, "loader", FIRST_LOAD)


def top_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view by its SQL name, with a limit on a full order."""
    register_views(star(spark, sf_dir))
    return spark.sql(
        "SELECT customer_id, customer_lifetime_value FROM customer_lifetime_value "
        "ORDER BY customer_lifetime_value DESC, customer_id LIMIT 25"
    )


def streamed_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs that two streamed feeds leave in the log: task, status, rows."""
    warehouse = _streamed_warehouse(spark, sf_dir, ("customers", "web"))
    tasks = ["merge_customers", "merge_web", "refresh_customers"]
    return warehouse.history(tasks, hours=24).select("task_name", "status", "rows_processed")


def quality_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with more than one transaction: the unique rule applied to a non-key."""
    return quality.duplicates(silver(spark, sf_dir, "transactions"), "customer_id")


def quality_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.orphans(
        silver(spark, sf_dir, "transactions"),
        "customer_id",
        silver(spark, sf_dir, "customers"),
        "customer_id",
    )


def quality_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw state codes that do not fit the silver column."""
    rules = quality.length_rules({"state_code": 2})
    _, rejects = quality.split_by_rules(bronze(spark, sf_dir, "customers"), rules)
    return rejects.select("customer_id", "state_code", F.col("_reason").alias("reason"))


def quality_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    required = ["transaction_id", "customer_id", "transaction_date", "amount", "payment_method"]
    _, rejects = quality.split_by_rules(
        bronze(spark, sf_dir, "transactions"), quality.not_null_rules(required)
    )
    return rejects.select("transaction_id", "customer_id", F.col("_reason").alias("reason"))


def _streamed_warehouse(
    spark: SparkSession, sf_dir: str, feeds_used: tuple[str, ...]
) -> Warehouse:
    """The feeds taken through landing files, bronze, silver and gold streams."""
    root = f"{scratch_dir(spark)}/clientele-{uuid.uuid4().hex}"
    landing = {feed: f"{root}/landing/{feed}" for feed in feeds_used}
    size = 0
    for feed, path in landing.items():
        rows = INGEST[feed](raw(spark, sf_dir, feed))
        size = max(size, estimated_bytes(rows))
        append_raw(rows, path)
    warehouse = Warehouse(spark, f"{root}/warehouse", buckets_for(size))
    warehouse.cycle(landing)
    return warehouse


def _streamed(view: str, feeds_used: tuple[str, ...]) -> Query:
    return lambda spark, sf_dir: VIEWS[view](_streamed_warehouse(spark, sf_dir, feeds_used).gold())


# ---- registry ----------------------------------------------------------------------------------

STRICT = [
    "dim_date",
    "dim_support",
    "dim_sessions",
    "fact_transactions",
    "customer_lifetime_value",
    "churned_customers_by_location",
    "avg_ticket_resolution_time",
    "resolution_ticket_count",
    "tickets_over_time",
]


def _ingested(feed: str) -> Query:
    audit = [name for name, _ in AUDIT]
    return lambda spark, sf_dir: bronze(spark, sf_dir, feed).drop(*audit)


def _cleaned(feed: str, strict: bool = False) -> Query:
    return lambda spark, sf_dir: silver(spark, sf_dir, feed, strict)


def _from_gold(f: Callable[[Tables], DataFrame], strict: bool = False) -> Query:
    return lambda spark, sf_dir: f(star(spark, sf_dir, strict))


def _tuned(query: Query) -> Query:
    return lambda spark, sf_dir: query(tune(spark), sf_dir)


def registry() -> dict[str, Query]:
    of_gold = {**GOLD, **VIEWS}
    found: dict[str, Query] = {
        **{f"ingest_{feed}": _ingested(feed) for feed in INGEST},
        **{f"clean_{feed}": _cleaned(feed) for feed in CLEAN},
        "clean_support_strict": _cleaned("support", strict=True),
        **{name: _from_gold(f) for name, f in of_gold.items()},
        **{f"{name}_strict": _from_gold(of_gold[name], strict=True) for name in STRICT},
        "link_transactions": _linked("transactions", "transaction_id", "customer_sk"),
        "link_support": _linked("support", "ticket_id", "customer_id_sk"),
        "link_support_strict": _linked("support", "ticket_id", "customer_id_sk", strict=True),
        "link_web": _linked("web", "session_id", "customer_id_sk"),
        "ticket_row_numbers": ticket_row_numbers,
        "session_row_numbers": session_row_numbers,
        "transaction_surrogates": transaction_surrogates,
        "upsert_transactions": upsert_transactions,
        "upsert_customers": upsert_customers,
        "upsert_web": _upsert_twice(
            "web", "interaction_date < '2024-01-20'", "page_views",
            "page_views + CASE WHEN device = 'Mobile' THEN 1 ELSE 0 END",
        ),
        "upsert_support": _upsert_twice(
            "support", "satisfaction_category = 'High'", "issue_type",
            "CASE WHEN satisfaction_score = 0 THEN 'Escalated' ELSE issue_type END",
        ),
        "upsert_small_batches": upsert_small_batches,
        "change_feed": change_feed,
        "keys_after_growth": keys_after_growth,
        "rolled_up_purchases": rolled_up_purchases,
        "load_policies": load_policies,
        "raw_history": raw_history,
        "run_states": run_states,
        "clock_and_user": clock_and_user,
        "audit_columns": audit_columns,
        "top_customers": top_customers,
        "streamed_run_log": streamed_run_log,
        "streamed_sessions": _streamed("performance_by_session", ("customers", "web")),
        "streamed_lifetime_value": _streamed(
            "customer_lifetime_value", ("customers", "transactions")
        ),
        "streamed_resolution_count": _streamed(
            "resolution_ticket_count", ("customers", "support")
        ),
        "quality_duplicates": quality_duplicates,
        "quality_orphans": quality_orphans,
        "quality_length": quality_length,
        "quality_not_null": quality_not_null,
    }
    return {name: _tuned(query) for name, query in found.items()}
