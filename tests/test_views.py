"""Views: invariants, a literal form of the widest one, skewed customers, SQL access."""

import pytest
from conftest import SF, values
from pyspark.sql import functions as F

from clientele import queries
from clientele.functions.temporal import date_of
from clientele.plans.gold import read_gold, write_gold
from clientele.plans.tables import Tables
from clientele.plans.views import VIEWS, register_views


@pytest.fixture(scope="module")
def gold(spark):
    star = queries.star(spark, SF)
    return Tables.of(**{n: getattr(star, n).cache() for n in star})


def test_end_is_new_plus_retained(gold):
    for r in VIEWS["monthly_churn_and_retention"](gold).collect():
        assert r.customers_at_end == r.new_customers + r.retained_customers
        assert r.churned_customers == r.customers_at_start - r.retained_customers


def test_shares_sum_to_100(gold):
    total = VIEWS["issue_type_by_tickets"](gold).agg(F.sum("percentage")).first()[0]
    assert abs(total - 100) < 1e-4


def test_totals_equal_row_counts(gold):
    sessions = gold.dim_sessions.count()
    for view, column in (
        ("performance_by_session", "total_sessions"),
        ("web_session_count_by_device", "session_count"),
    ):
        assert VIEWS[view](gold).agg(F.sum(column)).first()[0] == sessions
    assert VIEWS["customer_activity_status"](gold).count() == gold.dim_customers.count()
    signups = VIEWS["signups_over_time"](gold).agg(F.sum("signup_count")).first()[0]
    assert signups == gold.dim_customers.count()


def test_orders(gold):
    lifetime = [
        r.customer_lifetime_value for r in VIEWS["customer_lifetime_value"](gold).collect()
    ]
    assert lifetime == sorted(lifetime, reverse=True)
    buckets = [r.resolution_time_bucket for r in VIEWS["resolution_ticket_count"](gold).collect()]
    order = ["0-12 hours", "12-24 hours", "1-2 days", "2-5 days", "5+ days"]
    assert buckets == [b for b in order if b in buckets]


def test_churned_customers_equals_the_join_that_multiplies(spark, gold):
    """All transactions, sessions and tickets of a customer joined with each other, then grouped."""
    for name in gold:
        getattr(gold, name).createOrReplaceTempView(f"lit_{name}")
    literal = spark.sql(
        """
        WITH wide AS (
          SELECT c.customer_id, s.dates AS signup, max(td.dates) AS t, max(wd.dates) AS w,
                 max(ud.dates) AS u
          FROM lit_dim_customers c
          JOIN lit_dim_date s ON c.signup_date_sk = s.date_id_sk
          LEFT JOIN lit_fact_transactions f ON f.customer_id_sk = c.customer_sk
          LEFT JOIN lit_dim_date td ON f.transaction_date = td.date_id_sk
          LEFT JOIN lit_dim_sessions v ON v.customer_id_sk = c.customer_sk
          LEFT JOIN lit_dim_date wd ON v.interaction_date_sk = wd.date_id_sk
          LEFT JOIN lit_dim_support p ON p.customer_id_sk = c.customer_sk
          LEFT JOIN lit_dim_date ud ON p.created_date_sk = ud.date_id_sk
          GROUP BY c.customer_id, s.dates)
        SELECT customer_id,
               greatest(signup, coalesce(t, signup), coalesce(w, signup), coalesce(u, signup))
                 AS last_activity_date
        FROM wide"""
    )
    latest = gold.dim_date.agg(F.max("dates")).first()[0]
    want = literal.where(F.datediff(F.lit(latest), "last_activity_date") > 30)
    got = VIEWS["churned_customers_by_location"](gold)
    columns = ["customer_id", "last_activity_date"]
    assert values(got, *columns) == values(want, *columns)


def test_one_customer_with_a_third_of_all_rows(spark, gold):
    """The same star with one customer's rows copied until it holds a third of the fact."""
    fact = gold.fact_transactions
    hot = fact.orderBy("customer_id_sk").first().customer_id_sk
    n = fact.count()
    copies = spark.range(n // 2).select(F.col("id").cast("string").alias("copy"))
    one = fact.where(F.col("customer_id_sk") == hot).limit(1)
    more = one.crossJoin(copies).withColumn("transaction_id", F.concat(F.lit("H"), "copy"))
    skewed = Tables.of(
        **{name: getattr(gold, name) for name in gold if name != "fact_transactions"},
        fact_transactions=fact.unionByName(more.drop("copy")),
    )
    amount = one.first().amount
    before = {r.customer_id: r for r in VIEWS["customer_lifetime_value"](gold).collect()}
    after = {r.customer_id: r for r in VIEWS["customer_lifetime_value"](skewed).collect()}
    assert after.keys() == before.keys()
    gained = after[hot].customer_lifetime_value - before[hot].customer_lifetime_value
    assert gained == amount * (n // 2)
    counts = VIEWS["customer_purchase_frequency_monthly"](skewed).agg(F.sum("purchase_count"))
    assert counts.first()[0] == n + n // 2
    months = VIEWS["monthly_churn_and_retention"]
    assert values(months(skewed)) == values(months(gold))


def test_sql_names(spark, gold):
    register_views(gold)
    assert spark.sql("SELECT * FROM dim_date LIMIT 10").count() == 10
    top = spark.sql(
        "SELECT customer_id FROM customer_lifetime_value ORDER BY customer_lifetime_value DESC"
    )
    assert top.count() == VIEWS["customer_lifetime_value"](gold).count()


def test_calendar_covers_every_key(gold):
    for name, key in (
        ("fact_transactions", "transaction_date"),
        ("dim_customers", "signup_date_sk"),
        ("dim_support", "created_date_sk"),
        ("dim_support", "resolved_date_sk"),
        ("dim_sessions", "interaction_date_sk"),
    ):
        keys = getattr(gold, name).select(F.col(key).alias("date_id_sk")).dropna()
        assert keys.join(gold.dim_date, "date_id_sk", "left_anti").count() == 0
    wrong = gold.dim_date.where(date_of(F.col("date_id_sk")) != F.col("dates"))
    assert wrong.count() == 0


def test_written_gold_gives_the_same_views(spark, gold, tmp_path):
    write_gold(gold, str(tmp_path))
    back = read_gold(spark, str(tmp_path))
    for name in gold:
        columns = sorted(getattr(gold, name).columns)
        assert sorted(getattr(back, name).columns) == columns
        assert values(getattr(back, name), *columns) == values(getattr(gold, name), *columns)
    one_month = spark.read.parquet(f"{tmp_path}/fact_transactions").where("month = 202401")
    plan = one_month._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan
    view = "customer_lifetime_value"
    assert values(VIEWS[view](back)) == values(VIEWS[view](gold))
