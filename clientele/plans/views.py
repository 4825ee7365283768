"""The thirteen business views over gold.

Facts are grouped by customer or by date key before they meet a dimension, so a customer or a day
with a large share of the rows is reduced on the map side. Dates are read from calendar keys; the
calendar is joined for attributes a key does not carry, after grouping.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.functions.lookups import resolution_bucket
from clientele.functions.numeric import mean, percent
from clientele.functions.temporal import date_of
from clientele.plans.tables import Tables

TOTAL = T.DecimalType(28, 2)


def _latest_date(gold: Tables) -> Column:
    return gold.dim_date.agg(F.max("dates")).scalar()


def _last_date(df: DataFrame, key: str, name: str) -> DataFrame:
    """Last date per customer."""
    last = df.groupBy("customer_id_sk").agg(F.max(key).alias("_key"))
    return last.select(
        F.col("customer_id_sk").alias("customer_sk"), date_of(F.col("_key")).alias(name)
    )


def _spend(gold: Tables) -> DataFrame:
    """One row per customer with transactions: total, first and last date."""
    day = F.col("transaction_date")
    return (
        gold.fact_transactions.groupBy("customer_id_sk")
        .agg(F.sum("amount").alias("total"), F.min(day).alias("first"), F.max(day).alias("last"))
        .select(
            F.col("customer_id_sk").alias("customer_sk"),
            F.col("total").cast(TOTAL).alias("customer_lifetime_value"),
            date_of(F.col("first")).alias("first_transaction_date"),
            date_of(F.col("last")).alias("last_transaction_date"),
        )
    )


def customer_lifetime_value(gold: Tables) -> DataFrame:
    days = F.datediff("last_transaction_date", "first_transaction_date")
    return (
        gold.dim_customers.select("customer_sk", "customer_id", "full_name", "email")
        .join(_spend(gold), "customer_sk")
        .select(
            "customer_id",
            "full_name",
            "email",
            "customer_lifetime_value",
            "first_transaction_date",
            "last_transaction_date",
            days.alias("transaction_period_days"),
        )
        .orderBy(F.desc("customer_lifetime_value"))
    )


def customer_activity_status(gold: Tables) -> DataFrame:
    last = F.col("last_transaction_date")
    category = (
        F.when(last.isNull(), "Inactive")
        .when(last >= F.add_months(_latest_date(gold), -3), "Active")
        .otherwise("Dormant")
    )
    seen = _last_date(gold.fact_transactions, "transaction_date", "last_transaction_date")
    return (
        gold.dim_customers.join(seen, "customer_sk", "left")
        .select(
            "customer_id",
            "full_name",
            "email",
            "city",
            "state_name",
            "last_transaction_date",
            category.alias("user_category"),
        )
        .orderBy("user_category", "customer_id")
    )


def signups_over_time(gold: Tables) -> DataFrame:
    by_day = gold.dim_customers.groupBy(F.col("signup_date_sk").alias("date_id_sk")).agg(
        F.count("customer_id").alias("n")
    )
    return (
        by_day.join(gold.dim_date, "date_id_sk")
        .groupBy("years", "months", "month_name")
        .agg(F.sum("n").alias("signup_count"))
        .orderBy("years", "months")
    )


def monthly_churn_and_retention(gold: Tables) -> DataFrame:
    """Months without any transaction do not occur, so "start" is the previous month that does."""
    # one row per customer and month, so the window below sees months, not transactions
    months = gold.fact_transactions.select(
        "customer_id_sk", F.floor(F.col("transaction_date") / 100).cast("int").alias("month")
    ).distinct()
    first = F.min("month").over(W.partitionBy("customer_id_sk"))
    monthly = (
        months.withColumn("first_month", first)
        .groupBy("month")
        .agg(
            F.count("*").alias("customers_at_end"),
            F.count_if(F.col("month") == F.col("first_month")).alias("new_customers"),
        )
        .withColumn("activity_month", date_of(F.col("month") * 100 + 1))
    )
    month = F.col("activity_month")
    start, end = F.col("customers_at_start"), F.col("customers_at_end")
    retained = F.col("retained_customers")
    # one row per month: a single-task window is enough
    return (
        monthly.withColumn(
            "customers_at_start",
            F.lag("customers_at_end").over(W.orderBy("activity_month")),
        )
        .where(start.isNotNull())
        .withColumn("retained_customers", end - F.col("new_customers"))
        .select(
            "activity_month",
            F.date_format(month, "yyyy-MM").alias("period"),
            F.date_format(month, "MMM").alias("month_name"),
            F.year(month).alias("year"),
            F.month(month).alias("month_number"),
            "customers_at_start",
            "customers_at_end",
            "new_customers",
            "retained_customers",
            percent(retained, start).alias("retention_rate_percent"),
            (start - retained).alias("churned_customers"),
            percent(start - retained, start).alias("churn_rate_percentage"),
        )
        .orderBy("activity_month")
    )


def churn_rate_by_location(gold: Tables) -> DataFrame:
    """Churned: last seen from three months to one month before the latest month.

    The share divides by the number of locations with churn, so it can exceed 100.
    """
    latest = F.trunc(_latest_date(gold), "month")
    last = F.col("last_activity_date")
    churned = (last >= F.add_months(latest, -3)) & (last < F.add_months(latest, -1))
    seen = _last_date(gold.fact_transactions, "transaction_date", "last_activity_date")
    by_place = (
        gold.dim_customers.join(seen, "customer_sk", "left")
        .groupBy("city", "state_name")
        .agg(
            F.count("*").alias("total_customers"),
            F.count_if(churned).alias("churned_customers"),
        )
    )
    count = F.col("churned_customers")
    # over one row per place
    places_with_churn = F.count_if(count > 0).over(W.partitionBy())
    return by_place.select(
        "city",
        F.col("state_name").alias("state"),
        "total_customers",
        "churned_customers",
        percent(count, F.col("total_customers")).alias("churn_rate_percentage"),
        F.when(count > 0, percent(count, places_with_churn)).alias(
            "location_share_of_total_churn"
        ),
    ).orderBy(F.desc("churn_rate_percentage"))


def churned_customers_by_location(gold: Tables) -> DataFrame:
    """Each branch is one row per customer before the joins, so they do not multiply."""
    sessions = _last_date(gold.dim_sessions, "interaction_date_sk", "last_session_date")
    tickets = _last_date(gold.dim_support, "created_date_sk", "last_support_date")
    signup = F.col("signup_date")
    lasts = ["last_transaction_date", "last_session_date", "last_support_date"]
    last_activity = F.greatest(*[F.coalesce(c, signup) for c in lasts])

    def had(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), "Yes").otherwise("No")

    value = F.coalesce("customer_lifetime_value", F.lit(0).cast(TOTAL))
    return (
        gold.dim_customers.withColumn("signup_date", date_of(F.col("signup_date_sk")))
        .join(_spend(gold), "customer_sk", "left")
        .join(sessions, "customer_sk", "left")
        .join(tickets, "customer_sk", "left")
        .withColumn("last_activity_date", F.greatest(last_activity, signup))
        .withColumn("days_inactive", F.datediff(_latest_date(gold), "last_activity_date"))
        .where(F.col("days_inactive") > 30)
        .select(
            "city",
            F.col("state_name").alias("state"),
            "customer_id",
            "full_name",
            "email",
            "phone",
            "signup_date",
            "last_activity_date",
            "days_inactive",
            had("last_transaction_date").alias("had_transactions"),
            had("last_session_date").alias("had_sessions"),
            had("last_support_date").alias("had_support"),
            value.alias("lifetime_value"),
        )
        .orderBy("state", "city", F.desc("days_inactive"))
    )


def avg_ticket_resolution_time(gold: Tables) -> DataFrame:
    """From whole dates. Tickets without a resolution date do not count."""
    days = F.datediff(date_of(F.col("resolved_date_sk")), date_of(F.col("created_date_sk")))
    total, n = F.col("days"), F.col("ticket_count")
    return (
        gold.dim_support.where(F.col("resolved_date_sk").isNotNull())
        .groupBy("issue_type")
        .agg(F.sum(days).alias("days"), F.count("*").alias("ticket_count"))
        .select(
            "issue_type",
            mean(total * 24, n).alias("avg_resolution_time_hours"),
            mean(total, n).alias("avg_resolution_time_days"),
            "ticket_count",
        )
        .orderBy(F.desc("avg_resolution_time_days"))
    )


def issue_type_by_tickets(gold: Tables) -> DataFrame:
    by_type = gold.dim_support.groupBy("issue_type").agg(F.count("*").alias("ticket_count"))
    total = by_type.agg(F.sum("ticket_count")).scalar()
    return by_type.withColumn(
        "percentage", percent(F.col("ticket_count"), total, 6)
    ).orderBy(F.desc("ticket_count"))


def resolution_ticket_count(gold: Tables) -> DataFrame:
    days = F.col("resolution_time_days")
    return (
        gold.dim_support.where(F.col("satisfaction_score").isNotNull() & days.isNotNull())
        .groupBy(resolution_bucket(days).alias("resolution_time_bucket"))
        .agg(F.count("*").alias("ticket_count"), F.min(days).alias("shortest"))
        .orderBy("shortest")
        .drop("shortest")
    )


def tickets_over_time(gold: Tables) -> DataFrame:
    by_day = (
        gold.dim_support.where(F.col("resolved_date_sk").isNotNull())
        .groupBy(F.col("created_date_sk").alias("date_id_sk"))
        .agg(
            F.sum("resolution_time_days").alias("total_days"),
            F.count("resolution_time_days").alias("timed"),
            F.count("*").alias("n"),
        )
    )
    return (
        by_day.join(gold.dim_date, "date_id_sk")
        .groupBy("years", "months", "month_name")
        .agg(
            mean(F.sum("total_days"), F.sum("timed")).alias("avg_resolution_days"),
            F.sum("n").alias("ticket_count"),
        )
        .orderBy("years", "months")
    )


def performance_by_session(gold: Tables) -> DataFrame:
    """Grouped by category and customer first: the distinct count is then a plain count."""
    by_customer = gold.dim_sessions.groupBy("session_category", "customer_id_sk").agg(
        F.count("*").alias("n"),
        F.sum("session_duration").alias("seconds"),
        F.sum("page_views").alias("pages"),
    )
    n = F.sum("n")
    return (
        by_customer.groupBy("session_category")
        .agg(
            n.alias("total_sessions"),
            mean(F.sum("seconds"), n).alias("avg_duration"),
            mean(F.sum("pages"), n).alias("avg_pages"),
            F.count("customer_id_sk").alias("unique_users"),
        )
        .orderBy(F.desc("total_sessions"))
    )


def web_session_count_by_device(gold: Tables) -> DataFrame:
    return (
        gold.dim_sessions.groupBy("device_type")
        .agg(F.count("session_id").alias("session_count"))
        .orderBy(F.desc("session_count"))
    )


def customer_purchase_frequency_monthly(gold: Tables) -> DataFrame:
    month = F.floor(F.col("transaction_date") / 100).cast("int")
    by_month = gold.fact_transactions.groupBy(
        F.col("customer_id_sk").alias("customer_sk"), month.alias("month")
    ).agg(F.count_distinct("transaction_id").alias("purchase_count"))
    return (
        by_month.join(gold.dim_customers.select("customer_sk", "customer_id"), "customer_sk")
        .select(
            "customer_id",
            F.floor(F.col("month") / 100).cast("int").alias("years"),
            (F.col("month") % 100).alias("months"),
            "purchase_count",
        )
        .orderBy("years", "months", "customer_id")
    )


VIEWS: dict[str, Callable[[Tables], DataFrame]] = {
    f.__name__: f
    for f in (
        customer_lifetime_value,
        customer_activity_status,
        signups_over_time,
        monthly_churn_and_retention,
        churn_rate_by_location,
        churned_customers_by_location,
        avg_ticket_resolution_time,
        issue_type_by_tickets,
        resolution_ticket_count,
        tickets_over_time,
        performance_by_session,
        web_session_count_by_device,
        customer_purchase_frequency_monthly,
    )
}


def register_views(gold: Tables) -> None:
    """Make gold tables and all views available to SQL under their names."""
    for name in gold:
        getattr(gold, name).createOrReplaceTempView(name)
    for name, view in VIEWS.items():
        view(gold).createOrReplaceTempView(name)
