"""Silver to gold: calendar, three dimensions, the transaction fact.

Calendar keys are computed from dates (`date_key`), so no table joins the calendar to get one.
Children reach their customer by business key, so a customer that arrives late still counts;
`strict` joins tickets and sessions on the silver surrogate instead.
"""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.functions.temporal import date_key
from clientele.operators.joins import lookup_join
from clientele.plans.silver import customer_key_column
from clientele.plans.tables import Tables
from clientele.schemas import GOLD, KEYS, MONEY, SURROGATES


def calendar(dates: DataFrame) -> DataFrame:
    """Attributes of a one-column frame of unique dates, none of them null."""
    d = F.col("dates")
    # the coalesce marks the key as never null; else a join on it would filter every source row
    # by "key is not null" and compute the key there
    return dates.select(
        F.coalesce(date_key(d), F.lit(0)).alias("date_id_sk"),
        "dates",
        F.month(d).alias("months"),
        F.date_format(d, "MMM").alias("month_name"),
        F.quarter(d).alias("quarters"),
        F.year(d).alias("years"),
        F.dayname(d).alias("days"),
    )


def dates_of(roles: list[tuple[DataFrame, str]]) -> DataFrame:
    """Every date in the given columns, once. Branches are cut to dates before the one distinct."""
    branches = [df.select(F.to_date(c).alias("dates")) for df, c in roles]
    union = reduce(DataFrame.unionByName, branches)
    return union.where(F.col("dates").isNotNull()).distinct()


def build_dim_date(silver: Tables) -> DataFrame:
    return calendar(
        dates_of(
            [
                (silver.transactions, "transaction_date"),
                (silver.customers, "signup_date"),
                (silver.support, "created_at"),
                (silver.support, "resolved_at"),
                (silver.web, "interaction_date"),
            ]
        )
    )


def _row_key(df: DataFrame, feed: str):
    """Surrogate of a row, or its business key where the table has not been through the upsert."""
    sk = SURROGATES[feed]
    return F.col(sk if sk in df.columns else KEYS[feed])


def build_dim_customers(customers: DataFrame) -> DataFrame:
    return customers.where(F.col("signup_date").isNotNull()).select(
        F.col(customer_key_column(customers)).alias("customer_sk"),
        "customer_id",
        "first_name",
        "last_name",
        F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
        "email",
        "phone",
        "city",
        "state_code",
        "state_name",
        date_key(F.col("signup_date")).alias("signup_date_sk"),
    )


def _with_customer(
    child: DataFrame, silver_customers: DataFrame, strict_key: str | None
) -> DataFrame:
    """Inner join that adds the gold customer key as `_customer`."""
    gold_customers = silver_customers.where(F.col("signup_date").isNotNull())
    key = F.col(customer_key_column(silver_customers))
    if strict_key is None:
        table = gold_customers.select("customer_id", key.alias("_customer"))
        return lookup_join(child, table, "customer_id")
    table = gold_customers.select(key.alias(strict_key))
    return lookup_join(child, table, strict_key).withColumn("_customer", F.col(strict_key))


def build_dim_support(
    support: DataFrame, customers: DataFrame, strict: bool = False
) -> DataFrame:
    """An open ticket has no resolved_date_sk. Strict keeps whole days only."""
    days = F.col("resolution_time_hours")
    if strict:
        days = F.round(days).cast(support.schema["resolution_time_hours"].dataType)
    rows = support.where(F.col("created_at").isNotNull())
    return _with_customer(rows, customers, "customer_id_sk" if strict else None).select(
        _row_key(support, "support").alias("ticket_sk"),
        "ticket_id",
        F.col("_customer").alias("customer_id_sk"),
        date_key(F.col("created_at")).alias("created_date_sk"),
        "issue_type",
        days.alias("resolution_time_days"),
        date_key(F.col("resolved_at")).alias("resolved_date_sk"),
        "satisfaction_category",
        "satisfaction_score",
    )


def build_dim_sessions(
    web: DataFrame, customers: DataFrame, strict: bool = False
) -> DataFrame:
    return _with_customer(web, customers, "customer_id_sk" if strict else None).select(
        _row_key(web, "web").alias("session_sk"),
        "session_id",
        F.col("_customer").alias("customer_id_sk"),
        "session_duration",
        "page_views",
        date_key(F.col("interaction_date")).alias("interaction_date_sk"),
        F.col("device").alias("device_type"),
        "session_category",
    )


def build_fact_transactions(
    transactions: DataFrame, customers: DataFrame, strict: bool = False
) -> DataFrame:
    """Strict keeps whole amounts only. No feed links a transaction to a ticket or session."""
    amount = F.col("amount")
    if strict:
        amount = F.round(amount).cast(MONEY)
    return _with_customer(transactions, customers, None).select(
        _row_key(transactions, "transactions").alias("transaction_id_sk"),
        "transaction_id",
        F.col("_customer").alias("customer_id_sk"),
        F.lit(-1).cast("long").alias("support_id_sk"),
        F.lit(-1).cast("long").alias("session_id_sk"),
        date_key(F.col("transaction_date")).alias("transaction_date"),
        amount.alias("amount"),
        "payment_method",
        "city",
        "state",
        "state_code",
    )


def build_gold(silver: Tables, strict: bool = False) -> Tables:
    """The five gold tables of `silver` (customers, transactions, support, web)."""
    return Tables(
        dim_date=lambda: build_dim_date(silver),
        dim_customers=lambda: build_dim_customers(silver.customers),
        dim_support=lambda: build_dim_support(silver.support, silver.customers, strict),
        dim_sessions=lambda: build_dim_sessions(silver.web, silver.customers, strict),
        fact_transactions=lambda: build_fact_transactions(
            silver.transactions, silver.customers, strict
        ),
    )


def write_gold(gold: Tables, path: str) -> None:
    """A full rebuild: every table under `path`, the fact in one folder per month.

    The rebalance hint gathers a month's rows and splits months that are too large for one task.
    """
    for name in gold:
        df, parts = getattr(gold, name), []
        if name == "fact_transactions":
            month = F.floor(F.col("transaction_date") / 100).cast("int")
            df, parts = df.withColumn("month", month).hint("rebalance", F.col("month")), ["month"]
        df.write.mode("overwrite").partitionBy(*parts).parquet(f"{path}/{name}")


def read_gold(spark: SparkSession, path: str) -> Tables:
    def reader(name: str):
        return lambda: spark.read.parquet(f"{path}/{name}").drop("month")

    return Tables(**{name: reader(name) for name in GOLD})
