"""Rules the tables declare but nothing enforces: not null, length, unique, foreign key."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Declared lengths of silver text columns.
LENGTHS = {
    "customers": {"customer_id": 5, "state_code": 2},
    "transactions": {"transaction_id": 6, "state_code": 2},
    "support": {},
    "web": {},
}


def not_null_rules(columns: list[str]) -> dict[str, Column]:
    """Rule name to the condition that breaks it."""
    return {f"{c} is null": F.col(c).isNull() for c in columns}


def length_rules(limits: Mapping[str, int]) -> dict[str, Column]:
    return {f"{c} longer than {n}": F.length(c) > n for c, n in limits.items()}


def split_by_rules(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that keep all rules, and the others with `_reason`, in the order of the rules."""
    if not rules:
        return df, df.where(F.lit(False)).withColumn("_reason", F.lit(""))
    broken = F.concat_ws("; ", *[F.when(cond, F.lit(name)) for name, cond in rules.items()])
    marked = df.withColumn("_reason", broken)
    good = marked.where(F.col("_reason") == "").drop("_reason")
    return good, marked.where(F.col("_reason") != "")


def duplicates(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    counted = df.groupBy(key).agg(F.count("*").alias("row_count"))
    return counted.where(F.col("row_count") > 1)


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Values of a foreign key without a parent, with their number of rows.

    The child is grouped first, so a value that holds most rows is one row at the join.
    """
    counted = (
        child.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("row_count"))
    )
    keys = parent.select(F.col(parent_key).alias(column))
    return counted.join(keys, column, "left_anti")


