"""Lookup join: both ways give the same rows, also with hot keys."""

import pytest
from conftest import values
from pyspark.sql import functions as F

from clientele.operators import joins


def skewed(spark):
    """A third of the rows on one key, a tenth without key, some keys unknown to the table."""
    n = F.col("id")
    key = F.when(n % 3 == 0, "hot").when(n % 10 == 1, None).otherwise((n % 700).cast("string"))
    rows = spark.range(0, 30_000, 1, 6).select(key.alias("k"), "id")
    table = spark.range(500).select(F.col("id").cast("string").alias("k"), F.col("id").alias("sk"))
    hot = spark.range(1).select(F.lit("hot").alias("k"), F.lit(-5).cast("long").alias("sk"))
    return rows, table.unionByName(hot)


def test_hot_keys(spark):
    rows, _ = skewed(spark)
    assert joins.hot_keys(rows, "k")[0] == "hot"
    assert len(joins.hot_keys(rows, "k")) <= joins.MAX_HOT_KEYS
    assert joins.hot_keys(spark.range(0).select(F.col("id").cast("string").alias("k")), "k") == []


def test_both_ways_agree(spark, forced_shuffle):
    rows, table = skewed(spark)
    for how in ("inner", "left", "left_semi"):
        want = values(rows.join(table, "k", how))
        assert values(joins.lookup_join(rows, table, "k", how)) == want
        got = joins.lookup_join(rows, table, "k", how, hot=joins.hot_keys(rows, "k"))
        assert values(got) == want
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Union" in plan and "BroadcastHashJoin" in plan


def test_small_table_is_joined_in_one_go(spark):
    rows, table = skewed(spark)
    plan = joins.lookup_join(rows, table, "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan  # the table's own
    assert plan.count("Join") == 1


def test_without_hot_keys_planning_runs_no_job(spark, forced_shuffle):
    rows = spark.range(5000).select(F.col("id").alias("k"))
    table = spark.range(0, 5000, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("sk"))
    group = "planning"
    spark.sparkContext.setJobGroup(group, "no job is to be in this group")
    got = joins.lookup_join(rows, table, "k")
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setJobGroup("others", "")
    assert got.count() == 2500


def test_too_many_hot_keys(spark):
    rows, table = skewed(spark)
    with pytest.raises(ValueError):
        joins.lookup_join(rows, table, "k", hot=list(range(joins.MAX_HOT_KEYS + 1)))
