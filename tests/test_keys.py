"""Surrogate keys."""

from pyspark.sql import functions as F

from clientele.operators.surrogate import assign_sk, dense_sk


def keys(spark, n=10_000):
    return spark.range(0, n, 1, 7).select(F.md5(F.col("id").cast("string")).alias("k"))


def test_dense_keys_equal_a_global_row_number(spark):
    want = [k for (k,) in sorted(keys(spark).collect())]
    got = {r.k: r.sk for r in dense_sk(keys(spark), "k", "sk", base=100).collect()}
    assert [got[k] for k in want] == list(range(101, 10_101))


def test_dense_keys_of_nothing(spark):
    assert dense_sk(keys(spark, 0), "k", "sk").count() == 0


def test_assigned_keys_are_unique_and_repeatable(spark):
    once = {r.k: r.sk for r in assign_sk(keys(spark), "k", "sk", 16).collect()}
    again = {r.k: r.sk for r in assign_sk(keys(spark).repartition(3), "k", "sk", 16).collect()}
    assert once == again
    assert len(set(once.values())) == 10_000 and min(once.values()) >= 1


def test_no_single_task_window(spark):
    plan = assign_sk(keys(spark), "k", "sk")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
