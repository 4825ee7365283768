"""Aggregates kept up to date by changes equal those made anew."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.operators.keyed_table import KeyedTable, Upkeep
from clientele.operators.rollup import Rollup
from clientele.operators.upsert import TableSpec

COLUMNS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("team", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("amount", T.DecimalType(10, 2)),
    ]
)
SPEC = TableSpec("id", COLUMNS, when_changed=("team", "city", "amount"))


def anew(table):
    return sorted(
        map(
            str,
            table.read()
            .groupBy("team")
            .agg(
                F.count("*").alias("row_count"),
                F.count_distinct("city").alias("distinct_count"),
                F.coalesce(F.sum("amount"), F.lit(0)).cast("decimal(38,6)").alias("sum_amount"),
            )
            .collect(),
        )
    )


def kept(rollup):
    return sorted(map(str, rollup.read().select("team", "row_count", "distinct_count", "sum_amount").collect()))


def test_corrections_move_rows_between_groups(spark, tmp_path):
    rng = random.Random(5)
    table = KeyedTable(spark, f"{tmp_path}/t", SPEC, 2, Upkeep(least_rows=1, share=0.5))
    rollup = Rollup(spark, f"{tmp_path}/r", table, ["team"], ["amount"], "city")
    rollup.refresh()
    assert kept(rollup) == []
    for step in range(3):
        rows = [
            (f"k{rng.randrange(25)}", rng.choice(["a", "b", None, ""]), rng.choice(["x", "y", "z", None]), rng.choice([1.0, 2.5, None]))
            for _ in range(15)
        ]
        rows = list({r[0]: r for r in rows}.values())
        df = spark.createDataFrame(rows, "id string, team string, city string, amount double")
        table.upsert(df.withColumn("amount", F.col("amount").cast("decimal(10,2)")), "w", step)
        if step != 1:  # two versions at once
            rollup.refresh()
            assert kept(rollup) == anew(table)
    rollup.refresh()
    assert kept(rollup) == anew(table)


def test_a_refresh_that_is_broken_off_counts_nothing_twice(spark, tmp_path, monkeypatch):
    table = KeyedTable(spark, f"{tmp_path}/t", SPEC, 2)
    rollup = Rollup(spark, f"{tmp_path}/r", table, ["team"], ["amount"], "city")

    def put(*rows):
        df = spark.createDataFrame(rows, "id string, team string, city string, amount double")
        table.upsert(df.withColumn("amount", F.col("amount").cast("decimal(10,2)")))

    put(("1", "a", "x", 1.0), ("2", "a", "y", 2.0))
    with monkeypatch.context() as m:
        m.setattr(rollup, "_add_up", lambda *_: (_ for _ in ()).throw(OSError("driver lost")))
        with pytest.raises(OSError):
            rollup.refresh()
    put(("1", "b", "x", 1.0))
    rollup.refresh()
    rollup.refresh()
    assert kept(rollup) == anew(table)
    table.compact()
    put(("3", "b", "x", 1.0))
    table.expire(keep=2)
    rollup.refresh()
    assert kept(rollup) == anew(table)
    put(("4", "b", "x", 1.0))
    put(("5", "b", "x", 1.0))
    table.expire(keep=1)
    with pytest.raises(LookupError, match="has expired"):
        rollup.refresh()


def test_values_are_added_in_one_merge(spark, tmp_path):
    """What is added is computed once, and a single change folder is read without an aggregation."""
    table = KeyedTable(spark, f"{tmp_path}/t", SPEC, 2)
    computed = spark.sparkContext.accumulator(0)

    def put(batch, *rows):
        def count(frames):
            for frame in frames:
                computed.add(len(frame))
                yield frame

        df = spark.createDataFrame(rows, "id string, team string, city string, amount double")
        df = df.mapInPandas(count, df.schema).withColumn("amount", F.col("amount").cast("decimal(10,2)"))
        table.upsert(df, "w", batch, add=("amount",))

    put(1, ("1", "a", "x", 1.0), ("2", "a", "y", 2.5))
    put(2, ("1", "b", "x", 2.0), ("2", "a", "y", 0.0), ("3", "a", None, 4.0))
    assert computed.value == 5
    found = table.read()
    assert sorted((r.id, r.team, float(r.amount)) for r in found.collect()) == [
        ("1", "b", 3.0), ("2", "a", 2.5), ("3", "a", 4.0)
    ]
    assert "Aggregate" not in found._jdf.queryExecution().executedPlan().toString()
    kinds = table.changes(1, 2).select("_change", "id").collect()
    assert sorted(map(tuple, kinds)) == [("insert", "3"), ("update_postimage", "1"), ("update_preimage", "1")]
    table.upsert(spark.createDataFrame([("3", "c")], "id string, team string"), "w", 3)
    assert not table.manifest().unique and table.read().count() == 3
