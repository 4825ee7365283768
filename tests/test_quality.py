from pyspark.sql import functions as F

from clientele.operators import quality


def test_rows_are_split_with_all_reasons(spark):
    df = spark.createDataFrame(
        [("a", "NY"), (None, "NEW"), ("b", None), ("c", "Unknown")], "id string, code string"
    )
    rules = {**quality.not_null_rules(["id", "code"]), **quality.length_rules({"code": 2})}
    good, bad = quality.split_by_rules(df, rules)
    assert [r.id for r in good.collect()] == ["a"]
    assert {(r.id, r._reason) for r in bad.collect()} == {
        (None, "id is null; code longer than 2"),
        ("b", "code is null"),
        ("c", "code longer than 2"),
    }


def test_no_rules(spark):
    good, bad = quality.split_by_rules(spark.range(3), {})
    assert good.count() == 3 and bad.count() == 0


def test_duplicates_and_orphans(spark):
    child = spark.range(0, 900).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 5).alias("k")
    )
    assert {tuple(r) for r in quality.duplicates(child, "k").collect()} == {
        (-1, 300),
        (0, 120),
        (1, 120),
        (2, 120),
        (3, 120),
        (4, 120),
    }
    found = quality.orphans(child, "k", spark.range(5), "id").collect()
    assert [tuple(r) for r in found] == [(-1, 300)]
