"""Readers, the raw dump and load policies."""

import importlib.util
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.schemas import RAW
from clientele.sources.audit import with_audit
from clientele.sources.readers import (
    append_drop,
    append_raw,
    load_typed,
    probe_files,
    read_drops,
    read_feed,
    read_raw,
)

WANTED = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("at", T.TimestampNTZType()),
    ]
)


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_formats(spark, tmp_path, fmt):
    schema = T.StructType.fromDDL("id string, n bigint")
    df = spark.createDataFrame([("a", 1), ("b", None)], schema)
    df.write.format(fmt).option("header", "true").save(str(tmp_path / "x"))
    back = read_feed(spark, str(tmp_path / "x"), schema, fmt)
    assert back.schema == schema
    assert sorted(map(tuple, back.collect())) == [("a", 1), ("b", None)]


@pytest.mark.skipif(importlib.util.find_spec("openpyxl") is None, reason="needs openpyxl")
def test_workbook(spark, tmp_path):
    import pandas as pd

    pd.DataFrame({"ticket_id": ["T1"], "issue_type": [None]}).to_excel(tmp_path / "x.xlsx")
    df = read_feed(spark, str(tmp_path), RAW["support"], "xlsx")
    assert df.first().ticket_id == "T1"


def test_raw_dump_merges_schemas(spark, tmp_path):
    path = str(tmp_path / "raw")
    append_raw(spark.createDataFrame([("a",)], "id string"), path)
    append_raw(spark.createDataFrame([("b", 2)], "id string, n int"), path)
    assert sorted(map(tuple, read_raw(spark, path).collect())) == [("a", None), ("b", 2)]


def test_audit(spark):
    at = datetime(2024, 1, 1)
    row = with_audit(spark.range(1), "me", at).first()
    assert (row.ingested_at, row.updated_at, row.created_by, row.updated_by) == (at, at, "me", "me")
    assert with_audit(spark.range(1)).first().created_by


@pytest.fixture
def dirty(spark, tmp_path):
    good = [("a", "1", "2024-01-01 00:00:00"), ("b", None, None), ("c", "4.5", None)]
    bad = [("d", "x", None), ("e", "2", "never"), ("f", "3", None)]
    for name, data in (("good", good), ("bad", bad)):
        df = spark.createDataFrame(data, "id string, n string, at string").coalesce(1)
        df.write.parquet(str(tmp_path / name))
    return spark.read.parquet(str(tmp_path / "good"), str(tmp_path / "bad"))


def test_skip_row(dirty):
    good, rejects = load_typed(dirty, WANTED, "skip_row")
    assert {(r.id, r.n) for r in good.collect()} == {("a", 1), ("b", None), ("c", 5), ("f", 3)}
    reasons = {r.id: r._reason for r in rejects.collect()}
    assert reasons == {"d": "cannot cast: n", "e": "cannot cast: at"}


def test_skip_file(dirty):
    good, rejects = load_typed(dirty, WANTED, "skip_file")
    assert {r.id for r in good.collect()} == {"a", "b", "c"}
    assert {(r.id, r._reason) for r in rejects.collect()} == {
        (x, "2 bad rows in file") for x in "def"
    }


def test_missing_column_is_null(spark, tmp_path):
    spark.createDataFrame([("a",)], "id string").write.parquet(str(tmp_path / "p"))
    good, rejects = load_typed(spark.read.parquet(str(tmp_path / "p")), WANTED)
    assert tuple(good.first()) == ("a", None, None) and rejects.count() == 0


def test_unknown_policy(dirty):
    with pytest.raises(ValueError, match="skip_row or skip_file"):
        load_typed(dirty.withColumn("_file", F.lit("")), WANTED, "ignore")


def test_drops_keep_a_history_of_schemas(spark, tmp_path):
    path = str(tmp_path / "drops")
    append_drop(spark.sql("SELECT 'a' AS id, 1 AS n, date'2024-01-02' AS at"), path)
    append_drop(spark.sql("SELECT 'b' AS id, 5000000000L AS n, timestamp_ntz'2024-01-03 04:00:00' AS at, 1.5F AS x"), path)
    append_drop(spark.sql("SELECT 'c' AS id, 2.5D AS x"), path)
    df = read_drops(spark, path)
    assert dict(df.dtypes) == {"id": "string", "n": "bigint", "at": "timestamp_ntz", "x": "double", "_drop": "int"}
    rows = {r.id: (r.n, r.at, r.x, r._drop) for r in df.collect()}
    assert rows == {
        "a": (1, datetime(2024, 1, 2), None, 0),
        "b": (5_000_000_000, datetime(2024, 1, 3, 4), 1.5, 1),
        "c": (None, None, 2.5, 2),
    }
    # one that was not written to its end is not read
    spark.sql("SELECT 'd' AS id").write.parquet(f"{path}/drop-dead")
    assert read_drops(spark, path).count() == 3
    append_drop(spark.sql("SELECT 'e' AS id, 'many' AS n"), path)
    with pytest.raises(ValueError, match="no type holds both"):
        read_drops(spark, path)


def test_probe_tells_why(spark, tmp_path):
    spark.sql("SELECT 1 AS a, 'x' AS b").coalesce(1).write.parquet(f"{tmp_path}/x")
    (tmp_path / "x/zero.parquet").write_bytes(b"PAR")
    files = spark.read.format("binaryFile").load(f"{tmp_path}/x")
    found = sorted(probe_files(files).collect(), key=lambda r: r.error or "")
    assert (found[0].row_count, found[0].columns, found[0].error) == (1, "a int32, b string", None)
    assert found[1].length == 3 and found[1].error
