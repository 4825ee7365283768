"""Properties of the keyed upsert."""

import os
import subprocess
import sys
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from multiprocessing import get_context
from pathlib import Path

import pytest
from conftest import values
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.operators import files
from clientele.operators.keyed_table import KeyedTable, Upkeep
from clientele.operators.surrogate import bucket_of, parent_of
from clientele.operators.upsert import GOLD_SPECS, TableSpec, newest_per_key

REPO = Path(__file__).resolve().parents[1]

COLUMNS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("amount", T.IntegerType()),
    ]
)
ALWAYS = TableSpec("id", COLUMNS, "sk", ("created", "updated"), created_from="ingested_at")
CHANGED = TableSpec("id", COLUMNS, "sk", ("created", "updated"), ("name", "amount"))


def rows(spark, day, *data):
    df = spark.createDataFrame(data, COLUMNS)
    return df.withColumn("ingested_at", F.lit(str(day)).cast("timestamp_ntz"))


@pytest.fixture
def table(spark, tmp_path):
    return lambda spec: KeyedTable(spark, str(tmp_path / "t"), spec, 4)


def by_id(table):
    return {r.id: r for r in table.read().collect()}


def test_same_batch_twice_changes_nothing(spark, table, day):
    t = table(CHANGED)
    batch = rows(spark, day(1), ("a", "x", 1), ("b", None, 2))
    t.upsert(batch, as_of=day(1))
    first = values(t.read())
    t.upsert(batch, as_of=day(2))
    assert values(t.read()) == first


def test_replay_of_a_batch_is_skipped(spark, table, day):
    t = table(ALWAYS)
    assert t.upsert(rows(spark, day(1), ("a", "x", 1)), "w", 0, day(1)) == 1
    assert t.upsert(rows(spark, day(1), ("a", "y", 9)), "w", 0, day(2)) is None
    assert t.upsert(rows(spark, day(1), ("a", "z", 3)), "other", 0, day(2)) == 2
    assert by_id(t)["a"].name == "z"


def test_split_batches_equal_one(spark, tmp_path, day):
    data = [(f"k{i}", f"n{i}", i) for i in range(60)]
    whole = KeyedTable(spark, str(tmp_path / "a"), CHANGED, 4)
    whole.upsert(rows(spark, day(1), *data), as_of=day(1))
    split = KeyedTable(spark, str(tmp_path / "b"), CHANGED, 4)
    for i in range(3):
        split.upsert(rows(spark, day(1), *data[i::3]), as_of=day(1))
    columns = ["id", "name", "amount", "created", "updated"]
    assert values(whole.read(), *columns) == values(split.read(), *columns)
    keys = [r.sk for r in split.read().collect()]
    assert len(set(keys)) == 60


def test_conditional_update_and_stamps(spark, table, day):
    t = table(CHANGED)
    t.upsert(rows(spark, day(1), ("a", "x", 1), ("b", "y", 2), ("n", None, 3)), as_of=day(2))
    old = by_id(t)
    t.upsert(
        rows(spark, day(3), ("a", "x", 1), ("b", "y", 5), ("n", None, 3), ("c", "z", 7)),
        as_of=day(4),
    )
    new = by_id(t)
    assert new["a"] == old["a"] and new["n"] == old["n"]
    assert (new["b"].amount, new["b"].sk) == (5, old["b"].sk)
    assert (new["b"].created, new["b"].updated) == (day(2), day(4))
    assert (new["c"].created, new["c"].updated) == (day(4), day(4))
    assert len({r.sk for r in new.values()}) == 4


def test_unconditional_update_and_created_from_source(spark, table, day):
    t = table(ALWAYS)
    t.upsert(rows(spark, day(1), ("a", "x", 1)), as_of=day(2))
    t.upsert(rows(spark, day(3), ("a", "x", 1)), as_of=day(4))
    a = by_id(t)["a"]
    assert (a.created, a.updated) == (day(1), day(4))


def test_newest_duplicate_wins(spark, table, day):
    t = table(CHANGED)
    old, new = rows(spark, day(1), ("a", "z", 9)), rows(spark, day(2), ("a", "b", 1))
    t.upsert(new.unionByName(old), as_of=day(3))
    assert by_id(t)["a"].name == "b"


def test_newest_is_stable_for_ties(spark, day):
    a, b = rows(spark, day(1), ("a", "x", 1)), rows(spark, day(1), ("a", "y", 0))
    for df in (a.unionByName(b), b.unionByName(a)):
        assert newest_per_key(df, "id", "ingested_at").first().name == "y"


def test_only_touched_buckets_are_rewritten(spark, table, day):
    t = table(CHANGED)
    t.upsert(rows(spark, day(1), *[(f"k{i}", "n", i) for i in range(40)]), as_of=day(1))
    t.upsert(rows(spark, day(1), ("k7", "m", 7)), as_of=day(2))
    m = t.manifest()
    assert {version for _, version in m.homes.values()} == {1} and len(m.homes) == 4
    assert [(version, n) for _, version, n in m.deltas] == [(2, 2)]  # the row before and after
    assert t.read().count() == 40 and by_id(t)["k7"].name == "m"


def test_unpublished_version_is_invisible_and_redone(spark, table, day, tmp_path, monkeypatch):
    t = table(CHANGED)
    t.upsert(rows(spark, day(1), ("a", "x", 1)), "w", 0, day(1))

    def lost(*_):
        raise OSError("driver lost")

    batch = rows(spark, day(1), ("a", "y", 2), ("b", "z", 3))
    with monkeypatch.context() as m:
        m.setattr(files, "write_text", lost)
        with pytest.raises(OSError):
            t.upsert(batch, "w", 1, day(2))
    assert by_id(t)["a"].name == "x" and len(by_id(t)) == 1
    assert t.upsert(batch, "w", 1, day(2)) == 2
    assert by_id(t)["a"].name == "y" and len(by_id(t)) == 2


def test_empty_batch(spark, table, day):
    t = table(CHANGED)
    t.upsert(rows(spark, day(1)), "w", 0, day(1))
    assert t.read().count() == 0
    t.upsert(rows(spark, day(1), ("a", "x", 1)), "w", 1, day(1))
    t.upsert(rows(spark, day(1)), "w", 2, day(1))
    assert t.read().count() == 1 and t.manifest().applied == {"w": 2}


def test_calendar_rows_are_never_updated(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "d"), GOLD_SPECS["dim_date"], 2)
    days = spark.sql(
        "select 20240101 date_id_sk, date'2024-01-01' dates, 1 months, 'Jan' month_name, "
        "1 quarters, 2024 years, 'Mon' days"
    )
    t.upsert(days)
    t.upsert(days.withColumn("days", F.lit("?")))
    assert [r.days for r in t.read().collect()] == ["Mon"]


def test_merge_shuffles_once(spark, day):
    from clientele.operators.upsert import merge_rows

    a = rows(spark, day(1), ("a", "x", 1)).selectExpr(
        "1L sk", "id", "name", "amount", "ingested_at created", "ingested_at updated"
    )
    merged = merge_rows(a, rows(spark, day(1), ("b", "x", 1)), CHANGED, 4, datetime(2024, 1, 1))
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_writers_side_by_side_all_land(spark, tmp_path):
    """Two upserts of nine dates each, started from the same version."""
    path = str(tmp_path / "d")

    def dates(first):
        return spark.range(first, first + 9).selectExpr(
            "cast(id as int) date_id_sk", "date'2024-01-01' dates", "1 months", "'Jan' month_name",
            "1 quarters", "2024 years", "'Mon' days",
        )

    def write(n):
        KeyedTable(spark, path, GOLD_SPECS["dim_date"], 2).upsert(dates(100 * n), f"w{n}", 0)

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(write, range(4)))
    t = KeyedTable(spark, path, GOLD_SPECS["dim_date"], 2)
    assert t.read().count() == 36 and t.manifest().version == 4
    assert t.changes().count() == 36 and t.manifest().applied == {f"w{n}": 0 for n in range(4)}


def test_writers_in_two_processes_all_land(spark, tmp_path):
    """No lock of this process helps here: of two writers of one version, the file system lets one through."""
    code = """
import sys
from clientele.operators.keyed_table import KeyedTable
from clientele.operators.upsert import GOLD_SPECS
from clientele.session import local_session
path, n = sys.argv[1], int(sys.argv[2])
spark = local_session(2, "writer", **{"spark.sql.shuffle.partitions": "2"})
for k in range(4):
    rows = spark.range(1000 * n + 10 * k, 1000 * n + 10 * k + 5).selectExpr(
        "cast(id as int) date_id_sk", "date'2024-01-01' dates", "1 months", "'Jan' month_name",
        "1 quarters", "2024 years", "'Mon' days")
    KeyedTable(spark, path, GOLD_SPECS["dim_date"], 2).upsert(rows, f"w{n}", k)
"""
    path = str(tmp_path / "d")
    started = [
        subprocess.Popen([sys.executable, "-c", code, path, str(n)], cwd=str(REPO), env=os.environ | {"PYTHONPATH": str(REPO)})
        for n in (1, 2)
    ]
    assert [p.wait(300) for p in started] == [0, 0]
    t = KeyedTable(spark, path, GOLD_SPECS["dim_date"], 2)
    assert sorted(r.date_id_sk for r in t.read().collect()) == [
        1000 * n + 10 * k + i for n in (1, 2) for k in range(4) for i in range(5)
    ]
    assert t.manifest().applied == {"w1": 3, "w2": 3} and t.versions() == list(range(1, 9))
    found = {name for name in files.names(spark, f"{path}/data")}
    assert found == {t.manifest(v).changes for v in t.versions()}  # the losers' folders are gone


def _claim(arguments):
    path, n = arguments
    won = []
    for version in range(200):
        try:
            files.publish_local(f"{path}/{version}.json", f"{n}")
            won.append(version)
        except FileExistsError:
            pass
    return n, won


def test_each_name_is_published_once(tmp_path):
    with get_context("spawn").Pool(6) as pool:
        claims = pool.map(_claim, [(str(tmp_path), n) for n in range(6)], chunksize=1)
    assert sorted(v for _, won in claims for v in won) == list(range(200))
    for n, won in claims:
        assert all((tmp_path / f"{v}.json").read_text() == str(n) for v in won)
    assert len(list(tmp_path.iterdir())) == 200  # no file of a loser is left


def test_other_file_systems_publish_by_their_own_step(spark, tmp_path):
    key = "spark.clientele.publish.file"
    try:
        for how in ("rename", "create"):  # as on HDFS, as on a store with create preconditions
            spark.conf.set(key, how)
            files.write_text(spark, f"{tmp_path}/{how}/1.json", "one")
            with pytest.raises(FileExistsError):
                files.write_text(spark, f"{tmp_path}/{how}/1.json", "two")
            assert files.read_text(spark, f"{tmp_path}/{how}/1.json") == "one"
            assert files.names(spark, f"{tmp_path}/{how}") == ["1.json"]
        spark.conf.set(key, "hope")
        with pytest.raises(ValueError, match="no safe way"):
            files.write_text(spark, f"{tmp_path}/hope/1.json", "one")
    finally:
        spark.conf.unset(key)


def test_a_change_of_nothing_writes_nothing(spark, table, day, tmp_path):
    t = table(CHANGED)
    batch = rows(spark, day(1), *[(f"k{i}", "n", i) for i in range(40)])
    t.upsert(batch, "w", 0, day(1))
    before = files.size_of(spark, f"{tmp_path}/t/data")
    assert t.upsert(batch, "w", 1, day(2)) == 2 and t.upsert(batch, as_of=day(3)) == 2
    assert files.size_of(spark, f"{tmp_path}/t/data") == before
    assert t.manifest().changes is None and t.changes(1).count() == 0


def test_bytes_written_follow_the_changed_rows(spark, table, day, tmp_path):
    t = table(CHANGED)
    t.upsert(rows(spark, day(1), *[(f"k{i}", f"name {i * 7919}", i) for i in range(30_000)]), as_of=day(1))
    size = [files.size_of(spark, f"{tmp_path}/t/data")]
    for k in range(3):
        t.upsert(rows(spark, day(2), (f"k{k}", "x", -1), (f"new{k}", "x", k)), as_of=day(2))
        size.append(files.size_of(spark, f"{tmp_path}/t/data"))
    assert max(b - a for a, b in zip(size, size[1:])) < size[0] / 20


SHAPES = Upkeep(share=0.3, least_rows=1, most_folders=4)


@pytest.mark.parametrize("limit", [None, 1])
def test_compaction_changes_no_row(spark, tmp_path, day, limit):
    t = KeyedTable(spark, str(tmp_path / "t"), CHANGED, 4, Upkeep(least_rows=10**9))
    t.upsert(rows(spark, day(1), *[(f"k{i}", "n", i) for i in range(30)]), as_of=day(1))
    for k in range(3):
        t.upsert(rows(spark, day(2), *[(f"k{i}", "m", i + k) for i in range(0, 30, 3 + k)], (f"x{k}", "n", 1)))
    before, manifest = values(t.read()), t.manifest()
    while t.compact(limit) is not None:
        assert values(t.read()) == before
        t.upsert(rows(spark, day(3), ("k29", "late", t.manifest().version)))
        before = values(t.read())
        if t.manifest().version > 14:
            break
    t.compact()
    assert t.manifest().deltas == [] and values(t.read()) == before
    assert t.manifest().rows == 33 and t.manifest().last_key == manifest.last_key
    old = t.versions()
    t.expire(keep=1)
    assert t.versions() == old[-1:] and values(t.read()) == before
    assert len(files.names(spark, f"{tmp_path}/t/data")) <= 4


def test_buckets_grow_and_keys_stay(spark, tmp_path, day):
    t = KeyedTable(spark, str(tmp_path / "t"), CHANGED, 3, Upkeep(bucket_rows=10))
    for k in range(5):
        t.upsert(rows(spark, day(1), *[(f"k{k}-{i}", "n", i) for i in range(25)], ("same", "n", k)), as_of=day(1))
    grown = t.read()
    assert t.manifest().buckets == 24 and grown.count() == 126
    keys = {r.id: r.sk for r in grown.collect()}
    assert len(set(keys.values())) == 126
    t.grow(29)  # any number, one by one
    t.upsert(rows(spark, day(1), *[(f"z{i}", "n", i) for i in range(20)]), as_of=day(1))
    after = {r.id: r.sk for r in t.read().collect()}
    assert t.manifest().buckets == 29 and len(set(after.values())) == 146
    assert all(after[k] == v for k, v in keys.items())
    for bucket, (folder, _) in t.manifest().homes.items():
        if folder:
            own = spark.read.parquet(f"{tmp_path}/t/data/{folder}/_bucket={bucket}")
            assert {r.b for r in own.select(bucket_of(F.col("id"), 29).alias("b")).collect()} == {bucket}


def test_linear_hashing_splits_one_bucket_at_a_time(spark):
    keys = spark.range(2000).select(F.col("id").cast("string").alias("k"))
    for n in range(1, 20):
        pairs = keys.select(bucket_of(F.col("k"), n).alias("a"), bucket_of(F.col("k"), n + 1).alias("b"))
        moved = {(r.a, r.b) for r in pairs.distinct().collect() if r.a != r.b}
        assert moved == {(parent_of(n, n), n)}


def net(changes):
    """The rows that changes leave: images after, without those taken back later."""
    state = {}
    for r in sorted(changes.collect(), key=lambda r: (r._version, r._change != "update_preimage")):
        if r._change == "update_preimage":
            assert state.pop(r.id) == (r.name, r.amount)
        else:
            assert r.id not in state
            state[r.id] = (r.name, r.amount)
    return state


def test_changes_have_both_images(spark, tmp_path, day):
    t = KeyedTable(spark, str(tmp_path / "t"), CHANGED, 4, SHAPES)
    for k in range(6):
        t.upsert(rows(spark, day(1), *[(f"k{i}", "n", i * (k % 2)) for i in range(k, k + 5)]), as_of=day(1))
    assert net(t.changes()) == {r.id: (r.name, r.amount) for r in t.read().collect()}
    kinds = {r._change for r in t.changes().collect()}
    assert kinds == {"insert", "update_preimage", "update_postimage"}
    half = t.versions()[len(t.versions()) // 2]
    seen = net(t.changes(0, half))
    assert seen == {r.id: (r.name, r.amount) for r in t.read(half).collect()}


def test_followers_see_every_change_once(spark, tmp_path, day):
    t = KeyedTable(spark, str(tmp_path / "t"), CHANGED, 4, SHAPES)
    got = []

    def work(changes, batch):
        got.append((batch, changes.collect()))

    def follow(where="c", **options):
        t.follow(work, str(tmp_path / where), **options).awaitTermination()
        return sorted((r._version, r._change, r.id, r.amount) for _, own in got for r in own)

    follow()  # there is no table yet
    want = []
    for k in range(4):
        t.upsert(rows(spark, day(1), ("a", "n", k), (f"b{k}", "n", k)), as_of=day(1))
        if k != 1:
            want = sorted((r._version, r._change, r.id, r.amount) for r in t.changes().collect())
            assert follow() == want
    assert follow() == want  # nothing new
    # a batch that fails comes again, whole
    t.upsert(rows(spark, day(1), ("c", "n", 1)), as_of=day(1))

    def broken(changes, batch):
        raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        t.follow(broken, str(tmp_path / "c")).awaitTermination()
    assert follow() == sorted((r._version, r._change, r.id, r.amount) for r in t.changes().collect())
    # without its checkpoint a follower gets all; when versions have expired, the table
    got.clear()
    assert net(t.changes()) and follow("d", versions_per_batch=2) == sorted(
        (r._version, r._change, r.id, r.amount) for r in t.changes().collect()
    )
    t.expire(keep=1)
    got.clear()
    follow("e")
    (_, own), = got
    assert {r._change for r in own} == {"insert"} and len(own) == t.read().count()


def test_an_orphaned_folder_does_not_count(spark, table, day, tmp_path):
    t = table(CHANGED)
    t.upsert(rows(spark, day(1), ("a", "x", 1)), as_of=day(1))
    (home,) = {folder for folder, _ in t.manifest().homes.values()}
    spark.read.parquet(f"{tmp_path}/t/data/{home}").write.parquet(f"{tmp_path}/t/data/v-000000000001-dead")
    spark.read.parquet(f"{tmp_path}/t/data/{home}").write.parquet(f"{tmp_path}/t/data/v-000000000009-live")
    assert t.read().count() == 1 and t.changes().count() == 1
    t.upsert(rows(spark, day(1), ("b", "x", 1)), as_of=day(1))
    assert t.expire(keep=1) == ["v-000000000001-dead"]  # the other's writer may be at work


def test_version_files_are_never_replaced(spark, tmp_path):
    files.write_text(spark, f"{tmp_path}/v/1.json", "one")
    with pytest.raises(FileExistsError):
        files.write_text(spark, f"{tmp_path}/v/1.json", "two")
    assert files.read_text(spark, f"{tmp_path}/v/1.json") == "one"
    assert files.names(spark, f"{tmp_path}/v") == ["1.json"]


def test_stamps_follow_the_session_clock(spark, table, day):
    """Whatever the zone of the machine, created and updated come from one clock."""
    old = spark.conf.get("spark.sql.session.timeZone")
    t = table(CHANGED)
    try:
        spark.conf.set("spark.sql.session.timeZone", "Pacific/Auckland")
        now = spark.range(1).select(F.localtimestamp()).first()[0]
        t.upsert(rows(spark, now, ("a", "x", 1)))
        r = by_id(t)["a"]
        assert now <= r.created <= r.updated
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
