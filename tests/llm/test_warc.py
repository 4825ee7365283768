"""Archives: round trips, pushed predicates, passed-over payloads."""

import gzip
import hashlib
import io

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, In, IsNotNull, StringStartsWith

from clientele.llm import warc

SCHEMA = "page_id long, url string, html string"
BIG = "é" * 600


def pages():
    return [
        (1, "http://a/1", BIG), (2, "http://a/2", BIG), (5, "http://b/5", BIG), (3, "http://a/3", "small"),
        (4, None, "small"), (6, "http://x\r\ny", None), (7, "http://c", "WARC/1.1\r\nWARC-Type: x\r\n\r\n" * 40),
        (None, "http://n", BIG), (8, "u", ""), (5, "http://b/5", BIG), (9, "big", "z" * 3_000_000),
    ]


@pytest.fixture(params=["none", "gzip"])
def archives(spark, tmp_path, request):
    path = f"file://{tmp_path}/warc"
    df = spark.createDataFrame([(*p, "extra") for p in pages()], SCHEMA + ", record string")
    warc.write_warc(df.repartition(3), path, compression=request.param)
    return path


def test_round_trip(spark, archives):
    found = warc.read_warc(spark, archives)
    rows = found.collect()
    assert len(rows) == len(pages())
    by_id = {r.record_id: r for r in rows}
    for i, url, html in pages():
        data = (html or "").encode()
        r = by_id[f"<urn:page:{'null' if i is None else i}>"]
        assert r.payload_length == len(data)
        assert r.payload_digest == "sha1:" + hashlib.sha1(data).hexdigest()
        if html == BIG and i != 5:
            assert (r.record_type, r.refers_to, r.payload) == ("revisit", "<urn:page:5>", None)
        else:
            assert (r.record_type, r.refers_to, bytes(r.payload)) == ("response", None, data)
    assert by_id["<urn:page:6>"].target_uri == "http://x%0D%0Ay"
    assert by_id["<urn:page:4>"].target_uri is None
    assert sum(r.record_id == "<urn:page:5>" and r.record_type == "response" for r in rows) == 2


def test_predicates_and_payload_option(spark, archives):
    plain = warc.read_warc(spark, archives, payload=False)
    assert plain.where("payload is not null").count() == 0
    assert plain.agg(F.sum("payload_length")).first()[0] == sum(
        len((p[2] or "").encode()) for p in pages()
    )
    found = warc.read_warc(spark, archives).where(
        "record_type = 'response' and target_uri like 'http://a/%'"
    )
    assert [r.record_id for r in found.collect()] == ["<urn:page:3>"]
    wide = warc.read_warc(spark, archives).where("content_length > 1000000 or target_uri = 'u'")
    assert wide.count() == 2


def reader(path, **options):
    import json
    import os

    files = [(f"{path}/{n}", os.path.getsize(f"{path}/{n}")) for n in os.listdir(path) if n[0] not in "._"]
    return warc.WarcReader({"files": json.dumps(files), **options})


def test_reader_takes_header_predicates_only(tmp_path, spark):
    df = spark.createDataFrame(pages(), SCHEMA)
    warc.write_warc(df.coalesce(1), f"file://{tmp_path}/w")
    r = reader(f"{tmp_path}/w")
    taken = [EqualTo(("record_type",), "response"), In(("record_id",), ("<urn:page:3>", "x"))]
    taken.append(StringStartsWith(("target_uri",), "http"))
    left = [EqualTo(("payload_length",), 5), IsNotNull(("payload",))]
    assert list(r.pushFilters(taken + left)) == left
    rows = [x for p in r.partitions() for b in r.read(p) for x in b.to_pylist()]
    assert [x["record_id"] for x in rows] == ["<urn:page:3>"]


def test_unwanted_payloads_are_not_read(tmp_path, spark, monkeypatch):
    df = spark.createDataFrame([(k, "u", chr(97 + k) * 5_000_000) for k in range(4)], SCHEMA)
    warc.write_warc(df.coalesce(1), f"file://{tmp_path}/w")
    sizes = []

    class Watched(io.FileIO):
        def readinto(self, buffer):
            sizes.append(len(buffer))
            return super().readinto(buffer)

    monkeypatch.setattr(
        warc, "open_archive", lambda name: io.BufferedReader(Watched(name), 1 << 18)
    )
    r = reader(f"{tmp_path}/w")
    list(r.pushFilters([EqualTo(("record_id",), "<urn:page:2>")]))
    rows = [x for p in r.partitions() for b in r.read(p) for x in b.to_pylist()]
    assert [len(x["payload"]) for x in rows] == [5_000_000]
    assert sum(sizes) < 10_000_000  # of 20 million bytes


def test_partitions_are_whole_files():
    import json

    files = [("a", 50), ("b", 60), ("c", 200), ("d", 40)]
    r = warc.WarcReader({"files": json.dumps(files), "partitionbytes": "100"})
    plan = [p.value for p in r.partitions()]
    assert sorted(x for p in plan for x in p) == ["a", "b", "c", "d"]
    assert ["c"] in plan and len(plan) == 3


def test_cut_short_is_an_error(tmp_path):
    with gzip.open(tmp_path / "x.warc.gz", "wb") as f:
        f.write(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 100\r\n\r\nshort")
    r = reader(tmp_path)
    with pytest.raises(ValueError):
        [list(r.read(p)) for p in r.partitions()]


def test_no_pages(spark, tmp_path):
    path = f"file://{tmp_path}/none"
    warc.write_warc(spark.createDataFrame([], SCHEMA), path)
    assert warc.read_warc(spark, path).count() == 0
