"""WARC archives: written by Spark's text writer, read by a Python data source.

The reader plans partitions of whole files, takes predicates on record types and headers, parses a
record's headers first, and passes over payloads that nobody asked for without reading them.
"""

import gzip
import io
import json
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    StringContains,
    StringEndsWith,
    StringStartsWith,
)
from pyspark.sql.types import StructType

from clientele.llm.scratch import BROADCAST_BYTES, Scratch

SCHEMA = (
    "record_type string, record_id string, target_uri string, date string, refers_to string, "
    "payload_digest string, content_type string, content_length long, payload_length long, "
    "payload binary, file string, position long"
)
_NAMES = [part.split()[0] for part in SCHEMA.split(", ")]
_ARROW = pa.schema(
    [
        pa.field(n, {"long": pa.int64(), "binary": pa.binary()}.get(t, pa.string()))
        for n, t in (part.split() for part in SCHEMA.split(", "))
    ]
)
#: Columns known once a record's headers are parsed: predicates on them decide whether it is read.
HEADERS = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "target_uri": "warc-target-uri",
    "date": "warc-date",
    "refers_to": "warc-refers-to",
    "payload_digest": "warc-payload-digest",
    "content_type": "content-type",
    "content_length": "content-length",
}
#: Bytes of archives in a partition, and of payloads in a batch.
PARTITION_BYTES = 128 << 20
BATCH_BYTES = 4 << 20
BATCH_ROWS = 2000

_TESTS = {
    EqualTo: lambda a, b: a is not None and a == b,
    EqualNullSafe: lambda a, b: a == b,
    GreaterThan: lambda a, b: a is not None and a > b,
    GreaterThanOrEqual: lambda a, b: a is not None and a >= b,
    LessThan: lambda a, b: a is not None and a < b,
    LessThanOrEqual: lambda a, b: a is not None and a <= b,
    In: lambda a, b: a is not None and a in b,
    StringStartsWith: lambda a, b: a is not None and a.startswith(b),
    StringEndsWith: lambda a, b: a is not None and a.endswith(b),
    StringContains: lambda a, b: a is not None and b in a,
    IsNull: lambda a, _: a is None,
    IsNotNull: lambda a, _: a is not None,
}


class Files(InputPartition):
    def __init__(self, names: list[str]):
        super().__init__(names)


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.files: list[tuple[str, int]] = [tuple(x) for x in json.loads(options["files"])]
        self.payload = options.get("payload", "true") == "true"
        self.share = int(options.get("partitionbytes", PARTITION_BYTES))
        self.tests: list[tuple[str, type, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name in HEADERS and type(f) in _TESTS:
                self.tests.append((name, type(f), getattr(f, "value", None)))
            else:
                yield f

    def partitions(self) -> list[Files]:
        """Whole files, several small ones together; a record has no mark to split a file at."""
        out: list[list[str]] = []
        room = 0
        for name, size in sorted(self.files, key=lambda f: -f[1]):
            if not out or size > room:
                out.append([])
                room = self.share
            out[-1].append(name)
            room -= size
        return [Files(names) for names in out]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        for name in partition.value:
            with open_archive(name) as stream:
                rows, held = [], 0
                for row in self._records(stream, name):
                    rows.append(row)
                    held += len(row["payload"] or b"")
                    if held > BATCH_BYTES or len(rows) >= BATCH_ROWS:
                        yield pa.RecordBatch.from_pylist(rows, _ARROW)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _ARROW)

    def _wanted(self, row: dict) -> bool:
        return all(_TESTS[kind](row[name], value) for name, kind, value in self.tests)

    def _records(self, stream, name: str) -> Iterator[dict]:
        while True:
            position = stream.tell()
            line = stream.readline()
            if not line:
                return
            if not line.strip():
                continue  # the lines that end a record
            if not line.startswith(b"WARC/"):
                raise ValueError(f"no record at byte {position} of {name}")
            headers = _header_lines(stream)
            row = {column: headers.get(key) for column, key in HEADERS.items()}
            length = int(headers.get("content-length", 0))
            row |= {"content_length": length, "file": name, "position": position}
            if self._wanted(row):
                yield row | self._block(stream, headers, length)
            else:
                _skip(stream, length)

    def _block(self, stream, headers: dict[str, str], length: int) -> dict:
        """The payload and its length: what follows the HTTP headers, if there are any."""
        left, said = length, None
        if headers.get("content-type", "").startswith("application/http"):
            before = stream.tell()
            stream.readline()
            said = _header_lines(stream).get("content-length")
            left -= stream.tell() - before
        revisit = headers.get("warc-type") == "revisit"
        size = int(said) if revisit and said and said.isdigit() else left
        if revisit or not self.payload:
            _skip(stream, left)
            return {"payload": None, "payload_length": size}
        payload = stream.read(left)
        if len(payload) < left:
            raise ValueError("an archive ends within a record")
        return {"payload": payload, "payload_length": size}


def _header_lines(stream) -> dict[str, str]:
    """Names in lower case; up to the empty line."""
    out: dict[str, str] = {}
    while (line := stream.readline()).strip():
        name, _, value = line.decode("utf-8", "replace").partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def _skip(stream, n: int) -> None:
    if isinstance(stream, gzip.GzipFile):
        while n > 0 and (part := stream.read(min(n, 1 << 20))):
            n -= len(part)
    else:
        stream.seek(n, io.SEEK_CUR)


def open_archive(name: str):
    """A stream over an archive on any file system that Arrow knows; gzip by its name."""
    if "://" in name or name.startswith("file:"):
        system, path = pyarrow.fs.FileSystem.from_uri(name)
    else:
        system, path = pyarrow.fs.LocalFileSystem(), name
    raw = io.BufferedReader(system.open_input_file(path), 1 << 18)
    return gzip.GzipFile(fileobj=raw) if name.endswith(".gz") else raw


class WarcDataSource(DataSource):
    """format("warc"). Options: files (JSON of names and sizes), payload, partitionbytes."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(self.options)


def read_warc(
    spark: SparkSession, path: str, payload: bool = True, partition_bytes: int = PARTITION_BYTES
) -> DataFrame:
    """One row per record of the archives in a folder, or of one archive.

    payload_length is that of the body without HTTP headers; for a revisit it is the length that the
    HTTP headers state. payload is null for revisits and if `payload` is False, when it is passed over
    unread. Filters on the columns of HEADERS reach the reader. Missing headers are null; an empty
    folder gives no rows; a record cut short is an error. Files whose names begin with _ or . are left
    out.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)
    files = [
        (f.getPath().toString(), f.getLen())
        for f in found
        if f.isFile() and f.getPath().getName()[0] not in "_."
    ]
    source = spark.read.format("warc").option("files", json.dumps(files))
    source = source.option("payload", str(payload).lower())
    return source.option("partitionbytes", str(partition_bytes)).load()


def _header_value(value):
    """A value without line breaks, as they would end the header."""
    return F.regexp_replace(F.regexp_replace(value, "\r", "%0D"), "\n", "%0A")


def _line(name: str, value):
    """A header, or nothing for a null value."""
    return F.when(value.isNull(), "").otherwise(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")))


def deduplicated(
    pages: DataFrame,
    scratch: Scratch,
    min_bytes: int = 1000,
    broadcast_bytes: int = BROADCAST_BYTES,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, refers_to (null for responses).

    Of equal payloads of at least `min_bytes` bytes, rows with the largest id are responses, all
    others refer to it. Equality is that of SHA-1 and length. Payloads are counted with partial
    aggregation, so a payload that a third of all pages have is no hot group.
    """
    payload = F.coalesce(pages[html], F.lit(""))
    rows = pages.select(
        pages[page_id].alias("page_id"),
        pages[url].alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha1(payload).alias("payload_digest"),
    )
    same = ["payload_digest", "payload_bytes"]
    shared = rows.where(F.col("payload_bytes") >= min_bytes).groupBy(*same).agg(
        F.max("page_id").alias("last"), F.count("*").alias("n")
    )
    shared = scratch.write(shared.where("n > 1").drop("n"), "shared")
    out = rows.join(scratch.joinable(shared, broadcast_bytes), same, "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("last")), F.col("last"))
    return out.withColumn("refers_to", refers).drop("last")


def write_warc(
    pages: DataFrame,
    path: str,
    date: str = "2024-01-01T00:00:00Z",
    compression: str = "none",
    min_bytes: int = 1000,
    max_records: int = 100_000,
    broadcast_bytes: int = BROADCAST_BYTES,
    **columns: str,
) -> None:
    """Archives of the pages (page_id, url, html; `columns` names others), one record per row.

    A null html is an empty payload, a null url has no header; rows without an id are named by null;
    line breaks in a url are percent-encoded. Rows that repeat are records of their own: with the
    largest id of their payload they are all responses. No pages give no records. Other columns are
    left out. Files hold at most `max_records` records.
    """
    scratch = Scratch(pages.sparkSession, "warc")
    rows = deduplicated(pages, scratch, min_bytes, broadcast_bytes, **columns)
    revisit = F.col("refers_to").isNotNull()
    body = F.when(revisit, "").otherwise(F.col("payload"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit("\r\n\r\n"),
    )
    urn = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    record = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\n"),
        _line("WARC-Record-ID", F.coalesce(urn(F.col("page_id")), F.lit("<urn:page:null>"))),
        _line("WARC-Target-URI", _header_value(F.col("url"))),
        F.lit(f"WARC-Date: {date}\r\n"),
        _line("WARC-Refers-To", urn(F.col("refers_to"))),
        F.when(
            revisit,
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n",
        ).otherwise(""),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest"), F.lit("\r\n")),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "),
        (F.octet_length(http) + F.octet_length(body)).cast("string"),
        F.lit("\r\n\r\n"),
        http,
        body,
    )
    writer = rows.select(record.alias("value")).write.option("lineSep", "\r\n\r\n")
    writer = writer.option("maxRecordsPerFile", max_records)
    writer.option("compression", compression).text(path)


def page_of(urn):
    """The id in <urn:page:id>; null where it is none."""
    return F.regexp_extract(urn, r"^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")
