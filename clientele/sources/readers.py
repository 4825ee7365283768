"""Batch readers, the raw dump and the typed load with its two error policies."""

import io
import json
import uuid
from collections.abc import Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.operators import files


def read_feed(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", **options: str
) -> DataFrame:
    """Read one feed with a fixed schema. Formats: parquet, orc, json, csv, delta, xlsx."""
    if fmt == "xlsx":
        return read_workbooks(spark, path, schema)
    if fmt == "csv":
        options = {"header": "true", **options}
    if fmt == "delta":
        return spark.read.format("delta").options(**options).load(path)
    return spark.read.schema(schema).format(fmt).options(**options).load(path)


def read_workbooks(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read spreadsheet files, one task per workbook. Needs openpyxl on the executors."""
    columns = schema.fieldNames()
    as_text = T.StructType([T.StructField(c, T.StringType()) for c in columns])

    def parse(batches):
        for files in batches:
            for content in files["content"]:
                sheet = pd.read_excel(io.BytesIO(content), engine="openpyxl", dtype=object)
                text = sheet.reindex(columns=columns).astype("string")
                yield text.astype(object).where(text.notna(), None)

    files = spark.read.format("binaryFile").load(path).select("content")
    rows = files.mapInPandas(parse, as_text)
    return rows.select([F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def append_raw(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append to a raw folder; columns may come and go between drops."""
    writer = df.write.mode("append").format(fmt)
    if fmt == "delta":
        writer = writer.option("mergeSchema", "true")
    writer.save(path)


def read_raw(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read a raw folder with the union of the columns of its drops."""
    return spark.read.format(fmt).option("mergeSchema", "true").load(path)


def _as_type(df: DataFrame, f: T.StructField) -> Column:
    """Column `f` of `df` cast to its type; absent columns and values that do not fit are null."""
    if f.name not in df.columns:
        return F.lit(None).cast(f.dataType)
    c = F.col(f.name)
    source = df.schema[f.name].dataType
    if isinstance(f.dataType, T.IntegralType) and not isinstance(source, T.IntegralType):
        # whole numbers round half up; a cast alone would cut
        c = F.round(c.try_cast("decimal(38,6)"))
    return c.try_cast(f.dataType)


def extract_typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast the schema's columns by name.

    Adds `_bad`, the columns whose value did not fit, and `_file`, where the row came from.
    """
    bad = [
        F.when(F.col(f.name).isNotNull() & _as_type(df, f).isNull(), F.lit(f.name))
        for f in schema.fields
        if f.name in df.columns
    ]
    file = F.col("_file") if "_file" in df.columns else F.col("_metadata.file_path")
    return df.select(
        *[_as_type(df, f).alias(f.name) for f in schema.fields],
        F.array_compact(F.array(*bad)).alias("_bad"),
        file.alias("_file"),
    )


def load_typed(
    df: DataFrame, schema: T.StructType, on_error: str = "skip_row"
) -> tuple[DataFrame, DataFrame]:
    """Typed rows and rejects.

    `skip_row` rejects the rows with a value that does not fit; `skip_file` rejects every row of a
    file that has such a row. Rejects keep the file and the reason.
    """
    return split_typed(extract_typed(df, schema), schema, on_error)


def split_typed(
    rows: DataFrame, schema: T.StructType, on_error: str = "skip_row"
) -> tuple[DataFrame, DataFrame]:
    """`load_typed` of rows that `extract_typed` has made; they are read more than once."""
    columns = schema.fieldNames()
    is_bad = F.size("_bad") > 0
    reason = F.concat(F.lit("cannot cast: "), F.array_join("_bad", ", "))
    if on_error == "skip_row":
        good = rows.where(~is_bad).select(columns)
        rejects = rows.where(is_bad).select(*columns, "_file", reason.alias("_reason"))
        return good, rejects
    if on_error == "skip_file":
        bad_files = (
            rows.where(is_bad)
            .groupBy("_file")
            .agg(F.count("*").alias("n"))
            .select("_file", F.concat(F.col("n"), F.lit(" bad rows in file")).alias("_reason"))
        )
        good = rows.join(bad_files, "_file", "left_anti").select(columns)
        rejects = rows.join(bad_files, "_file").select(*columns, "_file", "_reason")
        return good, rejects
    raise ValueError(f"on_error must be skip_row or skip_file, not {on_error!r}")


# ---- files that may not be readable ------------------------------------------------------------

#: What Spark's binaryFile source gives; a stream of it is a stream of files.
FILE = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)
PROBE = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("columns", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for path, length, content in zip(*(batch.column(c) for c in ("path", "length", "content"))):
            rows, columns, error = None, None, None
            try:
                file = pq.ParquetFile(pa.BufferReader(content.as_buffer()))
                rows = sum(b.num_rows for b in file.iter_batches(batch_size=8192))  # decodes every page
                columns = ", ".join(f"{f.name} {f.type}" for f in file.schema_arrow)
            except Exception as e:
                error = f"{type(e).__name__}: {e}"[:500]
            found.append((path.as_py(), length.as_py(), rows, columns, error))
        rows = [dict(zip(PROBE.names, r, strict=True)) for r in found]
        yield pa.RecordBatch.from_pylist(rows, schema=_PROBE_ARROW)


_PROBE_ARROW = pa.schema(
    [("path", pa.string()), ("length", pa.int64()), ("row_count", pa.int64()), ("columns", pa.string()), ("error", pa.string())]
)


def probe_files(files: DataFrame) -> DataFrame:
    """Rows, columns and types of Parquet files, or why one cannot be read; a task looks at a few files.

    files: rows of the binaryFile source. Every page is decoded, so a file that passes will be read.
    """
    return files.select("path", "length", "content").mapInArrow(_probe, PROBE)


def read_probed(spark: SparkSession, found: list, schema: T.StructType) -> DataFrame:
    """Typed rows, as `extract_typed` gives them, of the files that could be read.

    found: rows of a probe, one for each file of a batch. Files of equal columns and types are read
    together, each such group by its own types, so a type that was widened between drops, a new column
    or one that is gone are no errors.
    """
    groups: dict[str, list[str]] = {}
    for r in found:
        if r["error"] is None:
            groups.setdefault(r["columns"], []).append(r["path"])
    typed = [extract_typed(spark.read.parquet(*sorted(paths)), schema) for _, paths in sorted(groups.items())]
    if not typed:
        none = spark.createDataFrame([], schema).withColumn("_file", F.lit(""))
        return extract_typed(none, schema)
    return reduce(DataFrame.unionByName, typed)


# ---- raw drops with a history of schemas -------------------------------------------------------

#: Types that values of a type may be widened to, narrowest first.
WIDER = [
    ["tinyint", "smallint", "int", "bigint", "decimal(38,0)"],
    ["tinyint", "smallint", "int", "double"],
    ["float", "double"],
    ["date", "timestamp_ntz"],
]


def wider_type(a: str, b: str) -> str:
    """The narrower of the types that both can be widened to."""
    if a == b:
        return a
    for line in WIDER:
        if a in line and b in line:
            return line[max(line.index(a), line.index(b))]
    raise ValueError(f"no type holds both {a} and {b}")


def append_drop(df: DataFrame, path: str) -> str:
    """Add a drop to a raw folder, in a folder of its own; its schema goes to the log. Returns its name.

    The log entry is published last, so a drop that was not written to its end is not read.
    """
    name = f"drop-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{name}")
    columns = [[f.name, f.dataType.simpleString()] for f in df.schema.fields]
    entry = json.dumps({"name": name, "columns": columns})
    while True:
        number = len([n for n in files.names(df.sparkSession, f"{path}/schemas") if n[0].isdigit()])
        try:
            files.write_text(df.sparkSession, f"{path}/schemas/{number:08d}.json", entry)
            return name
        except FileExistsError:  # another drop came first
            continue


def read_drops(spark: SparkSession, path: str) -> DataFrame:
    """All drops under the union of their columns, each type as wide as any drop has it; `_drop` is its number.

    The schemas come from the log, not from the files' footers. Drops of one schema are read together;
    columns that a drop does not have are null. Types without a common wider one are an error.
    """
    names = [n for n in files.names(spark, f"{path}/schemas") if n[0].isdigit()]
    entries = [json.loads(files.read_text(spark, f"{path}/schemas/{n}")) for n in names]
    types: dict[str, str] = {}
    groups: dict[str, list[str]] = {}
    numbers = {}
    for number, entry in enumerate(entries):
        numbers[entry["name"]] = number
        for name, kind in entry["columns"]:
            types[name] = wider_type(types.get(name, kind), kind)
        groups.setdefault(json.dumps(entry["columns"]), []).append(entry["name"])
    parts = []
    for columns, drops in groups.items():
        have = dict(json.loads(columns))
        schema = T.StructType.fromDDL(", ".join(f"`{c}` {t}" for c, t in have.items()))
        rows = spark.read.schema(schema).parquet(*[f"{path}/{d}" for d in drops])
        of = F.regexp_extract(F.col("_metadata.file_path"), "/(drop-[0-9a-f]+)/", 1)
        values = [F.col(c).cast(t) if c in have else F.lit(None).cast(t) for c, t in types.items()]
        number = F.element_at(F.create_map(*[F.lit(x) for d in drops for x in (d, numbers[d])]), of)
        parts.append(rows.select(*[v.alias(c) for v, c in zip(values, types)], number.alias("_drop")))
    if not parts:
        raise FileNotFoundError(f"no drop in {path}")
    return reduce(DataFrame.unionByName, parts)
