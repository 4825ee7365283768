"""Keyed upsert of frames, and the specifications of the keyed tables."""

from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele import schemas
from clientele.operators.joins import broadcast_threshold, estimated_bytes
from clientele.operators.surrogate import bucket_of, key_in_bucket
from clientele.sources.audit import stamp

INSERT, UPDATE, BEFORE = "insert", "update_postimage", "update_preimage"


@dataclass(frozen=True)
class TableSpec:
    """A keyed table: business key, columns, and optionally a surrogate and two stamps.

    `when_changed`: update only where one of these columns differs; None updates every match, ()
    none. `created_from`: source column for the created stamp of an insert; None takes the merge
    time.
    """

    key: str
    columns: T.StructType
    surrogate: str | None = None
    stamps: tuple[str, ...] = ()
    when_changed: tuple[str, ...] | None = None
    created_from: str | None = None

    @property
    def schema(self) -> T.StructType:
        surrogate = [T.StructField(self.surrogate, T.LongType())] if self.surrogate else []
        stamps = [T.StructField(s, T.TimestampNTZType()) for s in self.stamps]
        return T.StructType([*surrogate, *self.columns.fields, *stamps])


def _silver(feed: str, **options) -> TableSpec:
    return TableSpec(
        schemas.KEYS[feed],
        schemas.SILVER[feed],
        schemas.SURROGATES[feed],
        schemas.STAMPS[feed],
        **options,
    )


SPECS = {
    "customers": _silver("customers", created_from="ingested_at"),
    "transactions": _silver(
        "transactions",
        when_changed=tuple(
            c for c in schemas.SILVER["transactions"].fieldNames() if c != "transaction_id"
        ),
    ),
    "support": _silver("support", created_from="ingested_at"),
    "web": _silver("web"),
}

GOLD_SPECS = {
    # a date that is there already stays as it is
    "dim_date": TableSpec("date_id_sk", schemas.GOLD["dim_date"], when_changed=()),
    "dim_customers": TableSpec("customer_id", schemas.GOLD["dim_customers"]),
    "dim_support": TableSpec("ticket_id", schemas.GOLD["dim_support"]),
    "dim_sessions": TableSpec("session_id", schemas.GOLD["dim_sessions"]),
    "fact_transactions": TableSpec("transaction_id", schemas.GOLD["fact_transactions"]),
}


def newest_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key: the newest by `order`, then the greatest by the other columns.

    A maximum, not a window: copies of one key shrink on the map side.
    """
    rest = [c for c in df.columns if c not in (key, order)]
    newest = df.groupBy(key).agg(F.max(F.struct(order, *rest)).alias("_row"))
    return newest.select(key, "_row.*").select(df.columns)


def merge_rows(
    target: DataFrame, source: DataFrame, spec: TableSpec, buckets: int, as_of: datetime | None
) -> DataFrame:
    """Target after the upsert of `source`, with `_bucket` and `_change`.

    Both sides have one row per key; `target` may be any whole buckets of the table. `_change` is
    'insert', 'update_postimage' or null for an untouched row. Both sides meet by grouping their
    union, which is shuffled by bucket and sorted by key once; that also serves the numbering of
    new rows and the write.
    """
    # columns a frame does not have, such as a customer key not attached, are left out
    names = [c for c in spec.columns.fieldNames() if c in source.columns]
    kept = [c for c in spec.schema.fieldNames() if c in names or c not in spec.columns.names]
    extra = [spec.created_from] if spec.created_from else []
    bucket = bucket_of(F.col(spec.key), buckets).alias("_bucket")
    t = target.select(bucket, F.col(spec.key).alias("_key"), F.struct(kept).alias("t"))
    s = source.select(bucket, F.col(spec.key).alias("_key"), F.struct(names + extra).alias("s"))
    both = (
        t.unionByName(s, allowMissingColumns=True)
        .repartition("_bucket")
        .groupBy("_bucket", "_key")
        .agg(F.first("t", ignorenulls=True).alias("t"), F.first("s", ignorenulls=True).alias("s"))
    )
    is_new, has_source = F.col("t").isNull(), F.col("s").isNotNull()
    written = has_source & (is_new | _differs(spec, {c: F.col(f"s.{c}") for c in names}))
    now = stamp(as_of)
    values = {c: F.when(written, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")) for c in names}
    values[spec.key] = F.col("_key")
    if spec.surrogate:
        # new rows continue the sequence of their bucket, in key order
        place = W.partitionBy("_bucket")
        so_far = place.orderBy("_key").rowsBetween(W.unboundedPreceding, W.currentRow)
        old = F.col(f"t.{spec.surrogate}")
        used = F.coalesce(F.max(F.floor((old - 1) / buckets) + 1).over(place), F.lit(0))
        rank = F.count(F.when(is_new, 1)).over(so_far)
        fresh = key_in_bucket(used + rank, F.col("_bucket"), buckets).cast("long")
        values[spec.surrogate] = F.coalesce(old, fresh)
    if spec.stamps:
        created, updated = spec.stamps
        born = F.col(f"s.{spec.created_from}") if spec.created_from else now
        values[created] = F.when(is_new, born).otherwise(F.col(f"t.{created}"))
        values[updated] = F.when(written, now).otherwise(F.col(f"t.{updated}"))
    return both.select(
        "_bucket",
        *[values[c].alias(c) for c in kept],
        F.when(is_new, INSERT).when(written, UPDATE).alias("_change"),
    )


def _differs(spec: TableSpec, values: dict[str, Column]) -> Column:
    if spec.when_changed is None:
        return F.lit(True)
    pairs = [(F.col(f"t.{c}"), values[c]) for c in spec.when_changed if c in values]
    return reduce(or_, [~a.eqNullSafe(b) for a, b in pairs], F.lit(False))


def changed_rows(
    target: DataFrame,
    source: DataFrame,
    spec: TableSpec,
    buckets: int,
    last_key: int,
    as_of: datetime | None,
    add: tuple[str, ...] = (),
) -> DataFrame:
    """What an upsert of `source` changes in `target`: the rows it writes, with `_change`.

    Both have one row per key; `target` may be any part of the table that has the source's keys.
    `_change` is 'insert', 'update_preimage' (the row as it was) or 'update_postimage'. The target is
    read through a semi join with a source below the broadcast threshold, which then shuffles no table
    row; a larger source meets the table once, in one shuffle. New surrogates are above `last_key`: each
    bucket draws from an arithmetic sequence of its own. Columns in `add` are added to the row's values.
    """
    names = [c for c in spec.columns.fieldNames() if c in source.columns]
    kept = [c for c in spec.schema.fieldNames() if c in names or c not in spec.columns.names]
    extra = [spec.created_from] if spec.created_from else []
    s = source.select(F.col(spec.key).alias("_key"), F.struct(names + extra).alias("s"))
    if estimated_bytes(source.select(spec.key)) <= broadcast_threshold(source.sparkSession):
        target = target.join(source.select(spec.key), spec.key, "left_semi")
    t = target.select(F.col(spec.key).alias("_key"), F.struct(kept).alias("t"))
    both = s.join(t, "_key", "left")
    now = stamp(as_of)
    values = {c: F.col(f"s.{c}") for c in names}
    born = dict(values)
    for c in add:
        kind = spec.columns[c].dataType
        values[c] = (F.coalesce(F.col(f"t.{c}"), F.lit(0)) + F.col(f"s.{c}")).cast(kind)
        born[c] = F.col(f"s.{c}").cast(kind)
    differs = _differs(spec, values)
    if spec.stamps:
        created, updated = spec.stamps
        values |= {created: F.col(f"t.{created}"), updated: now}
        born |= {created: F.col(f"s.{spec.created_from}") if spec.created_from else now, updated: now}

    def image(change: str, of: dict[str, Column]) -> Column:
        return F.struct(F.lit(change).alias("_change"), *[of[c].alias(c) for c in kept])

    # one pass over the matches gives both images
    before = image(BEFORE, {c: F.col(f"t.{c}") for c in kept})
    if not spec.surrogate:
        inserts = F.array(image(INSERT, born))
        images = F.when(differs, F.array(before, image(UPDATE, values)))
        return both.select(F.inline(F.when(F.col("t").isNull(), inserts).otherwise(images)))
    new, old = both.where("t is null"), both.where("t is not null").where(differs)
    new = new.withColumn("_bucket", bucket_of(F.col("_key"), buckets))
    rank = F.row_number().over(W.partitionBy("_bucket").orderBy("_key"))
    values[spec.surrogate] = F.col(f"t.{spec.surrogate}")
    born[spec.surrogate] = F.lit(last_key) + key_in_bucket(rank, F.col("_bucket"), buckets).cast("long")
    inserts = new.select(F.lit(INSERT).alias("_change"), *[born[c].alias(c) for c in kept])
    return inserts.unionByName(old.select(F.inline(F.array(before, image(UPDATE, values)))))


def buckets_for(size: int, per_bucket: int = 512 << 20) -> int:
    """Buckets for a table expected to grow to `size` bytes."""
    return max(8, -(-size // per_bucket))


def empty_table(spark: SparkSession, spec: TableSpec) -> DataFrame:
    # a range of no rows: the optimizer knows its size, so joins with it are planned as small
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in spec.schema.fields]
    return spark.range(0).select(columns)
