"""Lookup join: many rows against a table with one row per key."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SKETCH_ITEMS = 1024  # counters per sketch; a share above about 0.4 % is always seen
MAX_HOT_KEYS = 128  # upper bound of keys treated apart
HOT_SHARE = 0.002  # a key is hot from this share of the rows on


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate, the one automatic broadcasts are decided by."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_threshold(spark: SparkSession) -> int:
    """Bytes up to which Spark broadcasts a table by its estimate; -1 for never."""
    return spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def hot_keys(rows: DataFrame, key: str) -> list:
    """Keys that hold a large share of the rows: at most MAX_HOT_KEYS values.

    One pass over the key column. Sketches merge in two steps, so no task sees one per input split.
    The counts are estimates; they only decide which way a key takes, not the result.
    """
    sketches = (
        rows.where(F.col(key).isNotNull())
        .groupBy(F.pmod(F.spark_partition_id(), F.lit(64)))
        .agg(
            F.expr(f"approx_top_k_accumulate(`{key}`, {SKETCH_ITEMS})").alias("sketch"),
            F.count("*").alias("n"),
        )
    )
    # by a constant: without rows there is no group, and so no sketch to read
    merged = sketches.groupBy(F.lit("all")).agg(
        F.expr(f"approx_top_k_combine(sketch, {SKETCH_ITEMS})").alias("sketch"),
        F.sum("n").alias("n"),
    )
    top = merged.select(
        "n", F.expr(f"inline(approx_top_k_estimate(sketch, {MAX_HOT_KEYS}))")
    )
    return [r["item"] for r in top.where(F.col("count") >= F.col("n") * HOT_SHARE).collect()]


def lookup_join(
    rows: DataFrame, table: DataFrame, key: str, how: str = "inner", hot: Sequence = ()
) -> DataFrame:
    """Join `rows` to `table`, which has one row per `key`; `how` is inner, left or left_semi.

    Spark chooses: a table below its broadcast threshold is broadcast; else rows are shuffled, and
    adaptive execution splits partitions that a hot key makes large. Keys known to be hot (see
    `hot_keys`, which runs a job, so find them once and keep them) can be given: their rows, and
    those without key, are then not shuffled, but meet the few table rows they need by broadcast.
    """
    if not hot:
        return rows.join(table, key, how)
    if len(hot) > MAX_HOT_KEYS:
        raise ValueError(f"at most {MAX_HOT_KEYS} keys can be joined apart")
    listed = F.col(key).isin(list(hot))
    apart = rows.where(F.col(key).isNull() | listed).join(
        F.broadcast(table.where(listed)), key, how
    )
    cold = rows.where(~listed).join(table.where(~listed), key, how)
    return apart.unionByName(cold)
