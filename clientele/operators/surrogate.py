"""Surrogate keys without a single-task window."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clientele.session import ensure_checkpoints


def bucket_of(key: Column, buckets: int) -> Column:
    """The hash bucket of a key, by linear hashing: any number of buckets, of which one more only
    splits one; see `parent_of`."""
    whole = 1 << max(buckets - 1, 0).bit_length()
    at = F.pmod(F.xxhash64(key), F.lit(whole))
    return F.when(at < buckets, at).otherwise(at - whole // 2).cast("int")


def parent_of(bucket: int, buckets: int) -> int:
    """The bucket, of the first `buckets`, that held the keys of `bucket` when there were only those."""
    while bucket >= buckets:
        bucket -= 1 << (bucket.bit_length() - 1)
    return bucket


def key_in_bucket(position: Column, bucket: Column, buckets: int) -> Column:
    """Every bucket draws from its own arithmetic sequence, so keys never meet across buckets."""
    return (position - 1) * buckets + bucket + 1


def assign_sk(df: DataFrame, key: str, name: str, buckets: int = 64) -> DataFrame:
    """Unique surrogate keys for a table with unique `key`; repeatable, with gaps.

    One shuffle by hash bucket. The same rows get the same keys on every run and retry.
    """
    window = W.partitionBy("_bucket").orderBy(key)
    position = F.row_number().over(window)
    return (
        df.withColumn("_bucket", bucket_of(F.col(key), buckets))
        .withColumn(name, key_in_bucket(position, F.col("_bucket"), buckets).cast("long"))
        .drop("_bucket")
    )


def dense_sk(df: DataFrame, key: str, name: str, base: int = 0) -> DataFrame:
    """base + 1, base + 2, ... in order of `key`, as a global ROW_NUMBER, but in many tasks.

    Rows are range partitioned, sorted and checkpointed, which fixes their places. The key is the
    place within the partition plus the sizes of the partitions before it.
    """
    ensure_checkpoints(df.sparkSession)
    placed = df.repartitionByRange(key).sortWithinPartitions(key).checkpoint()
    # monotonically_increasing_id is (partition << 33) + place
    marked = placed.withColumn("_at", F.monotonically_increasing_id())
    partition = F.shiftright("_at", 33)
    place = F.col("_at").bitwiseAND((1 << 33) - 1)
    sizes = marked.groupBy(partition.alias("_part")).agg(F.count("*").alias("_n"))
    # one row per partition, so this window is small
    before = F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    starts = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_start"))
    return (
        marked.withColumn("_part", partition)
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.lit(base) + F.col("_start") + place + 1)
        .drop("_at", "_part", "_start")
    )
