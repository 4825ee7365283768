"""Intermediate tables in the shared folder of spark.checkpoint.dir.

A written table cuts the lineage, survives lost executors and has a size that can be checked before
it is broadcast. Each run of an operator has a folder of its own.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.session import scratch_dir

#: Bytes of Parquet up to which a written table is broadcast; beyond it, joins shuffle.
BROADCAST_BYTES = 16 << 20


#: Bytes of an Arrow batch on its way to Python and back. Spark's own limit, 64 MB, is held several
#: times by a task: in the JVM, in the worker, and in what the worker makes of it.
BATCH_BYTES = "4m"


def small_batches(spark: SparkSession) -> None:
    """From now on batches that Python workers get are small, unless the session says how large."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) == "67108864b":
        spark.conf.set(key, BATCH_BYTES)


class Scratch:
    """Tables of one run. `drop` removes those that no later step reads."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self._paths: dict[int, str] = {}
        self._kept: list[DataFrame] = []  # so that ids stay unique

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}-{len(self._paths)}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = path
        self._kept.append(out)
        return out

    def bytes_of(self, table: DataFrame) -> int:
        fs, p = self._fs(self._paths[id(table)])
        return fs.getContentSummary(p).getLength()

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            fs, p = self._fs(self._paths[id(table)])
            fs.delete(p, True)

    def joinable(self, table: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
        """The table, marked for broadcast if its measured size is within the limit."""
        return F.broadcast(table) if self.bytes_of(table) <= limit else table
