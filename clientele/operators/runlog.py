"""Run log: two events of each task run, of which the last one tells its state."""

import json
import uuid
import warnings
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.operators import files
from clientele.schemas import RUN_LOG
from clientele.sources.audit import session_now, stamp

RUNNING, SUCCESS, ERROR, ORPHANED = "RUNNING", "SUCCESS", "ERROR", "ORPHANED"
#: A run without an end counts as orphaned after so many hours.
ORPHAN_HOURS = 24
_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


class Run:
    """A run that has begun. Its events are small files of their own, so runs side by side do not meet."""

    def __init__(self, spark: SparkSession, path: str, task: str):
        self._spark, self._path, self._task = spark, path, task
        self._id, self._start = uuid.uuid4().hex, session_now(spark)
        self._log(None, RUNNING)

    def _log(self, end: datetime | None, status: str, rows: int | None = None, error: str | None = None):
        times = [t and t.isoformat(timespec="microseconds") for t in (self._start, end)]
        event = dict(zip(RUN_LOG.names, (self._id, self._task, *times, status, rows, error), strict=True))
        name = f"{self._path}/{self._start:%Y-%m-%d}/{self._id}-{'end' if end else 'begin'}.json"
        try:
            files.write_text(self._spark, name, json.dumps(event))
        except Exception as e:  # the task's own result stands, whatever becomes of its log
            warnings.warn(f"run {self._id} of {self._task} is not in the log: {e}", stacklevel=3)

    def finish(self, rows: int) -> None:
        self._log(session_now(self._spark), SUCCESS, rows)

    def fail(self, error: BaseException) -> None:
        self._log(session_now(self._spark), ERROR, error=str(error))


def run_logged(
    spark: SparkSession, path: str, task: str, rows: int, work: Callable[[], object]
) -> None:
    """Run `work`, log its start, then its end, status, rows and error; an error is raised again.

    `rows` is what the task was given. Counting a batch of Parquet files before any transform
    reads their footers only.
    """
    run = Run(spark, path, task)
    try:
        work()
    except Exception as e:
        run.fail(e)
        raise
    run.finish(rows)


def run_history(
    spark: SparkSession,
    path: str,
    tasks: list[str],
    hours: int = 1,
    as_of: datetime | None = None,
    orphan_hours: int = ORPHAN_HOURS,
) -> DataFrame:
    """Runs of the named tasks that started within the last hours, as their last event has them.

    A run that began and did not end is RUNNING, and ORPHANED when it began more than `orphan_hours`
    ago: its driver was killed.
    """
    if not files.exists(spark, path):
        return spark.createDataFrame([], RUN_LOG)
    now = stamp(as_of)
    reader = spark.read.schema(RUN_LOG).option("recursiveFileLookup", "true")
    events = reader.option("timestampNTZFormat", _TIME).json(path)
    since = now - F.lit(timedelta(hours=hours))
    events = events.where((F.col("execution_start") >= since) & F.col("task_name").isin(tasks))
    ended = F.col("execution_end").isNotNull()
    rest = [c for c in RUN_LOG.names if c != "run_id"]
    last = events.groupBy("run_id").agg(F.max(F.struct(ended.alias("ended"), *rest)).alias("e"))
    dead = F.col("execution_start") < now - F.lit(timedelta(hours=orphan_hours))
    status = F.when((F.col("status") == RUNNING) & dead, ORPHANED).otherwise(F.col("status"))
    return last.select("run_id", "e.*").withColumn("status", status).select(RUN_LOG.names)
