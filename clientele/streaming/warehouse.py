"""Bronze, silver and gold folders under one root, kept up to date by checkpointed streams.

landing files -> load -> bronze -> merge -> silver + changes -> refresh -> gold

Every arrow is a Structured Streaming query over new files with its own checkpoint, so each
consumer sees every row once, whatever the others have read. Batches are replayed after a failure;
every write is either a folder named by batch or a keyed upsert that knows the batch.
"""

import uuid
from collections.abc import Callable, Mapping
from contextlib import suppress

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from clientele import schemas
from clientele.operators import files, quality
from clientele.operators.joins import lookup_join
from clientele.operators.runlog import run_history, run_logged
from clientele.operators.keyed_table import KeyedTable
from clientele.operators.upsert import BEFORE, GOLD_SPECS, INSERT, SPECS, newest_per_key
from clientele.plans.gold import (
    build_dim_customers,
    build_dim_sessions,
    build_dim_support,
    build_fact_transactions,
    calendar,
    dates_of,
)
from clientele.plans.silver import CLEAN, UNKNOWN_CUSTOMER
from clientele.plans.tables import Tables
from clientele.session import tune
from clientele.sources.audit import with_audit
from clientele.sources.readers import FILE, PROBE, extract_typed, probe_files, read_probed, split_typed

FEEDS = ("customers", "transactions", "support", "web")
NOW = {"availableNow": True}

# What a load does with a value that does not fit.
ON_ERROR = {
    "customers": "skip_row",
    "transactions": "skip_file",
    "support": "skip_file",
    "web": "skip_file",
}

# Feed to gold table, its builder, and the silver column with the customer's surrogate.
CHILDREN = {
    "transactions": ("fact_transactions", build_fact_transactions, "customer_sk"),
    "support": ("dim_support", build_dim_support, "customer_id_sk"),
    "web": ("dim_sessions", build_dim_sessions, "customer_id_sk"),
}
DATE_COLUMNS = {
    "customers": ["signup_date"],
    "transactions": ["transaction_date"],
    "support": ["created_at", "resolved_at"],
    "web": ["interaction_date"],
}


class Warehouse:
    """`buckets` sizes new tables, see `buckets_for`; `files_per_batch` bounds a batch.

    `lengths` are lengths of silver columns by feed; rows with longer values are set aside with the
    reason, never cut. By default only `strict` has lengths, the declared ones.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        buckets: int = 8,
        strict: bool = False,
        files_per_batch: int | None = None,
        lengths: Mapping[str, Mapping[str, int]] | None = None,
    ):
        self.spark, self.root, self.strict = tune(spark), root.rstrip("/"), strict
        self._lengths = lengths if lengths is not None else quality.LENGTHS if strict else {}
        self._limits = {"maxFilesPerTrigger": files_per_batch} if files_per_batch else {}
        self._silver = {f: self._table("silver", f, s, buckets) for f, s in SPECS.items()}
        self._gold = {g: self._table("gold", g, s, buckets) for g, s in GOLD_SPECS.items()}
        self.log_path = f"{self.root}/run_log"

    def _table(self, layer, name, spec, buckets) -> KeyedTable:
        return KeyedTable(self.spark, f"{self.root}/{layer}/{name}", spec, buckets)

    # ---- reading ---------------------------------------------------------------------------

    def bronze(self, feed: str) -> DataFrame:
        reader = self.spark.read.schema(schemas.BRONZE[feed])
        return reader.option("recursiveFileLookup", "true").parquet(self._bronze_path(feed))

    def silver(self) -> Tables:
        return Tables(**{f: t.read for f, t in self._silver.items()})

    def gold(self) -> Tables:
        return Tables(**{g: t.read for g, t in self._gold.items()})

    def history(self, tasks: list[str], hours: int = 1) -> DataFrame:
        return run_history(self.spark, self.log_path, tasks, hours)

    def rejects(self, stage: str, feed: str) -> DataFrame:
        reader = self.spark.read.option("recursiveFileLookup", "true")
        return reader.option("mergeSchema", "true").parquet(self._rejects_path(stage, feed))

    # ---- streams ---------------------------------------------------------------------------

    def load(
        self,
        feed: str,
        landing: str,
        fmt: str = "parquet",
        schema: T.StructType | None = None,
        trigger: dict | None = None,
        **options: str,
    ) -> StreamingQuery:
        """New landing files to bronze, each once. Text formats are read as text, then cast.

        Parquet files are first read through in tasks. One that cannot be read goes to the feed's
        quarantine, with the reason, and the others are loaded, each by the types it has.
        """
        business = schemas.BRONZE[feed].fieldNames()[: -len(schemas.AUDIT)]
        wanted = T.StructType([schemas.BRONZE[feed][c] for c in business])
        options = {**self._limits, **options}
        whole = fmt == "parquet"
        if whole:
            landed = self.spark.readStream.schema(FILE).format("binaryFile").options(**options)
            rows = landed.load(landing)
        else:
            if schema is None:
                names = schemas.LANDING[feed].names
                schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
            landed = self.spark.readStream.schema(schema).format(fmt).options(**options).load(landing)
            rows = landed.select("*", F.col("_metadata.file_path").alias("_file"))

        def typed(batch: DataFrame, batch_id: int) -> DataFrame | None:
            if not whole:
                return None if batch.isEmpty() else extract_typed(batch, wanted)
            # one row for each file of the batch, a list the driver needs to plan the scan
            found = probe_files(batch).collect()
            broken = [r for r in found if r["error"] is not None]
            if broken:
                kept = self.spark.createDataFrame(broken, PROBE)
                self._save(kept, self._rejects_path("quarantine", feed), stream, batch_id)
            return read_probed(self.spark, found, wanted) if len(found) > len(broken) else None

        def write(batch: DataFrame, batch_id: int) -> None:
            rows = typed(batch, batch_id)
            if rows is None:
                return
            rows = rows.persist()  # typed once; a lost part is made anew from the files
            try:
                good, bad = split_typed(rows, wanted, ON_ERROR[feed])
                self._save(with_audit(good), self._bronze_path(feed), stream, batch_id)
                if not bad.isEmpty():
                    self._save(bad, self._rejects_path("load", feed), stream, batch_id)
            finally:
                rows.unpersist()

        stream = self._stream_id(f"load_{feed}")
        return self._start(rows, f"load_{feed}", write, trigger)

    def merge(self, feed: str, trigger: dict | None = None) -> StreamingQuery:
        """New bronze rows: cleanse, set broken rows aside, upsert into silver, log the run."""
        reader = self.spark.readStream.schema(schemas.BRONZE[feed]).options(**self._limits)
        rows = reader.option("recursiveFileLookup", "true").parquet(self._bronze_path(feed))
        table, task = self._silver[feed], f"merge_{feed}"
        stream = self._stream_id(task)

        def work(batch: DataFrame, batch_id: int) -> None:
            # read several times below, cleansed once; a lost part is made anew from the batch
            cleaned = self._clean(feed, batch).persist()
            try:
                good, bad = quality.split_by_rules(cleaned, self._rules(feed))
                # rejects first: a batch the table knows is not looked at again
                if not bad.isEmpty():
                    self._save(bad, self._rejects_path("merge", feed), stream, batch_id)
                table.upsert(good, f"{task}-{stream}", batch_id)
            finally:
                cleaned.unpersist()

        return self._start(rows, task, self._logged(task, work), trigger)

    def refresh(self, feed: str, trigger: dict | None = None) -> StreamingQuery:
        """New silver changes to gold: the calendar first, then the feed's own table."""
        task = f"refresh_{feed}"
        writer = f"{task}-{self._stream_id(task)}"

        def work(changes: DataFrame, batch_id: int) -> None:
            self._refresh(feed, changes, writer, batch_id)

        checkpoint = f"{self.root}/checkpoints/{task}"
        limit = self._limits.get("maxFilesPerTrigger")
        return self._silver[feed].follow(self._logged(task, work), checkpoint, trigger, limit)

    def _logged(self, task: str, work: Callable[[DataFrame, int], None]):
        """A foreachBatch function that skips empty batches and logs the others."""

        def write(batch: DataFrame, batch_id: int) -> None:
            if batch.isEmpty():
                return
            rows = batch.count()
            run_logged(self.spark, self.log_path, task, rows, lambda: work(batch, batch_id))

        return write

    def cycle(self, landing: dict[str, str], **options: str) -> None:
        """One pass over everything that is new, customers first; then return."""
        feeds = [f for f in FEEDS if f in landing]
        self._finish([self.load(f, landing[f], **options) for f in feeds])
        children = [f for f in feeds if f != "customers"]
        if "customers" in feeds:
            self._finish([self.merge("customers")])
        self._finish([self.merge(f) for f in children])
        for feed in feeds:  # all of them write the calendar, so one at a time
            self._finish([self.refresh(feed)])

    @staticmethod
    def _finish(queries: list[StreamingQuery]) -> None:
        """Wait for all; an error of one is raised after the others are done."""
        errors = []
        for query in queries:
            try:
                query.awaitTermination()
            except Exception as e:
                errors.append(e)
        if errors:
            raise errors[0]

    # ---- batches ---------------------------------------------------------------------------

    def _clean(self, feed: str, rows: DataFrame) -> DataFrame:
        if feed == "customers":
            return CLEAN[feed](rows, strict=self.strict)
        return CLEAN[feed](rows, self._silver["customers"].read(), strict=self.strict)

    def _rules(self, feed: str) -> dict:
        required = schemas.SILVER[feed].fieldNames()
        if feed == "support" and not self.strict:  # open tickets
            required = [c for c in required if not c.startswith("resol")]
        return {
            **quality.not_null_rules(required),
            **quality.length_rules(self._lengths.get(feed, {})),
        }

    def _refresh(self, feed: str, changes: DataFrame, task: str, batch_id: int) -> None:
        changes = changes.where(F.col("_change") != BEFORE)
        if self.strict:  # corrections never reach gold
            changes = changes.where(F.col("_change") == INSERT)
        table = self._silver[feed]
        # by version, not by the clock, which may go back
        rows = newest_per_key(changes, table.spec.key, "_version").drop("_version")
        dates = calendar(dates_of([(rows, c) for c in DATE_COLUMNS[feed]]))
        self._gold["dim_date"].upsert(dates, task, batch_id)
        customers = self._silver["customers"].read()
        if feed != "customers":
            name, build, _ = CHILDREN[feed]
            built = build(rows, customers, self.strict)
            self._gold[name].upsert(built, task, batch_id)
            return
        self._gold["dim_customers"].upsert(build_dim_customers(rows), task, batch_id)
        if not self.strict:
            arrived = rows.where(F.col("_change") == INSERT).select("customer_id")
            for child in CHILDREN:
                self._adopt(child, arrived, customers, task, batch_id)

    def _adopt(self, feed, arrived, customers, task, batch_id) -> None:
        """Rows that came before their customer enter gold when the customer does."""
        name, build, customer_sk = CHILDREN[feed]
        waiting = self._silver[feed].read().where(F.col(customer_sk) == UNKNOWN_CUSTOMER)
        if waiting.isEmpty():
            return
        rows = lookup_join(waiting, arrived, "customer_id", "left_semi")
        self._gold[name].upsert(build(rows, customers), task, batch_id)

    # ---- files -----------------------------------------------------------------------------

    def _bronze_path(self, feed: str) -> str:
        return f"{self.root}/bronze/{feed}"

    def _rejects_path(self, stage: str, feed: str) -> str:
        return f"{self.root}/rejects/{stage}/{feed}"

    def _save(self, df: DataFrame, path: str, stream: str, batch_id: int) -> None:
        """A replay of the batch writes the same folder again."""
        df.write.mode("overwrite").parquet(f"{path}/load-{stream}-{batch_id}")

    def _stream_id(self, name: str) -> str:
        """A name that lives as long as the stream's checkpoint.

        Batches are numbered by the checkpoint. If it is lost, numbers begin anew; with this in their
        names, new batches neither replace old ones nor pass for them.
        """
        path = f"{self.root}/checkpoints/{name}/stream-id"
        if not files.exists(self.spark, path):
            with suppress(FileExistsError):
                files.write_text(self.spark, path, uuid.uuid4().hex[:12])
        return files.read_text(self.spark, path)

    def _start(self, rows: DataFrame, name: str, write, trigger: dict | None) -> StreamingQuery:
        writer = rows.writeStream.foreachBatch(write).trigger(**(trigger or NOW))
        return writer.option("checkpointLocation", f"{self.root}/checkpoints/{name}").start()
