"""A keyed table as a versioned folder of Parquet files, for where no table format with MERGE is at hand."""

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from clientele.operators import files
from clientele.operators.surrogate import bucket_of, parent_of
from clientele.operators.upsert import (
    BEFORE,
    INSERT,
    TableSpec,
    changed_rows,
    empty_table,
    newest_per_key,
)

#: Up to so many buckets an upsert reads all of them.
FEW_BUCKETS = 16


@dataclass(frozen=True)
class Upkeep:
    """When a table is put in shape: change rows are compacted from `share` of the table's rows on, if
    they are at least `least_rows`, and from `most_folders` change folders on; the number of buckets
    doubles when they have `bucket_rows` rows on average."""

    share: float = 0.25
    least_rows: int = 10_000
    most_folders: int = 64
    bucket_rows: int = 4_000_000


@dataclass
class Manifest:
    """One version of a table.

    homes: by bucket the folder with its rows and the version that wrote it; deltas: change folders
    with their version and rows, oldest first, which count in the buckets whose home is older. changes:
    the folder with what this version changed, if anything. applied: the last batch by writer. unique:
    every upsert so far had one row of a key, so a change folder has one newest row of each.
    """

    version: int = 0
    buckets: int = 8
    rows: int = 0
    last_key: int = 0
    homes: dict[int, tuple[str, int]] = field(default_factory=dict)
    deltas: list[tuple[str, int, int]] = field(default_factory=list)
    changes: str | None = None
    applied: dict[str, int] = field(default_factory=dict)
    unique: bool = True

    @property
    def has_rows(self) -> bool:
        return bool(self.homes or self.deltas)

    def home_version(self, bucket: int) -> int:
        return self.homes.get(bucket, ("", 0))[1]

    def dump(self) -> str:
        return json.dumps(vars(self), sort_keys=True)

    @staticmethod
    def load(text: str) -> "Manifest":
        raw = json.loads(text)
        raw["homes"] = {int(k): tuple(v) for k, v in raw["homes"].items()}
        raw["deltas"] = [tuple(d) for d in raw["deltas"]]
        raw.setdefault("unique", False)  # an older version does not tell
        return Manifest(**raw)


class KeyedTable:
    """One row per key in `path`; upserts write what they change.

    `versions/N.json` is version N. It names the folders in `data` that make up the table: homes, whole
    hash buckets written by the first load and by compaction, and change folders, the rows that one
    upsert inserted or updated. An upsert reads the buckets its keys fall into and writes its changes
    only; one that changes nothing writes no rows. A reader takes the newest row of a key. When the
    change folders become many (see `Upkeep`), buckets are written anew; `expire` removes old versions and
    the folders that only they name.

    Versions are published by `files.write_text`, which lets one of several writers through, in
    whatever process. The others write their changes anew on the version that came between. A folder
    that no version names does not count, so a writer that dies leaves nothing to be seen. A batch that
    is applied already is skipped, so a replay after a failure changes nothing.

    `buckets` is the number that a new table starts with; it can grow, and only the buckets that split
    are written anew.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        spec: TableSpec,
        buckets: int = 8,
        upkeep: Upkeep = Upkeep(),
    ):
        self.spark, self.path, self.spec = spark, path.rstrip("/"), spec
        self._buckets, self._upkeep = buckets, upkeep

    # ---- versions --------------------------------------------------------------------------

    def _version_path(self, version: int) -> str:
        return f"{self.path}/versions/{version:012d}.json"

    def versions(self) -> list[int]:
        """Numbers of the versions that are kept."""
        found = files.names(self.spark, f"{self.path}/versions")
        return [int(n.split(".")[0]) for n in found if n[0].isdigit()]

    def manifest(self, version: int | None = None) -> Manifest:
        """A version, by default the newest."""
        if version is None:
            kept = self.versions()
            if not kept:
                return Manifest(buckets=self._buckets)
            version = kept[-1]
        return Manifest.load(files.read_text(self.spark, self._version_path(version)))

    def _publish(self, manifest: Manifest) -> bool:
        """False if another writer has published this version."""
        try:
            files.write_text(self.spark, self._version_path(manifest.version), manifest.dump())
        except FileExistsError:
            return False
        return True

    def _folder(self, version: int) -> str:
        return f"v-{version:012d}-{uuid.uuid4().hex}"

    def _data(self, folder: str) -> str:
        return f"{self.path}/data/{folder}"

    # ---- reading ---------------------------------------------------------------------------

    def read(self, version: int | None = None) -> DataFrame:
        return self._read(self.manifest(version))

    def read_keys(self, keys: DataFrame) -> DataFrame:
        """The rows whose key is in `keys`, from the buckets that can hold them."""
        manifest = self.manifest()
        keys = keys.select(self.spec.key)
        rows = self._read(manifest, self._buckets_of(keys, manifest.buckets))
        return rows.join(keys, self.spec.key, "left_semi")

    def _read(self, manifest: Manifest, only: set[int] | None = None) -> DataFrame:
        """The table, or the rows of some of its buckets."""
        folders = [
            f"{self._data(folder)}/_bucket={bucket}"
            for bucket, (folder, _) in sorted(manifest.homes.items())
            if folder and (only is None or bucket in only)
        ]
        reader = self.spark.read.schema(self.spec.schema).option("recursiveFileLookup", "true")
        base = reader.parquet(*folders) if folders else empty_table(self.spark, self.spec)
        if not manifest.deltas:
            return base
        changed = self._later(manifest, only)
        # few rows against many: which side is sent is chosen by their sizes
        old = base.join(changed.select(self.spec.key), self.spec.key, "left_anti")
        if len(manifest.deltas) > 1 or not manifest.unique:
            changed = newest_per_key(changed, self.spec.key, "_version")
        return old.select(self.spec.schema.names).unionByName(changed.select(self.spec.schema.names))

    def _later(self, manifest: Manifest, only: set[int] | None) -> DataFrame:
        """Rows of the changes that are newer than the home of their bucket, with their _version."""
        rows = self._changes_in([folder for folder, _, _ in manifest.deltas])
        rows = rows.where(F.col("_change") != BEFORE).drop("_change")
        bucket = bucket_of(F.col(self.spec.key), manifest.buckets)
        homes = [(b, manifest.home_version(b)) for b in (only if only is not None else range(manifest.buckets))]
        if only is not None or any(v >= manifest.deltas[0][1] for _, v in homes):
            # one row for each bucket
            table = self.spark.createDataFrame(homes, "_bucket int, _home long")
            rows = rows.withColumn("_bucket", bucket).join(F.broadcast(table), "_bucket")
            rows = rows.where("_version > _home").drop("_bucket", "_home")
        return rows

    def _changes_in(self, folders: list[str]) -> DataFrame:
        """Rows of change folders, or of homes that a first load wrote, with _change and _version."""
        schema = T.StructType([*self.spec.schema.fields, T.StructField("_change", T.StringType())])
        if not folders:
            return empty_table(self.spark, self.spec).selectExpr("*", "'' AS _change", "0L AS _version")
        reader = self.spark.read.schema(schema).option("recursiveFileLookup", "true")
        rows = reader.parquet(*[self._data(folder) for folder in folders])
        version = F.regexp_extract(F.col("_metadata.file_path"), "/data/v-([0-9]+)-", 1).cast("long")
        change = F.coalesce("_change", F.lit(INSERT))
        return rows.select(*self.spec.schema.names, change.alias("_change"), version.alias("_version"))

    # ---- changes ---------------------------------------------------------------------------

    def changes(self, after: int = 0, upto: int | None = None, whole_if_expired: bool = True) -> DataFrame:
        """What versions after + 1 .. upto changed: table columns, _change and _version.

        An insert has one row, an update its row before and after. Only folders that these versions
        name are read. Where the first of them has expired, the table as of `upto` is given as inserts, or
        an error, for those who cannot take a row twice.
        """
        if upto is None:
            kept = self.versions()
            upto = kept[-1] if kept else 0
        if upto > after and not files.exists(self.spark, self._version_path(after + 1)):
            if not whole_if_expired:
                raise LookupError(f"version {after + 1} of {self.path} has expired")
            rows = self._read(self.manifest(upto))
            return rows.select("*", F.lit(INSERT).alias("_change"), F.lit(upto).cast("long").alias("_version"))
        found = [self.manifest(v).changes for v in range(after + 1, upto + 1)]
        return self._changes_in([folder for folder in found if folder])

    def follow(
        self,
        work: Callable[[DataFrame, int], None],
        checkpoint: str,
        trigger: dict | None = None,
        versions_per_batch: int | None = None,
    ) -> StreamingQuery:
        """Stream of changes: work(changes, batch number) for every run of new versions.

        The source is the folder of version files, so what is listed is one small file for each version
        that is kept, never data. `checkpoint`/progress holds the last version of each batch: a batch
        that is repeated has the versions it had, and none is left out. Without the checkpoint all
        versions come again, or the table, if the first ones have expired.
        """
        reader = self.spark.readStream.option("wholetext", "true")
        if versions_per_batch:
            reader = reader.option("maxFilesPerTrigger", versions_per_batch)
        files.make_folder(self.spark, f"{self.path}/versions")  # there may be no version yet
        published = reader.text(f"{self.path}/versions")
        progress = f"{checkpoint.rstrip('/')}/progress"

        def upto_of(batch_id: int) -> int:
            return int(files.read_text(self.spark, f"{progress}/{batch_id}"))

        def write(batch: DataFrame, batch_id: int) -> None:
            after = 0
            done = [int(n) for n in files.names(self.spark, progress) if n.isdigit() and int(n) < batch_id]
            if done:
                after = upto_of(max(done))
            path = f"{progress}/{batch_id}"
            if not files.exists(self.spark, path):
                number = F.get_json_object("value", "$.version").cast("long")
                newest = batch.agg(F.max(number)).first()[0]
                files.write_text(self.spark, path, str(max(after, newest or 0)))
            upto = upto_of(batch_id)
            if upto > after:
                work(self.changes(after, upto), batch_id)

        stream = published.writeStream.foreachBatch(write).trigger(**(trigger or {"availableNow": True}))
        return stream.option("checkpointLocation", checkpoint).start()

    # ---- writing ---------------------------------------------------------------------------

    def upsert(
        self,
        source: DataFrame,
        writer: str = "batch",
        batch: int | None = None,
        as_of: datetime | None = None,
        order: str = "ingested_at",
        add: tuple[str, ...] = (),
    ) -> int | None:
        """Merge `source` into the table; returns the version that has it, None for a batch seen before.

        `source` may hold several rows of a key; the newest by `order` counts. It is computed once, into
        a folder of its own. Columns in `add` hold what is added to the values of a row that is there; such
        a source has one row of a key.
        """
        if batch is not None and self.manifest().applied.get(writer, -1) >= batch:
            return None
        unique = order in source.columns or bool(add)
        if order in source.columns:
            source = newest_per_key(source, self.spec.key, order)
        staged = f"{self.path}/staging/{uuid.uuid4().hex}"
        source.write.parquet(staged)
        try:
            rows = self.spark.read.schema(source.schema).parquet(staged)
            while True:
                manifest = self.manifest()
                if batch is not None and manifest.applied.get(writer, -1) >= batch:
                    return None
                done = self._try(manifest, rows, writer, batch, as_of, add, unique)
                if done is not None:
                    break
        finally:
            files.remove(self.spark, staged)
        self._keep_in_shape(done)
        return done.version

    def _try(self, manifest, source, writer, batch, as_of, add, unique) -> Manifest | None:
        """One upsert on top of a version; None if another one was published meanwhile."""
        version = manifest.version + 1
        folder = self._folder(version)
        # of few buckets hardly any is left out, so a job to find them is not worth it
        prune = manifest.has_rows and manifest.buckets > FEW_BUCKETS
        touched = self._buckets_of(source, manifest.buckets) if prune else None
        target = self._read(manifest, touched) if manifest.has_rows else empty_table(self.spark, self.spec)
        rows = changed_rows(target, source, self.spec, manifest.buckets, manifest.last_key, as_of, add)
        homes, deltas = dict(manifest.homes), list(manifest.deltas)
        applied = dict(manifest.applied)
        if batch is not None:
            applied[writer] = batch
        if manifest.has_rows:
            rows.write.parquet(self._data(folder))
            written = self._written(folder)
            if written["rows"]:
                deltas.append((folder, version, written["rows"]))
        else:
            self._write_homes(rows.drop("_change"), folder, manifest.buckets)
            written = self._written(folder)
            if written["rows"]:
                homes = self._homes_in(folder, version)
        changes = folder if written["rows"] else None
        if not changes:
            files.remove(self.spark, self._data(folder))
            if batch is None:  # nothing to say
                return manifest
        last_key = max(manifest.last_key, written["last_key"] or 0)
        rows_now = manifest.rows + written["inserts"]
        unique = unique and manifest.unique
        done = Manifest(version, manifest.buckets, rows_now, last_key, homes, deltas, changes, applied, unique)
        if self._publish(done):
            return done
        if changes:
            files.remove(self.spark, self._data(folder))
        return None

    def _written(self, folder: str) -> dict:
        """Rows, inserts and the greatest surrogate of a folder just written."""
        key = F.max(self.spec.surrogate) if self.spec.surrogate else F.lit(None).cast("long")
        found = self._changes_in([folder]).agg(
            F.count("*").alias("rows"),
            F.count_if(F.col("_change") == INSERT).alias("inserts"),
            key.alias("last_key"),
        )
        return found.first().asDict()

    def _write_homes(self, rows: DataFrame, folder: str, buckets: int) -> None:
        placed = rows.withColumn("_bucket", bucket_of(F.col(self.spec.key), buckets))
        # a large bucket is split into several tasks and files
        placed.hint("rebalance", "_bucket").write.partitionBy("_bucket").parquet(self._data(folder))

    def _homes_in(self, folder: str, version: int) -> dict[int, tuple[str, int]]:
        found = [n for n in files.names(self.spark, self._data(folder)) if n.startswith("_bucket=")]
        return {int(n.split("=")[1]): (folder, version) for n in found}

    def _buckets_of(self, source: DataFrame, buckets: int) -> set[int]:
        """At most `buckets` numbers reach the driver."""
        hit = source.select(bucket_of(F.col(self.spec.key), buckets).alias("b")).distinct()
        return {r["b"] for r in hit.collect()}

    # ---- upkeep ----------------------------------------------------------------------------

    def _keep_in_shape(self, manifest: Manifest) -> None:
        upkeep, changed = self._upkeep, sum(n for _, _, n in manifest.deltas)
        if manifest.rows > manifest.buckets * upkeep.bucket_rows:
            self.grow(2 * manifest.buckets)
        elif len(manifest.deltas) >= upkeep.most_folders or (
            changed >= upkeep.least_rows and changed > upkeep.share * manifest.rows
        ):
            self.compact()

    def compact(self, limit: int | None = None) -> int | None:
        """Write buckets anew, those with the oldest homes first; all, or `limit` of them.

        Returns the version, None if there was nothing to do or another writer came between; the table's
        rows are the same either way.
        """
        manifest = self.manifest()
        if not manifest.deltas:
            return None
        last = manifest.deltas[-1][1]
        old = [b for b in range(manifest.buckets) if manifest.home_version(b) < last]
        chosen = sorted(old, key=lambda b: (manifest.home_version(b), b))[:limit]
        return self._rewrite(manifest, set(chosen), manifest.buckets)

    def grow(self, buckets: int) -> int | None:
        """More buckets: those that split are written anew, the others stay. Returns as `compact`."""
        manifest = self.manifest()
        if buckets <= manifest.buckets:
            return None
        split = {parent_of(b, manifest.buckets) for b in range(manifest.buckets, buckets)}
        return self._rewrite(manifest, split, buckets)

    def _rewrite(self, manifest: Manifest, chosen: set[int], buckets: int) -> int | None:
        version = manifest.version + 1
        folder = self._folder(version)
        self._write_homes(self._read(manifest, chosen), folder, buckets)
        homes = {b: h for b, h in manifest.homes.items() if b not in chosen}
        # a bucket without rows is up to date too
        homes |= {b: ("", version) for b in range(buckets) if parent_of(b, manifest.buckets) in chosen}
        homes |= self._homes_in(folder, version)
        done = Manifest(
            version,
            buckets,
            manifest.rows,
            manifest.last_key,
            homes,
            manifest.deltas,
            None,
            manifest.applied,
            manifest.unique,
        )
        oldest = min(done.home_version(b) for b in range(buckets))
        done.deltas = [d for d in manifest.deltas if d[1] > oldest]
        if self._publish(done):
            return version
        files.remove(self.spark, self._data(folder))
        return None

    def expire(self, keep: int = 100) -> list[str]:
        """Remove all but the last `keep` versions, and the folders that none of those names.

        A folder of a version that is not published yet stays: its writer may still be at work. Readers
        of a removed version fail; `changes` gives the whole table to those who come too late.
        """
        kept = self.versions()
        gone, kept = kept[:-keep], kept[-keep:]
        if not gone:
            return []
        named: set[str] = set()
        for version in kept:
            manifest = self.manifest(version)
            named |= {folder for folder, _ in manifest.homes.values()} | {d[0] for d in manifest.deltas}
            named |= {manifest.changes} if manifest.changes else set()
        for version in gone:
            files.remove(self.spark, self._version_path(version))
        found = files.names(self.spark, f"{self.path}/data")
        stale = [f for f in found if f not in named and int(f.split("-")[1]) <= kept[-1]]
        for folder in stale:
            files.remove(self.spark, self._data(folder))
        return stale
