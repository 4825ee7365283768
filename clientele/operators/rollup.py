"""Aggregates that are kept up to date by a table's changes, corrections included."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.operators.keyed_table import KeyedTable
from clientele.operators.upsert import BEFORE, TableSpec

SEPARATOR = "\x1f"
SOURCE = "source"


def _key(columns: list[str]) -> Column:
    """One text for the values of a group; null and the empty text differ."""
    return F.concat_ws(SEPARATOR, *[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in columns])


class Rollup:
    """count, sums and distinct counts per group of a `KeyedTable`, from its changes.

    An image before an update takes its values back, the image after adds the new ones. First the
    rows of each group and distinct value are kept, in a table of its own; the groups follow the images
    of that table's rows, so a value counts as long as a row has it. Each table's manifest says up to
    which version it has taken its source in, and moves with the data, so nothing is lost or counted
    twice whenever a refresh is broken off. Work is in proportion to the changes. Sums are exact decimals.

    group, distinct: columns (or names of columns that `prepare` makes) of any type; sums: numbers.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        source: KeyedTable,
        group: list[str],
        sums: list[str],
        distinct: str,
        prepare=lambda rows: rows,
        buckets: int = 8,
    ):
        self.spark, self.path, self._source, self._prepare = spark, path.rstrip("/"), source, prepare
        self._group, self._sums, self._distinct = group, sums, distinct
        shape = prepare(source.read()).schema
        groups = [T.StructField(c, shape[c].dataType) for c in group]
        value = T.StructField(distinct, shape[distinct].dataType)
        counts = [T.StructField("row_count", T.LongType())]
        totals = [T.StructField(f"sum_{c}", T.DecimalType(38, 6)) for c in sums]
        key = [T.StructField("_group", T.StringType())]
        values = T.StructType([*key, *groups, value, *counts, *totals])
        overall = T.StructType([*key, *groups, *counts, T.StructField("distinct_count", T.LongType()), *totals])
        changed = ("row_count", *[f"sum_{c}" for c in sums])
        self._values = KeyedTable(spark, f"{path}/values", TableSpec("_group", values, when_changed=changed), buckets)
        self._groups = KeyedTable(
            spark, f"{path}/groups", TableSpec("_group", overall, when_changed=(*changed, "distinct_count")), buckets
        )

    def read(self) -> DataFrame:
        """One row per group that has rows."""
        return self._groups.read().where("row_count > 0").drop("_group")

    def refresh(self) -> None:
        """Take in everything that is new in the source; then return."""
        self._follow(self._source, self._values, self._take)
        self._follow(self._values, self._groups, self._add_up)

    @staticmethod
    def _follow(source: KeyedTable, table: KeyedTable, work) -> None:
        upto = source.manifest().version
        after = table.manifest().applied.get(SOURCE, 0)
        if upto > after:
            work(source.changes(after, upto, whole_if_expired=not after), upto)

    def _measures(self) -> list[str]:
        return ["row_count", *[f"sum_{c}" for c in self._sums]]

    def _take(self, changes: DataFrame, batch: int) -> None:
        rows = self._prepare(changes)
        columns = [*self._group, self._distinct]
        sign = F.when(F.col("_change") == BEFORE, -1).otherwise(1)
        sums = [F.coalesce(F.col(c).cast("decimal(38,6)"), F.lit(0)) * sign for c in self._sums]
        added = rows.groupBy(_key(columns).alias("_group"), *columns).agg(
            F.sum(sign).alias("row_count"),
            *[F.sum(x).cast("decimal(38,6)").alias(f"sum_{c}") for x, c in zip(sums, self._sums, strict=True)],
        )
        self._values.upsert(added, SOURCE, batch, add=tuple(self._measures()))

    def _add_up(self, changes: DataFrame, batch: int) -> None:
        """Images of group and value to groups: a value counts while it has rows."""
        sign = F.when(F.col("_change") == BEFORE, -1).otherwise(1)
        there = F.when((F.col("row_count") > 0) & F.col(self._distinct).isNotNull(), sign).otherwise(0)
        added = changes.groupBy(_key(self._group).alias("_group"), *self._group).agg(
            F.sum(F.col("row_count") * sign).alias("row_count"),
            F.sum(there).alias("distinct_count"),
            *[F.sum(F.col(f"sum_{c}") * sign).cast("decimal(38,6)").alias(f"sum_{c}") for c in self._sums],
        )
        self._groups.upsert(added, SOURCE, batch, add=(*self._measures(), "distinct_count"))
