"""Shared steps on lines of documents, all in Spark's own functions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.llm.scratch import BROADCAST_BYTES, Scratch

BLANK = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, all else as it is."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def stripped(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANK))


def word_count(text: Column) -> Column:
    """Number of runs without ASCII white space; 0 for null."""
    found = F.filter(F.split(text, "[ \\t-\\r]+", -1), lambda w: w != "")
    return F.when(text.isNull(), 0).otherwise(F.size(found)).cast("long")


def pair_hash(*columns: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes: as one key of 128 bits."""
    return F.xxhash64(*columns), F.xxhash64(F.lit("second"), *columns)


def line_keys(text: Column, min_chars: int = 1) -> Column:
    """Per \\n-split line the two hashes of its key, or null if the key is shorter than min_chars.

    A line's key is the line without ASCII white space at its ends, A-Z in lower case. Each step is a
    transform of its own: within one, an expression that is used twice is computed twice.
    """
    keys = F.transform(split_lines(ascii_lower(text)), stripped)

    def one(key: Column) -> Column:
        a, b = pair_hash(key)
        return F.when(F.char_length(key) >= max(min_chars, 1), F.struct(a.alias("h1"), b.alias("h2")))

    return F.transform(keys, one)


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def documents_per_key(rows: DataFrame, group: list[str]) -> DataFrame:
    """Distinct documents of each line key and their smallest id, by `group`. rows: id, keys and the
    group's columns.

    The keys of a row are made distinct before they are exploded, so a line that stands in every
    document costs one partial row per task. Rows without an id count as one document.
    """
    # outer: else the array would be computed once more, for a filter
    each = rows.select(*group, "id", F.explode_outer(F.array_distinct("keys")).alias("key"))
    each = each.where("key is not null").select(*group, "id", "key.*")
    known = F.count_distinct("id") + F.max(F.col("id").isNull().cast("int"))
    return each.groupBy(*group, "h1", "h2").agg(known.cast("long").alias("n_docs"), F.min("id").alias("first"))


def marked_lines(
    rows: DataFrame, frequent: DataFrame, group: list[str], scratch: Scratch,
    limit: int = BROADCAST_BYTES, keep_first: bool = False,
) -> DataFrame:
    """k1, k2 (of the row) and its distinct positions whose key is frequent.

    `frequent` is a written table: broadcast if small, else joined by a shuffle on the key. With
    `keep_first` the lines of the document with the key's smallest id (column first) do not count; if
    no document with the key has an id, those of none do.
    """
    own = ["id"] if keep_first else []
    each = rows.select("k1", "k2", *own, *group, F.posexplode_outer("keys").alias("at", "key"))
    each = each.where("key is not null").select("k1", "k2", *own, *group, "at", "key.*")
    on = [each[c].eqNullSafe(frequent[c]) for c in [*group, "h1", "h2"]]
    if keep_first:
        on.append(~each["id"].eqNullSafe(frequent["first"]))
    hits = each.join(scratch.joinable(frequent, limit), on, "left_semi")
    return hits.groupBy("k1", "k2").agg(F.collect_set("at").alias("marked"))


def without(lines: Column, marked: Column) -> Column:
    """The lines at other positions than the marked ones, joined by \\n."""
    places = F.sequence(F.lit(0), F.size(lines) - 1)
    kept = F.array_except(places, F.coalesce(marked, F.array().cast("array<int>")))
    return F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
