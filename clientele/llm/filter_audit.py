"""Filter interaction audit: what each filter removes in every order in which filters can run.

A document's failures are the bits of a mask. Documents are counted by part and mask, at most 32 cells
a part; each cell is folded through all orders by Spark's higher-order functions, and the cells of a
part are added element by element. Work on documents is the same for 5 orders as for 120.
"""

from dataclasses import dataclass
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.llm.lines import pair_hash
from clientele.llm.scratch import Scratch

#: The filters; filter k fails bit k of the mask.
FILTERS = "ABCDE"
#: The filter that compares texts across the table.
DUPLICATE = FILTERS.index("E")
ORDERS = ["".join(p) for p in permutations(FILTERS)]
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


@dataclass(frozen=True)
class Limits:
    """A: fewer words than `min_words`. B: distinct words below this share of the words. C: A-Z above
    this share of the code points. D: one of `symbols`, a character class."""

    min_words: int = 100
    distinct_percent: int = 80
    upper_percent: int = 10
    symbols: str = "[#$%&*|]"


def _bit(failed: Column, k: int) -> Column:
    return F.when(failed, 1 << k).otherwise(0)


def text_failures(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """`mask` of the filters that look at a text alone, beside the columns of docs; text is not null."""
    rows = docs.withColumn(
        "_words", F.filter(F.split("text", "[ \\t-\\r]+", -1), lambda w: w != "")
    ).withColumn("_count", F.size("_words"))
    distinct = F.size(F.array_distinct("_words"))
    upper = F.char_length(F.regexp_replace("text", "[^A-Z]+", ""))
    mask = (
        _bit(F.col("_count") < limits.min_words, 0)
        .bitwiseOR(_bit(distinct * 100 < F.col("_count") * limits.distinct_percent, 1))
        .bitwiseOR(_bit(upper * 100 > F.char_length("text") * limits.upper_percent, 2))
        .bitwiseOR(_bit(F.col("text").rlike(limits.symbols), 3))
    )
    return rows.withColumn("mask", mask).drop("_words", "_count")


def failure_cells(docs: DataFrame, labels: DataFrame, scratch: Scratch, limits: Limits = Limits()) -> DataFrame:
    """part, mask, n, good, toxic: documents by part and by the set of filters that they fail.

    Texts are compared by 128-bit hashes. The smallest id of each text is found with map-side
    aggregation, and a row is compared with it by a join on text and id together, so a group of copies
    of any size is no hot key.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("lang", F.lit("")).alias("part"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    h1, h2 = pair_hash(F.col("text"))
    judged = text_failures(rows, limits).select("doc_id", "part", h1.alias("h1"), h2.alias("h2"), "mask")
    # repeated rows become one before any join
    slim = scratch.write(
        judged.groupBy("doc_id", "part", "h1", "h2", "mask").agg(F.count("*").alias("n")), "rows"
    )
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    flags = known.agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
    )
    flags = scratch.write(flags.where("good = 1 or toxic = 1"), "labels")
    with_id = slim.where("doc_id is not null")
    firsts = with_id.groupBy("h1", "h2").agg(F.min("doc_id").alias("doc_id"), F.lit(True).alias("first"))
    later = F.when(F.col("first"), 0).otherwise(1 << DUPLICATE)
    told = (
        with_id.join(flags, "doc_id", "left")
        .join(firsts, ["h1", "h2", "doc_id"], "left")
        .select(
            "part",
            F.col("mask").bitwiseOR(later).alias("mask"),
            "n",
            F.coalesce(F.col("good"), F.lit(0)).alias("good"),
            F.coalesce(F.col("toxic"), F.lit(0)).alias("toxic"),
        )
    )
    # a row without an id has no label, and no id is smaller than its own
    none = F.lit(0)
    unknown = slim.where("doc_id is null").select("part", "mask", "n", none.alias("good"), none.alias("toxic"))
    every = told.unionByName(unknown)
    return every.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("good")).alias("good"),
        F.sum(F.col("n") * F.col("toxic")).alias("toxic"),
    )


def _fold(mask: Column, n: Column, good: Column, toxic: Column) -> Column:
    """600 structs of one cell: for each order and step, the counts it adds."""
    none = F.lit(0).cast("long")

    def step(so_far: Column, bit: Column) -> Column:
        fails = mask.bitwiseAND(bit) != 0
        there = so_far["there"]
        counts = {
            "kept": F.when(there & ~fails, n),
            "removed": F.when(there & fails, n),
            "redundant": F.when(~there & fails, n),
            "unique_fails": F.when(mask == bit, n),
            "good_lost": F.when(there & fails, good),
            "toxic_lost": F.when(there & fails, toxic),
        }
        one = F.struct(*[F.coalesce(counts[c], none).alias(c) for c in COUNTS])
        return F.struct(
            (there & ~fails).alias("there"), F.concat(so_far["steps"], F.array(one)).alias("steps")
        )

    no_steps = F.array().cast(f"array<struct<{','.join(f'{c}:bigint' for c in COUNTS)}>>")
    start = F.struct(F.lit(True).alias("there"), no_steps.alias("steps"))
    orders = F.array(*[F.array(*[F.lit(1 << FILTERS.index(f)) for f in order]) for order in ORDERS])
    folded = F.transform(orders, lambda order: F.aggregate(order, start, step, lambda x: x["steps"]))
    return F.flatten(folded)


def _added(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.struct(*[(x[c] + y[c]).alias(c) for c in COUNTS]))


def filter_audit(docs: DataFrame, labels: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Per part, order of filters and step: what is kept, removed and lost.

    docs: doc_id, text, lang; labels: doc_id, quality, toxic; other columns are ignored. Filters: see
    `Limits`, and E: a text identical to that of a smaller doc_id anywhere in the table. The part is
    the language; a null one is the empty string. A null text is the empty one: no words, no
    characters, so it fails A, and E if a smaller id has an empty text too.

    Rows that repeat an id and text count each, and none of them fails E because of another: their
    ids are equal. A row without an id never fails E, makes no other fail it and has no label. Labels
    that repeat an id count once, by any row that says 1; those without an id are ignored. Every part
    has all 600 rows; no documents give no rows.

    part, filter_order, step (int), and as long: kept (after this step), removed (here), redundant
    (fail its filter, removed earlier), unique_fails (fail its filter only), good_lost and toxic_lost
    (removed here, by label), shapley (its filter's removed, over all orders).
    """
    scratch = Scratch(docs.sparkSession, "filter-audit")
    cells = failure_cells(docs, labels, scratch, limits)
    folds = cells.select("part", _fold(*[F.col(c) for c in ("mask", "n", "good", "toxic")]).alias("fold"))
    # at most 32 arrays meet
    sums = folds.groupBy("part").agg(F.collect_list("fold").alias("folds"))
    total = F.aggregate(F.slice("folds", 2, 31), F.get("folds", F.lit(0)), _added)
    names = F.array(*[F.lit(f) for order in ORDERS for f in order])
    merged = sums.select("part", total.alias("total"))

    def removed_by(name: str) -> Column:
        own = F.filter(F.arrays_zip("total", names.alias("name")), lambda x: x["name"] == name)
        return F.aggregate(own, F.lit(0).cast("long"), lambda s, x: s + x["total"]["removed"])

    shares = F.array(*[removed_by(f) for f in FILTERS])
    rows = merged.select("part", shares.alias("shares"), F.posexplode("total").alias("at", "counts"))
    order = F.get(F.array(*[F.lit(o) for o in ORDERS]), F.floor(F.col("at") / len(FILTERS)).cast("int"))
    own = F.array_position(F.array(*[F.lit(f) for f in FILTERS]), F.get(names, F.col("at")))
    return rows.select(
        "part",
        order.alias("filter_order"),
        (F.col("at") % len(FILTERS) + 1).cast("int").alias("step"),
        *[F.col("counts")[c].alias(c) for c in COUNTS],
        F.get("shares", own.cast("int") - 1).alias("shapley"),
    )
