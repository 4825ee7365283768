"""Mixing of sources to target weights by capped water-filling."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from clientele.llm.lines import word_count
from clientele.llm.scratch import BROADCAST_BYTES, Scratch
from clientele.operators.surrogate import dense_sk

#: Buckets of the seeded order of a source; sums are kept per source and bucket.
BUCKETS = 1 << 16


def fill_level(sources: DataFrame, budget: float, epochs: float) -> float:
    """The level at which min(level * weight, epochs * size), summed over sources, is the budget.

    Each round clamps the sources that the level lifts above their cap and shares what is left by
    weight; the clamped only grow in number, so it ends. A round brings two sums to the driver.
    """
    cap = F.col("source_size") * F.lit(epochs)
    level, clamped = None, -1
    while True:
        over = F.lit(False) if level is None else F.col("weight") * F.lit(level) > cap
        spent, weight, n = sources.agg(
            F.sum(F.when(over, cap).otherwise(0.0)),
            F.sum(F.when(over, 0).otherwise(F.col("weight"))),
            F.sum(over.cast("int")),
        ).first()
        if n == clamped or not weight:
            return level or 0.0
        level, clamped = (budget - spent) / weight, n


def source_targets(
    sized: DataFrame, scratch: Scratch, weights: tuple[int, ...], share: float, epochs: float
) -> DataFrame:
    """A written row per source: size, weight, target. sized: source, size."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    totals = scratch.write(totals, "totals")
    order = totals.withColumn("place", F.struct(F.col("source").isNull(), F.col("source")))
    ranked = dense_sk(order, "place", "rank").withColumn(
        "weight",
        F.element_at(
            F.array(*map(F.lit, weights)), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int")
        ),
    )
    sources = scratch.write(ranked.select("source", "source_size", "weight"), "sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level = fill_level(sources, share * total, epochs)
    target = F.least(F.col("weight") * F.lit(level), F.col("source_size") * F.lit(epochs))
    whole = F.when(F.col("source_size") > 0, F.floor(target / F.col("source_size"))).otherwise(0)
    out = sources.select(
        "source",
        "source_size",
        target.cast("double").alias("target"),
        whole.cast("long").alias("whole"),
        (target - whole * F.col("source_size")).alias("rest"),
    )
    return scratch.write(out, "targets")


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    share: float = 1.5,
    epochs: int = 2,
    seed: int = 7,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    size: str | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """How often each document enters a mix of `share` times all words.

    Sources, by code point with null last, weigh `weights`, repeating. A source's target is its share
    by weight, at most `epochs` times its size; the excess is shared again by weight until none is
    above. Every document enters floor(target / source size) times; one more repetition goes to the
    first documents of the source in a seeded random order, up to the target's rest in words, so a
    source's words miss its target by half a document at most.

    Adds size (words, or the column named `size`), source_size, target, copies and taken; columns of
    these names in the input give way. A null or empty text has size 0 and takes no words. A null
    source is a source. Documents without an id, and repeated rows, take part as single rows, in an
    order made by their id, size and text, so reruns agree. No documents give no rows.

    The seeded order is cut into 65,536 buckets per source: sums per bucket find the one bucket in
    which the rest runs out, and only that one is sorted, so a hot source is never in one task.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    made = word_count(docs[text]) if size is None else F.coalesce(docs[size], F.lit(0)).cast("long")
    # rows without an id are spread by their text, so they do not meet in one bucket
    content = F.md5(F.coalesce(docs[text].cast("string"), F.lit(""))) if text in docs.columns else F.lit("")
    name = F.coalesce(docs[doc_id].cast("string"), F.concat(F.lit("null "), content))
    key = F.md5(F.concat(F.lit(f"{seed}:"), name))
    tie = F.xxhash64(docs[text]) if text in docs.columns else F.lit(0).cast("long")
    base = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        docs[source].alias("source"),
        made.alias("size"),
        key.alias("key"),
        tie.alias("tie"),
        F.conv(F.substring(key, 1, 4), 16, 10).cast("int").alias("bucket"),
    )
    # one pass over the texts gives all sums
    buckets = scratch.write(
        base.groupBy("source", "bucket").agg(F.sum("size").alias("size")), "buckets"
    )
    targets = source_targets(buckets, scratch, weights, share, epochs)
    here = buckets.source.eqNullSafe(targets.source)
    along = W.partitionBy("source").orderBy("bucket")
    run = F.sum("size").over(along.rowsBetween(W.unboundedPreceding, 0))
    edge = (
        buckets.withColumn("run", run)
        .join(scratch.joinable(targets, broadcast_bytes), here)
        .where(F.col("run") > F.col("rest"))
        .groupBy(buckets.source)
        .agg(F.min(F.struct("bucket", (F.col("run") - F.col("size")).alias("before"))).alias("edge"))
    )
    cut = targets.join(edge, targets.source.eqNullSafe(edge.source), "left").select(
        targets["*"], F.col("edge.bucket").alias("at"), F.col("edge.before").alias("before")
    )
    cut = scratch.write(cut.withColumnRenamed("source", "s"), "cuts")
    joined = base.join(
        scratch.joinable(cut, broadcast_bytes), F.col("source").eqNullSafe(F.col("s"))
    )
    inside = F.col("at").isNull() | (F.col("bucket") < F.col("at"))
    sure = joined.where((F.col("bucket") != F.col("at")) | F.col("at").isNull()).withColumn(
        "more", inside
    )
    order = W.partitionBy("source").orderBy("key", "size", "tie")
    prior = F.sum("size").over(order.rowsBetween(W.unboundedPreceding, 0)) - F.col("size")
    near = joined.where(F.col("bucket") == F.col("at")).withColumn(
        "more", 2 * (F.col("before") + prior) + F.col("size") <= 2 * F.col("rest")
    )
    found = sure.unionByName(near)
    more = F.col("more") & (F.col("whole") < epochs) & (F.col("size") > 0)
    copies = F.col("whole") + more.cast("long")
    names = ("size", "source_size", "target", "copies", "taken")
    others = [c for c in docs.columns if c.lower() not in names]
    return found.select(
        *[F.col("row").getField(c).alias(c) for c in others],
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )
