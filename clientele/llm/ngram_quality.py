"""Quality classifier: an interpolated modified Kneser-Ney model over bytes, trained on trusted text.

The model is made of tables of counts that are joined on n-grams, sharded by Spark's hash
partitioning. A document's perplexity per byte is set against a quantile of its language.
"""

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from clientele.llm import flat
from clientele.llm.lines import pair_hash
from clientele.llm.scratch import BROADCAST_BYTES, Scratch

#: A text is preceded by newlines.
START = 10
#: Bytes of n-grams counted together in a task.
TALLY = 2 << 20
#: Steps per bit of log2 perplexity in which quantiles are told apart.
STEPS = 512
#: Confidence that a small language's limit is above the quantile of its documents.
CONFIDENCE = 0.95
#: Rows of n-grams that a piece of text is handled in.
PIECE = 1 << 20


def gram_keys(data: np.ndarray, offsets: np.ndarray, order: int) -> np.ndarray:
    """For every byte the n-gram that it ends, bytes packed into one integer."""
    n, lengths = len(offsets) - 1, np.diff(offsets)
    place = np.arange(len(data)) + (order - 1) * np.repeat(np.arange(n), lengths)
    padded = np.full(len(data) + (order - 1) * n, START, dtype=np.int64)
    padded[place + order - 1] = data
    keys = np.zeros(max(len(padded) - order + 1, 0), dtype=np.int64)
    for k in range(order):
        keys = (keys << 8) | padded[k : k + len(keys)]
    return keys[place]


def _count_job(order: int):
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0

        def counted():
            key, count = np.unique(np.concatenate(parts), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(key), pa.array(count)], ["key", "c"])

        for batch in batches:
            for _, data, offsets in flat.pieces(batch.column("text"), PIECE):
                parts.append(gram_keys(data, offsets, order))
                held += len(data)
                if held >= TALLY:
                    yield counted()
                    parts, held = [], 0
        if held:
            yield counted()

    return job


def discounts(counts: DataFrame) -> tuple[float, float, float]:
    """The three discounts from the numbers of n-grams with counts 1 to 4."""
    n = counts.agg(*[F.count_if(F.col("c") == k) for k in (1, 2, 3, 4)]).first()
    if not all(n):  # too little text to estimate them
        return 0.5, 1.0, 1.5
    y = n[0] / (n[0] + 2 * n[1])
    raw = [k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3)]
    return tuple(min(max(d, 0.05), k) for d, k in zip(raw, (1, 2, 3), strict=True))


def train(texts: DataFrame, scratch: Scratch, order: int) -> tuple[DataFrame, DataFrame]:
    """Written tables: n (length), key, logp of seen n-grams; n, key, logw of their contexts.

    Highest order: counts. Lower orders: numbers of distinct bytes seen before. The probability of an
    n-gram joins its count with its context's totals and with the n-gram one byte shorter.
    """
    counts = texts.mapInArrow(_count_job(order), "key long, c long")
    counts = scratch.write(counts.groupBy("key").agg(F.sum("c").alias("c")), "counts")
    by_order = {order: counts}
    for n in range(order - 1, 0, -1):
        shorter = F.col("key").bitwiseAND((1 << 8 * n) - 1).alias("key")
        by_order[n] = scratch.write(
            by_order[n + 1].groupBy(shorter).agg(F.count("*").alias("c")), "counts"
        )
    grams, contexts, lower = [], [], None
    for n in range(1, order + 1):
        d1, d2, d3 = discounts(by_order[n])
        c = F.col("c")
        discount = F.when(c == 1, d1).when(c == 2, d2).otherwise(d3)
        one = by_order[n].select(
            "key", "c", discount.alias("d"), F.shiftright("key", 8).alias("context")
        )
        total = one.groupBy("context").agg(F.sum("c").alias("total"), F.sum("d").alias("taken"))
        total = scratch.write(
            total.select("context", "total", (F.col("taken") / F.col("total")).alias("w")), "contexts"
        )
        joined = one.join(total, "context")
        if lower is None:
            below = F.lit(1 / 256)
        else:
            shorter = F.col("key").bitwiseAND((1 << 8 * (n - 1)) - 1)
            joined = joined.withColumn("shorter", shorter).join(
                lower.select(F.col("key").alias("shorter"), F.col("p").alias("below")), "shorter"
            )
            below = F.col("below")
        p = (c - F.col("d")) / F.col("total") + F.col("w") * below
        lower = scratch.write(joined.select("key", p.alias("p")), "grams")
        grams.append(lower.select(F.lit(n).alias("n"), "key", F.log("p").alias("logp")))
        contexts.append(
            total.select(F.lit(n).alias("n"), F.col("context").alias("key"), F.log("w").alias("logw"))
        )
    grams = scratch.write(_union(grams), "model")
    contexts = scratch.write(_union(contexts), "model")
    scratch.drop(*by_order.values())
    return grams, contexts


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


class Tables:
    """The model in sorted arrays, to score texts with."""

    def __init__(self, grams: pa.Table, contexts: pa.Table, order: int):
        self.order = order
        self.grams = {n: self._sorted(grams, n, "logp") for n in range(1, order + 1)}
        self.contexts = {n: self._sorted(contexts, n, "logw") for n in range(1, order + 1)}

    @staticmethod
    def _sorted(table: pa.Table, n: int, value: str) -> tuple[np.ndarray, np.ndarray]:
        own = np.asarray(table.column("n")) == n
        key = np.asarray(table.column("key"))[own]
        at = np.argsort(key)
        return key[at], np.asarray(table.column(value))[own][at]

    @staticmethod
    def _look_up(table: tuple[np.ndarray, np.ndarray], key: np.ndarray):
        keys, values = table
        if not len(keys):
            return np.zeros(len(key), bool), np.zeros(len(key))
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return keys[at] == key, values[at]

    def log_probabilities(self, key: np.ndarray) -> np.ndarray:
        """Of the last byte of each n-gram of the highest order, after the others."""
        out = np.zeros(len(key))
        rest = np.arange(len(key))
        for n in range(self.order, 0, -1):
            own = key[rest] & ((1 << 8 * n) - 1)
            seen, logp = self._look_up(self.grams[n], own)
            out[rest[seen]] += logp[seen]
            rest, own = rest[~seen], own[~seen]
            known, logw = self._look_up(self.contexts[n], own >> 8)
            out[rest[known]] += logw[known]
        out[rest] += math.log(1 / 256)
        return out


def _score_job(tables, order: int):
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = tables.value
        for batch in batches:
            rest = batch.drop_columns(["text"])
            for i, data, offsets in flat.pieces(batch.column("text"), PIECE):
                logp = model.log_probabilities(gram_keys(data, offsets, order))
                run = np.concatenate(([0.0], np.cumsum(logp)))
                own = rest.slice(i, len(offsets) - 1)
                arrays = [
                    *own.columns,
                    pa.array(np.diff(offsets)),
                    pa.array(run[offsets[1:]] - run[offsets[:-1]]),
                ]
                yield pa.RecordBatch.from_arrays(arrays, [*own.schema.names, "n_bytes", "logp"])

    return job


def _grams_job(order: int):
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = batch.drop_columns(["text"])
            for i, data, offsets in flat.pieces(batch.column("text"), PIECE):
                keys = gram_keys(data, offsets, order)
                for k, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
                    key, count = np.unique(keys[a:b], return_counts=True)
                    own = rest.slice(i + k, 1)
                    at = pa.array(np.zeros(len(key), np.int32))
                    arrays = [*(c.take(at) for c in own.columns), pa.array(key), pa.array(count)]
                    yield pa.RecordBatch.from_arrays(arrays, [*own.schema.names, "key", "c"])

    return job


def _scores_by_join(
    rows: DataFrame, grams: DataFrame, contexts: DataFrame, order: int
) -> DataFrame:
    """n_bytes and logp per row (k1, k2), by joins of its n-grams with the shards of the model."""
    schema = rows.drop("text").schema.add("key", "long").add("c", "long")
    found = rows.mapInArrow(_grams_job(order), schema)
    found = found.select("*", F.lit(0.0).alias("spent"), F.lit(None).cast("double").alias("logp"))
    for n in range(order, 0, -1):
        own = F.col("key").bitwiseAND((1 << 8 * n) - 1)
        gram = grams.where(F.col("n") == n).select(
            F.col("key").alias("gram"), F.col("logp").alias("here")
        )
        context = contexts.where(F.col("n") == n).select(F.col("key").alias("before"), "logw")
        found = (
            found.join(gram, own == F.col("gram"), "left")
            .join(context, F.shiftright(own, 8) == F.col("before"), "left")
            .withColumn("logp", F.coalesce("logp", F.col("spent") + F.col("here")))
            .withColumn("spent", F.col("spent") + F.coalesce("logw", F.lit(0.0)))
            .drop("gram", "here", "before", "logw")
        )
    logp = F.coalesce("logp", F.col("spent") + math.log(1 / 256)) * F.col("c")
    return found.groupBy("k1", "k2").agg(F.sum("c").alias("n_bytes"), F.sum(logp).alias("logp"))


def scores(
    rows: DataFrame, grams: DataFrame, contexts: DataFrame, order: int, scratch: Scratch, limit: int
) -> DataFrame:
    """Per row (k1, k2 and text, and others): n_bytes and logp. Rows without text may be absent."""
    if scratch.bytes_of(grams) + scratch.bytes_of(contexts) > limit:
        return _scores_by_join(rows, grams, contexts, order)
    tables = rows.sparkSession.sparkContext.broadcast(
        Tables(grams.toArrow(), contexts.toArrow(), order)
    )
    schema = rows.drop("text").schema.add("n_bytes", "long").add("logp", "double")
    return rows.mapInArrow(_score_job(tables, order), schema).select("k1", "k2", "n_bytes", "logp")


def length_class(n_bytes):
    return F.floor(F.log2(n_bytes)).cast("int")


def thresholds(measured: DataFrame, quantile: float, least: int) -> DataFrame:
    """level, lang, size, step: the quantile of log2 perplexity, in steps.

    Level 2 is by language and length class, as short texts vary more; level 1 by language. Groups of
    less than `least` rows are left out. Exact to one step: rows are counted per group and step, and
    only these counts are ordered.
    """
    none = F.lit(None)
    levels = F.array(
        F.struct(F.lit(1).alias("level"), "lang", none.cast("int").alias("size")),
        F.struct(F.lit(2).alias("level"), "lang", length_class(F.col("n_bytes")).alias("size")),
    )
    step = F.ceil(F.col("bits") * STEPS).alias("step")
    counts = measured.select(F.explode(levels).alias("g"), step).groupBy("g", "step")
    counts = counts.agg(F.count("*").alias("c"))
    by = W.partitionBy("g")
    counts = counts.withColumn("total", F.sum("c").over(by)).withColumn(
        "run", F.sum("c").over(by.orderBy("step").rowsBetween(W.unboundedPreceding, 0))
    )
    reached = counts.where((F.col("total") >= least) & (F.col("run") >= F.col("total") * F.lit(quantile)))
    return reached.groupBy("g").agg(F.min("step").alias("step")).select("g.*", "step")


def own_limits(measured: DataFrame, quantile: float, least: int) -> DataFrame:
    """lang, step: limits of languages with fewer than `least` rows, from their own rows alone.

    The larger of the quantile and the normal tolerance limit, mean + k * deviation (Natrella's
    approximation of k): it is above the quantile of the language's documents with CONFIDENCE, and k
    widens as rows get fewer. Below three rows it is infinite, and the language has no limit.
    """
    at, sure = (NormalDist().inv_cdf(p) for p in (quantile, CONFIDENCE))
    n = F.count("bits")
    own = measured.groupBy("lang").agg(
        n.alias("n"), F.avg("bits").alias("mean"), F.stddev_samp("bits").alias("deviation")
    ).where((F.col("n") < least) & (F.col("n") >= 3))
    a = 1 - sure**2 / (2 * (F.col("n") - 1))
    b = at**2 - sure**2 / F.col("n")
    k = (at + F.sqrt(F.greatest(at**2 - a * b, F.lit(0.0)))) / a
    wide = F.ceil((F.col("mean") + k * F.col("deviation")) * STEPS)
    own = own.where(a > 0).select("lang", wide.alias("wide"))
    reached = thresholds(measured, quantile, 3).where("level = 1")
    reached = reached.select(F.col("lang").alias("of"), "step")
    both = own.join(reached, F.col("lang").eqNullSafe(F.col("of")))
    return both.select("lang", F.greatest("wide", "step").alias("step"))


def quality_classifier(
    docs: DataFrame,
    labels: DataFrame,
    order: int = 5,
    quantile: float = 0.99,
    slack: float = 1.05,
    least: int = 30,
    seed: int = 5,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    broadcast_bytes: int = BROADCAST_BYTES,
    model_bytes: int = 4 * BROADCAST_BYTES,
) -> DataFrame:
    """Perplexity per byte of each document, and whether its language's threshold keeps it.

    Trusted documents have labels that all say quality 1 and toxic 0. Half of them, by a hash of the
    id, train the model, all their text counting; the others set the thresholds: the `quantile` of
    their perplexity per language and length class (powers of two), times `slack`. A class with fewer
    than `least` of them takes the language's threshold. A language with fewer has one from its own
    documents with a margin that widens as they get fewer (`own_limits`), null being a language; below
    three of them it has none, and all its documents with text are kept: no language is judged by
    another's. The model is broadcast if its measured size is within `model_bytes`; beyond it, n-grams of
    the documents are joined with it, with equal results.

    Adds n_bytes (long), perplexity, threshold (double) and kept (boolean); input columns of these
    names give way. A null or empty text has no perplexity and is not kept. Without any trusted text to
    train or set thresholds with, the threshold is null and every document with text is kept. Labels
    may repeat or be null (then not trusted). Rows that repeat get equal results, rows without an id
    are scored, but not trusted. No documents give no rows.
    """
    scratch = Scratch(docs.sparkSession, "ngram-quality")
    k1, k2 = pair_hash(docs[doc_id], docs[lang], docs[text])
    rows = docs.select(
        k1.alias("k1"), k2.alias("k2"), docs[doc_id].alias("id"), docs[lang].alias("lang"),
        docs[text].alias("text"),
    )
    good = F.coalesce((F.col("quality") == 1) & (F.col("toxic") == 0), F.lit(False))
    trusted = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min(good).alias("good"))
    trusted = trusted.where("good").select(
        F.col("doc_id").alias("id"),
        (F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(2)) == 0).alias("training"),
    )
    trusted = scratch.write(trusted, "trusted")
    learn = scratch.write(trusted.where("training").select("id"), "training")
    check = scratch.write(trusted.where("not training").select("id"), "checking")
    texts = rows.join(scratch.joinable(learn, broadcast_bytes), "id", "left_semi").select("text")
    grams, contexts = train(texts, scratch, order)
    found = scores(rows.select("k1", "k2", "text"), grams, contexts, order, scratch, model_bytes)
    bits = -F.col("logp") / F.col("n_bytes") / math.log(2)
    found = found.where("n_bytes > 0").select("k1", "k2", "n_bytes", bits.alias("bits"))
    # repeated rows have the same scores
    found = found.groupBy("k1", "k2").agg(F.min("n_bytes").alias("n_bytes"), F.min("bits").alias("bits"))
    found = scratch.write(found, "scores")
    marks = rows.select("k1", "k2", "id", "lang").join(
        scratch.joinable(check, broadcast_bytes), "id", "left_semi"
    )
    measured = marks.join(found, ["k1", "k2"]).select("lang", "n_bytes", "bits")
    measured = scratch.write(measured, "measured")
    edges = thresholds(measured, quantile, least)
    few = own_limits(measured, quantile, least).select(
        F.lit(1).alias("level"), "lang", F.lit(None).cast("int").alias("size"), "step"
    )
    edges = edges.unionByName(few)
    edges = scratch.write(edges, "thresholds")
    scratch.drop(trusted, learn, check, grams, contexts, measured)
    bits_of = F.col("step") / STEPS + math.log2(slack)
    names = ("n_bytes", "perplexity", "threshold", "kept")
    others = [c for c in docs.columns if c.lower() not in names]
    packed = docs.select(
        F.struct(*[docs[c] for c in others]).alias("row"),
        docs[lang].alias("lang"),
        k1.alias("k1"),
        k2.alias("k2"),
    )
    out = packed.join(scratch.joinable(found, broadcast_bytes), ["k1", "k2"], "left")
    # a row per language and length class at most
    edges = scratch.joinable(edges, broadcast_bytes)
    close = edges.where("level = 2").select(F.col("lang").alias("of"), "size", bits_of.alias("close"))
    wide = edges.where("level = 1").select(F.col("lang").alias("by"), bits_of.alias("wide"))
    lang_of, lang_by = F.col("lang").eqNullSafe(F.col("of")), F.col("lang").eqNullSafe(F.col("by"))
    here = lang_of & (length_class(F.col("n_bytes")) == F.col("size"))
    out = out.join(close, here, "left").join(wide, lang_by, "left")
    limit = F.coalesce("close", "wide")
    return out.select(
        *[F.col("row").getField(c).alias(c) for c in others],
        F.coalesce("n_bytes", F.lit(0)).cast("long").alias("n_bytes"),
        F.pow(F.lit(2.0), "bits").alias("perplexity"),
        F.pow(F.lit(2.0), limit).alias("threshold"),
        (F.col("bits").isNotNull() & F.coalesce(F.col("bits") <= limit, F.lit(True))).alias("kept"),
    )
