"""Quality rules on words and lines, with cross-document line frequency per host."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm import flat
from clientele.llm import lines as L
from clientele.llm.scratch import BROADCAST_BYTES, Scratch

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True
NEWLINE = 10

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def text_stats(data: np.ndarray, offsets: np.ndarray, width: int) -> dict[str, np.ndarray]:
    """The columns of STATS for texts in one flat array."""
    n = len(offsets) - 1
    word, text, _, _ = flat.words(data, offsets)
    count = np.bincount(text, minlength=n)
    # code points: all bytes but those that continue one
    points = ~flat.SPACE[data] & ((data & 0xC0) != 0x80)
    return {
        "n_words": count,
        "word_chars": flat.sums(points, offsets),
        "n_symbols": flat.sums(SYMBOLS[data], offsets),
        "n_dup_lines": _repeated_lines(data, offsets, n),
        "n_repeat_words": _repeated_words(word, text, n, width),
    }


def _seen_before(key: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per element: whether an earlier one of its owner is equal; whether any other one is."""
    mixed = flat.mix(key + flat.mix(owner.astype(np.uint64)))
    order = np.argsort(mixed, kind="stable")
    same = mixed[order][1:] == mixed[order][:-1]
    later = np.zeros(len(key), dtype=bool)
    later[order[1:]] = same
    paired = later.copy()
    paired[order[:-1]] |= same
    return later, paired


def _repeated_lines(data: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    starts, ends = flat.spans(data != NEWLINE, offsets)
    wordy = np.concatenate(([0], np.cumsum(~flat.SPACE[data])))
    some = wordy[ends] > wordy[starts]
    starts, ends = starts[some], ends[some]
    owner = flat.text_of(starts, offsets)
    later, _ = _seen_before(flat.hashes(data, starts, ends), owner)
    return np.bincount(owner[later], minlength=n)


def _repeated_words(word: np.ndarray, text: np.ndarray, n: int, width: int) -> np.ndarray:
    """Words in windows that their text has twice or more."""
    value, at = flat.windows(word, text, width)
    _, paired = _seen_before(value, text[at])
    cover = np.zeros(len(word) + 1, dtype=np.int64)
    cover[at[paired]] += 1  # places of windows are distinct
    cover[at[paired] + width] -= 1
    return np.bincount(text[np.cumsum(cover[:-1]) > 0], minlength=n)


def _stats_job(width: int):
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = batch.drop_columns(["text"])
            for i, data, offsets in flat.pieces(batch.column("text")):
                found = text_stats(data, offsets, width)
                own = rest.slice(i, len(offsets) - 1)
                arrays = [*own.columns, *(pa.array(found[c], pa.int64()) for c in STATS)]
                yield pa.RecordBatch.from_arrays(arrays, [*own.schema.names, *STATS])

    return job


def _keyed(docs: DataFrame, doc_id: str, host: str, text: str) -> DataFrame:
    """id, host, text and the two hashes that name a row by its content."""
    k1, k2 = L.pair_hash(docs[doc_id], docs[host], docs[text])
    return docs.select(
        docs[doc_id].alias("id"),
        docs[host].alias("host"),
        docs[text].alias("text"),
        k1.alias("k1"),
        k2.alias("k2"),
    )


def boilerplate(
    keyed: DataFrame, scratch: Scratch, min_docs: int, host_share: float, share_docs: int, limit: int
) -> DataFrame:
    """A written row per document (k1, k2) with lines above its host's limit: their positions."""
    keys = L.line_keys(F.col("text")).alias("keys")
    rows = scratch.write(keyed.select("id", "host", "k1", "k2", keys), "keys")
    hosts = rows.groupBy("host").agg(
        (F.count_distinct("id") + F.max(F.col("id").isNull().cast("int"))).alias("host_docs")
    )
    counted = L.documents_per_key(rows, ["host"]).where(F.col("n_docs") > min(min_docs, share_docs))
    counted = scratch.write(counted, "counted")
    hosts = scratch.write(hosts.withColumnRenamed("host", "of"), "hosts")
    many = F.col("n_docs") > min_docs
    much = (F.col("n_docs") > share_docs) & (F.col("n_docs") > F.col("host_docs") * F.lit(host_share))
    above = (
        counted.join(scratch.joinable(hosts, limit), F.col("host").eqNullSafe(F.col("of")))
        .where(many | much)
        .select("host", "h1", "h2", "first")
    )
    frequent = scratch.write(above, "frequent")
    marked = L.marked_lines(rows, frequent, ["host"], scratch, limit, keep_first=True)
    marked = scratch.write(marked, "marked")
    scratch.drop(rows, counted, hosts, frequent)
    return marked


def quality_rules(
    docs: DataFrame,
    min_words: int = 10,
    max_repeat_percent: int = 20,
    min_docs: int = 10,
    host_share: float = 0.5,
    share_docs: int = 5,
    min_left_words: int = 10,
    min_left_share: float = 0.3,
    width: int = 5,
    doc_id: str = "doc_id",
    host: str = "source",
    text: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Figures and a verdict for each document, and its text without boilerplate lines.

    Base rules: `base_failed` with fewer than `min_words` words, or with more than
    `max_repeat_percent` percent of the words in `width`-word windows that the text has twice.

    Method: lines are normalised (ASCII white space off both ends, A-Z lower) and hashed; distinct
    documents are counted per host and hash. A line is boilerplate on a host where more than
    `min_docs` documents have it, however many the host has, and on a small host also where more than
    `host_share` of its documents have it, if those are more than `share_docs`. The host's document of
    smallest id keeps it, so that one of many copies of a text stays. `clean_text` is the text without
    such lines. A document is depleted if it lost lines and keeps fewer than
    `min_left_words` words or less than `min_left_share` of its words. `kept`: neither base_failed
    nor depleted.

    Returns id, host and text columns, all others, and n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, n_boiler_words (long), base_failed, depleted, kept (boolean), clean_text; columns of these
    names in the input give way. A null text counts as empty (clean_text null): no words, so it fails. A
    null host is a host; rows without an id count as one document of their host. Repeated rows get
    equal results. No documents give no rows.
    """
    scratch = Scratch(docs.sparkSession, "quality-rules")
    keyed = _keyed(docs, doc_id, host, text)
    marked = boilerplate(keyed, scratch, min_docs, host_share, share_docs, broadcast_bytes)
    k1, k2 = L.pair_hash(docs[doc_id], docs[host], docs[text])
    names = (*STATS, "n_boiler_words", "base_failed", "depleted", "kept", "clean_text")
    others = [c for c in docs.columns if c.lower() not in names]
    packed = docs.select(
        F.struct(*[docs[c] for c in others]).alias("row"),
        docs[text].alias("text"),
        docs[text].alias("whole"),
        k1.alias("k1"),
        k2.alias("k2"),
    )
    schema = packed.drop("text").schema
    for c in STATS:
        schema = schema.add(c, "long")
    found = packed.mapInArrow(_stats_job(width), schema)
    found = found.join(scratch.joinable(marked, broadcast_bytes), ["k1", "k2"], "left")
    lines = L.split_lines(F.col("whole"))
    lost = F.aggregate(
        F.transform("marked", lambda i: L.word_count(F.get(lines, i))),
        F.lit(0).cast("long"),
        lambda a, b: a + b,
    )
    found = found.withColumn("n_boiler_words", F.when(F.col("marked").isNull(), 0).otherwise(lost))
    left = F.col("n_words") - F.col("n_boiler_words")
    failed = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")
    )
    depleted = F.col("marked").isNotNull() & (
        (left < min_left_words) | (left < F.col("n_words") * F.lit(min_left_share))
    )
    clean = F.when(F.col("marked").isNull(), F.col("whole")).otherwise(
        L.without(lines, F.col("marked"))
    )
    return found.select(
        *[F.col("row").getField(c).alias(c) for c in others],
        *STATS,
        "n_boiler_words",
        failed.alias("base_failed"),
        depleted.alias("depleted"),
        (~failed & ~depleted).alias("kept"),
        clean.alias("clean_text"),
    )
