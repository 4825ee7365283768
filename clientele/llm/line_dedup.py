"""Dropping of lines that many documents share, in DataFrame functions only."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm import lines as L
from clientele.llm.scratch import BROADCAST_BYTES, Scratch


def drop_shared_lines(
    docs: DataFrame,
    min_docs: int = 10,
    min_chars: int = 1,
    keep_first: bool = False,
    doc_id: str = "doc_id",
    text: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The documents without lines whose key at least `min_docs` documents have.

    A line's key is the line without ASCII white space at its ends, A-Z in lower case; keys below
    `min_chars` code points never count. With `keep_first` the document with the smallest id keeps such
    lines, so that of a text that many documents repeat one copy stays. Lines are exploded and hashed (128 bits), distinct documents
    are counted per hash, and the positions of frequent lines go back to their documents, whose
    other lines are joined again in order.

    Adds n_lines and n_dropped (long) and replaces `text`; columns of these names in the input give
    way, all others pass through. A null text is one empty line and stays null. An empty text stays
    empty. Rows that repeat keep their number and get equal results; they count as one document if
    their ids are equal, and rows without an id count as one document together. A document that
    loses all its lines has an empty text. No documents give no rows.
    """
    scratch = Scratch(docs.sparkSession, "line-dedup")
    base = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        docs[doc_id].alias("id"),
        docs[text].alias("text"),
    )
    k1, k2 = L.pair_hash(F.col("id"), F.col("text"))
    base = base.select("row", "id", "text", k1.alias("k1"), k2.alias("k2"))

    keys = L.line_keys(F.col("text"), min_chars).alias("keys")
    keyed = scratch.write(base.select("id", "k1", "k2", keys), "keys")
    counted = L.documents_per_key(keyed, []).where(F.col("n_docs") >= min_docs)
    frequent = scratch.write(counted.select("h1", "h2", "first"), "frequent")
    marked = scratch.write(
        L.marked_lines(keyed, frequent, [], scratch, broadcast_bytes, keep_first), "marked"
    )
    scratch.drop(frequent, keyed)
    out = base.join(scratch.joinable(marked, broadcast_bytes), ["k1", "k2"], "left").select(
        "row", "text", "marked", L.split_lines(F.col("text")).alias("lines")
    )
    none = F.col("marked").isNull()
    dropped = F.when(none, 0).otherwise(F.size("marked")).cast("long")
    left = F.when(none, F.col("text")).otherwise(L.without(F.col("lines"), F.col("marked")))
    others = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    return out.select(
        *[left.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in others],
        F.size("lines").cast("long").alias("n_lines"),
        dropped.alias("n_dropped"),
    )
