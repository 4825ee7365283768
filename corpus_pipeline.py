"""The corpus pipeline: five stages from raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last
return the columns of documents. Between stages the rows are written as Parquet and read again.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.llm.line_dedup import drop_shared_lines
from clientele.llm.mixing import mix_sources
from clientele.llm.ngram_join import keep_one_of_each
from clientele.llm.ngram_quality import quality_classifier
from clientele.llm.piece_codec import encode_pieces
from clientele.llm.queries import PIECE_MODEL, table
from clientele.llm.scratch import Scratch, small_batches

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps.

    A null or empty text goes. A language without trusted text of its own keeps all its other
    documents; repeated rows stay or go together; no documents give no rows.
    """
    judged = quality_classifier(docs, table(spark, sf_dir, "labels"))
    return judged.where("kept").select(docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many share; n_chars follows the text.

    The document of smallest id keeps such lines, so that of a text in many copies one stays whole.
    Documents left without text go, and so do null and empty ones. Rows that repeat one id count as one
    document, and so do rows without an id. No documents give no rows.
    """
    out = drop_shared_lines(docs, keep_first=True).where("text <> ''")
    if "n_chars" in docs.columns:
        changed = F.when(F.col("n_dropped") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of smallest id, of each group of near duplicates.

    Texts without words are in no group and stay; of rows that repeat, and of rows without an id in a
    group, one stays (see `keep_one_of_each`). No documents give no rows.
    """
    small_batches(spark)
    return keep_one_of_each(docs).select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice.

    A document without words has nothing to take. A null source is a source of its own. Repeated rows
    are documents of their own. No documents give no rows.
    """
    mixed = mix_sources(docs).where("copies > 0")
    repeated = F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))
    return mixed.select(*docs.columns, repeated.alias("copy")).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids beside the documents; those of a null text are null, of an empty one none."""
    small_batches(spark)
    return encode_pieces(docs, PIECE_MODEL)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_good),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix),
    ("SentencePiece encoding", encode),
]

#: SQL cannot express the classifier; tests compare the stages with plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    scratch = Scratch(spark, "corpus-pipeline")
    docs = table(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES):
        done, docs = docs, stage(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            docs = scratch.write(docs, f"stage-{n + 1}")
            if n:
                scratch.drop(done)
    return docs
