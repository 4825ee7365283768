"""Registered queries of the subpackage: each applies one operator to its whole table."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.llm import pii, secret_scan, warc
from clientele.llm.embedding_dedup import embedding_dedup
from clientele.llm.filter_audit import filter_audit
from clientele.llm.html_extract import extract_text
from clientele.llm.line_dedup import drop_shared_lines
from clientele.llm.lines import word_count
from clientele.llm.mixing import mix_sources
from clientele.llm.ngram_join import ngram_jaccard_components
from clientele.llm.ngram_quality import quality_classifier
from clientele.llm.piece_codec import encode_pieces
from clientele.llm.quality_rules import STATS, quality_rules
from clientele.llm.scratch import Scratch, small_batches
from clientele.llm.token_alignment import link_digest

#: The vocabulary files of op4, op13 and the pipeline; read, never copied.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BYTE_MODEL = "/opt/tokenizers/byte_bpe_50k.json"

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *STATS, "base_failed", "kept", "n_boiler_words")


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_components(table(spark, sf_dir, "documents"))


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # words are counted once: the operator passes over the sizes several times
    sizes = docs.select("doc_id", "source", word_count(docs.text).alias("words"), F.md5("text").alias("mark"))
    sizes = Scratch(spark, "sizes").write(sizes, "words")
    mixed = mix_sources(sizes, size="words", text="mark")
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op4_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_pieces(docs, PIECE_MODEL).drop("text")


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embedding_dedup(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "n_links", "component_id", "kept")


def _digest(spans_text, found, kinds: tuple[str, ...]) -> list:
    """Counts of the base kinds, the hash of their spans, and all spans."""
    column = F.col(found)

    def of(kind: str):
        return F.size(F.filter(column, lambda s: s["kind"] == kind)).cast("long")

    return [
        *[of(k).alias(f"n_{k}") for k in kinds],
        F.sha2(spans_text(column, kinds), 256).alias("base_sha256"),
        spans_text(column).alias("spans"),
    ]


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.find_pii(docs).select("doc_id", *_digest(pii.spans_text, "pii", pii.BASE))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drop_shared_lines(table(spark, sf_dir, "documents"))
    kept = F.sha2(F.coalesce("text", F.lit("")), 256)
    return found.select("doc_id", "n_lines", "n_dropped", kept.alias("kept_sha256"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = f"{Scratch(spark, 'archives').root}/warc"
    warc.write_warc(table(spark, sf_dir, "pages"), archives)
    responses = warc.read_warc(spark, archives).where("record_type = 'response'")
    revisits = warc.read_warc(spark, archives, payload=False).where("record_type = 'revisit'")
    # of what is there, the payload itself tells; a revisit has the headers' word
    read = responses.select(
        "*", F.octet_length("payload").cast("long").alias("size"), F.sha1("payload").alias("digest")
    ).unionByName(
        revisits.select(
            "*",
            F.col("payload_length").alias("size"),
            F.regexp_replace("payload_digest", "^sha1:", "").alias("digest"),
        )
    )
    return read.select(
        warc.page_of(F.col("record_id")).alias("page_id"),
        F.col("size").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        "record_type",
        warc.page_of(F.col("refers_to")).alias("refers_to"),
    )


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = quality_classifier(docs, labels)
    return found.select("doc_id", "lang", "n_bytes", "perplexity", "threshold", "kept")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.find_secrets(docs)
    return found.select("doc_id", *_digest(secret_scan.spans_text, "secrets", secret_scan.BASE))


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", "n_chars")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_digest(table(spark, sf_dir, "documents"), BYTE_MODEL, PIECE_MODEL)


QUERIES: dict[str, Query] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
    "op3_source_mixing": op3_source_mixing,
    "op4_piece_encoding": op4_piece_encoding,
    "op5_embedding_dedup": op5_embedding_dedup,
    "op6_pii": op6_pii,
    "op7_line_dedup": op7_line_dedup,
    "op8_warc": op8_warc,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_secret_scan": op10_secret_scan,
    "op11_html_extraction": op11_html_extraction,
    "op12_filter_audit": op12_filter_audit,
    "op13_token_alignment": op13_token_alignment,
}
