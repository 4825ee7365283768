"""The n-gram classifier against a plain model, and on held-out labels."""

import plain
import pytest
from pyspark.sql import functions as F

from clientele.llm.ngram_quality import STEPS, own_limits, quality_classifier

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string"
LABELS = "doc_id long, quality int, toxic int"


def corpus():
    clean = [f"the cat {k} sat on the mat and the dog {k % 7} ran to the house" for k in range(80)]
    junk = [f"X{k}#Q%%Z{k * 7919 % 997}&&&|||~~~" for k in range(20)]
    rows = [(k, t, "en" if k % 4 else "fr") for k, t in enumerate(clean + junk)]
    labels = [(k, int(k < 80), 0) for k in range(100)]
    return rows, labels


@pytest.mark.parametrize("model_bytes", [64 << 20, 0])
def test_perplexity_equals_plain(spark, model_bytes):
    rows, labels = corpus()
    docs, marks = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, LABELS)
    found = {
        r.doc_id: r
        for r in quality_classifier(docs, marks, order=3, model_bytes=model_bytes).collect()
    }
    half = marks.where("quality = 1").where(F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(2)) == 0)
    train = {r.doc_id for r in half.collect()}
    assert 20 < len(train) < 60
    model = plain.KneserNey([t for i, t, _ in rows if i in train], 3)
    bits = {i: model.bits(t) for i, t, _ in rows}
    for i, _, _ in rows:
        assert found[i].perplexity == pytest.approx(2 ** bits[i], rel=1e-9)
    # thresholds: here English has enough texts of its length class, French takes that of its few
    french = [b for i, b in bits.items() if i < 80 and i not in train and i % 4 == 0]
    assert 3 <= len(french) < 30
    for i, _, lang in rows:
        if lang == "fr":
            assert found[i].threshold == pytest.approx(2 ** (plain.own_step(french) / 512) * 1.05)
        assert found[i].kept == (found[i].perplexity <= found[i].threshold)
    assert all(found[i].kept for i in train) and not any(found[i].kept for i in range(80, 100))


def test_probabilities_sum_to_one():
    model = plain.KneserNey(["abracadabra", "abba", "barbara"], 3)
    for context in (b"ab", b"zz", b"\n\n"):
        total = sum(model.probability(context + bytes([b])) for b in range(256))
        assert total == pytest.approx(1)


def test_held_out_labels(spark):
    """Labels that neither trained nor set thresholds: junk, and every second clean document."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    judged = quality_classifier(docs, labels).select("doc_id", "kept").join(labels, "doc_id")
    share = {
        r.quality: r.kept
        for r in judged.where("toxic = 0").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    }
    assert share[1] >= 0.97 and share[0] <= 0.2


def test_odd_rows(spark):
    rows, labels = corpus()
    rows += [(200, None, "en"), (201, "", None), (None, rows[0][1], None), (3, rows[3][1], "en")]
    labels += [(1, None, 0), (2, 1, 1), (2, 1, 0), (None, 1, 0), (777, 1, 0)]
    docs = spark.createDataFrame([(*r, "x", 5) for r in rows], SCHEMA + ", kept string, bits int")
    found = quality_classifier(docs, spark.createDataFrame(labels, LABELS)).collect()
    assert len(found) == len(rows) and {r.bits for r in found} == {5}
    by_id = {r.doc_id: r for r in found}
    assert by_id[200].perplexity is None and not by_id[200].kept and not by_id[201].kept
    assert by_id[None].perplexity > 1


def test_without_trusted_text(spark):
    docs = spark.createDataFrame([(1, "a b c", "en"), (2, None, "en")], SCHEMA)
    none = spark.createDataFrame([], LABELS)
    found = {r.doc_id: r for r in quality_classifier(docs, none).collect()}
    assert found[1].kept and found[1].threshold is None and found[1].perplexity == pytest.approx(256)
    assert not found[2].kept
    assert quality_classifier(spark.createDataFrame([], SCHEMA), none).count() == 0


@pytest.mark.parametrize("trusted", [0, 20])
def test_rare_language_is_judged_by_its_own_text(spark, trusted):
    """Spanish has few trusted documents or none: its clean ones are not rejected for it."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    spanish = docs.where("lang = 'es'").select("doc_id").join(labels, "doc_id")
    clean = spanish.where("quality = 1 and toxic = 0").select("doc_id")
    few = clean.orderBy(F.xxhash64("doc_id")).limit(trusted)
    others = labels.join(clean, "doc_id", "left_anti")
    marks = others.unionByName(labels.join(few, "doc_id", "left_semi"))
    found = quality_classifier(docs, marks)
    judged = found.join(clean, "doc_id", "left_semi").join(few, "doc_id", "left_anti")
    kept = [r.kept for r in judged.select("kept").collect()]
    assert len(kept) >= 10 and sum(kept) >= 0.95 * len(kept)
    limits = found.where("lang = 'es' and n_bytes > 0").select("threshold").distinct().collect()
    assert trusted or [r.threshold for r in limits] == [None]


def test_margin_widens_as_a_language_gets_rarer(spark):
    rows = [(f"l{n}", 64, k / (n - 1)) for n in (2, 3, 5, 10, 29) for k in range(n)]
    measured = spark.createDataFrame(rows, "lang string, n_bytes long, bits double")
    steps = {r.lang: r.step for r in own_limits(measured, 0.99, 30).collect()}
    assert set(steps) == {"l3", "l5", "l10", "l29"}
    assert steps["l3"] > steps["l5"] > steps["l10"] > steps["l29"] > STEPS
