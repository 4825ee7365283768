"""Line dedup and quality rules on small and odd inputs."""

import plain
import pytest

from clientele.llm.line_dedup import drop_shared_lines
from clientele.llm.quality_rules import quality_rules

SCHEMA = "doc_id long, text string, source string"
LONG = "\n".join(f"line {k}" for k in range(20_000)) + "\nShared"


def documents():
    shared = [(k, f"own {k}\n  SHARED \t\nÉté\n\nété", "a") for k in range(12)]
    odd = [
        (20, None, "a"),
        (21, "", "a"),
        (22, "shared", None),
        (22, "shared", None),
        (None, "shared\nx", "b"),
        (None, "shared\ny", "b"),
        (23, LONG, "b"),
        (24, "\n\n", "b"),
        (25, "\x0bshared\x0c\nlast\r", "b"),
    ]
    return shared + odd


@pytest.mark.parametrize("limit", [0, 16 << 20])
def test_line_dedup_equals_plain(spark, limit):
    rows = documents()
    found = drop_shared_lines(spark.createDataFrame(rows, SCHEMA), broadcast_bytes=limit)
    want = plain.drop_shared_lines([(i, t) for i, t, _ in rows])
    got = [(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in found.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_line_dedup_counts_documents_not_lines(spark):
    rows = [(1, "x\nx\nx\nx"), (1, "x"), (2, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.n_dropped for r in drop_shared_lines(docs, min_docs=3).collect()} == {0}
    assert {r.n_dropped for r in drop_shared_lines(docs, min_docs=2).collect()} == {1, 4}


def test_line_dedup_clashing_names(spark):
    rows = [(1, "a\nb", 9, "k", [1], "r")] * 2
    columns = "doc_id long, text string, n_lines int, k1 string, marked array<int>, row string"
    found = drop_shared_lines(spark.createDataFrame(rows, columns), min_docs=1)
    assert found.columns == ["doc_id", "text", "k1", "marked", "row", "n_lines", "n_dropped"]
    assert [tuple(r) for r in found.collect()] == [(1, "", "k", [1], "r", 2, 2)] * 2


def test_no_documents(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert drop_shared_lines(docs).count() == 0
    assert quality_rules(docs).count() == 0


def test_text_stats_equal_plain(spark):
    texts = [
        None, "", "  \n\t", "one", "a b c d e a b c d e", "a b c d e f a b c d",
        "x # $ <b>|</b> é é\né é\n\n é é\nx", "Ünï cödé\x0bwörds\x0cmore\r\nend", "w " * 3000,
        "p q r s t " * 50 + "u v w " + "p q r s t", "z" * (3 << 20), "    x",
    ]
    rows = [(k, t, "s") for k, t in enumerate(texts)]
    found = quality_rules(spark.createDataFrame(rows, SCHEMA)).collect()
    for r in found:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got == plain.text_stats(texts[r.doc_id]), texts[r.doc_id]
        failed = r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words
        assert r.base_failed == failed and r.kept == (not failed)


def words(k, n):
    return " ".join(f"w{k}x{j}" for j in range(n))


def test_boilerplate_and_depletion(spark):
    menu = "Home about us contact imprint and more links to follow here"
    rows = [(k, f"{menu}\n{words(k, 40)}", "a") for k in range(30)]
    rows += [(100 + k, f"{menu}\n{words(100 + k, 5)}", "a") for k in range(3)]
    # the same line on another host, where it is rare, and on the null host
    rows += [(200 + k, f"{menu}\n{words(200 + k, 5)}", "b") for k in range(5)]
    rows += [(300, f"{menu}\n{words(300, 5)}", None)]
    found = {r.doc_id: r for r in quality_rules(spark.createDataFrame(rows, SCHEMA)).collect()}
    # one document of the host keeps the line
    assert found[0].clean_text == f"{menu}\n{words(0, 40)}" and found[0].n_boiler_words == 0
    assert all(found[k].kept and found[k].clean_text == words(k, 40) for k in range(1, 30))
    assert all(not found[k].kept and found[k].depleted for k in (100, 101, 102))
    assert all(found[k].kept and menu in found[k].clean_text for k in (200, 204, 300))


def test_each_limit_flags_lines(spark):
    """Eleven documents are enough on a host of any size; on a small one more than half, from six on."""
    menu = "Home about us contact imprint and more links to follow here"

    def flagged(shared, others):
        rows = [(k, f"{menu}\n{words(k, 40)}", "h") for k in range(shared)]
        rows += [(1000 + k, words(1000 + k, 20), "h") for k in range(others)]
        found = quality_rules(spark.createDataFrame(rows, SCHEMA)).where("n_boiler_words > 0")
        return sorted(r.doc_id for r in found.collect())

    assert flagged(11, 400) == list(range(1, 11))
    assert flagged(10, 400) == [] and flagged(10, 10) == []
    assert flagged(6, 5) == list(range(1, 6)) and flagged(6, 6) == [] and flagged(5, 0) == []


def test_of_many_copies_one_is_kept(spark):
    rows = [(k, words(1, 40), "h") for k in range(40)] + [(None, words(2, 40), "h")] * 3
    found = quality_rules(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(str(r.doc_id) for r in found if r.kept) == ["0", "None", "None", "None"]


def test_line_dedup_keeps_the_first(spark):
    rows = documents()
    docs = spark.createDataFrame(rows, SCHEMA)
    for limit in (0, 16 << 20):
        found = drop_shared_lines(docs, keep_first=True, broadcast_bytes=limit)
        want = plain.drop_shared_lines([(i, t) for i, t, _ in rows], keep_first=True)
        assert sorted([(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in found.collect()], key=str) == sorted(want, key=str)


def test_quality_rules_pass_other_columns_on(spark):
    rows = [(1, "a b", "s", "old", 5, 7)]
    columns = SCHEMA + ", kept string, extra int, k1 int"
    (r,) = quality_rules(spark.createDataFrame(rows, columns)).collect()
    assert (r.extra, r.k1, r.kept) == (5, 7, False)
