"""The filter audit against a plain walk through every order."""

import re
from itertools import permutations

from clientele.llm import filter_audit as fa

DOCS = "doc_id long, text string, lang string, part string, n long, good int"
LABELS = "doc_id long, quality int, toxic int, lang string, mask int"
COLUMNS = ["part", "filter_order", "step", *fa.COUNTS, "shapley"]

LONG = " ".join(f"w{k}" for k in range(100))


def plain(docs, labels):
    good = {d for d, q, *_ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t, *_ in labels if t == 1 and d is not None}
    texts = [(d, text or "", lang or "") for d, text, lang in docs]
    rows = []
    for doc, text, part in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        failed = set()
        if len(words) < 100:
            failed.add("A")
        if 100 * len(set(words)) < 80 * len(words):
            failed.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text):
            failed.add("C")
        if re.search(r"[#$%&*|]", text):
            failed.add("D")
        if doc is not None and any(d is not None and d < doc and t == text for d, t, _ in texts):
            failed.add("E")
        rows.append((part, failed, doc in good, doc in toxic))
    out = []
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        found = {}
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                failing = [r for r in own if f in r[1]]
                found["".join(order), step] = (
                    len(left), len(gone), len(failing) - len(gone),
                    sum(r[1] == {f} for r in own), sum(r[2] for r in gone), sum(r[3] for r in gone),
                )
        share = {f: sum(v[1] for (o, s), v in found.items() if o[s - 1] == f) for f in "ABCDE"}
        out += [(part, o, s, *v, share[o[s - 1]]) for (o, s), v in found.items()]
    return sorted(out)


def audit(spark, docs, labels):
    d = spark.createDataFrame([(*r, "x", 5, 1) for r in docs], DOCS)
    got = fa.filter_audit(d, spark.createDataFrame([(*r, "y", 3) for r in labels], LABELS))
    assert got.columns == COLUMNS
    return sorted(map(tuple, got.collect()))


def test_edges_equal_the_plain_walk(spark):
    docs = [
        (1, None, None), (2, "", ""), (3, "", "en"), (None, "", "en"), (None, "", "en"),
        (4, LONG, "en"), (4, LONG, "en"), (4, LONG, "fr"), (5, LONG, "fr"), (5, "short", "fr"),
        (6, "AB " * 120, "de"), (7, LONG + " #", "de"), (8, "x " * 200_000, "de"),
        (9, "É é " * 99 + "tail", "es"), (10, LONG.upper(), "es"), (11, " \t\n\x0b", "es"),
        (12, "AbcdefghIj" * 10, "en"), (13, "AbcdefghiJ" * 10 + "A", "en"), (0, "short", "en"),
    ]
    labels = [(3, 1, 0), (3, 0, 0), (4, 1, 1), (5, 0, 1), (7, 1, 0), (None, 1, 1), (99, 1, 1), (8, None, None)]
    assert audit(spark, docs, labels) == plain(docs, labels)


def test_empty_tables(spark):
    assert audit(spark, [], [(1, 1, 1)]) == []
    assert audit(spark, [(1, LONG, None)], []) == plain([(1, LONG, None)], [])


def test_hot_copies(spark):
    """A third of all rows one text, another third one row repeated, the rest without an id."""
    docs = [(k, LONG, f"l{k % 3}") for k in range(300)] + [(7, "same", "l0")] * 300
    docs += [(None, f"t{k}", "l1") for k in range(300)]
    labels = [(k, k % 2, k % 5 == 0) for k in range(300)]
    labels = [(d, int(q), int(t)) for d, q, t in labels]
    assert audit(spark, docs, labels) == plain(docs, labels)


def test_limits_are_parameters(spark):
    limits = fa.Limits(min_words=1, distinct_percent=0, upper_percent=100, symbols="[@]")
    docs = spark.createDataFrame([(1, "A A A #", "en"), (2, "@", "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = fa.filter_audit(docs, labels, limits).where("filter_order = 'DABCE'").orderBy("step").collect()
    assert [r.kept for r in rows] == [1] * 5 and rows[0].removed == 1
