"""Mixing of sources."""

import plain
import pytest

from clientele.llm.mixing import mix_sources

SCHEMA = "doc_id long, source string, text string"


def documents():
    rows = [(k, f"s{k % 4}", "w " * (k % 37)) for k in range(400)]
    rows += [(k, "big", "w " * 90) for k in range(400, 800)]
    rows += [(900, None, "a b c"), (None, None, "d e"), (None, "s1", None), (901, "empty", "")]
    rows += [(902, "s2", "x y z")] * 3 + [(903, "Ärger", "a b"), (904, "tiny", "a")]
    return rows


@pytest.mark.parametrize("limit", [0, 16 << 20])
def test_equals_plain(spark, limit):
    rows = documents()
    size, sizes, targets, copies = plain.mix(rows)
    found = mix_sources(spark.createDataFrame(rows, SCHEMA), broadcast_bytes=limit).collect()
    got = sorted((str(r.doc_id), str(r.source), r.size, r.source_size, r.copies, r.taken) for r in found)
    want = sorted(
        (str(i), str(s), size[p], sizes[s], copies[p], copies[p] * size[p])
        for p, (i, s, _) in enumerate(rows)
    )
    assert got == want
    for r in found:
        assert r.target == pytest.approx(targets[r.source])


def test_targets_are_met_and_capped(spark):
    found = mix_sources(spark.createDataFrame(documents(), SCHEMA)).toPandas()
    largest = found.groupby("source", dropna=False)["size"].max()
    for source, own in found.groupby("source", dropna=False):
        assert own.target.iloc[0] <= 2 * own.source_size.iloc[0]
        assert abs(own.taken.sum() - own.target.iloc[0]) <= largest[source] / 2
    assert (found.taken <= 2 * found["size"]).all()
    assert found.taken.sum() == pytest.approx(1.5 * found["size"].sum(), rel=0.02)


def test_rows_without_an_id_are_spread(spark):
    """A third of all rows have no id: they are in an order of their own, in many buckets."""
    rows = [(None if k % 3 else k, "a", f"w{k} " * (1 + k % 5)) for k in range(600)]
    size, _, _, copies = plain.mix(rows)
    found = mix_sources(spark.createDataFrame(rows, SCHEMA)).collect()
    want = sorted((t, copies[p]) for p, (_, _, t) in enumerate(rows))
    assert sorted((r.text, r.copies) for r in found) == want
    assert {c for (i, _, _), c in zip(rows, (copies[p] for p in range(600))) if i is None} == {1, 2}


def test_reruns_agree(spark):
    docs = spark.createDataFrame(documents(), SCHEMA)
    one, other = (sorted(map(str, mix_sources(d).collect())) for d in (docs, docs.repartition(7)))
    assert one == other


def test_empty_and_clashing(spark):
    assert mix_sources(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, "a", "x y", "old", 3, 4)]
    docs = spark.createDataFrame(rows, SCHEMA + ", target string, bucket int, s int")
    (r,) = mix_sources(docs).collect()
    assert (r.bucket, r.s, r.target, r.size) == (3, 4, 3.0, 2)


def test_only_empty_texts(spark):
    docs = spark.createDataFrame([(1, "a", ""), (2, "b", None)], SCHEMA)
    assert {(r.target, r.taken) for r in mix_sources(docs).collect()} == {(0.0, 0)}
