"""The n-gram Jaccard join against all pairs."""

import math
import random

import plain
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clientele.llm import ngram_join as nj
from clientele.llm.components import components
from clientele.llm.scratch import Scratch

SCHEMA = "doc_id long, text string"


def edited(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"e{rng.random()}"
    return " ".join(words)


def documents(seed):
    """Groups of copies near the threshold, short texts, shared passages."""
    rng = random.Random(seed)
    rows = []
    passage = [f"p{k}" for k in range(60)]
    for g in range(12):
        base = [f"g{g}w{k}" for k in range(rng.choice([5, 8, 12, 20, 60, 150]))]
        for _ in range(rng.choice([2, 3, 8, 25])):
            rows.append(edited(rng, base, rng.randrange(0, max(2, len(base) // 25))))
    rows += [" ".join(rng.sample("abcdefgh", rng.randrange(1, 7))) for _ in range(60)]
    rows += [" ".join(passage + [f"u{rng.random()}" for _ in range(rng.randrange(5, 80))]) for _ in range(40)]
    rng.shuffle(rows)
    return [(1000 - k, t) for k, t in enumerate(rows)]


@pytest.mark.parametrize("seed, limit", [(1, 16 << 20), (2, 16 << 20), (3, 0)])
def test_equals_all_pairs(spark, seed, limit):
    rows = documents(seed)
    want = plain.jaccard_components(rows)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = nj.ngram_jaccard_components(docs, broadcast_bytes=limit).collect()
    assert {r.doc_id: r.component_id for r in found} == want
    sizes = {i: len(plain.shingles(t)) for i, t in rows}
    assert {r.doc_id: r.n_shingles for r in found} == sizes


def test_long_lists_in_blocks(spark, monkeypatch):
    """With nearly all lists long, and groups of near copies that are several blocks large."""
    monkeypatch.setattr(nj, "LONG", 3)
    monkeypatch.setattr(nj, "BLOCK", 4)
    monkeypatch.setattr(nj, "COLUMNS", 16)
    rng = random.Random(8)
    base = [f"w{k}" for k in range(60)]
    rows = [(k, edited(rng, base, rng.randrange(0, 4))) for k in range(60)]
    want = plain.jaccard_components(rows)
    assert 2 < len(set(want.values())) < 50
    found = nj.ngram_jaccard_components(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id: r.component_id for r in found} == want


def test_least_power_keeps_the_bound(monkeypatch):
    monkeypatch.setattr(nj, "FREQUENT", 100)
    assert nj.least_power({3: 50, 4: 40, 9: 10}) == 3
    assert nj.least_power({3: 51, 4: 40, 9: 10}) == 4
    assert nj.least_power({3: 5, 4: 101}) == 5
    assert nj.least_power({}) == nj.LEAST_FREQUENT + 1


def test_chains_and_order_by_frequency(spark, monkeypatch):
    """With a low bound on frequent shingles, and a chain whose ends do not link themselves."""
    monkeypatch.setattr(nj, "TALLY", 200)
    chain = [" ".join(f"c{k}" for k in range(s, s + 60)) for s in range(0, 40, 5)]
    rows = [(k, t) for k, t in enumerate(chain * 3)]
    want = plain.jaccard_components(rows)
    found = nj.ngram_jaccard_components(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id: r.component_id for r in found} == want
    assert set(want.values()) == {0}


def test_odd_rows(spark):
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(5, text), (3, text.upper()), (9, None), (8, ""), (7, " \n\t "), (None, text)]
    rows += [(12, "a b"), (12, text), (11, "a b"), (30, "x y"), (31, "x y")]
    found = nj.ngram_jaccard_components(spark.createDataFrame(rows, SCHEMA)).collect()
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in found)
    assert got == sorted(
        [("5", 26, "3"), ("3", 26, "3"), ("9", 0, "9"), ("8", 0, "8"), ("7", 0, "7")]
        + [("None", 26, "None"), ("12", 1, "3"), ("12", 26, "3"), ("11", 1, "3")]
        + [("30", 1, "30"), ("31", 1, "31")]
    )


def test_one_of_each_stays(spark):
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(4, text, 1), (2, text, 2), (2, text, 2), (6, "other", 3), (None, text, 4), (None, None, 5)]
    docs = spark.createDataFrame(rows, SCHEMA + ", node int")
    kept = nj.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, map(tuple, kept.collect()))) == sorted(
        map(str, [(2, text, 2), (6, "other", 3), (None, text, 4), (None, None, 5)])
    )


def test_no_documents(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert nj.ngram_jaccard_components(empty).count() == 0
    assert nj.keep_one_of_each(empty).count() == 0


@given(st.integers(1, 400), st.integers(1, 400), st.sampled_from([50, 75, 80, 90]))
@settings(max_examples=300, deadline=None)
def test_overlap_and_prefix(n, m, percent):
    need = nj.overlap(n, m, percent)
    common = min(n, m)
    if 100 * common >= percent * max(n, m):  # sizes that can link
        assert 100 * need >= percent * (n + m - need) and (
            100 * (need - 1) < percent * (n + m - need + 1)
        )
        # outside its prefix, a set has too few elements to link
        assert n - nj.prefix(n, percent) < need


def test_light_keys_cover_all_pairings():
    for n in range(1, nj.MOST_LIGHT + 1):
        pairs = {(a, b) for a, b, _ in nj.light_keys(n, nj.MOST_LIGHT, 75)}
        assert pairs == {
            (min(n, m), max(n, m))
            for m in range(1, nj.MOST_LIGHT + 1)
            if 100 * min(n, m) >= 75 * max(n, m)
        }


def test_boundary_follows_cost():
    assert nj.boundary({}, 75) == 0
    small = nj.boundary({3: 1000, 4: 1000, 16: 5}, 75)
    assert small >= 4
    # many sets for which subsets are dear stay on the heavy side
    assert nj.boundary({n: 10_000 for n in range(10, 17)}, 75) < 10
    assert math.comb(16, 12) > nj.prefix(16, 75) + nj.COMPARE_COST * 16


def test_components_of_long_paths(spark):
    edges = [(k, k + 1) for k in range(50)] + [(100, 90), (90, 95), (7, 7)]
    found = components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "test"))
    got = {r.node: r.component for r in found.collect()}
    assert got == {k: 0 for k in range(51)} | {90: 90, 95: 90, 100: 90}
