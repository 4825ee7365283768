"""Embedding near-dedup against all pairs."""

import random
from collections import Counter, defaultdict

import numpy as np
import plain
import pytest

from clientele.llm import embedding_dedup as ed
from clientele.llm import sorted_hashes

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(seed, n=150):
    rng = np.random.default_rng(seed)
    out = []
    for group in range(n // 5):
        base = rng.standard_normal(16)
        for k in range(5):
            noise = [0, 0, 0.02, 0.05, 0.4][k]
            out.append((base + noise * rng.standard_normal(16)).astype(np.float32).tolist())
    rows = [(k, v, k % 2 if k % 7 else 0) for k, v in enumerate(out)]
    random.Random(seed).shuffle(rows)
    return rows


def expected(rows):
    links = plain.cosine_links(rows)
    count = Counter(p for pair in links for p in pair)
    members = defaultdict(list)
    for p, root in plain.component_of(range(len(rows)), links).items():
        members[root].append(p)
    out = []
    for own in members.values():
        ids = [rows[p][0] for p in own if rows[p][0] is not None]
        least = min(ids, default=None)
        for p in own:
            out.append((rows[p][0], count[p], least, rows[p][0] == least))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()), key=str)


@pytest.mark.parametrize("limit", [0, 16 << 20])
def test_equals_all_pairs(spark, limit, monkeypatch):
    monkeypatch.setattr(ed, "BLOCK", 32)  # many blocks, also within components
    rows = vectors(4)
    # a third of all rows are one vector
    rows += [(1000 + k, rows[0][1], rows[0][2]) for k in range(75)]
    df = ed.embedding_dedup(spark.createDataFrame(rows, SCHEMA), broadcast_bytes=limit)
    assert found(df) == expected(rows)


def test_odd_vectors(spark):
    v = [1.0, 2.0, 3.0]
    rows = [
        (1, v, 1), (2, v, None), (3, v, 2), (4, None, 1), (5, [], 1), (6, [0.0, 0.0, 0.0], 1),
        (7, [1.0, None, 3.0], 1), (8, [1.0, float("nan"), 3.0], 1), (9, [1.0, float("inf"), 3.0], 1),
        (10, [2.0, 4.0, 6.0], 1), (11, [1.0, 2.0], 1), (None, v, 1), (1, v, 1), (None, None, 1),
        (12, [-1.0, -2.0, -3.0], 1), (13, [1e30, 2e30, 3e30], 1),
    ]
    df = ed.embedding_dedup(spark.createDataFrame(rows, SCHEMA))
    want = expected(rows)
    got = found(df)
    assert [x[:2] for x in got] == [x[:2] for x in want]
    by_id = {x[0]: x for x in got if x[0] is not None}
    assert by_id[10][1:] == (4, 1, False) and by_id[13][1] == 4 and by_id[12][1:] == (0, 12, True)


def test_empty_and_clashing(spark):
    assert ed.embedding_dedup(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, [1.0, 0.0], 1, "x", 5, 6), (2, [1.0, 0.01], 1, "y", 5, 6)]
    df = ed.embedding_dedup(spark.createDataFrame(rows, SCHEMA + ", kept string, rep int, v int"))
    assert found(df) == [(1, 1, 1, True), (2, 1, 1, False)]
    assert [(r.rep, r.v) for r in df.collect()] == [(5, 6)] * 2


def cone(rng, n, cosine, pairs, size=64):
    """Unit vectors, a third of them with the given mean cosine, and near partners of some of those."""
    x = rng.standard_normal((n, size))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    axis = rng.standard_normal(size)
    axis /= np.linalg.norm(axis)
    x[: n // 3] = np.sqrt(cosine) * axis + np.sqrt(1 - cosine) * x[: n // 3]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = rng.choice(n // 3, pairs, replace=False)
    return np.concatenate([x, sorted_hashes.partners(x[near], 0.982, 77)])


def met(hashes, x, window):
    """Pairs at the threshold, all against all, and those of them that some pass brings within the window."""
    pairs = []
    for at in range(0, len(x), 1000):
        i, j = np.nonzero(x[at : at + 1000] @ x.T >= 0.98)
        pairs.append(np.stack([i + at, j])[:, i + at < j])
    a, b = np.concatenate(pairs, axis=1)
    found = np.zeros(len(a), dtype=bool)
    for p in range(hashes.passes):
        place = np.empty(len(x), dtype=np.int64)
        place[np.argsort(hashes.keys(x, np.zeros(len(x)), p), kind="stable")] = np.arange(len(x))
        found |= np.abs(place[a] - place[b]) <= window
    return len(a), found.mean()


@pytest.mark.parametrize("rows, cosine", [(4000, 0.0), (4000, 0.9), (20_000, 0.7), (20_000, 0.9), (20_000, 0.97)])
def test_recall_in_a_cone(rows, cosine):
    rng = np.random.default_rng(rows)
    x = cone(rng, rows, cosine, 200)
    drawn = rng.choice(len(x), len(x) // 4, replace=False)  # the hashes are fitted on a sample
    known = {(64, 0): float(len(x))}
    hashes, left = sorted_hashes.fit(x[drawn], np.zeros(len(drawn)), known, 64, 0.98, 0.01, 3)
    pairs, recall = met(hashes, x, 64)
    assert pairs >= 200 and recall >= 0.97 and recall >= 1 - left - 0.02


def test_cone_equals_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(ed, "BLOCK", 128)
    rng = np.random.default_rng(2)
    x = np.concatenate([cone(rng, 900, 0.9, 60), cone(rng, 300, 0.5, 30)])
    rows = [(k, v.astype(np.float32).tolist(), int(k >= 960)) for k, v in enumerate(x)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(ed.embedding_dedup(df, window=48, missed=1e-4)) == expected(rows)


def test_forest_spans_the_links():
    rng = np.random.default_rng(1)
    for n in (1, 2, 40):
        near = rng.random((n, n)) < 1.5 / n
        near |= near.T | np.eye(n, dtype=bool)
        a, b = ed.forest(near)
        links = [(i, j) for i, j in zip(*np.nonzero(near)) if i != j]
        want = plain.component_of(range(n), links)
        assert dict(zip(a.tolist(), b.tolist())) == {k: v for k, v in want.items() if k != v}
    chain = np.eye(300, dtype=bool)
    chain[np.arange(299), np.arange(1, 300)] = chain[np.arange(1, 300), np.arange(299)] = True
    assert set(ed.forest(chain)[1].tolist()) == {0}


def test_passes_grow_with_rows():
    rng = np.random.default_rng(3)
    x = cone(rng, 2000, 0.5, 10)
    few, many = (
        sorted_hashes.fit(x, np.zeros(len(x)), {(64, 0): float(n)}, 256, 0.98, 0.005, 1)[0].passes
        for n in (len(x), 10**8)
    )
    assert 1 <= few < many <= sorted_hashes.MOST_PASSES


def test_hashes_come_from_all_rows(spark, monkeypatch):
    """Rows before a leaf and in it add up to the whole table, and the hashes find the pairs in a cone."""
    rng = np.random.default_rng(5)
    x = cone(rng, 3000, 0.9, 200)
    rows = [(k, v.tolist(), 0) for k, v in enumerate(x)]
    reps = spark.createDataFrame(rows, "rep long, v array<double>, label long")
    hashes = ed.fitted_hashes(reps, 64, 0.98, 0.01, 3)
    for tree in hashes.trees[64, 0]:
        assert tree.rows.sum() == len(x) and len(tree.below) > 2 * 50
    pairs, recall = met(hashes, x, 64)
    assert pairs >= 200 and recall >= 0.97
