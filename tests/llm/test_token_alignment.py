"""The alignment against whole texts encoded apart, and corpus counts against plain sums."""

import hashlib
from collections import Counter, defaultdict
from functools import cache

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clientele.llm import token_alignment as ta
from clientele.llm.queries import BYTE_MODEL, PIECE_MODEL, QUERIES
from clientele.llm.scratch import Scratch

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@cache
def libraries():
    a = Tokenizer.from_file(BYTE_MODEL)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)


@cache
def byte_of():
    """The byte-level alphabet: the n-th byte that does not print stands at 256 + n."""
    out, n = {}, 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174:
            out[chr(b)] = b
        else:
            out[chr(256 + n)] = b
            n += 1
    return out


def plain_tokens(text):
    """(id, end in bytes) of A and of B; none if the bytes do not make the text again."""
    if not text:
        return [], []
    a, b = libraries()
    sides = []
    found = a.encode(" " + text, add_special_tokens=False)
    sides.append([(k, bytes(byte_of()[c] for c in t)) for k, t in zip(found.ids, found.tokens)])
    own = []
    for k in b.encode(text):
        piece = b.id_to_piece(k)
        own.append((k, bytes([int(piece[3:5], 16)]) if b.is_byte(k) else piece.replace("▁", " ").encode()))
    sides.append(own)
    if any(b"".join(t for _, t in side) != (" " + text).encode() for side in sides):
        return [], []
    out = []
    for side in sides:
        at, tokens = 0, []
        for k, token in side:
            at += len(token)
            tokens.append((k, at))
        out.append(tokens)
    return tuple(out)


def plain_groups(text):
    a, b = plain_tokens(text)
    both = {e for _, e in a} & {e for _, e in b}
    sides = []
    for side in (a, b):
        cut, run = [], []
        for k, end in side:
            run.append(k)
            if end in both:
                cut.append(run)
                run = []
        sides.append(cut)
    return list(zip(*sides, strict=True))


def plain_rows(docs):
    groups = [plain_groups(text) for _, text in docs]
    links = [[(a[-1], b[-1]) for a, b in found] for found in groups]
    count = Counter(pair for own in links for pair in own)
    top = defaultdict(int)
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    out = []
    for (doc, _), found, own in zip(docs, groups, links):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in found)
        out.append(
            (
                doc, sum(len(a) for a, _ in found), sum(len(b) for _, b in found), len(found), len(own),
                sum(count[p] == top[p[1]] for p in own), sum(count[p] for p in own),
                hashlib.sha256(text.encode()).hexdigest() if found else "",
            )
        )
    return sorted(out, key=str)


ODD = [
    "", " ", "  ", "a", "▁", "a ▁b c", "<|endoftext|>", "x <s></s> <unk> <0x41>", "é😀 ab ", " 😀😀", "\n\nA b\n c  d\te ",
    "漢字 かな 한국어 عربى עברית", "don't we'll I'VE 's", "1234567 12,345.6 0x1F", "a b   c", "\x00 \x01b",
    "naïve café “quoted” — dash…", "👩‍👩‍👧‍👦 flag 🇩🇪 x", "a" * 3000, "é" * 1500, "word " * 2000 + "end", "  a 　b",
    "snake_case_name(x)[0] != {'k': 1};", "\x1c a \x85b", "ﬁ ﬀ ① Ⅳ", "é à", "﻿bom", "tab\t tab \tend",
]


@cache
def shared_aligner():
    return ta.Aligner(open(BYTE_MODEL).read(), open(PIECE_MODEL, "rb").read())


@pytest.fixture(scope="module")
def aligner():
    return shared_aligner()


def groups_of(aligner, texts):
    found = aligner.align(texts)
    groups = [[(g["a"], g["b"]) for g in own] for own in ta._groups(found).to_pylist()]
    assert ta._texts(found, aligner).to_pylist() == [
        ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in own) for own in groups
    ]
    return groups


def test_odd_texts_equal_whole_encoding(aligner):
    assert aligner.splits
    assert groups_of(aligner, [None, *ODD]) == [[], *map(plain_groups, ODD)]
    assert groups_of(aligner, ODD[::-1]) == [plain_groups(t) for t in ODD[::-1]]
    whole = ta.Aligner(open(BYTE_MODEL).read(), open(PIECE_MODEL, "rb").read())
    whole.splits = False
    assert groups_of(whole, ODD) == [plain_groups(t) for t in ODD]
    aligner.forget()
    assert [bool(g) for g in groups_of(aligner, ["good one", "bad ▁one", "good one"])] == [True, False, True]


@given(st.lists(st.text(alphabet=st.sampled_from("ab '1.é😀▁ \n\t <s>|ﬁ́"), max_size=30), max_size=6))
@settings(max_examples=100, deadline=None)
def test_any_text_equals_whole_encoding(texts):
    assert groups_of(shared_aligner(), texts) == [plain_groups(t) for t in texts]


def test_memory_is_bounded(aligner, monkeypatch):
    monkeypatch.setattr(ta, "MEMORY", 20)
    texts = [f"w{k} x{k % 3} y z{k * 7}" for k in range(60)]
    got = [groups_of(aligner, texts[i : i + 5]) for i in range(0, 60, 5)]
    assert sum(got, []) == [plain_groups(t) for t in texts]
    assert len(aligner.index) <= 30 and {"y", "x0"} <= set(aligner.index)
    monkeypatch.setattr(ta, "MEMORY_CHARS", 12)
    assert [groups_of(aligner, [t]) for t in texts] == [[plain_groups(t)] for t in texts]


def test_coarse_spans_are_refined_where_tokens_share_a_character(aligner):
    a, b = libraries()
    text = " 😀"
    spans = a.encode(text, add_special_tokens=False).offsets
    assert spans[1][0] < spans[0][1]  # two tokens spell the character
    (groups,) = groups_of(aligner, ["😀"])
    assert groups == plain_groups("😀")
    assert ta.token_ends(*map(lambda x: ta.np.array(x), ([0, 1, 1], [1, 5, 5], [1, 3, 1]))).tolist() == [1, 4, 5]
    assert ta.token_ends(*map(lambda x: ta.np.array(x), ([0, 1], [1, 5], [1, 3]))) is None


def test_whole_table_equals_plain(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op13_token_alignment"](spark, SF)
    assert got.columns == COLUMNS and set(t for _, t in got.dtypes) == {"bigint", "string"}
    assert sorted(map(tuple, got.collect()), key=str) == plain_rows(docs)


def test_frames(spark):
    docs = [(k, t) for k, t in enumerate(ODD)] + [(None, "a b"), (None, None), (3, "a b"), (3, "a b"), (70, None)]
    schema = "doc_id long, text string, key int, links int, n int, `x.y` int"
    df = spark.createDataFrame([(*d, 1, 2, 3, 4) for d in docs], schema).repartition(5)
    got = ta.link_digest(df, BYTE_MODEL, PIECE_MODEL)
    assert sorted(map(tuple, got.collect()), key=str) == plain_rows(docs)
    assert ta.link_digest(df.limit(0), BYTE_MODEL, PIECE_MODEL).count() == 0
    aligned = ta.align_tokens(df, BYTE_MODEL, PIECE_MODEL)
    assert aligned.columns == ["doc_id", "key", "n", "x.y", *ta.ADDED]
    assert {r["x.y"] for r in aligned.collect()} == {4}


@pytest.mark.parametrize("frequent", [1, 3, 50, 1 << 18])
def test_frequent_and_rare_pairs_meet_the_same_counts(spark, frequent):
    docs = [(k, f"the cat {'sat ' * (k % 4)}on the mat {k}") for k in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = ta.align_tokens(df, BYTE_MODEL, PIECE_MODEL).select(F.col("doc_id").alias("key"), "links")
    pairs = ta.pair_counts(rows, Scratch(spark, "test"))
    got = {r.key: (r.n_best, r.count_sum) for r in ta.link_figures(rows, pairs, frequent).collect()}
    assert got == {r[0]: (r[5], r[6]) for r in plain_rows(docs)}
