"""Personal data and secrets against plain patterns."""

import random
import string
from pathlib import Path

import plain
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clientele.llm import pii, secret_scan
from clientele.llm.queries import QUERIES
from clientele.session import scratch_dir

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string"


def base_of(spans, kinds):
    return [f"{s.kind}:{s.start}:{s.end}" for s in spans if s.kind in kinds]


@given(st.text(alphabet="ab@.-_é 0123456789+()", max_size=60))
@settings(max_examples=500, deadline=None)
def test_base_pii_equals_plain_patterns(text):
    assert base_of(pii.find_spans(text), pii.BASE) == plain.base_pii(text)


def test_pii_kinds_and_context():
    assert not pii.find_spans("number 123-45-6789 here")
    found = pii.find_spans("her SSN is 123-45-6789, IBAN DE89 3704 0044 0532 0130 00, call (555) 123-4567")
    assert [s.kind for s in found] == ["ssn", "iban", "local_phone"]
    assert not pii.find_spans("IBAN DE88 3704 0044 0532 0130 00")
    near, far = (pii.find_spans(t)[0].score for t in ("mail me: a@b.co", "see a@b.co"))
    assert near > far


@pytest.mark.parametrize(
    "text", ["9" * 200_000, "a" * 200_000, "@" * 200_000, "a@" * 100_000, "+(" * 100_000]
)
def test_long_runs_take_linear_time(text):
    assert pii.find_spans(text) == []


def test_a_long_run_of_addresses_is_found_whole():
    found = pii.find_spans("1." * 100_000)
    assert [(s.kind, s.start, s.end) for s in found] == [("ip", 8 * k, 8 * k + 7) for k in range(25_000)]


def rows_of(spark, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    return [(r, docs) for r in [{x.doc_id: x for x in QUERIES[name](spark, SF).collect()}]][0]


@pytest.mark.parametrize(
    "name, plainly, kinds",
    [
        ("op6_pii", plain.base_pii, pii.BASE),
        ("op10_secret_scan", plain.base_secrets, secret_scan.BASE),
    ],
)
def test_queries_equal_plain(spark, name, plainly, kinds):
    found, docs = rows_of(spark, name)
    assert len(found) == len(docs)
    for doc in docs:
        want, r = plainly(doc.text or ""), found[doc.doc_id]
        assert r.base_sha256 == plain.sha256(",".join(want))
        for kind in kinds:
            assert r[f"n_{kind}"] == sum(w.startswith(kind + ":") for w in want)
        assert set(want) <= set(r.spans.split(","))


def token(rng, letters, n):
    return "".join(rng.choices(letters, k=n))


def test_secret_texts(spark):
    rng = random.Random(3)
    upper = string.ascii_uppercase + string.digits
    texts = [
        "password = hunter2x, Token:'abc' secret:token: abcdef API_KEY=\"A.b-c_d/e+f=\"",
        "x AKIA" + token(rng, upper, 16) + " AKIASHORT AKIAAKIA" + token(rng, upper, 30),
        "é" * 5 + " 0123456789abcdef01234567 0123456789abcdef0123456 z",
        "ſecret=abcdefg pasſword=abcdefg",
        None,
        "",
        "passwd" * 1000 + "=" + "k" * 50_000,
        "token==abcdef token = \"'abcdef",
    ]
    rows = [(k, t) for k, t in enumerate(texts)] + [(0, texts[0]), (None, texts[1])]
    docs = spark.createDataFrame([(*r, 7, "o") for r in rows], SCHEMA + ", rid int, secrets string")
    found = secret_scan.find_secrets(docs).collect()
    assert len(found) == len(rows)
    for r in found:
        want = plain.base_secrets(r.text or "")
        assert base_of(r.secrets, secret_scan.BASE) == want, r.text
        assert r.rid == 7
    assert secret_scan.find_secrets(spark.createDataFrame([], SCHEMA)).count() == 0


def test_random_tokens_are_told_from_structured_ones(spark):
    rng = random.Random(5)
    b62 = string.ascii_letters + string.digits
    secret = [token(rng, b62, rng.choice([32, 40, 64])) for _ in range(60)]
    secret += [token(rng, b62 + "+/", 64) for _ in range(30)]
    plainer = [f"Version1/{'abcabc' * 6}{k}Ab" for k in range(60)]
    plainer += ["A1" + "ab" * 20 + str(k) for k in range(30)]
    rows = [(k, f"see {t} there") for k, t in enumerate(secret + plainer)]
    found = secret_scan.find_secrets(spark.createDataFrame(rows, SCHEMA)).collect()
    tokens = {r.doc_id for r in found if any(s.kind == "token" for s in r.secrets)}
    assert len(tokens & set(range(90))) >= 85
    assert len(tokens & set(range(90, 180))) <= 2
    for r in found:
        for s in r.secrets:
            assert r.text[s.start : s.end] == s.match


def test_tail_probabilities(spark):
    from math import erfc, log10, sqrt

    from pyspark.sql import functions as F

    z = [0.0, 0.5, 1.0, 2.5, 5.0, 12.0, 30.0]
    got = spark.createDataFrame([(x,) for x in z], "z double").select(
        secret_scan.log10_tail(F.col("z")).alias("p")
    )
    for x, r in zip(z, got.collect(), strict=True):
        assert r.p == pytest.approx(log10(erfc(x / sqrt(2)) / 2), abs=1e-6)


def test_redaction(spark):
    rows = [(1, "mail a@b.co or +1 555 123 4567!"), (2, None), (3, "nothing"), (4, ""), (5, "é😀 1.2.3.4")]
    out = pii.redact(pii.find_pii(spark.createDataFrame([(*r, 7) for r in rows], SCHEMA + ", `a.b` int")))
    assert [r.text for r in out.orderBy("doc_id").collect()] == [
        "mail <EMAIL> or <PHONE>!", None, "nothing", "", "é😀 <IP>",
    ]
    assert out.columns == ["doc_id", "text", "a.b", "pii"] and {r["a.b"] for r in out.collect()} == {7}
    assert pii.redact(pii.find_pii(spark.createDataFrame([], SCHEMA))).count() == 0


@pytest.mark.parametrize(
    "text, kinds",
    [
        ("the hotel 555 123 4567", []),
        ("078-05-1120 antisocial", []),
        ("a barbecue, recall 555 123 4567", []),
        ("Tel: 555 123 4567", ["local_phone"]),
        ("two phones, 555 123 4567", ["local_phone"]),
        ("078-05-1120 (SSN)", ["ssn"]),
    ],
)
def test_context_words_are_whole_words(text, kinds):
    assert [s.kind for s in pii.find_spans(text)] == kinds


def test_nearer_context_counts_more():
    near, far = (pii.find_spans(f"phone {gap} 555 123 4567")[0].score for gap in ("", "x" * 30))
    assert 0.5 <= far < near


def test_added_kinds_catch_what_is_planted():
    """Planted with context: all found. The same forms without context or with a wrong sum: none."""
    rng = random.Random(11)

    def digits(n):
        return "".join(rng.choices(string.digits, k=n))

    def iban(shift):
        body = digits(18)
        check = 98 - int(body + "131400") % 97  # D is 13, E is 14
        return f"DE{(check + shift) % 100:02d}{body}"

    planted, clean = [], []
    for _ in range(200):
        local = f"{rng.randint(200, 999)}-{rng.randint(100, 999)}-{digits(4)}"
        ssn = f"{rng.randint(100, 665)}-{rng.randint(10, 99)}-{rng.randint(1000, 9999)}"
        planted += [("local_phone", f"call me: {local}."), ("ssn", f"SSN {ssn}"), ("iban", f"to {iban(0)} now")]
        clean += [f"part {local} of", f"page {ssn} of", f"to {iban(rng.randint(1, 96))} now"]
    assert all(kind in [s.kind for s in pii.find_spans(t)] for kind, t in planted)
    assert not any(pii.find_spans(t) for t in clean)


def test_pii_frames(spark):
    rows = [(1, "a@b.co", 1, 2), (None, None, 1, 2), (1, "a@b.co", 1, 2)]
    found = pii.find_pii(spark.createDataFrame(rows, SCHEMA + ", pii int, row int")).collect()
    assert sorted(len(r.pii) for r in found) == [0, 1, 1] and {r.row for r in found} == {2}
    assert pii.find_pii(spark.createDataFrame([], SCHEMA)).count() == 0


def test_every_form_of_secret_is_tested(spark):
    rng = random.Random(7)
    low, up = string.ascii_lowercase + string.digits, string.ascii_uppercase + string.digits
    dashed = ["-".join(token(rng, string.hexdigits[:16], n) for n in (8, 4, 4, 4, 12)) for _ in range(15)]
    live = ["sk_live_" + token(rng, low, 24) for _ in range(15)]
    upper = [token(rng, up, 32) for _ in range(15)]
    letters = [token(rng, string.ascii_letters, 40) for _ in range(15)]
    keys = [token(rng, string.ascii_letters + string.digits, 40) for _ in range(15)]
    rows = [(k, f"see {t} there") for k, t in enumerate(dashed + live + upper + letters)]
    rows += [(60 + k, f"see example/my-path_to/{t} there") for k, t in enumerate(keys)]
    found = secret_scan.find_secrets(spark.createDataFrame(rows, SCHEMA)).collect()
    spans = {r.doc_id: r.secrets for r in found}
    for first in range(0, 75, 15):
        assert sum(bool(spans[k]) for k in range(first, first + 15)) >= 13, first
    for r in found:
        assert len(r.secrets) <= 1 and all(r.text[s.start : s.end] == s.match for s in r.secrets)
        assert r.doc_id < 60 or not r.secrets or keys[r.doc_id - 60] in r.secrets[0].match


@pytest.mark.parametrize(
    "iban, after",
    [
        ("BE68 5390 0754 7034", " BIC GKCCBEBB"),
        ("ES91 2100 0418 4502 0005 1332", " EUR"),
        ("BE68 5390 0754 7034", " 2024"),
    ],
)
def test_iban_before_other_words(iban, after):
    for text in (iban + after, "AB12 3456 7890 " + iban + after):
        assert [text[s.start : s.end] for s in pii.find_spans(text) if s.kind == "iban"] == [iban]
    twice = [s for s in pii.find_spans(f"{iban} {iban}") if s.kind == "iban"]
    assert len(twice) == 2


def test_context_after_a_span():
    assert [s.kind for s in pii.find_spans("078-05-1120 (SSN)")] == ["ssn"]
    assert [s.kind for s in pii.find_spans("555 123 4567 is the phone")] == ["local_phone"]


def test_no_secret_stays_in_the_scratch_folder(spark):
    key = token(random.Random(5), string.ascii_letters + string.digits, 40)
    before = set(Path(scratch_dir(spark)).glob("secret-scan-*"))
    docs = spark.createDataFrame([(1, f"password: {key} and {key[::-1]}")], SCHEMA)
    (found,) = secret_scan.find_secrets(docs).collect()
    assert [s.match for s in found.secrets] and all(s.match in found.text for s in found.secrets)
    (mine,) = set(Path(scratch_dir(spark)).glob("secret-scan-*")) - before
    assert [p.name.split("-")[0] for p in mine.iterdir()] == ["spans"]
    assert "match" not in str(spark.read.parquet(*map(str, mine.iterdir())).schema)
