"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score."""

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Kinds in their order. The first four are the base; they stand whatever their context.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "local_phone")
BASE = KINDS[:4]
#: Characters before and after a span in which context words count.
REACH = 48

# Context words, scores and patterns.
CONTEXT = {
    "email": "mail contact write courriel correo",
    "ip": "ip address server host adresse",
    "card": "card visa mastercard credit debit karte carte tarjeta",
    "phone": "phone tel call mobile telefon fax",
    "iban": "iban account konto compte cuenta bank",
    "ssn": "ssn social security insurance taxpayer",
    "local_phone": "phone tel call mobile telefon fax",
}
SCORES = {"email": 0.8, "ip": 0.7, "card": 0.8, "phone": 0.7, "iban": 0.8, "ssn": 0.4, "local_phone": 0.4}
CONTEXT_SCORE = 0.2
ACCEPTED = 0.5

LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can begin only where a run of digits begins, and takes a run whole; saying so keeps the
# search linear in long runs of digits.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
LOCAL_PHONE = re.compile(r"(?<![0-9+(.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9-])")
# Characters of an IBAN by country.
IBAN_LENGTHS = {
    c[:2]: int(c[2:])
    for c in (
        "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 "
        "EG29 ES24 FI18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 "
        "KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 MC27 MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15 PK24 PL28 "
        "PS29 PT25 QA29 RO24 RS22 SA24 SC31 SE24 SI19 SK24 SM27 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20"
    ).split()
}
DIGIT = re.compile(r"[0-9]")
#: Whole words, also in the plural; a word inside another one says nothing.
CONTEXT_WORDS = {
    k: re.compile(rf"(?<![^\W\d_])(?:{'|'.join(v.split())})s?(?![^\W\d_])", re.IGNORECASE)
    for k, v in CONTEXT.items()
}


@dataclass(frozen=True)
class Span:
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """The check of an IBAN: its first four characters moved to the end, letters as 10 to 35."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each @: the local part is the whole run before it."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and LOCAL.match(text, start - 1, start):
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        # characters before this @ cannot be in a later local part
        done = max(done, at + 1)
        at = text.find("@", done)


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """Candidates cut to their country's length; one that fails is left from its second character."""
    m = IBAN.search(text)
    while m:
        want = IBAN_LENGTHS.get(m[0][:2])
        at = [k for k in range(m.start(), m.end()) if text[k] != " "]
        end = m.end() if want is None else at[want - 1] + 1 if want <= len(at) else None
        # no character of a word follows
        whole = end is not None and not re.match("[A-Za-z0-9]", text[end : end + 1])
        iban = text[m.start() : end].replace(" ", "") if whole else ""
        good = 15 <= len(iban) <= 34 and mod97(iban)
        if good:
            yield m.start(), end
        m = IBAN.search(text, end if good else m.start() + 1)


def digits_of(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def proposals(text: str) -> Iterator[tuple[str, int, int]]:
    """Spans by kind that pass their checks."""
    if "@" in text:
        for start, end in emails(text):
            yield "email", start, end
    if not DIGIT.search(text):
        return
    for m in IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            yield "ip", m.start(), m.end()
    for m in CARD.finditer(text):
        # a long run is rejected by its length alone
        if 12 <= m.end() - m.start() <= 37:
            digits = digits_of(m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                yield "card", m.start(), m.end()
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(digits_of(m[0])) <= 15:
                yield "phone", m.start(), m.end()
    for start, end in ibans(text):
        yield "iban", start, end
    for kind, pattern in (("ssn", SSN), ("local_phone", LOCAL_PHONE)):
        for m in pattern.finditer(text):
            yield kind, m.start(), m.end()


def context_gap(kind: str, text: str, start: int, end: int) -> int | None:
    """Characters between a span and the nearest context word within reach; None without one."""
    words, near = CONTEXT_WORDS[kind], None
    for m in words.finditer(text, max(0, start - REACH), start):
        near = start - m.end()  # the last one is the nearest
    after = words.search(text, end, end + REACH)
    if after and (near is None or after.start() - end < near):
        near = after.start() - end
    return near


def find_spans(text: str) -> list[Span]:
    """All spans in order of start and kind; base kinds stay, others need a sufficient score."""
    out = []
    for kind, start, end in proposals(text):
        gap = context_gap(kind, text, start, end)
        # a word at the end of the reach counts half of one beside the span
        bonus = 0.0 if gap is None else CONTEXT_SCORE * (1 - gap / (2 * REACH))
        score = min(1.0, SCORES[kind] + bonus)
        if kind in BASE or score >= ACCEPTED:
            out.append(Span(kind, start, end, score))
    return sorted(out, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


SPAN_TYPE = T.ArrayType(
    T.StructType()
    .add("kind", "string", False)
    .add("start", "long", False)
    .add("end", "long", False)
    .add("score", "double", False)
    .add("text", "string", False),
    False,
)
_ARROW_SPANS = pa.list_(
    pa.struct(
        [
            pa.field("kind", pa.string(), False),
            pa.field("start", pa.int64(), False),
            pa.field("end", pa.int64(), False),
            pa.field("score", pa.float64(), False),
            pa.field("text", pa.string(), False),
        ]
    )
)


def _job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for value in batch.column("text"):
            text = value.as_py() or ""
            spans = find_spans(text)
            found.append(
                [
                    {
                        "kind": s.kind,
                        "start": s.start,
                        "end": s.end,
                        "score": s.score,
                        "text": text[s.start : s.end],
                    }
                    for s in spans
                ]
            )
        rest = batch.drop_columns(["text"])
        yield pa.RecordBatch.from_arrays(
            [*rest.columns, pa.array(found, _ARROW_SPANS)], [*rest.schema.names, "pii"]
        )


def find_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """Spans of personal data in each text.

    Base kinds, leftmost and not overlapping within a kind: email; ip (parts up to 255); card (12 to
    19 digits with a valid Luhn sum); phone (+ and 9 to 15 digits). The method adds iban (of its
    country's length, valid mod 97), and ssn and local_phone, which only count with a context word, a
    whole one, in the `REACH` characters before or after them. The nearest context word raises any
    span's score, the more the nearer it stands.

    Adds pii: an array of kind, start, end (code points, end exclusive), score, text, ordered by start
    and kind; an input column of that name gives way. A null or empty text has none. Spans of
    different kinds may overlap. Repeated rows get equal results. No documents give no rows. Time is
    linear in the text but for a phone's or card's own length.
    """
    others = [c for c in docs.columns if c.lower() != "pii"]
    packed = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in others]).alias("row"), docs[text].alias("text")
    )
    out = packed.mapInArrow(_job, packed.drop("text").schema.add("pii", SPAN_TYPE))
    return out.select(*[F.col("row").getField(c).alias(c) for c in others], "pii")


def spans_text(spans, kinds: tuple[str, ...] | None = None):
    """kind:start:end of the spans, comma-joined; of some kinds or all."""
    if kinds:
        spans = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    one = F.transform(
        spans,
        lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.array_join(one, ",")


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with each span of personal data replaced by <KIND>; overlapping ones as one.

    Takes what `find_pii` returns. A text without spans stays as it is, a null one stays null, also
    where spans came with it. No documents give no rows.
    """
    every = [docs[f"`{c}`"] for c in docs.columns]
    packed = docs.select(F.struct(*every).alias("row"), docs[text].alias("text"), docs["pii"])
    out = packed.mapInArrow(_mask_job, packed.select("row", "text").schema)
    return out.select(
        *[F.col("text" if c == text else f"row.`{c}`").alias(c) for c in docs.columns]
    )


def _mask_job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column("text").to_pylist(), batch.column("pii").to_pylist(), strict=True)
        texts = [t if t is None or not spans else _masked(t, spans) for t, spans in pairs]
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(texts, pa.string())], ["row", "text"]
        )


def _masked(text: str, spans: list[dict]) -> str:
    out, done = [], 0
    for s in spans:
        if s["start"] >= done:
            out += [text[done : s["start"]], f"<{s['kind'].upper()}>"]
        done = max(done, s["end"])
    return "".join([*out, text[done:]])
