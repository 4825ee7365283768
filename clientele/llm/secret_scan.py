"""Secret scan in DataFrame functions only: patterns, and a battery of randomness tests on tokens.

Matches get their places from the lengths of the pieces between them, summed along the text.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from clientele.llm.lines import pair_hash
from clientele.llm.scratch import BROADCAST_BYTES, Scratch

#: Kinds in their order; the first three are the base, found by their patterns alone.
KINDS = ("assign", "access", "hex", "token")
BASE = KINDS[:3]

# Patterns, and what a text must hold for a pattern to be tried.
ASSIGN = (
    r"(?i)(password|passwd|secret|token|api_?key)"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
PATTERNS = {
    "assign": (ASSIGN, r"(?i)password|passwd|secret|token|api_?key"),
    # runs are taken whole, so their least length can be part of the pattern
    "access": (r"AKIA[A-Z0-9]{16,}", r"AKIA[A-Z0-9]{16}"),
    "hex": (r"[0-9a-f]{24,}", r"[0-9a-f]{24}"),
    "token": (r"[A-Za-z0-9+/_-]{20,}={0,2}", r"[A-Za-z0-9+/_-]{20}"),
}
LEAST_VALUE = 6

DIGITS = "0123456789"
SMALL = "abcdefghijklmnopqrstuvwxyz"
#: Encodings by inference order: condition on the token without =, and alphabet.
ENCODINGS = {
    "hex": (r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]+$", DIGITS + "abcdef"),
    "hex_upper": (r"^(?=.*[0-9])(?=.*[A-F])[0-9A-F]+$", DIGITS + "ABCDEF"),
    "base32": (r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+$", SMALL.upper() + "234567"),
    "base36": (r"^(?=.*[0-9])(?=.*[a-z])[0-9a-z]+$", DIGITS + SMALL),
    "base62": (r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[0-9A-Za-z]+$", DIGITS + SMALL.upper() + SMALL),
    "base64": (
        r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[0-9A-Za-z+/]+$",
        SMALL.upper() + SMALL + DIGITS + "+/",
    ),
    "base64url": (
        r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[0-9A-Za-z_-]+$",
        SMALL.upper() + SMALL + DIGITS + "-_",
    ),
}
#: Tried next, and then these and the first ones of a single case on the token without - and _.
LATER = {
    "base36_upper": (r"^(?=.*[0-9])(?=.*[A-Z])[0-9A-Z]+$", DIGITS + SMALL.upper()),
    "base52": (r"^(?=.*[a-z])(?=.*[A-Z])[A-Za-z]+$", SMALL.upper() + SMALL),
}
SINGLE_CASE = ("hex", "hex_upper", "base32", "base36")
LEAST_TOKEN = 20
#: Steps per unit of -log10 of a p-value, and the largest such value told apart.
STEPS, LARGEST = 32, 64

# Coefficients of a rational approximation of the complementary error function whose
# relative error is below 1.2e-7 everywhere.
ERFC = (
    -1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806,
    0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277,
)


def log10_tail(z: Column) -> Column:
    """log10 of the probability that a standard normal is above z; z below 0 counts as 0."""
    x = F.greatest(z, F.lit(0.0)) / math.sqrt(2)
    t = 1 / (1 + x / 2)
    series = F.lit(ERFC[-1])
    for c in reversed(ERFC[:-1]):
        series = series * t + c
    return (F.log(t) - x * x + series - math.log(2)) / math.log(10)


def matches(texts: DataFrame, kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """kind, start, end (code points) and match of all matches; with the columns of texts but text.

    texts: text, and rid that is unique. Only texts that can match are cut up; only matches and the
    lengths of what is between them are shuffled.
    """
    each = [
        F.when(
            F.col("text").rlike(PATTERNS[k][1]),
            F.struct(
                F.lit(k).alias("kind"),
                F.split("text", PATTERNS[k][0], -1).alias("gaps"),
                F.regexp_extract_all("text", F.lit(PATTERNS[k][0]), F.lit(0)).alias("found"),
            ),
        )
        for k in kinds
    ]
    other = [c for c in texts.columns if c != "text"]
    cut = texts.select(*other, F.explode(F.array_compact(F.array(*each))).alias("x"))
    parts = F.arrays_zip(
        F.transform("x.gaps", F.char_length).alias("gap"), F.col("x.found").alias("found")
    )
    rows = cut.select(*other, "x.kind", F.posexplode(parts).alias("i", "part"))
    rows = rows.select(
        *other, "kind", "i", F.col("part.gap").alias("gap"), F.col("part.found").alias("match")
    ).where("match is not null")
    size = F.char_length("match").cast("long")
    along = W.partitionBy("rid", "kind").orderBy("i").rowsBetween(W.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + size).over(along)
    return rows.select(*other, "kind", "match", (end - size).alias("start"), end.alias("end"))


def encoded(token: Column) -> tuple[Column, Column, Column]:
    """Name and alphabet of the encoding that a token seems to be in, and its symbols.

    Null for words and numbers: digits only, or letters of one case only.
    """
    bare = F.rtrim(token, F.lit("="))
    joined = F.regexp_replace(bare, "[_-]", "")
    single = {k: ENCODINGS[k] for k in SINGLE_CASE} | {"base36_upper": LATER["base36_upper"]}
    tries = [(bare, ENCODINGS | LATER), (joined, single)]
    none = F.lit(None).cast("string")
    name, alphabet, symbols = none, none, none
    for of, encodings in reversed(tries):
        for key, (pattern, letters) in reversed(encodings.items()):
            fits = of.rlike(pattern)
            name = F.when(fits, key).otherwise(name)
            alphabet = F.when(fits, letters).otherwise(alphabet)
            symbols = F.when(fits, of).otherwise(symbols)
    return name, alphabet, symbols


def with_segments(tokens: DataFrame) -> DataFrame:
    """The tokens, and what is between / - _ in them if long enough; owner: start of the token."""
    parts = F.split("match", "[/_-]")
    before = F.aggregate(
        F.slice(parts, 1, F.col("at")), F.lit(0), lambda n, part: n + F.char_length(part) + 1
    )
    cut = tokens.where(F.col("match").rlike("[/_-]")).select(
        "*", F.posexplode(parts).alias("at", "segment")
    )
    cut = cut.where(F.char_length("segment") >= LEAST_TOKEN).withColumn("first", F.col("start") + before)
    size = F.char_length("segment")
    same = [c for c in tokens.columns if c not in ("match", "start", "end")]
    segments = cut.select(
        *same, F.col("segment").alias("match"), F.col("first").alias("start"),
        (F.col("first") + size).alias("end"), F.col("start").alias("owner"),
        F.lit(True).alias("segment"),
    )
    whole = tokens.select("*", F.col("start").alias("owner"), F.lit(False).alias("segment"))
    return whole.unionByName(segments)


def battery(tokens: DataFrame) -> DataFrame:
    """Adds encoding, n, and logp (log10): how far three tests speak against even randomness.

    Chi-squared: evenness over the alphabet. Runs: of symbols in either half of the alphabet. Serial
    correlation: of neighbouring symbols' places in the alphabet. The smallest of the three p-values
    times three stands for all. Tokens in no encoding are left out.
    """
    name, alphabet, symbols = encoded(F.col("match"))
    rows = tokens.select(
        "*", name.alias("encoding"), alphabet.alias("alphabet"), symbols.alias("symbols")
    )
    rows = rows.where("encoding is not null")
    # places in the alphabet, from 0
    places = F.transform(
        F.filter(F.split("symbols", ""), lambda c: c != ""),
        lambda c: (F.instr(F.col("alphabet"), c) - 1).cast("double"),
    )
    rows = rows.withColumn("x", places).withColumn("n", F.size("x").cast("double"))
    rows = rows.withColumn("k", F.char_length("alphabet").cast("double"))

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda a, b: a + b)

    squares = total(
        F.transform(
            F.sequence(F.lit(0), F.col("k").cast("int") - 1),
            lambda s: F.pow(F.size(F.filter("x", lambda v: v == s)).cast("double"), F.lit(2.0)),
        )
    )
    n, k = F.col("n"), F.col("k")
    df = k - 1
    chi = F.greatest(squares * k / n - n, F.lit(0.0))
    cube = F.pow(chi / df, F.lit(1 / 3))
    z_chi = (cube - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))

    size = F.size("x")
    upper = total(F.transform("x", lambda v: F.when(v >= k / 2, 1.0).otherwise(0.0)))
    pairs = F.arrays_zip(
        F.slice("x", 1, size - 1).alias("a"), F.slice("x", 2, size - 1).alias("b")
    )
    turns = total(
        F.transform(
            pairs, lambda p: F.when((p["a"] >= k / 2) != (p["b"] >= k / 2), 1.0).otherwise(0.0)
        )
    )
    rows = rows.withColumn("pairs", pairs).withColumn("upper", upper).withColumn("turns", turns)
    both = 2 * F.col("upper") * (n - F.col("upper")) / n
    spread = F.sqrt(F.greatest(both * (both - 1) / (n - 1), F.lit(1e-9)))
    z_runs = F.abs(F.col("turns") - both) / spread
    # all in one half: the chance of that many equal sides
    z_runs = F.when((F.col("upper") == 0) | (F.col("upper") == n), F.sqrt(n)).otherwise(z_runs)

    rows = rows.withColumn("mean", total(F.col("x")) / n)
    mean = F.col("mean")
    top = total(F.transform("pairs", lambda p: (p["a"] - mean) * (p["b"] - mean)))
    bottom = total(F.transform("x", lambda v: (v - mean) * (v - mean)))
    serial = F.when(bottom > 0, top / bottom).otherwise(1.0)
    z_serial = F.abs(serial) * F.sqrt(n)

    least = F.least(
        log10_tail(z_chi), log10_tail(z_runs) + math.log10(2), log10_tail(z_serial) + math.log10(2)
    )
    logp = F.least(least + math.log10(3), F.lit(0.0))
    return rows.withColumn("logp", logp).drop(
        "x", "k", "alphabet", "symbols", "pairs", "upper", "turns", "mean"
    )


def rejection_step(tested: DataFrame, rate: float) -> int:
    """Tokens at or above this step of -log10 of the weighted p-value are not random.

    Benjamini and Hochberg's procedure at the false-discovery rate, p-values weighted by length over
    the mean length: longer tokens, on which the tests have more power, are rejected more easily. It
    runs over counts per step, so the driver gets at most STEPS * LARGEST rows.
    """
    counts = dict(tested.groupBy("step").count().collect())
    total, run, found = sum(counts.values()), 0, STEPS * LARGEST + 1
    for step in sorted(counts, reverse=True):
        run += counts[step]
        # every p-value of the step is below its lower edge's
        if 10 ** (-step / STEPS) <= rate * run / total:
            found = step
    return found


def find_secrets(
    docs: DataFrame,
    rate: float = 0.05,
    doc_id: str = "doc_id",
    text: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Spans of secrets in each text.

    Base kinds, leftmost and not overlapping within a kind: assign (a keyword, : or =, and a value of
    at least 6 characters), access (AKIA and more, 20 characters at least), hex (24 at least). Matches
    that fail are dropped and not tried anew. The method adds tokens of 20 characters or more, and such
    segments between / - _ of tokens that are not added whole, in an inferred encoding (letters of one
    case alone are in none; - and _ in a token of one case are passed over), for which a battery of randomness tests (see `battery`) does not reject
    randomness under false-discovery control over all tokens of the input at `rate`. A token that meets a
    base span is not added.

    Adds secrets: an array of start, order (of the kind), kind, end, match, by start and kind (code
    points, end exclusive); an input column of that name gives way. A null or empty text has none.
    Repeated rows get equal results, and count once each for the rate. No documents give no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "secret-scan")
    k1, k2 = pair_hash(docs[doc_id], docs[text])
    others = [c for c in docs.columns if c.lower() != "secrets"]
    texts = docs.select(
        F.coalesce(docs[text], F.lit("")).alias("text"),
        k1.alias("k1"),
        k2.alias("k2"),
        F.monotonically_increasing_id().alias("rid"),
    )
    found = scratch.write(matches(texts), "matches")
    value = F.regexp_extract("match", ASSIGN, 2)
    base = found.where(
        F.col("kind").isin("access", "hex")
        | ((F.col("kind") == "assign") & (F.char_length(value) >= LEAST_VALUE))
    )
    tokens = scratch.write(battery(with_segments(found.where("kind = 'token'"))), "tokens")
    mean = tokens.agg(F.avg("n")).first()[0] or 1.0
    # larger weights make p-values smaller
    weighted = -F.col("logp") + F.log10(F.col("n") / F.lit(mean))
    step = F.floor(F.least(F.greatest(weighted, F.lit(0.0)), F.lit(float(LARGEST))) * STEPS)
    tested = tokens.withColumn("step", step.cast("int"))
    random = tested.where(F.col("step") < rejection_step(tested, rate))
    none = F.lit(None)
    both = base.select("*", none.cast("long").alias("owner"), F.lit(False).alias("segment"))
    both = both.unionByName(random.select(both.columns))
    by_text = W.partitionBy("rid")
    is_base = F.col("kind") != "token"
    reached = F.max(F.when(is_base, F.col("end"))).over(
        by_text.orderBy("start").rangeBetween(W.unboundedPreceding, 0)
    )
    follows = F.min(F.when(is_base, F.col("start"))).over(
        by_text.orderBy("end").rangeBetween(0, W.unboundedFollowing)
    )
    marked = both.withColumn("reached", reached).withColumn("follows", follows)
    # a base span began before or with it and goes on, or one begins within it
    meets = (F.coalesce("reached", F.lit(0)) > F.col("start")) | (
        F.coalesce("follows", F.col("end")) < F.col("end")
    )
    spans = marked.where(is_base | ~meets)
    # a token that is added whole stands for its segments
    added = F.max(~F.col("segment")).over(W.partitionBy("rid", "kind", "owner"))
    spans = spans.withColumn("added", added).where(is_base | ~F.col("segment") | ~F.col("added"))
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int")
    one = F.struct("start", order.alias("order"), "kind", "end")
    spans = spans.groupBy("k1", "k2", "rid").agg(F.sort_array(F.collect_list(one)).alias("secrets"))
    # repeated rows have the same spans
    spans = spans.groupBy("k1", "k2").agg(F.min_by("secrets", "rid").alias("secrets"))
    # only places stay behind: the secrets themselves are taken from the text again
    spans = scratch.write(spans, "spans")
    scratch.drop(found, tokens)
    out = docs.select(
        F.struct(*[docs[c] for c in others]).alias("row"), docs[text].alias("text"), k1.alias("k1"), k2.alias("k2")
    ).join(scratch.joinable(spans, broadcast_bytes), ["k1", "k2"], "left")
    none = F.array().cast(spans.schema["secrets"].dataType)
    whole = F.transform(
        F.coalesce("secrets", none),
        lambda s: F.struct(
            *[s[c].alias(c) for c in ("start", "order", "kind", "end")],
            F.substring(F.col("text"), s["start"].cast("int") + 1, (s["end"] - s["start"]).cast("int")).alias("match"),
        ),
    )
    return out.select(*[F.col("row").getField(c).alias(c) for c in others], whole.alias("secrets"))


def spans_text(spans: Column, kinds: tuple[str, ...] | None = None) -> Column:
    """kind:start:end of the spans, comma-joined; of some kinds or all."""
    if kinds:
        spans = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    one = F.transform(
        spans,
        lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.array_join(one, ",")
