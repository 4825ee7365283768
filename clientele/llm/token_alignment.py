"""Cross-tokenizer alignment: where the tokens of two tokenizers end together in a text.

Tokenizer A is a byte-level BPE of the tokenizers library, B a SentencePiece model. Both libraries give
spans, which serve as coarse cuts: characters of A, bytes of B's own text. Where several tokens spell
one character, or a token is one byte, the token's decoded bytes tell where it ends.
"""

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from clientele.llm.flat import sums
from clientele.llm.scratch import Scratch

MARK = "▁"  # stands for a space in B's pieces
#: Distinct chunks of text kept aligned in a worker, and their characters. Beyond, half are kept: those
#: that were used most.
MEMORY, MEMORY_CHARS = 200_000, 4 << 20
#: Chunks that the libraries get as one text; long texts are slower by the character.
RUN = 100
POOLS = ("a", "b", "a_sizes", "b_sizes")
#: Characters of text aligned at once; a longer single document is aligned alone.
SLICE = 1 << 20
#: Id pairs that are broadcast at most.
FREQUENT_PAIRS = 1 << 18

# A space between characters that are no white space: neither tokenizer has a token across the place
# before it. Python's white space includes all of theirs.
CUT = re.compile(r"(?<=\S) (?=\S)")
UNEVEN = re.compile(r" \s|\s ")


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in A's entries.

    Printable characters of Latin-1 stand for themselves, the other bytes for the next characters
    from 256 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


def byte_offsets(text: str) -> np.ndarray:
    """The byte at which each character of a text starts, and its end."""
    codes = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
    sizes = 1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)
    return np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))


def token_ends(starts: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> np.ndarray | None:
    """Byte offsets where tokens end, from their coarse spans and the sizes of their decoded bytes.

    A span ends its token, unless the next one begins before it: then tokens share a character, and
    end where their own bytes do. None if spans and bytes contradict each other.
    """
    spelled = np.cumsum(sizes, dtype=np.int64)
    shared = np.concatenate((starts[1:] < ends[:-1], [False])) | (starts == ends)
    out = np.where(shared, spelled, ends)
    return out if (out == spelled).all() else None


class Spelling:
    """The bytes of a vocabulary's entries."""

    def __init__(self, entries: list[bytes]):
        self.sizes = np.array([len(t) for t in entries], dtype=np.int64)
        self._starts = np.cumsum(self.sizes) - self.sizes
        self._data = np.frombuffer(b"".join(entries), dtype=np.uint8)

    def bytes_of(self, ids: np.ndarray) -> bytes:
        sizes = self.sizes[ids]
        before = np.cumsum(sizes) - sizes
        return self._data[np.arange(sizes.sum()) + np.repeat(self._starts[ids] - before, sizes)].tobytes()


class Aligner:
    """Aligns chunks of texts; keeps what it has aligned for the chunks that come again."""

    def __init__(self, a_json: str, b_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor()
        self.b.LoadFromSerializedProto(b_model)
        symbols, vocabulary = byte_symbols(), self.a.get_vocab(with_added_tokens=True)
        a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for entry, k in vocabulary.items():
            known = all(c in symbols for c in entry)
            a_bytes[k] = bytes(symbols[c] for c in entry) if known else entry.encode()
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace(MARK, " ").encode()
            for k, p in enumerate(pieces)
        ]
        self.a_spelling, self.b_spelling = Spelling(a_bytes), Spelling(b_bytes)
        # ids of A before , and | and ids of B before , and ;
        parts = ((a_bytes, ","), (a_bytes, "|"), (b_bytes, ","), (b_bytes, ";"))
        self.id_texts = Spelling([f"{k}{end}".encode() for entries, end in parts for k in range(len(entries))])
        self.splits = self._can_split(json.loads(a_json), pieces)
        self.forget()

    def _can_split(self, a: dict, pieces: list[str]) -> bool:
        """Whether a text may be cut at CUT, so that equal chunks are aligned once."""
        shape = a.get("pre_tokenizer") or {}
        by_words = shape.get("type") == "ByteLevel" and shape.get("use_regex", True)
        plain = by_words and not shape.get("add_prefix_space") and not a.get("normalizer")
        one = self.b.encode("a", out_type=str)
        prefixed = bool(one) and one[0].startswith(MARK)
        return plain and prefixed and not any(MARK in p.lstrip(MARK) for p in pieces)

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.chars = 0
        self.good = np.zeros(0, dtype=bool)
        self.uses = np.zeros(0, dtype=np.int64)
        # per chunk, ragged: ids of A and of B, and the numbers of both in each group
        self.pools = {name: np.zeros(0, dtype=np.int32) for name in POOLS}
        self.starts = {name: np.zeros(1, dtype=np.int64) for name in POOLS}

    def shrink(self) -> None:
        """Keep the chunks that were used most, as far as they were used again."""
        often = np.argsort(-self.uses, kind="stable")[: MEMORY // 2]
        often = np.sort(often[self.uses[often] > 1])
        chunks, size = list(self.index), 0
        for n, k in enumerate(often):
            size += len(chunks[k])
            if size > MEMORY_CHARS // 2:
                often = often[:n]
                break
        kept = [chunks[k] for k in often]
        self.index = dict(zip(kept, range(len(kept))))
        self.chars = sum(map(len, kept))
        for name in POOLS:
            self.pools[name], bounds = self._gather(name, often)
            self.starts[name] = bounds
        self.good, self.uses = self.good[often], self.uses[often] // 2

    def _gather(self, name: str, picked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of chunks in a pool, and their bounds."""
        starts = self.starts[name]
        first, sizes = starts[picked], starts[picked + 1] - starts[picked]
        before = np.concatenate(([0], np.cumsum(sizes)))
        places = np.arange(before[-1]) + np.repeat(first - before[:-1], sizes)
        return self.pools[name][places], before

    def _keep(self, chunks: list[str], found: dict[str, np.ndarray] | None, bounds: dict | None) -> None:
        """Chunks and their ragged results; None: of no chunk do the tokens make the text."""
        self.index.update(zip(chunks, range(len(self.good), len(self.good) + len(chunks))))
        self.chars += sum(map(len, chunks))
        self.good = np.concatenate((self.good, np.full(len(chunks), found is not None)))
        self.uses = np.concatenate((self.uses, np.zeros(len(chunks), dtype=np.int64)))
        for name in POOLS:
            end = self.starts[name][-1]
            if found is None:
                more = np.full(len(chunks), end)
            else:
                self.pools[name] = np.concatenate((self.pools[name], found[name].astype(np.int32)))
                more = end + bounds[name]
            self.starts[name] = np.concatenate((self.starts[name], more))

    def _try(self, chunks: list[str]) -> bool:
        """Align chunks as one text, if the tokens' bytes make it again."""
        runs = [" " + " ".join(chunks[k : k + RUN]) for k in range(0, len(chunks), RUN)]
        text = "".join(runs)
        data = text.encode()
        encodings = self.a.encode_batch(runs, add_special_tokens=False)
        protos = self.b.encode([r[1:] for r in runs], return_type="proto", num_threads=1)
        a = np.fromiter(chain.from_iterable([e.ids for e in encodings]), dtype=np.int64)
        pieces = [proto.pieces for proto in protos]
        spelled = [x for run in pieces for p in run for x in (p.id, p.begin, p.end)]
        b, b_begins, b_stops = np.array(spelled, dtype=np.int64).reshape(-1, 3).T
        if self.a_spelling.bytes_of(a) != data or self.b_spelling.bytes_of(b) != data:
            return False
        at = byte_offsets(text)
        # A's spans are characters of its run
        begins = np.cumsum([0, *map(len, runs)])[:-1]
        offsets = chain.from_iterable(chain.from_iterable([e.offsets for e in encodings]))
        own = np.fromiter(offsets, dtype=np.int64).reshape(-1, 2)
        spans = at[own + np.repeat(begins, [len(e) for e in encodings])[:, None]]
        a_ends = token_ends(spans[:, 0], spans[:, 1], self.a_spelling.sizes[a])
        # B's are bytes of its run without the space in front, which belongs to the first token
        base = np.repeat(at[begins], [len(run) for run in pieces])
        b_starts = base + np.where(b_begins > 0, b_begins + 1, 0)
        b_ends = token_ends(b_starts, base + b_stops + 1, self.b_spelling.sizes[b])
        if a_ends is None or b_ends is None:
            a_ends, b_ends = np.cumsum(self.a_spelling.sizes[a]), np.cumsum(self.b_spelling.sizes[b])
        common = np.intersect1d(a_ends, b_ends, assume_unique=True)
        a_last, b_last = np.searchsorted(a_ends, common), np.searchsorted(b_ends, common)
        found = {
            "a": a,
            "b": b,
            "a_sizes": np.diff(a_last, prepend=-1),
            "b_sizes": np.diff(b_last, prepend=-1),
        }
        chunk_ends = at[np.cumsum([len(c) + 1 for c in chunks])]
        if not np.isin(chunk_ends, common).all():
            return False
        groups = np.searchsorted(common, chunk_ends) + 1
        bounds = {
            "a": np.searchsorted(a_ends, chunk_ends) + 1,
            "b": np.searchsorted(b_ends, chunk_ends) + 1,
            "a_sizes": groups,
            "b_sizes": groups,
        }
        self._keep(chunks, found, bounds)
        return True

    def _learn(self, chunks: list[str]) -> None:
        """Align chunks that are not known, together where they stay apart in one text."""
        whole = [c for c in chunks if self.splits and not (c[0].isspace() or c[-1].isspace())]
        alone = chunks if not self.splits else [c for c in chunks if c[0].isspace() or c[-1].isspace()]
        runs = [whole] if whole else []
        while runs:
            run = runs.pop()
            if self._try(run):
                continue
            if len(run) == 1:
                self._keep(run, None, None)
            else:  # find the ones whose tokens do not make the text
                runs += [run[: len(run) // 2], run[len(run) // 2 :]]
        for chunk in alone:
            if not self._try([chunk]):
                self._keep([chunk], None, None)

    def chunks(self, text: str) -> list[str]:
        if not self.splits:
            return [text]
        if text[0] == " " or text[-1] == " " or UNEVEN.search(text):
            return CUT.split(text)
        return text.split(" ")

    def align(self, texts: list[str | None]) -> dict[str, np.ndarray]:
        """Ragged results of texts: the pools' values, and their bounds by text."""
        cut = [self.chunks(t) if t else [] for t in texts]
        fresh = dict.fromkeys(c for chunks in cut for c in chunks)
        if len(self.index) + len(fresh) > MEMORY or self.chars > MEMORY_CHARS:
            self.shrink()
        known = self.index
        fresh = [c for c in fresh if c not in known]
        if fresh:
            self._learn(fresh)
        picked = np.array([known[c] for chunks in cut for c in chunks], dtype=np.int64)
        bounds = np.cumsum([0, *map(len, cut)])
        self.uses += np.bincount(picked, minlength=len(self.uses))
        good = self.good[picked]
        whole = sums(~good, bounds) == 0
        picked = picked[np.repeat(whole, np.diff(bounds))]
        bounds = np.concatenate(([0], np.cumsum(np.where(whole, np.diff(bounds), 0))))
        out = {}
        for name in POOLS:
            out[name], before = self._gather(name, picked)
            out[f"{name}_bounds"] = before[bounds]
        return out


_ALIGNERS: dict[str, Aligner] = {}


def _aligner(mark: str, files) -> Aligner:
    """One for each worker; it serves the tasks that the worker runs. mark: a hash of the files."""
    if mark not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[mark] = Aligner(*files.value)
    return _ALIGNERS[mark]


LINKS = T.ArrayType(
    T.StructType().add("a", "integer", False).add("b", "integer", False).add("n", "integer", False), False
)
GROUPS = T.ArrayType(
    T.StructType()
    .add("a", T.ArrayType(T.IntegerType(), False), False)
    .add("b", T.ArrayType(T.IntegerType(), False), False),
    False,
)


def _slices(texts: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """Runs of texts of at most SLICE characters, or one longer text, with their first place."""
    first, chars, run = 0, 0, []
    for k, value in enumerate(texts):
        text = value.as_py()
        if run and chars + len(text or "") > SLICE:
            yield first, run
            first, chars, run = k, 0, []
        run.append(text)
        chars += len(text or "")
    if run:
        yield first, run


def _ragged(values: pa.Array, bounds: np.ndarray) -> pa.ListArray:
    kind = pa.list_(pa.field("element", values.type, False))
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), values).cast(kind)


def _texts(found: dict[str, np.ndarray], aligner: Aligner) -> pa.Array:
    """Groups of each text as a1,a2|b1;a3|b2,b3."""
    a_sizes, b_sizes = found["a_sizes"].astype(np.int64), found["b_sizes"].astype(np.int64)
    a_ends, b_ends = np.cumsum(a_sizes), np.cumsum(b_sizes)
    a_count, b_count = len(aligner.a_spelling.sizes), len(aligner.b_spelling.sizes)
    a, b = found["a"].astype(np.int64), found["b"].astype(np.int64) + 2 * a_count
    a[a_ends - 1] += a_count
    b[b_ends - 1] += b_count
    # a group's ids of A stand behind all earlier groups, those of B behind them
    codes = np.empty(len(a) + len(b), dtype=np.int64)
    codes[np.arange(len(a)) + np.repeat(b_ends - b_sizes, a_sizes)] = a
    codes[np.arange(len(b)) + np.repeat(a_ends, b_sizes)] = b
    data = aligner.id_texts.bytes_of(codes)
    sizes = np.concatenate(([0], np.cumsum(aligner.id_texts.sizes[codes])))
    ends = sizes[found["a_bounds"] + found["b_bounds"]]
    return pa.array([data[i : max(i, j - 1)].decode() for i, j in zip(ends[:-1], ends[1:])], pa.string())


def _groups(found: dict[str, np.ndarray]) -> pa.Array:
    """Groups of each text as arrays of ids."""
    sides = [
        _ragged(pa.array(found[name]), np.concatenate(([0], np.cumsum(found[f"{name}_sizes"], dtype=np.int64))))
        for name in "ab"
    ]
    fields = [pa.field(name, side.type, False) for name, side in zip("ab", sides, strict=True)]
    return _ragged(pa.StructArray.from_arrays(sides, fields=fields), found["a_sizes_bounds"])


def _links(found: dict[str, np.ndarray], b_size: int) -> pa.Array:
    """Distinct links of each text."""
    bounds = found["a_sizes_bounds"]
    a_ends = np.cumsum(found["a_sizes"], dtype=np.int64)
    b_ends = np.cumsum(found["b_sizes"], dtype=np.int64)
    # a group ends where both of its last tokens do: that is its link
    a, b = found["a"][a_ends - 1].astype(np.int64), found["b"][b_ends - 1].astype(np.int64)
    pair, n = a * b_size + b, len(bounds) - 1
    values, counts, sizes = [], [], np.zeros(n, dtype=np.int64)
    for k in range(n):
        value, count = np.unique(pair[bounds[k] : bounds[k + 1]], return_counts=True)
        values.append(value)
        counts.append(count)
        sizes[k] = len(value)
    value = np.concatenate([np.zeros(0, np.int64), *values])
    count = np.concatenate([np.zeros(0, np.int64), *counts])
    columns = [pa.array(x.astype(np.int32)) for x in (value // b_size, value % b_size, count)]
    struct = pa.StructArray.from_arrays(columns, fields=[pa.field(c, pa.int32(), False) for c in "abn"])
    return _ragged(struct, np.concatenate(([0], np.cumsum(sizes))))


def _job(mark: str, files, as_text: bool):
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(mark, files)
        b_size = len(aligner.b_spelling.sizes)
        for batch in batches:
            rows = batch.column("row")
            for first, texts in _slices(batch.column("text")):
                found = aligner.align(texts)
                sizes = [np.diff(found[f"{name}_bounds"]) for name in ("a", "b", "a_sizes")]
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.slice(first, len(texts)),
                        *[pa.array(x.astype(np.int64)) for x in sizes],
                        _texts(found, aligner) if as_text else _groups(found),
                        _links(found, b_size),
                    ],
                    ["row", "n_a", "n_b", "n_groups", "groups", "links"],
                )

    return job


def read_file(spark: SparkSession, path: str) -> bytes:
    """Read on the driver, from any file system that Spark reads; a vocabulary has a fixed size."""
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])


ADDED = ("n_a", "n_b", "n_groups", "groups", "links")


def align_tokens(
    docs: DataFrame, a_path: str, b_path: str, text: str = "text", as_text: bool = False
) -> DataFrame:
    """The tokens of both tokenizers of each text, cut into groups where tokens of both end.

    A, a byte-level BPE, encodes a space and the text; B encodes the text, and adds the space itself.
    There are no special tokens; their strings in a text are plain text. Where neither tokenizer has
    tokens across a single space, texts are cut there, and equal chunks are aligned once.

    Adds n_a, n_b, n_groups (long), groups (array of the ids a and b of each group, in order; with
    `as_text` the same as a string, a1,a2|b1;a3|b2,b3, which is made faster) and links (array of a, b, n: how often a token of A ends where one of B does, by their ids); input
    columns of these names give way, and the text is left out. A null or empty text has no tokens, and neither has one whose
    tokens' bytes, of A or of B, do not make the space and the text again. Repeated rows get equal
    results. No documents give no rows.
    """
    spark = docs.sparkSession
    contents = read_file(spark, a_path).decode(), read_file(spark, b_path)
    files = spark.sparkContext.broadcast(contents)
    mark = hashlib.sha256(b"\0".join((contents[0].encode(), contents[1]))).hexdigest()
    others = [c for c in docs.columns if c.lower() not in (*ADDED, text.lower())]
    packed = docs.select(
        F.struct(F.lit(0).alias("_"), *[docs[f"`{c}`"] for c in others]).alias("row"), docs[text].alias("text")
    )
    schema = T.StructType([packed.schema["row"]])
    for name in ADDED[:3]:
        schema = schema.add(name, "long")
    schema = schema.add("groups", "string" if as_text else GROUPS).add("links", LINKS)
    out = packed.mapInArrow(_job(mark, files, as_text), schema)
    return out.select(*[F.col("row").getField(c).alias(c) for c in others], *ADDED)


def pair_counts(links: DataFrame, scratch: Scratch) -> DataFrame:
    """a, b, n, best: links of each id pair in all rows, and whether no pair with that b has more.

    There are at most as many pairs as A has ids times those of B, however many texts there are.
    """
    each = links.select(F.inline("links"))
    pairs = scratch.write(each.groupBy("a", "b").agg(F.sum("n").alias("n")), "pairs")
    tops = pairs.groupBy("b").agg(F.max("n").alias("top"))
    # one row for each id of B: bounded by its vocabulary
    best = pairs.join(F.broadcast(tops), "b").withColumn("best", F.col("n") == F.col("top"))
    return scratch.write(best.select("a", "b", "n", "best"), "best")


def link_figures(rows: DataFrame, pairs: DataFrame, frequent: int = FREQUENT_PAIRS) -> DataFrame:
    """key, n_best, count_sum of the links of each row, for rows with any. rows: key, links.

    Pairs that make up at least 1 / `frequent` of all links are at most `frequent`: they are broadcast.
    The links of all other pairs, none of which is a hot key then, are shuffled.
    """
    total = pairs.agg(F.sum("n")).first()[0] or 0
    often = F.col("n") * frequent >= total
    each = rows.select("key", F.inline("links")).withColumnRenamed("n", "times")
    hot = F.broadcast(pairs.where(often))
    by_hot = each.join(hot, ["a", "b"])
    rest = each.join(F.broadcast(pairs.where(often).select("a", "b")), ["a", "b"], "left_anti")
    by_rest = rest.join(pairs.where(~often), ["a", "b"])
    found = by_hot.unionByName(by_rest).select(
        "key", F.when(F.col("best"), F.col("times")).otherwise(0).alias("n_best"), (F.col("times") * F.col("n")).alias("sum")
    )
    return found.groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("sum").alias("count_sum"))


def link_digest(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per row of docs (doc_id, text): figures of its alignment and of its links in the whole table.

    doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair's count is the highest of their id
    of B, ties included), count_sum (of the pairs' counts over links), groups_sha256 ('' without
    tokens). See `align_tokens` for what nulls and odd texts give.
    """
    scratch = Scratch(docs.sparkSession, "token-alignment")
    aligned = align_tokens(docs.select("doc_id", "text"), a_path, b_path, as_text=True)
    sha = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    rows = scratch.write(
        aligned.select(
            F.monotonically_increasing_id().alias("key"), "doc_id", "n_a", "n_b", "n_groups",
            F.aggregate("links", F.lit(0).cast("long"), lambda s, x: s + x["n"]).alias("n_links"),
            sha.alias("groups_sha256"), "links",
        ),
        "rows",
    )
    figures = link_figures(rows.select("key", "links"), pair_counts(rows.select("links"), scratch))
    # one row of figures meets each row: by grouping their union
    own = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    both = rows.select("key", *own).unionByName(figures, allowMissingColumns=True)
    firsts = [F.max(c).alias(c) for c in own]
    sums_ = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
    out = both.groupBy("key").agg(*firsts, *sums_)
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
