"""SentencePiece encoding and decoding with the pieces and scores of a model file.

An Aho-Corasick automaton over the pieces reads a text once. At each position its output links give
all pieces that end there, longest first; each relaxes the best score of the position (Viterbi).
"""

from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.llm import flat

MARK = "▁"  # stands for a space in pieces
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: An unknown character scores so much less than the worst piece.
UNKNOWN_PENALTY = 10.0
#: Distinct chunks of text kept encoded in a task.
MEMORY = 300_000
SPACE = 32


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(tag & 7) or varint()
        yield tag >> 3, data[at : at + size]
        at += size


@dataclass
class Model:
    """Pieces, scores and kinds by id, and how texts are prepared."""

    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    kinds: list[int] = field(default_factory=list)
    dummy_prefix: bool = True

    @staticmethod
    def parse(data: bytes) -> "Model":
        model, squeeze, rules = Model(), True, b""
        for number, value in _fields(data):
            if number == 1:
                parts = {1: b"", 2: b"\0\0\0\0", 3: NORMAL} | dict(_fields(value))
                model.pieces.append(parts[1].decode())
                model.scores.append(float(np.frombuffer(parts[2], "<f4")[0]))
                model.kinds.append(parts[3])
            elif number == 3:
                spec = dict(_fields(value))
                rules = spec.get(2, b"")
                model.dummy_prefix = bool(spec.get(3, 1))
                squeeze = bool(spec.get(4, 1))
        if rules or squeeze:
            raise ValueError("only models that leave texts as they are, spaces included, are supported")
        return model


def load_model(spark: SparkSession, path: str) -> Model:
    """Read on the driver, from any file system that Spark reads; a vocabulary has a fixed size."""
    content = spark.read.format("binaryFile").load(path).select("content").first()[0]
    return Model.parse(bytes(content))


class Codec:
    """The automaton and the tables for decoding; one for each task."""

    def __init__(self, model: Model):
        self.model = model
        usable = [i for i, kind in enumerate(model.kinds) if kind in (NORMAL, USER) and model.pieces[i]]
        self.automaton = ahocorasick.Automaton()
        for i in usable:
            self.automaton.add_word(model.pieces[i], (len(model.pieces[i]), model.scores[i], i))
        if usable:
            self.automaton.make_automaton()
        self.singles = {model.pieces[i] for i in usable if len(model.pieces[i]) == 1}
        worst = min((model.scores[i] for i in usable), default=0.0)
        self.unknown_score = worst - UNKNOWN_PENALTY
        self.unknown = model.kinds.index(UNKNOWN) if UNKNOWN in model.kinds else 0
        byte = {int(model.pieces[i][3:-1], 16): i for i, k in enumerate(model.kinds) if k == BYTE}
        self.byte_ids = [byte[b] for b in range(256)] if len(byte) == 256 else None
        # no piece goes on after a space: chunks that start at spaces can be encoded one by one
        self.splits = not any(MARK in model.pieces[i].lstrip(MARK) for i in usable)
        raw = [self._bytes_of(i) for i in range(len(model.pieces))]
        self.piece_bytes = np.frombuffer(b"".join(raw), np.uint8)
        self.piece_bounds = np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64)
        self.cache: dict[bytes, int] = {}
        self._reset()

    def _bytes_of(self, i: int) -> bytes:
        kind, piece = self.model.kinds[i], self.model.pieces[i]
        if kind == BYTE:
            return bytes([int(piece[3:-1], 16)])
        if kind == CONTROL:
            return b""
        return b" \xe2\x81\x87 " if kind == UNKNOWN else piece.replace(MARK, " ").encode()

    def viterbi(self, text: str) -> list[int]:
        """Ids of the best segmentation of a text in which spaces are marks already.

        Of equal scores the piece that starts first wins.
        """
        n, unknown, singles = len(text), self.unknown_score, self.singles
        best = [0.0] + [-np.inf] * n
        size, ids = [0] * (n + 1), [-1] * (n + 1)
        done = 0  # positions up to here are final

        def settle(upto: int) -> None:
            nonlocal done
            while done < upto:
                done += 1
                if text[done - 1] not in singles and best[done - 1] + unknown > best[done]:
                    best[done], size[done], ids[done] = best[done - 1] + unknown, 1, -1

        for end, (length, score, i) in self.automaton.iter(text) if len(self.automaton) else ():
            if done < end:
                settle(end)
            value = best[end + 1 - length] + score
            if value > best[end + 1]:
                best[end + 1], size[end + 1], ids[end + 1] = value, length, i
        settle(n)
        out: list[int] = []
        at = n
        while at > 0:
            if ids[at] >= 0:
                out.append(ids[at])
            elif self.byte_ids:
                out.extend(self.byte_ids[b] for b in reversed(text[at - 1].encode()))
            else:
                out.append(self.unknown)
            at -= size[at]
        return out[::-1]

    def _reset(self) -> None:
        self.cache.clear()
        self.token_parts: list[np.ndarray] = []
        self.ends: list[int] = [0]

    def _encoded(self, chunks: list[bytes]) -> np.ndarray:
        """The number of each chunk among those kept encoded."""
        cache = self.cache
        for chunk in set(chunks):
            if chunk not in cache:
                ids = self.viterbi(chunk.decode("utf-8", "replace").replace(" ", MARK))
                cache[chunk] = len(self.ends) - 1
                self.token_parts.append(np.array(ids, dtype=np.int32))
                self.ends.append(self.ends[-1] + len(ids))
        return np.fromiter(map(cache.__getitem__, chunks), np.int64, len(chunks))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of flat texts, and their n + 1 offsets."""
        starts, ends = self._chunks(data, offsets)
        owner = flat.text_of(starts, offsets)
        raw = data.tobytes()
        chunks = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        if self.model.dummy_prefix:
            for k in np.flatnonzero(starts == offsets[owner]).tolist():
                chunks[k] = b" " + chunks[k]
        if len(self.cache) > MEMORY:
            self._reset()
        number = self._encoded(chunks)
        bounds = np.array(self.ends, dtype=np.int64)
        tokens = np.concatenate([np.zeros(0, np.int32), *self.token_parts])
        if len(self.token_parts) > 1:
            self.token_parts = [tokens]
        out, sizes = gather(tokens, bounds, number)
        per_text = np.bincount(owner, weights=sizes, minlength=len(offsets) - 1).astype(np.int64)
        return out, np.concatenate(([0], np.cumsum(per_text)))

    def _chunks(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Spans that cover all texts: cut where spaces begin, or whole texts."""
        first = np.zeros(len(data) + 1, dtype=bool)
        first[offsets] = True
        if self.splits and len(data):
            space = data == SPACE
            # the mark itself in a text stands for a space, too
            space[2:] |= (data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81)
            first[1:-1] |= (data[1:] == SPACE) & ~space[:-1]
        at = np.flatnonzero(first)
        return at[:-1], at[1:]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the texts of token ids, and their offsets; the prefix put in front is cut off."""
        data, sizes = gather(self.piece_bytes, self.piece_bounds, ids.astype(np.int64))
        run = np.concatenate(([0], np.cumsum(sizes)))
        offsets = run[bounds]
        if not self.model.dummy_prefix or not len(data):
            return data, offsets
        filled = offsets[1:] > offsets[:-1]
        cut = offsets[:-1][filled]
        cut = cut[data[cut] == SPACE]
        kept = np.ones(len(data), dtype=bool)
        kept[cut] = False
        return data[kept], np.concatenate(([0], np.cumsum(kept)))[offsets]


def gather(values: np.ndarray, bounds: np.ndarray, which: np.ndarray):
    """values[bounds[i]:bounds[i + 1]] for each i of `which`, joined; and their lengths."""
    sizes = bounds[which + 1] - bounds[which]
    run = np.cumsum(sizes)
    total = int(run[-1]) if len(run) else 0
    shift = bounds[which] - (run - sizes)
    return values[np.arange(total) + np.repeat(shift, sizes)], sizes


def _encode_job(model):
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(model.value)
        byte_id = np.zeros(len(codec.model.pieces) + 1, dtype=bool)
        byte_id[[i for i, kind in enumerate(codec.model.kinds) if kind == BYTE]] = True
        for batch in batches:
            texts = batch.column("text")
            rest = batch.drop_columns(["text"])
            for i, data, offsets in flat.pieces(texts):
                n = len(offsets) - 1
                ids, bounds = codec.encode(data, offsets)
                back, back_offsets = codec.decode(ids, bounds)
                same = np.diff(back_offsets) == np.diff(offsets)
                if same.all():  # else texts are compared one by one
                    wrong = np.concatenate(([0], np.cumsum(back != data)))
                    same = wrong[offsets[1:]] == wrong[offsets[:-1]]
                else:
                    for k in np.flatnonzero(same):
                        a, b = offsets[k], back_offsets[k]
                        size = offsets[k + 1] - a
                        same[k] = (data[a : a + size] == back[b : b + size]).all()
                known = np.asarray(texts.slice(i, n).is_valid())
                lists = pa.ListArray.from_arrays(
                    pa.array(bounds.astype(np.int32)), pa.array(ids), mask=pa.array(~known)
                )
                spelled = np.concatenate(([0], np.cumsum(byte_id[ids])))
                own = rest.slice(i, n)
                arrays = [
                    *own.columns,
                    lists,
                    pa.array(np.diff(bounds)),
                    pa.array(spelled[bounds[1:]] - spelled[bounds[:-1]]),
                    pa.array(same),
                ]
                names = [*own.schema.names, "token_ids", "n_tokens", "n_byte_tokens", "round_trip"]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return job


def encode_pieces(docs: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """Token ids of each text, by the best sum of piece scores.

    A space is the mark U+2581 (which a text may not be told from, so such a text makes no round
    trip), and one is put in front of a text that is not empty. Of equal scores
    the piece that starts first wins. A character that no piece covers scores 10 below the worst piece
    and becomes the pieces of its UTF-8 bytes (or the unknown piece where the model has none). Where
    no piece goes on after a space, texts are cut before spaces, and equal chunks are encoded once.

    Adds token_ids (array<int>), n_tokens, n_byte_tokens (long) and round_trip (boolean: decoding
    gives the text again, bit by bit); input columns of these names give way. A null text has null
    ids and no tokens, an empty text no tokens; both make the round trip. Repeated rows get equal
    results. No documents give no rows.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(load_model(spark, model_path))
    names = ("token_ids", "n_tokens", "n_byte_tokens", "round_trip")
    others = [c for c in docs.columns if c.lower() not in names]
    packed = docs.select(
        F.struct(*[docs[c] for c in others]).alias("row"), docs[text].alias("text")
    )
    schema = packed.drop("text").schema.add("token_ids", T.ArrayType(T.IntegerType())).add("n_tokens", "long")
    schema = schema.add("n_byte_tokens", "long").add("round_trip", "boolean")
    out = packed.mapInArrow(_encode_job(model), schema)
    return out.select(*[F.col("row").getField(c).alias(c) for c in others], *names)


def _decode_job(model):
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(model.value)
        for batch in batches:
            lists = batch.column("ids")
            sizes = np.asarray(lists.value_lengths().fill_null(0), dtype=np.int64)
            ids = np.asarray(lists.flatten(), dtype=np.int64)
            data, offsets = codec.decode(ids, np.concatenate(([0], np.cumsum(sizes))))
            raw = data.tobytes()
            texts = [
                raw[a:b].decode("utf-8", "replace") if known else None
                for a, b, known in zip(offsets[:-1], offsets[1:], lists.is_valid().tolist(), strict=True)
            ]
            own = batch.drop_columns(["ids"])
            yield pa.RecordBatch.from_arrays(
                [*own.columns, pa.array(texts, pa.string())], [*own.schema.names, "decoded"]
            )

    return job


def decode_pieces(encoded: DataFrame, model_path: str, ids: str = "token_ids") -> DataFrame:
    """Adds `decoded`: the text of the token ids; null for null. An input column of that name gives way.

    Ids must not hold nulls. Control pieces have no text; bytes that are no UTF-8 become U+FFFD.
    """
    spark = encoded.sparkSession
    model = spark.sparkContext.broadcast(load_model(spark, model_path))
    others = [c for c in encoded.columns if c.lower() != "decoded"]
    packed = encoded.select(
        F.struct(*[encoded[c] for c in others]).alias("row"), encoded[ids].alias("ids")
    )
    out = packed.mapInArrow(_decode_job(model), packed.drop("ids").schema.add("decoded", "string"))
    return out.select(*[F.col("row").getField(c).alias(c) for c in others], "decoded")
