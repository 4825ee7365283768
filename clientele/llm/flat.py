"""Texts of an Arrow batch as one flat byte array, cut into hashed words, lines and shingles.

All steps are vectorised over a batch. Words are hashed by differences of one running sum of
code * base^position, so a word's hash does not depend on where it stands.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes hashed at once; a longer single word is hashed in one go.
STRIDE = 1 << 20
#: Bytes of text handled at once; a longer single document is handled alone.
PIECE = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_CODES = np.random.Generator(np.random.PCG64(20240217)).integers(
    1, 2**64 - 1, 256, dtype=np.uint64, endpoint=True
)

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the base and of its inverse, grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, STRIDE + 1)
            steps = np.ones(size, dtype=np.uint64)
            steps[1:] = _BASE
            up = np.multiply.accumulate(steps)
            steps[1:] = _INVERSE
            down = np.multiply.accumulate(steps)
            if n > 4 * STRIDE:  # a giant word; do not hold on to its powers
                return up, down
            self.up, self.down = up, down
        return self.up, self.down


_POWERS = _Powers()


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and their n + 1 offsets; a null is an empty text."""
    column = pc.fill_null(column, pa.scalar("", column.type))
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    kind = np.int64 if wide else np.int32
    ends = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    ends = ends.astype(np.int64)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def pieces(column: pa.Array, limit: int = PIECE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of whole texts with at most `limit` bytes, or one text."""
    data, offsets = flat(column)
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of True bytes; a run ends with its text."""
    n = len(inside)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begins = np.zeros(n + 1, dtype=bool)
    begins[offsets] = True  # the place after the last byte, too
    first = inside.copy()
    first[1:] &= ~inside[:-1] | begins[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | begins[1:n]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def text_of(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The index of the text that each place lies in."""
    return np.searchsorted(offsets, starts, side="right") - 1


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans, which are in order and do not overlap."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        j = int(np.searchsorted(ends, starts[i] + STRIDE, side="right"))
        j = max(j, i + 1)
        at = starts[i]
        part = data[at : ends[j - 1]]
        up, down = _POWERS.upto(len(part) + 1)
        run = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(_CODES[part] * up[: len(part)], out=run[1:])
        s, e = starts[i:j] - at, ends[i:j] - at
        value = (run[e] - run[s]) * down[s]
        out[i:j] = mix(value + (e - s).astype(np.uint64) * _BASE)
        i = j
    return out


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Hash, text index, start and end of every word (a run without ASCII white space)."""
    starts, ends = spans(~SPACE[data], offsets)
    return hashes(data, starts, ends), text_of(starts, offsets), starts, ends


def windows(word: np.ndarray, text: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of every `width` consecutive words of one text."""
    n = len(word) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    value = np.full(n, width, dtype=np.uint64)
    for k in range(width):
        value = mix(value * _BASE + word[k : k + n])
    at = np.flatnonzero(text[:n] == text[width - 1 :])
    return value[at], at


def shingle_sets(
    data: np.ndarray, offsets: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: number of words; sorted distinct shingle hashes, flat, with their n + 1 offsets.

    A text of fewer than `width` words has its whole word sequence as its one shingle, none without
    words.
    """
    n = len(offsets) - 1
    word, text, _, _ = words(data, offsets)
    count = np.bincount(text, minlength=n)
    value, at = windows(word, text, width)
    owner = text[at]
    first = np.concatenate(([0], np.cumsum(count)))
    for k in range(1, width):
        short = np.flatnonzero(count == k)
        if len(short):
            one = np.full(len(short), k, dtype=np.uint64)
            for step in range(k):
                one = mix(one * _BASE + word[first[short] + step])
            value, owner = np.concatenate((value, one)), np.concatenate((owner, short))
    order = np.argsort(owner, kind="stable")
    value, owner = value[order], owner[order]
    bounds = np.searchsorted(owner, np.arange(n + 1))
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        value[a:b].sort()
    fresh = np.ones(len(value), dtype=bool)
    fresh[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return count, value[fresh], np.searchsorted(owner[fresh], np.arange(n + 1))


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values[bounds[i]:bounds[i + 1]]."""
    run = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return run[bounds[1:]] - run[bounds[:-1]]
