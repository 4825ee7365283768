"""Sort keys of vectors: concatenated bits of random projections, each cut where the rows at hand lie.

A bit says on which side of a cut a vector's projection on a random direction lies. Signs alone would
leave vectors that share a direction in one long run of equal bits. So the cuts are fitted on the rows:
the first bits form a tree, in which each cut lies in the middle of the rows that share the bits before;
the later bits are signs about the mean of the rows at the leaf. `Growth` makes a tree level by level from
sums over all rows of a table, which Spark adds up, with means as cuts; `fit` makes trees with medians from
rows in memory.
"""

from dataclasses import dataclass

import numpy as np

#: Bits of a key.
BITS = 48
#: Rows that a cut is fitted on at least.
LEAST = 24
#: A leaf has at least one of so many parts of all rows, which bounds the trees, not the rows they are made of.
MOST_LEAVES = 800
#: Passes of random directions with which hits are estimated, and passes at most.
TRIALS, MOST_PASSES = 8, 96


def directions(seed: int, number: int, size: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64([seed, number])).standard_normal((BITS, size))


@dataclass
class Tree:
    """The cuts of one pass. Node 0 is the root; `below[n]` is the node for bit 0, the next one for bit 1,
    or 0 at a leaf. `cuts[n, k]`: where bit k of node n is cut; a node within the tree has its own bit
    only, a leaf all later ones. rows, first, depth, if known: by leaf its rows, those before it, and its
    bits."""

    below: np.ndarray
    cuts: np.ndarray
    rows: np.ndarray | None = None
    first: np.ndarray | None = None
    depth: np.ndarray | None = None

    @staticmethod
    def fit(projected: np.ndarray) -> "Tree":
        """projected: the sample's rows on the pass's directions."""
        below: list[int] = []
        cuts: list[np.ndarray] = []
        todo = [(np.arange(len(projected)), 0)]
        while todo:
            following = []
            for rows, k in todo:
                own = projected[rows]
                cut = own.mean(axis=0) if len(rows) else np.zeros(BITS)
                if k < BITS and len(rows) >= 2 * LEAST:
                    cut[k] = np.median(own[:, k])
                    high = own[:, k] > cut[k]
                    if high.any() and not high.all():
                        cuts.append(cut)
                        below.append(-1)
                        following += [(rows[~high], k + 1), (rows[high], k + 1)]
                        continue
                cuts.append(cut)
                below.append(0)
            # children stand in the order of their parents
            at = len(below)
            for n in range(len(below) - len(todo), len(below)):
                if below[n] < 0:
                    below[n] = at
                    at += 2
            todo = following
        return Tree(np.array(below, dtype=np.int32), np.array(cuts, dtype=np.float32))

    def keys(self, projected: np.ndarray) -> np.ndarray:
        node = np.zeros(len(projected), dtype=np.int32)
        out = np.zeros(len(projected), dtype=np.int64)
        for k in range(BITS):
            bit = projected[:, k] > self.cuts[node, k]
            out = (out << 1) | bit
            below = self.below[node]
            node = np.where(below > 0, below + bit, node)
        return out

    def leaves(self, projected: np.ndarray) -> np.ndarray:
        node = np.zeros(len(projected), dtype=np.int32)
        for k in range(BITS):
            below = self.below[node]
            if not below.any():
                break
            node = np.where(below > 0, below + (projected[:, k] > self.cuts[node, k]), node)
        return node

    def places(self, projected: np.ndarray) -> np.ndarray:
        """Places in the order of keys: the rows before the leaf are counted, each later bit halves the leaf's."""
        node = self.leaves(projected)
        free = BITS - self.depth[node].astype(np.int64)
        within = (self.keys(projected) & ((1 << free) - 1)) / 2.0**free
        return self.first[node] + self.rows[node] * within


class Growth:
    """A tree on its way, level by level. `start`: the first node of the last level, whose rows are asked for."""

    def __init__(self):
        self.start = 0
        self._below, self._depth, self._rows, self._path, self._above = [0], [0], [0.0], [0], [-1]
        self._cuts = [np.zeros(BITS)]

    def done(self) -> bool:
        return self.start >= len(self._below)

    def take(self, found: dict[int, tuple[float, np.ndarray]], least: float) -> None:
        """found: rows, and sums of their projections, by node of the last level; empty nodes are absent."""
        for node in range(self.start, len(self._below)):
            n, sums = found.get(node, (0.0, None))
            self._rows[node] = n
            if n:
                self._cuts[node] = sums / n
            above = self._above[node]
            parted = above < 0 or n < self._rows[above]  # else rows that nothing parts
            if self._depth[node] < BITS and n >= 2 * least and parted:
                self._below[node] = len(self._below)
                for bit in (0, 1):
                    self._below.append(0)
                    self._depth.append(self._depth[node] + 1)
                    self._rows.append(0.0)
                    self._path.append(2 * self._path[node] + bit)
                    self._above.append(node)
                    self._cuts.append(self._cuts[node])
            self._last = node
        self.start = self._last + 1

    def tree(self) -> Tree:
        below, depth = np.array(self._below, dtype=np.int32), np.array(self._depth)
        rows = np.where(below > 0, 0.0, self._rows)
        order = sorted(range(len(below)), key=lambda n: (self._path[n] << (BITS - self._depth[n]), depth[n]))
        first = np.empty(len(below))
        first[order] = np.cumsum(rows[order]) - rows[order]
        return Tree(below, np.array(self._cuts, dtype=np.float32), rows, first, depth)


@dataclass
class Hashes:
    """Trees by length of vector, label and pass; labels with few rows have common ones."""

    seed: int
    passes: int
    trees: dict[tuple[int, int | None], list[Tree]]

    def groups(self, size: int, labels: np.ndarray) -> list[tuple[tuple[int, int | None], np.ndarray]]:
        """The rows of each tree, for vectors of one length; rows without a tree are left out."""
        own = np.array([(size, int(label)) in self.trees for label in labels], dtype=bool)
        out = [((size, int(n)), np.flatnonzero(labels == n)) for n in np.unique(labels[own])]
        if (size, None) in self.trees and not own.all():
            out.append(((size, None), np.flatnonzero(~own)))
        return out

    def keys(self, vectors: np.ndarray, labels: np.ndarray, number: int) -> np.ndarray:
        """Keys of unit vectors of one length in a pass."""
        size = vectors.shape[1]
        projected = (vectors @ directions(self.seed, number, size).T).astype(np.float32)
        out = np.zeros(len(vectors), dtype=np.int64)
        own = np.array([(size, int(label)) in self.trees for label in labels], dtype=bool)
        for label in np.unique(labels[own]):
            rows = np.flatnonzero(labels == label)
            out[rows] = self.trees[size, int(label)][number].keys(projected[rows])
        rest = np.flatnonzero(~own)
        if len(rest):
            common = self.trees.get((size, None))
            tree = common[number] if common else Tree(np.zeros(1, np.int32), np.zeros((1, BITS), np.float32))
            out[rest] = tree.keys(projected[rest])
        return out


def partners(vectors: np.ndarray, threshold: float, seed: int) -> np.ndarray:
    """For each unit vector another one, in a random direction, whose cosine with it is the threshold."""
    noise = np.random.Generator(np.random.PCG64([seed, 1 << 20])).standard_normal(vectors.shape)
    noise -= (noise * vectors).sum(axis=1, keepdims=True) * vectors
    length = np.linalg.norm(noise, axis=1, keepdims=True)
    noise /= np.where(length > 0, length, 1)
    return threshold * vectors + np.sqrt(max(0.0, 1 - threshold * threshold)) * noise


def hit_shares(
    sample: np.ndarray, rows: float, window: int, threshold: float, seed: int
) -> np.ndarray:
    """For each vector of a label's sample, the share of passes in which a partner comes within the window.

    The rows between a pair are counted in the sample where that is dense enough. Elsewhere they are half
    of the run that shares the bits in which the pair agrees, as both go on alike after the bit that
    parts them; each bit halves a run.
    """
    other = partners(sample, threshold, seed)
    hits = np.zeros(len(sample))
    scale = rows / len(sample)
    for number in range(TRIALS):
        planes = directions(seed, MOST_PASSES + number, sample.shape[1]).T
        projected = (sample @ planes).astype(np.float32)
        tree = Tree.fit(projected)
        mine, theirs = tree.keys(projected), tree.keys((other @ planes).astype(np.float32))
        apart = mine ^ theirs
        agreed = BITS - np.ceil(np.log2(apart.astype(np.float64) + 1)).astype(np.int64)
        ordered = np.sort(mine)
        between = np.abs(np.searchsorted(ordered, theirs) - np.searchsorted(ordered, mine)) * scale
        apart_by = between if 8 * scale <= window else np.maximum(between, rows * 2.0 ** -(agreed + 1))
        hits += apart_by <= window
    return hits / TRIALS


def passes_for(hits: np.ndarray, weights: np.ndarray, missed: float) -> tuple[int, float]:
    """Passes after which the share of pairs missed is at most `missed`, and the share expected.

    hits: by vector, the share of passes that find a pair at the threshold; weights: rows it stands for.
    """
    if not len(hits):
        return 1, 0.0
    weights = weights / weights.sum()
    for passes in range(1, MOST_PASSES + 1):
        left = float((weights * (1 - hits) ** passes).sum())
        if left <= missed:
            break
    return passes, left


def fit(
    vectors: np.ndarray,
    labels: np.ndarray,
    rows_of: dict[tuple[int, int], float],
    window: int,
    threshold: float,
    missed: float,
    seed: int,
) -> tuple[Hashes, float]:
    """Trees and number of passes from a sample of unit vectors of one length; and the share missed.

    rows_of: rows of each (length, label) in the whole table, as far as known.
    """
    size = vectors.shape[1]
    parts = {None: np.arange(len(vectors))}
    for label, n in zip(*np.unique(labels, return_counts=True)):
        if n >= 2 * LEAST:
            parts[int(label)] = np.flatnonzero(labels == label)
    hits, weights = [np.zeros(0)], [np.zeros(0)]
    for label, own in parts.items():
        if label is not None:
            rows = max(rows_of.get((size, label), 0.0), float(len(own)))
            hits.append(hit_shares(vectors[own], rows, window, threshold, seed))
            weights.append(np.full(len(own), rows / len(own)))
    passes, left = passes_for(np.concatenate(hits), np.concatenate(weights), missed)
    trees: dict[tuple[int, int | None], list[Tree]] = {(size, label): [] for label in parts}
    for number in range(passes):
        projected = (vectors @ directions(seed, number, size).T).astype(np.float32)
        for label, own in parts.items():
            trees[size, label].append(Tree.fit(projected[own]))
    return Hashes(seed, passes, trees), left


def joined(parts: list[Hashes], seed: int) -> Hashes:
    """Hashes of several lengths as one: each has as many passes as the longest needs."""
    passes = max((h.passes for h in parts), default=1)
    trees = {key: own for h in parts for key, own in h.trees.items()}
    return Hashes(seed, passes, trees)
