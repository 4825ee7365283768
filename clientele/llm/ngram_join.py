"""Jaccard self-join on word shingles: a size-aware join with a light and a heavy side.

Sets up to a boundary are light: pairs of them are found by enumerating their subsets of the size
that their overlap must have, so that an equal subset is a link and nothing is compared. Pairs with
a set above the boundary are found by scanning inverted lists of the sets' rarest elements and
compared exactly. The boundary is the one of least cost for the sizes at hand.

Only components are asked for, so lists are not expanded into all pairs. First each set is compared
with the one set that it shares most lists with, then with ones of other components, as long as this
is cheaper than the rest; at last all pairs of a list that are still in different components, and
share enough of their prefixes, are compared. This loses no link between components.
"""

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm import flat
from clientele.llm.components import components
from clientele.llm.scratch import BROADCAST_BYTES, Scratch

#: Shingles of a task that are counted together to find those that repeat.
TALLY = 2 << 20
#: At most so many shingles are put last in the order; a bound on what each task is sent.
FREQUENT = 1 << 20
#: And only such as repeat 2 to this power times.
LEAST_FREQUENT = 3
#: Largest boundary considered; beyond it, subsets are too many by far.
MOST_LIGHT = 16
#: Cost of bringing one element of a set to a comparison, in rows of a list.
COMPARE_COST = 2

#: Sets in lists above this size are compared in blocks of so many, some elements at a time.
LONG, BLOCK, COLUMNS = 64, 512, 4096
#: Counts in a set's profile, by the first bits of its elements.
BUCKETS = 128
_SHIFT = np.uint64(57)

_SALT = np.uint64(0x5851F42D4C957F2D)


def overlap(n: int, m: int, percent: int) -> int:
    """Least intersection of linked sets of sizes n and m."""
    return -(-percent * (n + m) // (100 + percent))


def prefix(n, percent: int):
    """So many first elements of a set must meet those of any set that it links with."""
    return n + (-percent * n // 100) + 1


def least_power(numbers: dict[int, int]) -> int:
    """The least power of two from which on there are at most FREQUENT shingles.

    numbers: shingles by the power of two that their count reaches.
    """
    held, least = 0, max(numbers, default=LEAST_FREQUENT) + 1
    for power in sorted(numbers, reverse=True):
        held += numbers[power]
        if held > FREQUENT:
            break
        least = power
    return least


def light_keys(n: int, most: int, percent: int) -> list[tuple[int, int, int]]:
    """(smaller size, larger size, subset size) of the pairings of a set of n up to `most`."""
    as_small = [(n, m) for m in range(n, min(100 * n // percent, most) + 1)]
    as_large = [(m, n) for m in range(-(-percent * n // 100), n)]
    return [(a, b, overlap(a, b, percent)) for a, b in as_small + as_large]


def boundary(sizes: dict[int, int], percent: int) -> int:
    """The largest light size, of least cost. sizes: number of sets by size, of small sizes."""

    def heavy(n: int) -> int:
        return prefix(n, percent) + COMPARE_COST * n

    def cost(most: int) -> float:
        keys = sum(
            count * math.comb(n, c)
            for n, count in sizes.items()
            if n <= most
            for _, _, c in light_keys(n, most, percent)
        )
        least = -(-percent * (most + 1) // 100)
        return keys + sum(c * heavy(n) for n, c in sizes.items() if n >= least)

    return min(range(MOST_LIGHT + 1), key=cost)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _wrapped_sums(x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    run = np.concatenate((np.zeros(1, np.uint64), np.cumsum(x)))
    return run[bounds[1:]] - run[bounds[:-1]]


def _tally(parts: list[np.ndarray]) -> pa.RecordBatch:
    value, count = np.unique(np.concatenate(parts), return_counts=True)
    often = count >= 2
    hot = pa.array([value[often].view(np.int64)], pa.list_(pa.int64()))
    times = pa.array([count[often]], pa.list_(pa.int64()))
    none = pa.nulls(1, pa.int64())
    names = ["id", "n", "s1", "s2", "hot", "times"]
    return pa.RecordBatch.from_arrays([none, none, none, none, hot, times], names)


def _sets_job(width: int):
    """id, n and two hashes of the set; and rows of shingles that repeat in the task."""

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            ids = batch.column("id")
            for i, data, offsets in flat.pieces(batch.column("text")):
                _, value, bounds = flat.shingle_sets(flat.LOWER[data], offsets, width)
                n = len(offsets) - 1
                empty = pa.nulls(n, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(i, n),
                        pa.array(np.diff(bounds)),
                        _signed(_wrapped_sums(flat.mix(value), bounds)),
                        _signed(_wrapped_sums(flat.mix(value ^ _SALT), bounds)),
                        empty,
                        empty,
                    ],
                    ["id", "n", "s1", "s2", "hot", "times"],
                )
                parts.append(value)
                held += len(value)
                if held >= TALLY:
                    yield _tally(parts)
                    parts, held = [], 0
        if held:
            yield _tally(parts)

    return job


def _subset_sums(values: np.ndarray, size: int) -> list[int]:
    """A hash of each subset of so many elements."""
    mixed = [int(v) for v in flat.mix(values)]
    total, out = sum(mixed), len(mixed) - size
    return [(total - sum(left)) % (1 << 64) for left in itertools.combinations(mixed, out)]


def _postings_job(width: int, percent: int, most_light: int, frequent):
    """hash, node, n, kind: 0 in an inverted list; 1 and 2 for a subset of the smaller, larger set."""
    least_heavy = -(-percent * (most_light + 1) // 100)

    def light(value: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
        n = len(value)
        for a, b, size in light_keys(n, most_light, percent):
            keys = np.array(_subset_sums(value, size), dtype=np.uint64)
            yield flat.mix(keys + flat.mix(np.uint64([a * 4096 + b]))), 1 if n == a else 2

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, times = frequent.value
        for batch in batches:
            ids = np.asarray(batch.column("id"))
            for i, data, offsets in flat.pieces(batch.column("text")):
                _, value, bounds = flat.shingle_sets(flat.LOWER[data], offsets, width)
                weight = np.zeros(len(value), dtype=np.int64)
                if len(hot):
                    at = np.minimum(np.searchsorted(hot, value), len(hot) - 1)
                    weight = np.where(hot[at] == value, times[at], 0)
                some = np.concatenate(([0], np.cumsum(weight > 0)))
                out: list[tuple[np.ndarray, int, int, int]] = []
                for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                    n, node, own = int(b - a), ids[i + k], value[a:b]
                    if n >= max(least_heavy, 1):
                        if some[b] > some[a]:  # rare ones first; else the order is by hash
                            own = own[np.argsort(weight[a:b], kind="stable")]
                        out.append((own[: prefix(n, percent)], node, n, 0))
                    if 0 < n <= most_light:
                        out += [(keys, node, n, kind) for keys, kind in light(value[a:b])]
                if not out:
                    continue
                each = [len(x[0]) for x in out]
                columns = [np.repeat([x[c] for x in out], each) for c in (1, 2, 3)]
                yield pa.RecordBatch.from_arrays(
                    [
                        _signed(np.concatenate([x[0] for x in out])),
                        pa.array(columns[0].astype(np.int64)),
                        pa.array(columns[1].astype(np.int32)),
                        pa.array(columns[2].astype(np.int8)),
                    ],
                    ["hash", "node", "n", "kind"],
                )

    return job


def _profiles(value: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Per set, how many of its elements begin with each of BUCKETS patterns of bits."""
    n = len(bounds) - 1
    place = np.repeat(np.arange(n) * BUCKETS, np.diff(bounds))
    counts = np.bincount(place + (value >> _SHIFT).astype(np.int64), minlength=n * BUCKETS)
    raw = counts.astype("<u4").tobytes()
    return pa.FixedSizeBinaryArray.from_buffers(
        pa.binary(4 * BUCKETS), n, [None, pa.py_buffer(raw)]
    ).cast(pa.binary())


def _profile_job(percent: int):
    """Drops pairs whose profiles leave too little room for their intersection."""

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u4").reshape(-1, BUCKETS)
                for c in ("left", "right")
            )
            most = np.minimum(left, right).sum(axis=1, dtype=np.int64)
            sizes = left.sum(axis=1, dtype=np.int64) + right.sum(axis=1, dtype=np.int64)
            near = most >= -(-percent * sizes // (100 + percent))
            yield batch.select(["a", "b"]).filter(pa.array(near))

    return job


def _whole_sets_job(width: int):
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id")
            for i, data, offsets in flat.pieces(batch.column("text")):
                _, value, bounds = flat.shingle_sets(flat.LOWER[data], offsets, width)
                sets = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), _signed(value))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, len(offsets) - 1), _profiles(value, bounds), sets],
                    ["node", "profile", "own"],
                )

    return job


def _block_job(percent: int):
    """Pairs of sets of two chunks of a list that share enough of their prefixes."""

    def job(table: pa.Table) -> pa.Table:
        node, n = np.asarray(table.column("node")), np.asarray(table.column("n")).astype(np.int64)
        component, chunk = np.asarray(table.column("component")), np.asarray(table.column("chunk"))
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        lists = table.column("own").combine_chunks()
        _, element = np.unique(np.asarray(lists.flatten()), return_inverse=True)
        owner = np.repeat(np.arange(len(node)), np.asarray(lists.value_lengths()))
        often = np.bincount(element) > 1
        element, owner = (np.cumsum(often) - 1)[element[often[element]]], owner[often[element]]
        left, right = np.flatnonzero(chunk == low), np.flatnonzero(chunk == high)
        shared = np.zeros((len(left), len(right)), dtype=np.float32)
        for first in range(0, int(often.sum()), COLUMNS):
            here = (element >= first) & (element < first + COLUMNS)
            held = np.zeros((len(node), COLUMNS), dtype=np.float32)
            held[owner[here], element[here] - first] = 1
            shared += held[left] @ held[right].T
        a, b = n[left][:, None], n[right][None, :]
        needed = -(-percent * (a + b) // (100 + percent))
        outside = np.maximum(a - prefix(a, percent), b - prefix(b, percent))
        near = (shared > 0) & (shared + outside >= needed)
        near &= component[left][:, None] != component[right][None, :]
        if low == high:
            near &= node[left][:, None] < node[right][None, :]
        i, j = np.nonzero(near)
        i, j = left[i], right[j]
        # a pair comes out of the first of the long lists that it shares
        far, here = table.column("far").to_pylist(), table.column("hash")[0].as_py()
        sets = {k: set(far[k]) for k in {*i.tolist(), *j.tolist()}}
        first = [min(sets[x] & sets[y]) == here for x, y in zip(i.tolist(), j.tolist(), strict=True)]
        kept = np.array(first, dtype=bool)
        i, j = i[kept], j[kept]
        swap = node[i] > node[j]
        i, j = np.where(swap, j, i), np.where(swap, i, j)
        return pa.table({"a": node[i], "b": node[j]})

    return job


class _Join:
    """One run of the join: the texts of one document per class of equal sets, and its tables."""

    def __init__(self, texts: DataFrame, scratch: Scratch, width: int, percent: int, limit: int):
        self.texts, self.scratch, self.limit = texts, scratch, limit
        self.width, self.percent = width, percent

    def needed(self):
        """Least intersection for the columns n (of a) and m (of b)."""
        p = self.percent
        return F.expr(f"({p} * (n + m) + {99 + p}) div {100 + p}")

    def prefix_of(self, size: str):
        return F.expr(f"{size} - ({self.percent} * {size} + 99) div 100 + 1")

    def compared(self, pairs: DataFrame) -> DataFrame:
        """Of the pairs (a, b) those that may link, with the intersection of their sets; written.

        Pairs meet each other's profile first, which bounds the intersection from above; only the
        pairs that this leaves meet each other's whole set.
        """
        scratch = self.scratch
        pairs = scratch.write(pairs.select("a", "b"), "pairs")
        ends = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
        ends = scratch.write(ends, "ends")
        sets = self.texts.join(scratch.joinable(ends, self.limit), "id", "left_semi")
        schema = "node long, profile binary, own array<long>"
        sets = scratch.write(sets.mapInArrow(_whole_sets_job(self.width), schema), "sets")

        def met(rows: DataFrame, what: str) -> DataFrame:
            left = sets.select(F.col("node").alias("a"), F.col(what).alias("left"))
            right = sets.select(F.col("node").alias("b"), F.col(what).alias("right"))
            return rows.join(left, "a").join(right, "b")

        near = met(pairs, "profile").mapInArrow(_profile_job(self.percent), "a long, b long")
        near = scratch.write(near.distinct(), "near")
        # sizes from the sets: rows may share an id
        both = met(near, "own").select(
            "a", "b", F.size("left").alias("n"), F.size("right").alias("m"),
            F.size(F.array_intersect("left", "right")).alias("shared"),
        )
        found = scratch.write(both, "compared")
        scratch.drop(pairs, ends, sets, near)
        return found

    def links_of(self, compared: DataFrame) -> DataFrame:
        return compared.where(F.col("shared") >= self.needed()).select("a", "b")

    def star_pairs(self, lists: DataFrame, number: int) -> DataFrame:
        """For each set, one of another component: the one with which it shares most lists.

        A list and size class offers three sets: the one of which the largest share of its prefix is
        in lists, as the text that others were copied from has it, and the first and last in an order
        of components that changes by round.
        """
        size_class = F.floor(F.log(F.col("n")) / math.log(100 / self.percent))
        one = F.struct("component", "node", "n")
        mark = F.struct(F.xxhash64("component", F.lit(number)).alias("order"), one.alias("one"))
        middle = F.struct("share", F.xxhash64("node").alias("order"), one.alias("one"))
        lists = lists.withColumn("class", size_class)
        ends = lists.groupBy("hash", "class").agg(
            F.max(middle)["one"].alias("mid"),
            F.min(mark)["one"].alias("lo"),
            F.max(mark)["one"].alias("hi"),
        )
        ends = ends.where("lo.component <> hi.component")
        other = F.when(F.col("component") != F.col("mid.component"), F.col("mid"))
        other = other.when(F.col("component") != F.col("lo.component"), F.col("lo"))
        other = other.otherwise(F.col("hi"))
        offers = lists.join(ends, ["hash", "class"]).withColumn("other", other)
        counted = offers.groupBy(
            F.col("node").alias("a"), F.col("other.node").alias("b"), "n", F.col("other.n").alias("m")
        ).agg(F.count("*").alias("k"))
        # links share most of their prefixes; others are left to the last step
        counted = counted.where((8 * F.col("k") >= self.prefix_of("n")) & (F.col("a") != F.col("b")))
        best = counted.groupBy("a").agg(F.max(F.struct("k", "b", "n", "m")).alias("best"))
        return best.select("a", "best.b", "best.n", "best.m")

    def rest_pairs(self, lists: DataFrame) -> DataFrame:
        """All pairs of a list in different components that may link, by sizes and shared prefix.

        Short lists are joined with themselves. The sets of long lists are compared in pairs of
        blocks, each set with its whole prefix, and only pairs that may link come out.
        """
        p, scratch = self.percent, self.scratch
        sizes = lists.groupBy("hash").agg(F.count("*").alias("c"))
        sizes = scratch.write(sizes.where(F.col("c") > LONG), "long")
        long = scratch.joinable(sizes, self.limit)
        # one row of each set: its prefix, as far as lists are open, and how much of it is in long ones
        own = lists.join(long, "hash", "left").groupBy("node").agg(
            F.first("n").alias("n"),
            F.first("component").alias("component"),
            F.collect_set("hash").alias("own"),
            F.collect_set(F.when(F.col("c").isNotNull(), F.col("hash"))).alias("far"),
        )
        own = scratch.write(own.withColumn("long", F.size("far")), "prefixes")
        short = lists.join(long, "hash", "left_anti").join(own.select("node", "long"), "node")
        a = short.select(
            "hash", F.col("node").alias("a"), "n", F.col("component").alias("ca"), F.col("long").alias("la")
        )
        b = short.select(
            "hash", F.col("node").alias("b"), F.col("n").alias("m"),
            F.col("component").alias("cb"), F.col("long").alias("lb"),
        )
        fits = (F.col("m") * p <= F.col("n") * 100) & (F.col("n") * p <= F.col("m") * 100)
        met = a.join(b, "hash").where((F.col("ca") < F.col("cb")) & fits)
        met = met.groupBy("a", "b", "n", "m", "la", "lb").agg(F.count("*").alias("k"))
        # an element that both have, but not in both prefixes, is outside one of them
        outside = F.greatest(F.col("n") - self.prefix_of("n"), F.col("m") - self.prefix_of("m"))
        most = F.col("k") + F.least("la", "lb") + outside
        met = met.where(most >= self.needed()).select("a", "b")

        chunks = F.expr(f"(c + {BLOCK - 1}) div {BLOCK}")
        placed = lists.select("hash", "node").join(long, "hash")
        placed = placed.withColumn("chunk", F.pmod(F.xxhash64("node"), chunks))
        placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)))
        blocks = placed.select(
            "hash", "node", "chunk",
            F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"),
        ).join(own, "node")
        dense = blocks.groupBy("hash", "low", "high").applyInArrow(
            _block_job(p), "a long, b long"
        )
        return met.union(dense).distinct()

    def open_lists(self, lists: DataFrame, links: DataFrame) -> DataFrame:
        """The lists that still hold sets of different components."""
        known = components(links, self.scratch)
        marked = lists.drop("component").join(
            self.scratch.joinable(known, self.limit), "node", "left"
        )
        marked = marked.withColumn("component", F.coalesce("component", "node"))
        marked = self.scratch.write(marked, "marked")
        mixed = marked.groupBy("hash").agg(
            F.min("component").alias("lo"), F.max("component").alias("hi")
        )
        mixed = mixed.where("lo < hi").select("hash")
        mixed = self.scratch.write(mixed, "mixed")
        out = marked.join(self.scratch.joinable(mixed, self.limit), "hash", "left_semi")
        out = self.scratch.write(out, "open")
        self.scratch.drop(marked, mixed, known)
        return out

    def heavy_links(self, lists: DataFrame) -> DataFrame:
        scratch = self.scratch
        open_, links = lists.withColumn("component", F.col("node")), None
        for number in itertools.count():
            compared = self.compared(self.star_pairs(open_, number))
            found = self.links_of(compared)
            links = found if links is None else links.union(found)
            last = open_
            open_ = self.open_lists(last, links)
            if number:
                scratch.drop(last)
            by = open_.groupBy("hash", "component").agg(F.count("*").alias("c"))
            by = by.groupBy("hash").agg(F.sum("c").alias("c"), F.sum(F.expr("c * c")).alias("own"))
            rows, pairs = by.agg(F.sum("c"), F.sum(F.expr("(c * c - own) / 2"))).first()
            # a round costs some passes over the lists: go on while the rest costs more and a round
            # still brings many sets together
            left = open_.agg(F.count_distinct("node")).first()[0]
            if not rows or pairs <= 64 * rows or 20 * found.count() <= left:
                break
        if rows:
            links = links.union(self.links_of(self.compared(self.rest_pairs(open_))))
        return links


def ngram_jaccard_components(
    docs: DataFrame,
    width: int = 5,
    percent: int = 75,
    doc_id: str = "doc_id",
    text: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Per document its number of distinct shingles and its component of linked documents.

    Texts are lower-cased (A-Z) and cut at ASCII white space; a document's set holds its distinct
    `width`-word shingles (128 bits name a whole set, 64 a shingle), with fewer words the whole
    sequence as one. Two documents link when 100 * intersection >= `percent` * union.

    Returns id (named as `doc_id`, as long), n_shingles and component_id (smallest id reachable by
    links, its own included). Null texts and texts without words have no set and link with nothing.
    A row without an id links with nothing and has a null component. Rows that repeat an id are one
    document: it links where any of them does; each row is returned. No documents give no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "ngram-join")
    lower = docs.select(docs[doc_id].cast("long").alias("id"), docs[text].alias("text"))
    fields = "id long, n long, s1 long, s2 long, hot array<long>, times array<long>"
    seen = scratch.write(lower.mapInArrow(_sets_job(width), fields), "sets")
    sets = seen.where("hot is null").select("id", "n", "s1", "s2")
    same = ["n", "s1", "s2"]
    classes = sets.where("n > 0 and id is not null").groupBy(*same).agg(F.min("id").alias("node"))
    classes = scratch.write(classes, "classes")

    # the order: shingles that repeat within a task come last, by their counts
    counts = seen.where("hot is not null").select(F.explode(F.arrays_zip("hot", "times")).alias("x"))
    counts = counts.groupBy("x.hot").agg(F.sum("x.times").alias("times"))
    counts = scratch.write(counts.where(F.col("times") >= 1 << LEAST_FREQUENT), "counts")
    power = F.floor(F.log2("times")).cast("int")
    least = least_power(dict(counts.groupBy(power.alias("p")).count().collect()))
    counts = counts.where(F.col("times") >= 1 << least).toArrow()
    hot = np.asarray(counts.column("hot").combine_chunks()).view(np.uint64)
    order = np.argsort(hot)
    times = np.asarray(counts.column("times").combine_chunks())
    frequent = spark.sparkContext.broadcast((hot[order], times[order]))

    few = 2 * MOST_LIGHT
    sizes = dict(classes.where(F.col("n") <= few).groupBy("n").count().collect())
    most_light = boundary(sizes, percent)

    # one document of each class
    named = sets.where("id is not null").join(scratch.joinable(classes, broadcast_bytes), same)
    by_id = named.groupBy("id").agg(
        F.min("node").alias("lo"), F.max("node").alias("hi"), F.max(F.expr("id = node")).alias("head")
    )
    by_id = scratch.write(by_id.where("not head or lo <> hi"), "others")
    spare = scratch.write(by_id.where("not head").select("id"), "spare")
    # an id with several texts joins their classes
    several_texts = named.join(by_id.where("lo <> hi").select("id"), "id")
    several_texts = several_texts.select(F.col("id").alias("a"), F.col("node").alias("b"))
    texts = lower.where("id is not null").join(
        scratch.joinable(spare, broadcast_bytes), "id", "left_anti"
    )
    postings = texts.mapInArrow(
        _postings_job(width, percent, most_light, frequent), "hash long, node long, n int, kind byte"
    )
    postings = scratch.write(postings, "postings")
    subsets, lists = postings.where("kind > 0"), postings.where("kind = 0").drop("kind")

    hubs = subsets.groupBy("hash").agg(
        F.min(F.when(F.col("kind") == 1, F.col("node"))).alias("hub"), F.count("*").alias("c")
    )
    light = subsets.join(hubs.where("c > 1 and hub is not null"), "hash").where("node <> hub")
    light = scratch.write(light.select(F.col("node").alias("a"), F.col("hub").alias("b")), "light")

    several = lists.groupBy("hash").agg(F.count("*").alias("c")).where("c > 1").select("hash")
    several = scratch.write(several, "several")
    lists = lists.join(scratch.joinable(several, broadcast_bytes), "hash", "left_semi")
    lists = scratch.write(lists, "lists")
    join = _Join(texts, scratch, width, percent, broadcast_bytes)
    share = lists.groupBy("node").agg((F.count("*") / join.prefix_of("first(n)")).alias("share"))
    share = scratch.write(share, "shares")
    heavy = join.heavy_links(lists.join(scratch.joinable(share, broadcast_bytes), "node"))
    scratch.drop(postings, several, lists, share)
    found = components(light.union(heavy).union(several_texts), scratch)

    named = sets.join(scratch.joinable(classes, broadcast_bytes), same, "left")
    named = named.join(scratch.joinable(found, broadcast_bytes), "node", "left")
    return named.select(
        F.col("id").alias(doc_id),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component", "node", "id")).alias("component_id"),
    )


def keep_one_of_each(
    docs: DataFrame,
    width: int = 5,
    percent: int = 75,
    doc_id: str = "doc_id",
    text: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The documents without those that are linked to one of a smaller id; see above for links.

    Rows that repeat an id are one document, of which one row stays: the one whose text is first in
    order. Rows without an id all stay.
    """
    scratch = Scratch(docs.sparkSession, "ngram-keep")
    found = ngram_jaccard_components(docs, width, percent, doc_id, text, broadcast_bytes)
    ids = found.select(F.col(doc_id).alias("gone"), "component_id").where("gone is not null")
    ids = scratch.write(ids, "components")
    gone = ids.where("gone <> component_id").select("gone").distinct()
    gone = scratch.write(gone, "gone")
    twice = ids.where("gone = component_id").groupBy("gone").agg(F.count("*").alias("c"))
    twice = scratch.write(twice.where("c > 1").select("gone"), "twice")
    same = docs[doc_id].cast("long") == F.col("gone")
    kept = docs.join(scratch.joinable(gone, broadcast_bytes), same, "left_anti")
    if not twice.take(1):
        return kept
    alike = kept[doc_id].cast("long") == F.col("gone")
    once = kept.join(scratch.joinable(twice, broadcast_bytes), alike, "left_anti")
    many = kept.join(scratch.joinable(twice, broadcast_bytes), alike, "left_semi")
    first = many.groupBy(F.col(doc_id).cast("long").alias("_id")).agg(
        F.min_by(F.struct("*"), F.struct(F.col(text).isNull(), F.col(text))).alias("_row")
    )
    return once.unionByName(first.select("_row.*"))
