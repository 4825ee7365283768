"""Near duplicates among embeddings by sorted passes over concatenated random hashes."""

import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.components import components
from clientele.llm.scratch import BROADCAST_BYTES, Scratch
from clientele.llm.sorted_hashes import (
    BITS,
    LEAST,
    MOST_LEAVES,
    MOST_PASSES,
    TRIALS,
    Growth,
    Hashes,
    directions,
    partners,
    passes_for,
)
from clientele.operators.surrogate import dense_sk

#: Rows of a block in the neighbour search and in the counting of links.
BLOCK = 1024
#: Share of pairs missed, as estimated, from which a warning is given.
LOW_RECALL = 0.05


def matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors in double precision, padded with zeros, and their lengths before padding."""
    sizes = np.asarray(column.value_lengths().fill_null(0), dtype=np.int64)
    values = np.asarray(column.flatten(), dtype=np.float64)
    out = np.zeros((len(sizes), sizes.max(initial=0)))
    out[np.arange(out.shape[1]) < sizes[:, None]] = values
    out /= np.abs(out).max(axis=1, initial=1e-300, keepdims=True)  # so that squares stay finite
    norm = np.sqrt((out * out).sum(axis=1))
    return out / np.where(norm > 0, norm, 1)[:, None], sizes


def _pass_job(hashes):
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(at, BLOCK)
                vectors, sizes = matrix(batch.column("v"))
                labels = np.asarray(batch.column("label"))
                for p in range(hashes.value.passes):
                    keys = np.zeros(len(sizes), dtype=np.int64)
                    for n in np.unique(sizes):
                        own = np.flatnonzero(sizes == n)
                        keys[own] = hashes.value.keys(vectors[own, :n], labels[own], p)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(sizes), p, np.int32)),
                            pa.array(sizes.astype(np.int32)),
                            batch.column("label"),
                            pa.array(keys),
                            batch.column("rep"),
                        ],
                        ["pass", "dim", "label", "key", "rep"],
                    )

    return job


def forest(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row that has a neighbour, and the first row that it reaches; rows that are that are left out."""
    some = np.flatnonzero(near.sum(axis=1) > near.diagonal())
    own = near[np.ix_(some, some)] | np.eye(len(some), dtype=bool)
    least = np.arange(len(some))
    while len(some):
        now = np.where(own, least[None, :], len(some)).min(axis=1)
        now = now[now]  # a root's root is nearer
        if (now == least).all():
            break
        least = now
    parted = least != np.arange(len(some))
    return some[parted], some[least[parted]]


def _neighbour_job(threshold: float):
    def job(table: pa.Table) -> pa.Table:
        """Links of a block as a spanning forest: enough for components, at most one for each row."""
        table = table.combine_chunks().sort_by("pos")
        vectors, _ = matrix(table.column("v").combine_chunks())
        rep = np.asarray(table.column("rep"))
        group = np.stack([np.asarray(table.column(c)) for c in ("pass", "dim", "label")])
        # rows of one group stand together
        parts = np.flatnonzero((group[:, 1:] != group[:, :-1]).any(axis=0)) + 1
        bounds = [0, *parts.tolist(), len(rep)]
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for start, end in zip(bounds[:-1], bounds[1:]):
            own = vectors[start:end]
            one, other = forest(own @ own.T >= threshold)
            a.append(rep[start + one])
            b.append(rep[start + other])
        return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)})

    return job


def _count_job(threshold: float):
    def job(table: pa.Table) -> pa.Table:
        vectors, _ = matrix(table.column("v").combine_chunks())
        rep, n = np.asarray(table.column("rep")), np.asarray(table.column("n"))
        mine, low = np.asarray(table.column("chunk")), np.asarray(table.column("low"))
        high = np.asarray(table.column("high"))
        left, right = np.flatnonzero(mine == low), np.flatnonzero(mine == high)
        near = vectors[left] @ vectors[right].T >= threshold
        found, links = [rep[left]], [near @ n[right]]
        if low[0] != high[0]:
            found.append(rep[right])
            links.append(near.T @ n[left])
        return pa.table({"rep": np.concatenate(found), "links": np.concatenate(links)})

    return job


def _parts(batches: Iterator[pa.RecordBatch], hashes: Hashes):
    """Unit vectors of one length, and the rows of each tree among them."""
    for whole in batches:
        for at in range(0, whole.num_rows, BLOCK):
            batch = whole.slice(at, BLOCK)
            vectors, sizes = matrix(batch.column("v"))
            labels = np.asarray(batch.column("label"))
            for n in np.unique(sizes):
                own = np.flatnonzero(sizes == n)
                yield vectors[own, :n], hashes.groups(int(n), labels[own])


def _sums_job(state):
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows, and sums of their projections, by tree and node of the tree's last level."""
        hashes, numbers, start = state.value
        place = {group: k for k, group in enumerate(hashes.trees)}
        sums: dict[tuple[int, int], np.ndarray] = {}
        for vectors, groups in _parts(batches, hashes):
            for p, number in enumerate(numbers):
                todo = [(g, rows) for g, rows in groups if start[g][p] < len(hashes.trees[g][p].below)]
                if not todo:
                    continue
                projected = (vectors @ directions(hashes.seed, number, vectors.shape[1]).T).astype(np.float32)
                for g, rows in todo:
                    tree, first = hashes.trees[g][p], start[g][p]
                    node = tree.leaves(projected[rows]) - first
                    live = node >= 0
                    total = sums.setdefault((place[g], p), np.zeros((len(tree.below) - first, BITS + 1)))
                    np.add.at(total[:, 1:], node[live], projected[rows[live]])
                    total[:, 0] += np.bincount(node[live], minlength=len(total))
        for (k, p), total in sums.items():
            nodes = np.flatnonzero(total[:, 0])
            columns = [
                pa.array(np.full(len(nodes), k, np.int32)),
                pa.array(np.full(len(nodes), p, np.int32)),
                pa.array((nodes + start[list(place)[k]][p]).astype(np.int32)),
                *[pa.array(total[nodes, c]) for c in range(BITS + 1)],
            ]
            yield pa.RecordBatch.from_arrays(columns, ["part", "pass", "node", *SUMS])

    return job


def _hits_job(state):
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows by the number of passes in which a partner at the threshold comes within the window."""
        hashes, window, threshold = state.value
        found = np.zeros(hashes.passes + 1, dtype=np.int64)
        for vectors, groups in _parts(batches, hashes):
            other = partners(vectors, threshold, hashes.seed)
            hits = np.zeros(len(vectors), dtype=np.int64)
            for number in range(hashes.passes):
                planes = directions(hashes.seed, number, vectors.shape[1]).T
                mine, theirs = (vectors @ planes).astype(np.float32), (other @ planes).astype(np.float32)
                for g, rows in groups:
                    tree = hashes.trees[g][number]
                    hits[rows] += np.abs(tree.places(mine[rows]) - tree.places(theirs[rows])) <= window
            for _, rows in groups:
                found += np.bincount(hits[rows], minlength=len(found))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(found))), pa.array(found)], ["hits", "n"])

    return job


#: Columns of a node's rows and of the sums of their projections.
SUMS = [f"s{c}" for c in range(BITS + 1)]


def grown(reps: DataFrame, groups: list, numbers: list[int], least: float, seed: int) -> dict:
    """Trees of some passes from all rows, one job for each level; sums of the nodes reach the driver."""
    growing = {g: [Growth() for _ in numbers] for g in groups}
    fields = "part int, pass int, node int, " + ", ".join(f"{c} double" for c in SUMS)
    while any(not one.done() for own in growing.values() for one in own):
        trees = {g: [one.tree() for one in own] for g, own in growing.items()}
        start = {g: [one.start for one in own] for g, own in growing.items()}
        state = reps.sparkSession.sparkContext.broadcast((Hashes(seed, len(numbers), trees), numbers, start))
        rows = reps.select("label", "v").mapInArrow(_sums_job(state), fields)
        rows = rows.groupBy("part", "pass", "node").agg(*[F.sum(c).alias(c) for c in SUMS]).toArrow()
        found: dict[tuple[int, int], dict] = {}
        keys = [rows.column(c).to_pylist() for c in ("part", "pass", "node")]
        sums = np.stack([rows.column(c).to_numpy() for c in SUMS], axis=1)
        for k, p, node, own in zip(*keys, sums):
            found.setdefault((k, p), {})[node] = (own[0], own[1:])
        for k, g in enumerate(growing):
            for p, one in enumerate(growing[g]):
                if not one.done():
                    one.take(found.get((k, p), {}), least)
        state.unpersist()
    return {g: [one.tree() for one in own] for g, own in growing.items()}


def fitted_hashes(reps: DataFrame, window: int, threshold: float, missed: float, seed: int):
    """Hashes fitted on all vectors: every cut and count, and the number of passes, comes from all rows.

    A label with enough rows for a split has trees of its own, the others of a length have common ones, so
    at most MOST_LEAVES groups reach the driver, and at most as many nodes of a pass and level.
    """
    reps = reps.withColumn("dim", F.size("v"))
    total = reps.count()
    if not total:
        return Hashes(seed, 1, {})
    least = max(LEAST, total / MOST_LEAVES)
    counted = reps.groupBy("dim", "label").agg(F.count("*").alias("n"))
    groups = [(r["dim"], r["label"]) for r in counted.where(F.col("n") >= 2 * least).collect()]
    rest = counted.where(F.col("n") < 2 * least).groupBy("dim").agg(F.sum("n").alias("n"))
    groups += [(r["dim"], None) for r in rest.where(F.col("n") >= 2 * least).collect()]
    if not groups:  # signs alone; labels are small, or there are more lengths than trees
        return Hashes(seed, TRIALS if least == LEAST else MOST_PASSES, {})
    trees = grown(reps, groups, list(range(TRIALS)), least, seed)
    state = reps.sparkSession.sparkContext.broadcast((Hashes(seed, TRIALS, trees), window, threshold))
    hits = reps.select("label", "v").mapInArrow(_hits_job(state), "hits long, n long")
    hits = hits.groupBy("hits").agg(F.sum("n").alias("n")).collect()
    shares = np.array([r["hits"] / TRIALS for r in hits])
    passes, left = passes_for(shares, np.array([float(r["n"]) for r in hits]), missed)
    if left > LOW_RECALL:
        warnings.warn(f"about {left:.0%} of pairs at the threshold may be missed", stacklevel=3)
    if passes > TRIALS:
        more = grown(reps, groups, list(range(TRIALS, passes)), least, seed)
        trees = {g: own + more[g] for g, own in trees.items()}
    return Hashes(seed, passes, {g: own[:passes] for g, own in trees.items()})


def embedding_dedup(
    vectors: DataFrame,
    threshold: float = 0.98,
    window: int = 256,
    missed: float = 0.005,
    seed: int = 11,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Links between near-equal vectors of one label, and their components.

    Equal vectors of a label are taken together first. In each pass the vectors are put in
    lexicographic order of concatenated random hashes, and each is compared with the others of its
    block of the order, in double precision; pairs with cosine >= `threshold` are links. Blocks overlap
    by `window` rows, so every neighbour within a window is met. The hashes are cut where the vectors lie
    (`sorted_hashes`), by sums over all of them, so vectors that share a direction do not stay together.
    The number of passes is the least with which pairs at the threshold are missed with a share of
    `missed`, as estimated with a partner of each row among the counts of all rows; a warning tells where the most passes are
    not enough for LOW_RECALL. Links of all passes are united to components. As blocks see only part of
    a large group's links, the links within each component are then counted exactly, in pairs of
    blocks, of which only the counts come out.

    Returns the input's columns and n_links (long: other rows linked directly), component_id (the
    smallest id reachable), kept (id = component_id); input columns of these names give way. Vectors
    that are null, empty, zero, or hold null or non-finite components, and rows without a label, link with
    nothing; vectors of different lengths do not link. A null id with no link has a null component and is
    kept; in a component with ids the smallest id counts. Repeated rows, also with equal ids, are
    rows of their own that link. No rows give no rows.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "embedding-dedup")
    row = F.struct(*[vectors[c] for c in vectors.columns])
    v = vectors[embedding].cast("array<double>")
    # cosine is undefined for these
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(v, lambda x: x != 0)
    valid = v.isNotNull() & vectors[label].isNotNull() & some & ~odd
    base = vectors.select(
        row.alias("row"),
        vectors[vec_id].alias("id"),
        F.xxhash64(vectors[label]).alias("label"),
        v.alias("v"),
        F.coalesce(valid, F.lit(False)).alias("valid"),
        F.xxhash64(v).alias("h1"),
        F.xxhash64(F.lit("second"), v).alias("h2"),
        F.monotonically_increasing_id().alias("rid"),
    )
    base = scratch.write(base, "vectors")
    same = ["label", "h1", "h2"]
    groups = base.where("valid").groupBy(*same).agg(
        F.min("rid").alias("rep"), F.count("*").alias("n"), F.min("id").alias("least_id")
    )
    groups = scratch.write(groups, "groups")
    reps = base.select(F.col("rid").alias("rep"), "label", "v").join(
        scratch.joinable(groups, broadcast_bytes).select("rep", "n"), "rep"
    )
    reps = scratch.write(reps, "reps")

    # sorted passes: keys are placed without their vectors, which then join the blocks
    hashes = spark.sparkContext.broadcast(fitted_hashes(reps, window, threshold, missed, seed))
    fields = "pass int, dim int, label long, key long, rep long"
    keyed = scratch.write(reps.select("rep", "label", "v").mapInArrow(_pass_job(hashes), fields), "keys")
    order = F.struct("pass", "dim", "label", "key", "rep")
    placed = dense_sk(keyed.withColumn("order", order), "order", "pos", base=-1).drop("order", "key")
    block = F.expr(f"pos div {BLOCK}")
    early = (F.col("pos") % BLOCK < window) & (block > 0)
    blocks = placed.select(
        "*",
        F.explode(
            F.when(early, F.array(block, block - 1)).otherwise(F.array(block))
        ).alias("block"),
    )
    blocks = blocks.join(reps.select("rep", "v"), "rep")
    found = blocks.groupBy("block").applyInArrow(_neighbour_job(threshold), "a long, b long")
    links = components(found, scratch)

    # exact counts within components
    ranked = dense_sk(links.withColumn("order", F.struct("component", "node")), "order", "pos")
    first = ranked.groupBy("component").agg(
        F.min("pos").alias("first"), F.count("*").alias("members")
    )
    chunk = F.expr(f"(pos - first) div {BLOCK}")
    last = F.expr(f"(members - 1) div {BLOCK}")
    placed = ranked.join(first, "component").select(
        "component", F.col("node").alias("rep"), chunk.alias("chunk"), last.alias("last")
    )
    pairs = placed.join(reps.select("rep", "n", "v"), "rep").withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), "last"))
    )
    pairs = pairs.withColumn("low", F.least("chunk", "other")).withColumn(
        "high", F.greatest("chunk", "other")
    )
    counts = pairs.groupBy("component", "low", "high").applyInArrow(
        _count_job(threshold), "rep long, links long"
    )
    counts = scratch.write(counts.groupBy("rep").agg(F.sum("links").alias("links")), "counts")

    # back to all rows
    named = groups.join(links.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.withColumn("component", F.coalesce("component", "rep"))
    least = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = named.join(least, "component").join(counts, "rep", "left")
    named = named.select(
        *same, "component_id", (F.coalesce("links", "n") - 1).alias("n_links"), F.lit(True).alias("valid")
    )
    named = scratch.write(named, "named")
    scratch.drop(groups, reps, keyed, links, counts)
    out = base.join(scratch.joinable(named, broadcast_bytes), [*same, "valid"], "left")
    component = F.coalesce("component_id", "id")
    others = [c for c in vectors.columns if c.lower() not in ("n_links", "component_id", "kept")]
    return out.select(
        *[F.col("row").getField(c).alias(c) for c in others],
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
