"""Connected components by alternating large and small stars, all in joins and aggregations."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.scratch import Scratch


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.col("a") % 1000003))
    return tuple(row.first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    out = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return out.where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them. edges: a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    out = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return out.where("a <> b").union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """node, component (its smallest reachable node) for all nodes of the edges (a, b: long).

    Nodes without an edge are absent; no edges give no rows. Edges may repeat, in either direction;
    loops are ignored. Each round is written, so lineage stays short; the number of rounds grows
    with the logarithm of the longest path.
    """
    turned = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = scratch.write(turned.where("a <> b").distinct(), "edges")
    mark = _fingerprint(now)
    while mark[0]:
        then = scratch.write(_small_star(_large_star(now)), "stars")
        scratch.drop(now)
        now, before, mark = then, mark, _fingerprint(then)
        if mark == before:
            break
    members = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return scratch.write(members.union(roots), "components")
