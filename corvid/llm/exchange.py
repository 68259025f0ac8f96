"""Packed exchange: sorted arrays of hashes travel as binary rows for each hash bucket.

A hundred million 8-byte hashes as rows cost a hundred million row objects, sort keys and
serialisations; as arrays dealt by hash they cost their bytes. deal() cuts arrays by the
hash's bucket; by_part() brings the rows (part, ...) of a bucket together, and per_part() gives
one bucket after the other. So a task holds one bucket, of a size that does not grow with the
input. Partitions are MOST_PARTITIONS at most, each then with many buckets, sorted with spill;
rows never outnumber the entries, as a bucket without entries gets no row.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Partitions of one exchange at most; beyond, a partition has several buckets.
MOST_PARTITIONS = 20_000


def parts(spark: SparkSession, entries: int, each: int = 1_500_000) -> int:
    """Buckets for so many entries, at least the session's own number of partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), entries // each + 1)


def deal(hashes: np.ndarray, n: int):
    """(part, positions) of the hashes of each part, positions in order of part and hash."""
    part = ((hashes >> np.uint64(32)) % np.uint64(n)).astype(np.int64)
    order = np.lexsort((hashes, part))
    edges = np.searchsorted(part[order], np.arange(n + 1))
    for p in np.flatnonzero(np.diff(edges)).tolist():
        yield p, order[edges[p] : edges[p + 1]]


def by_part(rows: DataFrame, n: int) -> DataFrame:
    """Rows in order of their bucket, those of one bucket in one partition."""
    return rows.repartition(min(n, MOST_PARTITIONS), "part").sortWithinPartitions("part")


def per_part(batches):
    """(part, its record batches) for each run of rows with one value in the first column, `part`."""
    held, at = [], None
    for b in batches:
        if not b.num_rows:
            continue
        part = b.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
        for start, end in zip(cuts, cuts[1:], strict=False):
            if held and part[start] != at:
                yield at, held
                held = []
            at = part[start]
            held.append(b.slice(start, end - start))
    if held:
        yield at, held


def repeated(sorted_hashes: np.ndarray) -> np.ndarray:
    """Whether each entry of a sorted array has an equal neighbour."""
    same = sorted_hashes[1:] == sorted_hashes[:-1]
    out = np.zeros(len(sorted_hashes), bool)
    out[1:] |= same
    out[:-1] |= same
    return out


#: Rounds after which components() gives up with an error; a chain of n nodes takes about log n.
ROUNDS = 500


def components(stash, edges: DataFrame, name: str) -> DataFrame:
    """(node, root) of undirected edges (a, b): the smallest node of each component.

    Alternating large stars and small stars (Kiveris et al.) with written tables, until the edges
    are stars around the smallest nodes. Edges point from the larger node to the smaller one, and
    each step puts one edge at most in the place of each, or fewer: the graph contracts, so the
    rounds are logarithmic (squared, as far as proven) in a component's nodes.
    """
    links = stash.keep(edges.select("a", "b"), f"{name}-edges")
    star = stash.keep(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).dropDuplicates(), f"{name}-0")
    turn = 0
    while not _are_stars(star):
        turn += 1
        if turn > ROUNDS:
            raise RuntimeError(f"components of {name} are not found after {ROUNDS} rounds")
        # large star: all larger neighbours of a node go to its smallest one
        both = star.unionByName(star.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stash.keep(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least")), f"{name}-{turn}-large")
        large = star.select(F.col("b").alias("node"), F.col("a").alias("far")).join(least.withColumnRenamed("a", "node"), "node")
        large = stash.keep(large.select(F.col("far").alias("a"), F.col("least").alias("b")).dropDuplicates(), f"{name}-{turn}-star")
        # small star: a node and all its smaller neighbours go to the smallest of them
        least = stash.keep(large.groupBy("a").agg(F.min("b").alias("least")), f"{name}-{turn}-small")
        small = large.join(least, "a").where("b != least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        star = stash.keep(small.unionByName(least.select("a", F.col("least").alias("b"))).dropDuplicates(), f"{name}-{turn}")
        for old in (f"{name}-{turn - 1}", f"{name}-{turn}-large", f"{name}-{turn}-star", f"{name}-{turn}-small"):
            stash.drop(old)
    own = links.select(F.explode(F.array("a", "b")).alias("node"))
    rows = star.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(own.select("node", F.col("node").alias("root")))
    return stash.keep(rows.groupBy("node").agg(F.min("root").alias("root")), f"{name}-roots")


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node of distinct edges (a, b) has one edge down and none up, or none down."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("down")), F.struct(F.col("b").alias("node"), F.lit(0).alias("down")))).alias("end")).select("end.*")
    sides = ends.groupBy("node").agg(F.sum("down").alias("down"), F.min("down").alias("least"))
    return sides.where("down > 1 or (down = 1 and least = 0)").isEmpty()
