"""Inverted cells with product quantisation: byte codes of residuals, tables of products, exact re-ranking.

Coarse cells and codebooks are fitted on a bounded sample; every vector is coded. A vector lies
in its `copies` nearest cells, as the difference to the cell's centre, cut into parts, each the
number of its nearest codeword: a byte for each part. A query builds one table of its
products with all codewords, scans the codes of the cells it probes by table look-ups, and
the best of them are scored exactly by their vectors.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .retrieval import dot, top_k
from .routing import SAMPLE

#: Codewords of a part: one byte. Bytes of tables that a task holds for one pass of queries.
WORDS, PASS_BYTES = 256, 64 << 20


def lloyd(x: np.ndarray, n: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    """n centres of the rows of x, or as many as there are rows; a centre that loses all its rows stays."""
    centre = x[rng.choice(len(x), min(n, len(x)), replace=False)].copy()
    for _ in range(rounds):
        own = nearest(x, centre)
        size = np.bincount(own, minlength=len(centre))
        sums = np.stack([np.bincount(own, x[:, j], len(centre)) for j in range(x.shape[1])], 1)
        centre[size > 0] = sums[size > 0] / size[size > 0, None]
    return centre


def nearest(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.concatenate([((centre * centre).sum(1) - 2 * x[k : k + 4096] @ centre.T).argmin(1) for k in range(0, len(x), 4096)]) if len(x) else np.empty(0, np.int64)


@dataclass
class Quantiser:
    """centres: cells x d; books: parts x WORDS x d / parts (unused words are infinitely far)."""

    centres: np.ndarray
    books: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, cells: int, parts: int, seed: int = 7) -> Quantiser:
        rng = np.random.default_rng(seed)
        width = x.shape[1] // parts
        if width * parts != x.shape[1]:
            raise ValueError(f"{x.shape[1]} dimensions can't be cut into {parts} parts")
        centres = lloyd(x, cells, 12, rng)
        rest = x - centres[nearest(x, centres)]
        books = np.full((parts, WORDS, width), np.inf)
        for p in range(parts):
            words = lloyd(rest[:, p * width : (p + 1) * width], WORDS, 12, rng)
            books[p, : len(words)] = words
        return cls(centres, books)

    def cells_of(self, x: np.ndarray, n: int) -> np.ndarray:
        far = (self.centres * self.centres).sum(1) - 2 * x @ self.centres.T
        return np.argsort(far, axis=1, kind="stable")[:, :n]

    def encode(self, x: np.ndarray, cell: np.ndarray) -> np.ndarray:
        rest, width = x - self.centres[cell], self.books.shape[2]
        out = np.empty((len(x), len(self.books)), np.uint8)
        for p, book in enumerate(self.books):
            out[:, p] = nearest(rest[:, p * width : (p + 1) * width], book[np.isfinite(book[:, 0])])
        return out

    def tables(self, q: np.ndarray) -> np.ndarray:
        """queries x parts x WORDS: the products of each query's parts with all codewords."""
        cut = q.reshape(len(q), len(self.books), -1)
        return np.einsum("qpw,pcw->qpc", cut, np.where(np.isfinite(self.books), self.books, 0.0)).astype(np.float32)


@dataclass
class Coded:
    """A written index: codes by cell, the vectors themselves, and the quantiser."""

    spark: SparkSession
    path: str

    def codes(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/codes")

    def vectors(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/vectors")

    def quantiser(self) -> Quantiser:
        r = self.spark.read.parquet(f"{self.path}/quantiser").first()  # cells and codewords alone
        centres = np.array(r.centres).reshape(r.cells, -1)
        return Quantiser(centres, np.array(r.books).reshape(r.parts, WORDS, -1))


def build(vectors: DataFrame, path: str, cells: int = 1024, parts: int = 16, copies: int = 2) -> Coded:
    """Codes all of (item, v) and writes them by cell. cells: at most one for four vectors of the sample of SAMPLE."""
    spark = vectors.sparkSession
    sample = vectors.orderBy(F.xxhash64("item"), "item").limit(SAMPLE).select("v").collect()  # at most SAMPLE
    if not sample:
        raise ValueError("no vectors to index")
    x = np.array([r.v for r in sample], float)
    fitted = Quantiser.fit(x, max(1, min(cells, len(x) // 4)), parts)
    row = [(len(fitted.centres), parts, fitted.centres.ravel().tolist(), fitted.books.ravel().tolist())]
    spark.createDataFrame(row, "cells int, parts int, centres array<double>, books array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/quantiser")
    sent = spark.sparkContext.broadcast(fitted)
    arrow = pa.schema([("cell", pa.int32()), ("item", pa.int64()), ("code", pa.binary())])

    def run(batches):
        for b in batches:
            if b.num_rows:
                own, v = sent.value, np.array(b.column(1).to_pylist(), float)
                near = own.cells_of(v, copies)
                for n in range(near.shape[1]):
                    code = own.encode(v, near[:, n])
                    yield pa.RecordBatch.from_arrays([pa.array(near[:, n], pa.int32()), b.column(0), pa.array([c.tobytes() for c in code], pa.binary())], schema=arrow)

    parts_of = int(spark.conf.get("spark.sql.shuffle.partitions"))
    flat = vectors.select(F.col("item").cast("long").alias("item"), F.col("v").cast("array<float>").alias("v"))
    flat.write.mode("overwrite").parquet(f"{path}/vectors")
    made = spark.read.parquet(f"{path}/vectors").mapInArrow(run, "cell int, item long, code binary")
    # by cell and item, so that a large cell is many files
    made.repartitionByRange(parts_of, "cell", "item").sortWithinPartitions("cell", "item").write.mode("overwrite").parquet(f"{path}/codes")
    return Coded(spark, path)


def candidates(index: Coded, queries: DataFrame, depth: int, share: float) -> DataFrame:
    """(q_id, item, score): the best `depth` of each query by codes, of the nearest `share` of the cells.

    The queries go in passes, their tables of products PASS_BYTES at most; all are answered.
    """
    spark, own = index.spark, index.quantiser()
    probes = max(1, round(share * len(own.centres)))
    schema = "q_id long, item long, score float"
    arrow = pa.schema([("q_id", pa.int64()), ("item", pa.int64()), ("score", pa.float32())])

    def pass_of(block):
        sent = spark.sparkContext.broadcast((own, np.array([r.q_id for r in block], np.int64), np.array([r.q for r in block], float)))

        def run(batches):
            quantiser, ids, q = sent.value
            table, base = quantiser.tables(q), (q @ quantiser.centres.T).astype(np.float32)
            probed = np.zeros(base.shape, bool)
            np.put_along_axis(probed, quantiser.cells_of(q, probes), True, 1)
            for b in batches:
                cell, item = b.column(0).to_numpy(), b.column(1).to_numpy()
                code = np.frombuffer(b"".join(b.column(2).to_pylist()), np.uint8).reshape(len(cell), -1)
                edges = [0, *(np.flatnonzero(np.diff(cell)) + 1).tolist(), len(cell)]
                for start, end in zip(edges, edges[1:], strict=False):
                    asked = np.flatnonzero(probed[:, cell[start]]) if end > start else ()
                    if len(asked):
                        score = np.repeat(base[asked, cell[start]][:, None], end - start, 1)
                        for p in range(code.shape[1]):
                            score += table[asked, p][:, code[start:end, p]]
                        n = min(depth, end - start)
                        best = np.argpartition(-score, n - 1, axis=1)[:, :n]
                        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids[asked], n)), pa.array(item[start:end][best].ravel()), pa.array(np.take_along_axis(score, best, 1).ravel())], schema=arrow)

        return index.codes().mapInArrow(run, schema)

    each = max(1, PASS_BYTES // (len(own.books) * WORDS * 4))
    rows = queries.select("q_id", "q").orderBy("q_id").toLocalIterator()
    found = spark.createDataFrame([], schema)
    while block := list(islice(rows, each)):  # PASS_BYTES of tables
        found = found.unionByName(pass_of(block))
    once = found.where(F.col("item") != F.col("q_id")).groupBy("q_id", "item").agg(F.max("score").alias("score"))
    return top_k(once, depth, item="item").select("q_id", "item", "score")


def search(index: Coded, queries: DataFrame, k: int, share: float = 0.25, depth: int | None = None) -> DataFrame:
    """(q_id, item, score, rank): the candidates by codes, scored exactly. queries: (q_id, q)."""
    near = candidates(index, queries, depth or 10 * k, share).select("q_id", "item")
    scored = near.join(index.vectors(), "item").join(queries.select("q_id", "q"), "q_id").select("q_id", "item", F.round(dot(F.col("v"), F.col("q")), 6).alias("score"))
    return top_k(scored, k, item="item")
