"""Retrieval from several sources: tagging, fan-out, modality routing, encoders, IVF cells, final selection."""

from __future__ import annotations

import hashlib
import threading
import time
import uuid
import warnings
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import InheritableThread, SparkContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvid.functions import text as tx
from corvid.session import scratch

from .retrieval import SMALL, best_by_products, dense_search, minmax, top_k


def tag(hits: DataFrame, source: str, corpus: str | None = None, multimodal: bool = False) -> DataFrame:
    """Hits with their source, and with chunk and document ids filled in: a chunk's document is the
    part of its id before the first underscore."""
    have = set(hits.columns)
    chunk = F.coalesce(*[F.col(c).cast("string") for c in ("chunk_id", "id", "doc_id") if c in have])
    doc = F.coalesce(*([F.col("doc_id").cast("string")] if "doc_id" in have else []), F.substring_index(chunk, "_", 1))
    keep = [c for c in hits.columns if c not in ("chunk_id", "doc_id", "source", "corpus", "multimodal")]
    return hits.select(*keep, chunk.alias("chunk_id"), doc.alias("doc_id"), F.lit(source).alias("source"), F.lit(corpus).alias("corpus"), F.lit(multimodal).alias("multimodal"))


def fan_out(searches: dict[str, Callable[[], DataFrame]], seconds: float = 3600, whole: bool = False) -> DataFrame:
    """The union of the sources' hits under their names, searched side by side.

    Each source is settled in the shared folder by a thread of its own, its jobs under a tag. A source
    that can't be set up, fails in a task, or has not ended in time (its jobs are cancelled)
    is left out with a warning; only if none is left is that an error.
    whole: no source may be missing. The first one that is lost is an error, and the others are cancelled.
    """
    spark = SparkSession.active()
    sc, ended, lost = spark.sparkContext, {}, threading.Event()

    def settle(name: str, tag: str) -> None:
        sc.addJobTag(tag)
        try:
            path = scratch(spark, "source")
            hits = searches[name]()
            hits.write.parquet(path)
            ended[name] = spark.read.schema(hits.schema).parquet(path)
        except Exception as why:  # noqa: BLE001  any source may fail in its own way
            ended[name] = why
            lost.set()
        finally:
            sc.removeJobTag(tag)

    threads = {name: (f"source-{uuid.uuid4().hex}", None) for name in searches}
    for name, (tag, _) in threads.items():
        threads[name] = tag, InheritableThread(target=settle, args=(name, tag), daemon=True)
        threads[name][1].start()
    until = time.monotonic() + seconds
    for _, thread in threads.values():
        while thread.is_alive() and time.monotonic() < until and not (whole and lost.is_set()):
            thread.join(0.2)
    got = dict(ended)  # what is cancelled from here on has not ended in time
    late = [name for name in searches if name not in got]
    for name in late:
        sc.cancelJobsWithTag(threads[name][0])
    said = {name: str(why).strip().split("\n")[0] for name, why in got.items() if isinstance(why, Exception)}
    said |= dict.fromkeys(late, f"no result within {seconds:g} seconds")
    if whole and said:
        _end([threads[name] for name in late], sc)
        name = next(iter(said))
        raise RuntimeError(f"source {name} is lost: {said[name]}") from got.get(name)
    found = None
    for name in searches:
        if name in said:
            warnings.warn(f"source {name} is left out: {said[name]}", stacklevel=2)
            continue
        hits = got[name].withColumn("source", F.lit(name))
        found = hits if found is None else found.unionByName(hits, allowMissingColumns=True)
    if found is None:
        raise RuntimeError("no source could be searched")
    return found


def _end(threads: list[tuple[str, InheritableThread]], sc: SparkContext, seconds: float = 60) -> None:
    """Cancels the jobs of these threads, those that they still begin too, until they have ended: the caller may delete what they read."""
    until = time.monotonic() + seconds
    while time.monotonic() < until and any(thread.is_alive() for _, thread in threads):
        for tag, thread in threads:
            sc.cancelJobsWithTag(tag)
            thread.join(0.5)


def share_of_weights(weights: Column, total: Column) -> Column:
    """Weights clamped at zero over their clamped total; equal halves where there is none."""
    return F.when(total > 0, F.greatest(weights, F.lit(0.0)) / total).otherwise(F.lit(0.5))


def route(queries: DataFrame, modality: Column, searches: dict[str, Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Each query goes to the search of its modality; queries of a modality without one get nothing."""
    named = queries.withColumn("modality", modality)
    out = None
    for kind, search in searches.items():
        hits = search(named.where(F.col("modality") == kind).drop("modality")).withColumn("modality", F.lit(kind))
        out = hits if out is None else out.unionByName(hits)
    return out


def over_fetch(k: int, factor: float = 1.2) -> int:
    return int(k * factor)


def table_boost(hits: DataFrame, factor: float = 1.3) -> DataFrame:
    """Scores of documents with a table, for numeric queries: times the factor, the normalised one at most 1."""
    boosted = F.col("numeric") & F.col("has_table")
    return hits.withColumn("score", F.round(F.when(boosted, F.col("score") * factor).otherwise(F.col("score")), 6)).withColumn("norm", F.round(F.when(boosted, F.least(F.col("norm") * factor, F.lit(1.0))).otherwise(F.col("norm")), 6))


def best(hits: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k best of each query by several scores, all descending, then by document."""
    w = Window.partitionBy("q_id").orderBy(*[F.desc_nulls_last(c) for c in keys], "doc_id")
    return hits.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def first_of_each(hits: DataFrame, order: list[str]) -> DataFrame:
    """The first row of each (q_id, doc_id)."""
    w = Window.partitionBy("q_id", "doc_id").orderBy(*order)
    return hits.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def ensemble(runs: DataFrame, weights: dict[str, float], k: int, first: str, original: str = "original") -> DataFrame:
    """Weighted mean over the models that saw a document, each with its best min(size of the first
    list, 2 k); the original score stands if it is larger, but no less than 0.8 of the mean.

    runs: q_id, doc_id, model, score and the original score.
    """
    size = F.sum((F.col("model") == first).cast("int")).over(Window.partitionBy("q_id"))
    place = F.row_number().over(Window.partitionBy("q_id", "model").orderBy(F.desc("score"), "doc_id"))
    head = runs.withColumn("_size", size).withColumn("_place", place).where(F.col("_place") <= F.least(F.col("_size"), F.lit(2 * k)))
    w = F.coalesce(*[F.when(F.col("model") == m, F.lit(x)) for m, x in weights.items()], F.lit(0.0))
    mean = head.groupBy("q_id", "doc_id").agg((F.sum(w * F.col("score")) / F.count("*")).alias("mean"), F.max(original).alias("o"))
    kept = F.when(F.col("o") > 0.8 * F.col("mean"), F.greatest("o", "mean")).otherwise(F.col("mean"))
    return top_k(mean.select("q_id", "doc_id", F.round(kept, 8).alias("score")), k)


# --- encoders -----------------------------------------------------------------------------

DIM = 64
#: Instructions by model family, query and passage side.
PREFIXES = {"e5": ("query: ", "passage: "), "bge": ("Represent this sentence for searching relevant passages: ", ""), "none": ("", "")}


def instruct(c: Column, family: str, query: bool) -> Column:
    return F.concat(F.lit(PREFIXES[family][0 if query else 1]), c)


def hashed_dim(term: Column, dim: int = DIM) -> Column:
    return (F.conv(F.substring(F.md5(term), 1, 6), 16, 10).cast("long") % dim).cast("long")


def hash_vectors(rows: DataFrame, id_col: str, text_col: str = "text", dim: int = DIM) -> DataFrame:
    """(id, dim, w): token counts by hashed dimension, of unit length. An offline encoder in expressions."""
    t = rows.select(F.col(id_col).alias("id"), F.explode(tx.tokens(F.col(text_col))).alias("term"))
    n = t.groupBy("id", hashed_dim(F.col("term"), dim).alias("dim")).agg(F.count("*").alias("n"))
    length = F.sqrt(F.sum(F.col("n") * F.col("n")).over(Window.partitionBy("id")))
    return n.select("id", "dim", (F.col("n") / length).alias("w"))


def backing_off(call: Callable[[list], list], items: list, size: int = 64, least: int = 4) -> list:
    """call() over batches of items; where a batch runs out of memory, batches of half the size, `least` at the lowest."""
    out, at = [], 0
    while at < len(items):
        try:
            out += call(items[at : at + size])
            at += size
        except MemoryError:
            if size <= least:
                raise
            size = max(least, size // 2)
    return out


#: Tokens, padding included, that one call of a model gets.
BUDGET = 16_384


def by_budget(call: Callable[[list], list], items: list, sizes: list[int], budget: int = BUDGET) -> list:
    """call() over batches of items of like size, the longest first, each of `budget` at most when all
    are padded to its largest, or of one item; the results in the order of items.

    Where a batch runs out of memory the budget is halved for what follows, down to single items.
    """
    order = sorted(range(len(items)), key=lambda n: -sizes[n])
    out: list = [None] * len(items)
    at = 0
    while at < len(order):
        n = max(1, budget // max(1, sizes[order[at]]))
        own = order[at : at + n]
        try:
            made = call([items[k] for k in own])
        except MemoryError:
            if len(own) == 1:
                raise
            budget = max(1, min(budget, len(own) * max(1, sizes[own[0]])) // 2)
            continue
        for k, x in zip(own, made, strict=True):
            out[k] = x
        at += len(own)
    return out


def token_sizes(texts: list[str]) -> list[int]:
    """About a token for four characters."""
    return [len(x) // 4 + 1 for x in texts]


class Encoder:
    """The encoder seam: encode() turns texts into unit vectors; a model is loaded once for each worker.

    It gets batches of texts of like length, `budget` tokens each, smaller ones once memory runs out.
    """

    dim = DIM
    budget = BUDGET

    def encode(self, texts: list[str]) -> np.ndarray:
        raise NotImplementedError

    def apply(self, rows: DataFrame, text: str = "text", out: str = "embedding") -> DataFrame:
        """rows with a vector column, batch by batch."""
        own = self

        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for texts in batches:
                held = texts.fillna("").tolist()
                yield pd.Series(by_budget(lambda part: list(own.encode(part).astype(np.float32)), held, token_sizes(held), own.budget))

        run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
        return rows.withColumn(out, F.pandas_udf(run, "array<float>")(text))


class HashEncoder(Encoder):
    """hash_vectors() as a model: the offline stand-in behind the seam."""

    def __init__(self, dim: int = DIM):
        self.dim = dim

    def encode(self, texts: list[str]) -> np.ndarray:
        import regex

        word = regex.compile(tx.WORD)
        out = np.zeros((len(texts), self.dim))
        for row, text in zip(out, texts, strict=True):
            for term in word.findall(text.lower()):
                row[int(hashlib.md5(term.encode()).hexdigest()[:6], 16) % self.dim] += 1
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


def bi_rerank(pairs: DataFrame, queries: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """Candidates (q_id, doc_id) by the dot product of both sides' vectors; only candidates are encoded."""
    wanted = docs.join(pairs.select("doc_id").dropDuplicates(), "doc_id", "left_semi")
    q = hash_vectors(queries, "q_id").select(F.col("id").alias("q_id"), "dim", F.col("w").alias("x"))
    v = hash_vectors(wanted, "doc_id").select(F.col("id").alias("doc_id"), "dim", F.col("w").alias("y"))
    scored = pairs.select("q_id", "doc_id").join(q, "q_id").join(v, ["doc_id", "dim"]).groupBy("q_id", "doc_id").agg(F.round(F.sum(F.col("x") * F.col("y")), 6).alias("score"))
    return top_k(scored, k)


# --- dense index --------------------------------------------------------------------------

#: Vectors that the coarse cells are fitted on at most (the smallest hashes of their ids).
SAMPLE = 20_000


def write_vectors(vectors: DataFrame, path: str) -> None:
    """The flat index: (item, v) as float arrays, in files of the session's own number."""
    vectors.select("item", F.col("v").cast("array<float>").alias("v")).write.mode("overwrite").parquet(path)


def read_vectors(spark, path: str) -> DataFrame:
    return spark.read.schema("item long, v array<float>").parquet(path)


def coarse_cells(vectors: DataFrame, cells: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """Centroids of a bounded sample by Lloyd's rounds on the driver; every vector is indexed by assign()."""
    rows = vectors.orderBy(F.xxhash64("item"), "item").limit(SAMPLE).select("v").collect()  # at most SAMPLE
    x = np.array([r.v for r in rows], float)
    rng = np.random.default_rng(seed)
    centre = x[rng.choice(len(x), min(cells, len(x)), replace=False)]
    for _ in range(rounds):
        own = _nearest(x, centre, 1)[:, 0]
        for c in range(len(centre)):
            if (own == c).any():
                centre[c] = x[own == c].mean(axis=0)
    return centre


def _nearest(x: np.ndarray, centre: np.ndarray, n: int) -> np.ndarray:
    far = (centre * centre).sum(axis=1) - 2 * x @ centre.T
    return np.argsort(far, axis=1, kind="stable")[:, :n]


def assign(vectors: DataFrame, centre: np.ndarray, n: int, column: str = "v", explode: bool = True) -> DataFrame:
    """Rows with `cell`, the n nearest cells of each vector, a row for each or as an array; the centroids are a few hundred at most."""
    sent = vectors.sparkSession.sparkContext.broadcast(centre)

    @F.pandas_udf("array<int>")
    def near(v: pd.Series) -> pd.Series:
        return pd.Series(list(_nearest(np.array(v.tolist(), float), sent.value, n).astype(np.int32)))

    return vectors.withColumn("cell", F.explode(near(column)) if explode else near(column))


def ivf_search(vectors: DataFrame, queries: DataFrame, k: int, cells: int = 32, probes: int = 24) -> DataFrame:
    """Approximate search of (item, v) for (q_id, q): a query meets the vectors of its nearest cells.

    Every vector is in one cell. The default probes suit vectors without structure, like the test ones
    (recall 0.95 to 0.96); clustered embeddings need far fewer. A task meets the vectors of a cell with
    the queries that probe it as matrices and sends each query's best k, so a hot cell is no one task.
    """
    centre = coarse_cells(vectors, cells)

    def by_cell(q):
        probed = _nearest(q, centre, probes) if len(centre) else np.zeros((len(q), 0), int)
        asked = [np.nonzero((probed == c).any(axis=1))[0] for c in range(len(centre))]

        def meet(v):
            own = _nearest(v, centre, 1)[:, 0]
            return [(np.nonzero(own == c)[0], asked[c]) for c in np.unique(own)]

        return meet

    blocks = max(1, -(-queries.count() // SMALL))
    scored = None
    for n in range(blocks):
        part = queries if blocks == 1 else queries.where(F.pmod(F.xxhash64("q_id"), F.lit(blocks)) == n)
        own = best_by_products(vectors, part, k, cells=by_cell)
        scored = own if scored is None else scored.unionByName(own)
    return top_k(scored, k, item="item")


def normalised(hits: DataFrame, flat: float = 0.5) -> DataFrame:
    return hits.withColumn("norm", minmax("score", ["q_id"], flat, 6))


def pooled_vector(tokens: Column, mask: Column, method: str = "mean", pooler: Column | None = None) -> Column:
    """One vector of a text's token vectors (array<array<double>>): the mean of those that the mask
    (array<boolean>) marks, the first, or the model's own `pooler` vector. Without a marked token,
    or without tokens, null."""
    if method == "pooler":
        if pooler is None:
            raise ValueError("pooler needs the model's own vector")
        return pooler
    if method == "cls":
        return F.try_element_at(tokens, F.lit(1))
    if method != "mean":
        raise ValueError(f"unknown pooling {method}; there are mean, cls and pooler")
    kept = F.filter(F.arrays_zip(tokens.alias("t"), mask.alias("m")), lambda x: x["m"])
    added = F.aggregate(F.slice(kept, 2, F.greatest(F.size(kept) - 1, F.lit(0))), F.try_element_at(kept, F.lit(1))["t"], lambda a, x: F.zip_with(a, x["t"], lambda p, q: p + q))
    return F.transform(added, lambda x: x / F.size(kept))


def modal_search(tables: dict[str, DataFrame], queries: DataFrame, k: int) -> DataFrame:
    """(q_id, item, score, rank, modal): the best k of each modality's vectors (item, v) for each query, whatever its own modality."""
    out = None
    for modal, vectors in tables.items():
        found = dense_search(vectors, queries, k).withColumn("modal", F.lit(modal))
        out = found if out is None else out.unionByName(found)
    return out
