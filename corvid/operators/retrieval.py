"""Sparse and dense retrieval, fusion and reranking over keyed long tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvid.functions import text as tx

#: Queries that a plan may send to every task; larger query sets are joined by shuffle.
SMALL = 100_000


#: The term that stands for a document itself among its terms; no token is empty.
ITSELF = ""


def few_of(queries: DataFrame):
    """What a plan does with hits of these queries before they meet the texts: a checked, small query set's are
    sent to the scan, which then isn't shuffled; a larger one's are joined."""
    return F.broadcast if queries.count() <= SMALL else (lambda hits: hits)


def postings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokens=tx.tokens, terms: DataFrame | None = None) -> DataFrame:
    """(doc_id, term, tf, dl): partial counts before the one shuffle, and a row of ITSELF for each document.

    The length travels with the terms, so texts are read once and nothing is joined back.
    terms: the only terms that are wanted, a frame of distinct ones; others go before the shuffle.
    """
    made = docs.select(F.col(id_col).alias("doc_id"), tokens(F.col(text_col)).alias("t"))
    rows = made.select("doc_id", F.size("t").cast("long").alias("dl"), F.explode(F.concat("t", F.array(F.lit(ITSELF)))).alias("term"))
    if terms is not None:
        rows = rows.join(terms, "term", "left_semi")
    return rows.groupBy("doc_id", "term").agg(F.count("*").alias("tf"), F.first("dl").alias("dl"))


def weigh(counts: DataFrame, k1: float = 1.5, b: float = 0.75) -> DataFrame:
    """(term, doc_id, tf, weight) of postings, with the Lucene idf; the same exchange serves all three uses."""
    tf = counts.where(F.col("term") != ITSELF)
    stats = counts.where(F.col("term") == ITSELF).agg(F.count("*").alias("n_docs"), F.avg("dl").alias("avgdl"))  # one row
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log(1 + (F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    norm = F.col("tf") + k1 * (1 - b + b * F.col("dl") / F.col("avgdl"))
    return tf.join(df, "term").crossJoin(F.broadcast(stats)).select("term", "doc_id", "tf", (idf * F.col("tf") / norm).alias("weight"))


def bm25_index(docs: DataFrame, k1: float = 1.5, b: float = 0.75, id_col: str = "doc_id", text_col: str = "text", tokens=tx.tokens) -> DataFrame:
    """(term, doc_id, tf, weight) of every posting."""
    return weigh(postings(docs, id_col, text_col, tokens), k1, b)


def write_index(index: DataFrame, path: str, partitions: int | None = None) -> None:
    """Writes an index sorted by term, so that a search prunes row groups by their term ranges."""
    n = partitions or int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    index.repartitionByRange(n, "term").sortWithinPartitions("term", "doc_id").write.mode("overwrite").parquet(path)


def query_terms(queries: DataFrame, tokens=tx.tokens) -> DataFrame:
    """(q_id, term), each term once; sent to all tasks if the query set is a checked, small one."""
    asked = queries.select("q_id", F.explode(F.array_distinct(tokens(F.col("text")))).alias("term"))
    return F.broadcast(asked) if queries.count() <= SMALL else asked


def bm25_search(docs: DataFrame, queries: DataFrame, k: int, k1: float = 1.5, b: float = 0.75, tokens=tx.tokens) -> DataFrame:
    """The search without an index: only postings of the queries' terms are counted, weighed and shuffled."""
    asked = query_terms(queries, tokens)
    wanted = asked.select("term").unionByName(docs.sparkSession.range(1).select(F.lit(ITSELF).alias("term"))).dropDuplicates()
    if queries.count() <= SMALL:
        wanted = F.broadcast(wanted)
    return _found(weigh(postings(docs, tokens=tokens, terms=wanted), k1, b), asked, k)


def top_k(scored: DataFrame, k: int, by: str = "score", key: str = "q_id", item: str = "doc_id", rank: str = "rank") -> DataFrame:
    """The k best of each key; equal scores by item. Spark limits each group before the shuffle."""
    w = Window.partitionBy(key).orderBy(F.desc(by), item)
    return scored.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def sparse_search(index: DataFrame, queries: DataFrame, k: int, tokens=tx.tokens) -> DataFrame:
    """(q_id, doc_id, score, rank) of queries (q_id, text) against term weights."""
    return _found(index, query_terms(queries, tokens), k)


def _found(index: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    hits = index.join(asked, "term").groupBy("q_id", "doc_id").agg(F.round(F.sum("weight"), 6).alias("score"))
    return top_k(hits, k)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.pow(x.cast("double") - y.cast("double"), F.lit(2.0))), F.lit(0.0), lambda s, x: s + x)


def dense_search(vectors: DataFrame, queries: DataFrame, k: int, metric=dot, ascending: bool = False) -> DataFrame:
    """Exact search of (item, v) for queries (q_id, q): the stated query set in blocks.

    A block of about SMALL queries at most, dealt by hash, is sent to the scan; a larger query set takes
    one pass over the vectors for each block. By dot product or squared distance a task meets its
    vectors with the queries as matrices and sends each query's best k; other metrics are expressions.
    """
    blocks = max(1, -(-queries.count() // SMALL))
    products = (metric is dot and not ascending) or (metric is squared_distance and ascending)
    scored = None
    for n in range(blocks):
        part = queries if blocks == 1 else queries.where(F.pmod(F.xxhash64("q_id"), F.lit(blocks)) == n)
        own = best_by_products(vectors, part, k, ascending) if products else _scores(vectors, part, metric)
        scored = own if scored is None else scored.unionByName(own)
    if ascending:
        return top_k(scored.withColumn("neg", -F.col("score")), k, "neg", item="item").drop("neg")
    return top_k(scored, k, item="item")


def _scores(vectors: DataFrame, queries: DataFrame, metric) -> DataFrame:
    pairs = vectors.crossJoin(F.broadcast(queries)).where(F.col("item") != F.col("q_id"))
    return pairs.select("q_id", "item", F.round(metric(F.col("v"), F.col("q")), 6).alias("score"))


def matrix_of(column, dim: int | None = None):
    """(matrix, plain) of an Arrow array of vectors: the rows of `dim` numbers without a null (plain), the others left out."""
    import numpy as np
    import pyarrow.compute as pc

    size = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    if dim is None:
        dim = int(size.max(initial=0))
    plain = size == dim
    flat = column.filter(plain).flatten()
    if flat.null_count:
        held = pc.is_valid(flat).to_numpy(zero_copy_only=False).reshape(-1, dim).all(axis=1)
        plain[np.nonzero(plain)[0][~held]] = False
        flat = column.filter(plain).flatten()
    return flat.to_numpy(zero_copy_only=False).astype(float).reshape(int(plain.sum()), dim), plain


def best_of(v, item, q, ids, k: int, least, distance: bool):
    """(col, item, score): the k best rows of v for each row of q, from `least` on, which is raised to what was found.

    Products choose the candidates, with a margin for their error and for the rounding; the candidates' scores are
    then added up from the first number to the last, as the expressions do, and cut to k, equal ones by item.
    """
    import numpy as np

    raw = v @ q.T
    own = (v * v).sum(axis=1), (q * q).sum(axis=1)
    if distance:
        raw = 2 * raw - own[0][:, None] - own[1][None, :]
    raw[np.isnan(raw)] = np.inf if not distance else -np.inf
    raw[item[:, None] == ids[None, :]] = -np.inf
    margin = 1.1e-6 + 1e-12 * (own[0].max(initial=0.0) + own[1])
    bound = least
    if len(raw) > k and (raw >= least - margin).sum() > 2 * k * len(ids):
        bound = np.maximum(np.partition(raw, len(raw) - k, axis=0)[len(raw) - k], least)
        least[:] = bound
    row, col = np.nonzero((raw >= bound - margin) & (item[:, None] != ids[None, :]))
    score = np.empty(len(row))
    step = max(1, 4_000_000 // max(1, v.shape[1]))
    for at in range(0, len(row), step):
        x, y = v[row[at : at + step]], q[col[at : at + step]]
        each = (x - y) ** 2 if distance else x * y
        score[at : at + step] = np.cumsum(each, axis=1)[:, -1] if v.shape[1] else 0.0
    score = np.round(score, 6)
    order = np.lexsort((item[row], score if distance else -np.nan_to_num(score, nan=np.inf, posinf=np.inf, neginf=-np.inf), col))
    row, col, score = row[order], col[order], score[order]
    kept = np.arange(len(col)) - np.searchsorted(col, col) < k
    return col[kept], item[row[kept]], score[kept]


def best_by_products(vectors: DataFrame, queries: DataFrame, k: int, distance: bool = False, cells=None) -> DataFrame:
    """(q_id, item, score): each task's best k of (item, v) for the queries (q_id, q) of one block.

    cells: of the queries' matrix it makes a function that lists, for a batch's matrix, which rows meet which queries;
    without it all rows meet all queries. A null, a vector with one, or one of another length than the queries has a null score.
    """
    import numpy as np
    import pyarrow as pa

    asked = queries.select("q_id", "q").orderBy("q_id").toArrow().combine_chunks()  # at most a block
    ids = asked.column("q_id").to_numpy()
    column = asked.column("q").combine_chunks() if asked.num_rows else pa.array([], pa.list_(pa.float64()))
    q, plain = matrix_of(column)
    sent = vectors.sparkSession.sparkContext.broadcast((ids[plain], q, ids[~plain]))
    kind = {n: s[n].dataType.simpleString() for n, s in (("q_id", queries.schema), ("item", vectors.schema))}

    def rows(q_id, item, score):
        return pa.RecordBatch.from_arrays([pa.array(q_id), pa.array(item), score if isinstance(score, pa.Array) else pa.array(score)], ["q_id", "item", "score"])

    def nulls(q_id, item):
        """Null scores: the first k of the items for each of the queries."""
        a, b = np.repeat(q_id, len(item)), np.tile(item, len(q_id))
        a, b = a[a != b], b[a != b]
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        first = np.arange(len(a)) - np.searchsorted(a, a) < k
        return rows(a[first], b[first], pa.nulls(int(first.sum()), pa.float64()))

    def run(batches):
        ids, q, odd = sent.value
        meet = cells and cells(q)
        least = np.full(len(ids), -np.inf)
        for batch in batches:
            every = batch.column("item").to_numpy(zero_copy_only=False)
            v, plain = matrix_of(batch.column("v"), q.shape[1])
            item = every[plain]
            if len(odd):
                yield nulls(odd, np.sort(every)[: k + 1])
            if not plain.all():
                yield nulls(ids, np.sort(every[~plain])[: k + 1])
            for own, mine in meet(v) if meet else [(slice(None), np.arange(len(ids)))]:
                if not len(item[own]):
                    continue
                for start in range(0, len(mine), WIDTH):
                    at = mine[start : start + WIDTH]
                    floor = least[at]
                    col, found, score = best_of(v[own], item[own], q[at], ids[at], k, floor, distance)
                    least[at] = floor
                    yield rows(ids[at][col], found, score)

    return vectors.select("item", "v").mapInArrow(run, f"q_id {kind['q_id']}, item {kind['item']}, score double")


#: Queries whose scores with one Arrow batch are held at once.
WIDTH = 1024


def blas_search(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The same by matrix products on Arrow batches: each batch keeps its best k, then the window.

    The queries go out in blocks of SMALL, one pass over the vectors for each, and none is left out.
    """
    from itertools import islice

    import numpy as np
    import pandas as pd

    sc = queries.sparkSession.sparkContext

    def pass_of(block):
        sent = sc.broadcast((np.array([r.q_id for r in block], np.int64), np.array([r.q for r in block], float)))

        def run(frames):
            all_ids, all_q = sent.value
            for f in frames:
                if not len(f):
                    continue
                v, item = np.array(f["v"].tolist(), float), f["item"].to_numpy()
                for start in range(0, len(all_ids), WIDTH):
                    ids = all_ids[start : start + WIDTH]
                    score = np.round(v @ all_q[start : start + WIDTH].T, 6)
                    score[item[:, None] == ids[None, :]] = -np.inf
                    least = np.partition(score, max(0, len(score) - k), axis=0)[max(0, len(score) - k)]
                    row, col = np.nonzero((score >= least) & np.isfinite(score))
                    order = np.lexsort((item[row], -score[row, col], col))  # ties with the k-th: the smallest items
                    row, col = row[order], col[order]
                    first = np.searchsorted(col, np.arange(len(ids)))
                    kept = np.arange(len(col)) - first[col] < k
                    row, col = row[kept], col[kept]
                    yield pd.DataFrame({"q_id": ids[col], "item": item[row], "score": score[row, col]})

        return vectors.select("item", "v").mapInPandas(run, "q_id long, item long, score double")

    rows = queries.select("q_id", "q").orderBy("q_id").toLocalIterator()
    found = vectors.sparkSession.createDataFrame([], "q_id long, item long, score double")
    while block := list(islice(rows, SMALL)):  # at most SMALL vectors
        found = found.unionByName(pass_of(block))
    return top_k(found, k, item="item")


def rrf(hits: DataFrame, k: int, constant: int = 60) -> DataFrame:
    """Reciprocal rank fusion of hits (q_id, doc_id, source, rank)."""
    return top_k(hits.groupBy("q_id", "doc_id").agg(F.round(F.sum(1 / (F.lit(float(constant)) + F.col("rank"))), 9).alias("score")), k)


def minmax(by: str, partition: list[str], flat: float, digits: int = 9) -> Column:
    w = Window.partitionBy(*partition)
    low, high = F.min(by).over(w), F.max(by).over(w)
    return F.when(high == low, F.lit(flat)).otherwise(F.round((F.col(by) - low) / (high - low), digits))


def weighted(hits: DataFrame, weights: dict[str, float], k: int) -> DataFrame:
    """Sum of weight * min-max score over sources; sources of no weight are skipped."""
    total = sum(max(0.0, w) for w in weights.values())
    if total <= 0:
        raise ValueError("no source has a weight")
    w = F.coalesce(*[F.when(F.col("source") == s, F.lit(max(0.0, x) / total)) for s, x in weights.items()], F.lit(0.0))
    normal = hits.withColumn("w", w).where("w > 0").withColumn("norm", minmax("score", ["q_id", "source"], 1.0))
    fused = normal.groupBy("q_id", "doc_id").agg(F.round(F.sum(F.col("w") * F.col("norm")), 6).alias("score"), F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"))
    return top_k(fused, k)


def concat(hits: DataFrame, order: list[str]) -> DataFrame:
    """The first occurrence of each document, sources in the given order."""
    place = F.coalesce(*[F.when(F.col("source") == s, F.lit(n)) for n, s in enumerate(order)], F.lit(len(order)))
    w = Window.partitionBy("q_id", "doc_id").orderBy("place", "rank")
    return hits.withColumn("place", place).withColumn("first", F.row_number().over(w)).where("first = 1").drop("first")


def backfill(chosen: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """(q_id, doc_id, place): the chosen by rank, then new documents of the candidates by rank, k in all."""
    first = chosen.select("q_id", "doc_id", F.lit(0).alias("part"), "rank")
    more = candidates.join(chosen, ["q_id", "doc_id"], "left_anti").groupBy("q_id", "doc_id").agg(F.min("rank").alias("rank")).select("q_id", "doc_id", F.lit(1).alias("part"), "rank")
    w = Window.partitionBy("q_id").orderBy("part", "rank", "doc_id")
    return first.unionByName(more).withColumn("place", F.row_number().over(w)).where(F.col("place") <= k).select("q_id", "doc_id", "place")


def pad(array: Column, k: int, fallback: int = 1) -> Column:
    """An array of k: its last item repeated, or the fallback if it is empty."""
    last = F.when(F.size(array) > 0, F.element_at(array, -1)).otherwise(F.lit(fallback).cast("long"))
    return F.slice(F.concat(array, F.array_repeat(last, k)), 1, k)


def overlap_rerank(pairs: DataFrame, k: int) -> DataFrame:
    """Stand-in for a cross-encoder: share of the query's terms that the text holds. pairs: q_id, doc_id, query, text."""
    q, d = F.array_distinct(tx.tokens(F.col("query"))), F.array_distinct(tx.tokens(F.col("text")))
    return top_k(pairs.select("q_id", "doc_id", F.round(F.size(F.array_intersect(q, d)) / F.greatest(F.size(q), F.lit(1)), 6).alias("score")), k)


def ensemble(runs: DataFrame, weights: dict[str, float], k: int, normalise: bool = False) -> DataFrame:
    """Weighted scores over the models that saw a document: divided by their number, or by their weights."""
    w = F.coalesce(*[F.when(F.col("model") == m, F.lit(x)) for m, x in weights.items()], F.lit(0.0))
    by = F.sum(w) if normalise else F.count("*")
    return top_k(runs.groupBy("q_id", "doc_id").agg(F.round(F.sum(w * F.col("score")) / by, 6).alias("score")), k)
