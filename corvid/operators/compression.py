"""Context compression, chunk fusion and answer scoring over keyed long tables."""

from __future__ import annotations

import zlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvid.functions import text as tx


def second_pass(hits: DataFrame, scores: DataFrame, head: int) -> DataFrame:
    """(q_id, doc_id, rank): the first `head` hits in the order of other scores, the rest behind them as they were."""
    both = hits.select("q_id", "doc_id", "rank").join(scores.select("q_id", "doc_id", F.col("score").alias("again")), ["q_id", "doc_id"], "left")
    first = F.col("rank") <= head
    order = Window.partitionBy("q_id").orderBy(F.when(first, 0).otherwise(1), F.when(first, F.col("again")).desc_nulls_last(), F.when(~first, F.col("rank")), "doc_id")
    return both.select("q_id", "doc_id", F.row_number().over(order).cast("long").alias("rank"))


def combined_score(rerank: Column, norm: Column, hybrid: Column, dense: Column) -> Column:
    """A chunk's score: by the reranker if it has one, else by the normalised score, else by the raw ones."""
    r, n, h, d = (F.coalesce(x, F.lit(0.0)) for x in (rerank, norm, hybrid, dense))
    return F.when(r > 0, 0.7 * r + 0.2 * n + 0.1 * h).when(n > 0, 0.6 * n + 0.4 * h).otherwise(0.7 * h + 0.3 * d)


def best_chunks(hits: DataFrame, score: Column, tie: str) -> DataFrame:
    """One row per (q_id, doc_id): its best chunk, the first by `tie` among equals; combined partially before the shuffle."""
    best = F.max_by(F.struct(*hits.columns), F.struct(F.col("_s"), -F.col(tie)))
    return hits.withColumn("_s", score).groupBy("q_id", "doc_id").agg(best.alias("r"), F.max("_s").alias("combined")).select("r.*", "combined")


@F.pandas_udf(T.DoubleType())
def gzip_distance(a: pd.Series, b: pd.Series) -> pd.Series:
    """Normalised compression distance of two texts."""
    size = lambda x: len(zlib.compress(x.encode()))

    def one(x, y):
        x, y = x or "", y or ""
        m, n = size(x), size(y)
        return (size(f"{x} {y}") - min(m, n)) / max(m, n)

    return pd.Series([one(x, y) for x, y in zip(a, b, strict=True)])


def sentence_budget(sentences: DataFrame, keys: list[str], budget: float, edge: float = 0.0) -> DataFrame:
    """Sentences (keys, pos, score, size) in order of score until the budget is negative; the overshooting one stays.

    `edge` is added to the score of the first and the last one.
    """
    last = F.max("pos").over(Window.partitionBy(*keys))
    scored = sentences.withColumn("_s", F.col("score") + F.when((F.col("pos") == 0) | (F.col("pos") == last), edge).otherwise(0.0))
    before = F.sum("size").over(Window.partitionBy(*keys).orderBy(F.desc("_s"), "pos").rowsBetween(Window.unboundedPreceding, -1))
    return scored.withColumn("_b", F.coalesce(before, F.lit(0))).where(F.col("_b") <= budget).drop("_b", "_s")


def keep_surprising(tokens: DataFrame, keys: list[str], ratio: float, window: int = 200) -> DataFrame:
    """Tokens (keys, pos, loss) above the int(n ratio) - 1-th largest loss of their window of `window` positions."""
    t = tokens.withColumn("window", F.floor(F.col("pos") / window).cast("long"))
    by = Window.partitionBy(*keys, "window")
    t = t.withColumn("_n", F.count("*").over(by)).withColumn("_r", F.row_number().over(by.orderBy(F.desc("loss"), "pos")))
    at = F.greatest(F.floor(F.col("_n") * ratio).cast("int"), F.lit(1))
    return t.withColumn("_t", F.max(F.when(F.col("_r") == at, F.col("loss"))).over(by)).where(F.col("loss") > F.col("_t")).drop("_n", "_r", "_t")


def keep_probable(words: DataFrame, key: str, reduce: float) -> DataFrame:
    """Words (key, pos, prob, pieces) strictly above the percentile int(100 reduce + 1) of probabilities, each counted once per piece."""
    if reduce <= 0:
        return words
    cut = words.groupBy(key).agg(F.percentile("prob", int(100 * reduce + 1) / 100, F.col("pieces")).alias("_t"))
    return words.join(cut, key).where(F.col("prob") > F.col("_t") + 1e-12).drop("_t")


def recursive_chunks(c: Column, size: int) -> Column:
    """Chunks of at most `size` words: whole lines where they fit, else sentences, else runs of words."""
    fits = lambda x: F.size(tx.words(x)) <= size

    def runs(x):
        w = tx.words(x)
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(w) - 1) / size).cast("int")), lambda k: F.array_join(F.slice(w, k * size + 1, size), " "))

    pieces = lambda x: F.when(fits(x), F.array(x)).otherwise(F.flatten(F.transform(tx.sentences(x), lambda s: F.when(fits(s), F.array(s)).otherwise(runs(s)))))
    return F.filter(F.flatten(F.transform(F.split(c, "\n"), pieces)), lambda x: F.trim(x) != "")


def sure_choice(candidates: DataFrame, duels: DataFrame) -> DataFrame:
    """Best candidate per q_id of (q_id, pos, answer, valid): validity plus its row of the pairwise matrix (q_id, a, b, won); the first of equals."""
    rows = duels.groupBy("q_id", F.col("a").alias("pos")).agg(F.sum("won").alias("wins"))
    total = candidates.join(rows, ["q_id", "pos"], "left").withColumn("total", F.col("valid") + F.coalesce("wins", F.lit(0.0)))
    return total.groupBy("q_id").agg(F.max_by("answer", F.struct("total", -F.col("pos"))).alias("answer"), F.max("total").alias("total"))


USEFULNESS = (-1.0, -0.5, 0.0, 0.5, 1.0)


def critique_score(mean_logprob: Column, relevant: Column, full: Column, partial: Column, none: Column, useful: Column, weights=(1.0, 1.0, 0.5)) -> Column:
    """Self-critique: sequence probability and the weighted shares of the relevance, support and usefulness tokens."""
    support = (full + 0.5 * partial) / (full + partial + none)
    worth = sum((F.lit(u) * useful[k] for k, u in enumerate(USEFULNESS)), F.lit(0.0))
    return F.exp(mean_logprob) + weights[0] * relevant + weights[1] * support + weights[2] * worth


def confident_query(tokens: Column, probs: Column, least: float = 0.2) -> Column:
    """Null if every token is over `least`, else the query made of those that are."""
    sure = F.transform(F.filter(F.arrays_zip(tokens.alias("t"), probs.alias("p")), lambda x: x["p"] > least), lambda x: x["t"])
    return F.when(F.exists(probs, lambda p: p <= least), F.array_join(sure, " "))
