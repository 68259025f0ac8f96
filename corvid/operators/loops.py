"""Iterative retrieve-and-generate dataflows: bounded driver loops over keyed state tables.

The generator is a seam; its offline stand-in answers with the first sentence of the best
document. Each round's state is checkpointed to the shared folder, so lineage stays short and
a lost executor costs one round.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvid.session import scratch, shared_dir

from .retrieval import few_of, sparse_search


def settled(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """settled() for loops of many turns: a table in the shared folder, read back. A checkpoint keeps the
    constraints that Spark infers of its plan, and they double with each turn."""
    path = scratch(df.sparkSession, "turn")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def answer(hits: DataFrame, texts: DataFrame) -> DataFrame:
    """(q_id, answer): the first sentence of the best document."""
    return hits.where("rank = 1").join(texts, "doc_id").select("q_id", F.regexp_extract("text", r"^([^.!?\n]*)", 1).alias("answer"))


def iterate(spark: SparkSession, queries: DataFrame, index: DataFrame, texts: DataFrame, rounds: int, k: int = 5) -> DataFrame:
    """(q_id, answer, rounds) after a fixed number of rounds."""
    index = settled(index)
    state = queries.select("q_id", "text", F.lit("").alias("answer"))
    for _ in range(rounds):
        asked = state.select("q_id", F.concat_ws(" ", "text", "answer").alias("text"))
        found = answer(sparse_search(index, asked, k), texts)
        state = settled(state.select("q_id", "text").join(found, "q_id", "left").select("q_id", "text", F.coalesce("answer", F.lit("")).alias("answer")))
    return state.select("q_id", "answer", F.lit(rounds).alias("rounds"))


def pooled(queries: DataFrame, search: Callable[[DataFrame, int], DataFrame], texts: DataFrame, rounds: int, k: int) -> DataFrame:
    """(q_id, doc_id, score, place): every query's pool, worst first; a query without a new answer stops."""
    active, pool = queries.select("q_id", "text"), None
    few = few_of(queries)
    for _ in range(rounds):
        found = written(search(active, k))
        pool = found.select("q_id", "doc_id", "score") if pool is None else pool.unionByName(found.select("q_id", "doc_id", "score"))
        pool = written(pool.groupBy("q_id", "doc_id").agg(F.max("score").alias("score")))
        active = written(active.join(answer(few(found), texts).where("answer <> ''"), "q_id").select("q_id", F.concat_ws(" ", "text", "answer").alias("text")))
        if active.isEmpty():
            break
    return pool.withColumn("place", F.row_number().over(Window.partitionBy("q_id").orderBy("score", F.desc("doc_id"))))
