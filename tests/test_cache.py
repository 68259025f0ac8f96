"""The retrieval cache: spliced results, touched partitions, short hits, other sessions."""

import os
import warnings

import pytest
from pyspark.sql import functions as F

from corvid.operators.cache import Cache
from corvid.session import scratch


def questions(spark, ids, text="question {}"):
    return spark.createDataFrame([(i, text.format(i)) for i in ids], "q_id long, text string")


class Searcher:
    """The n-th result of a question is n; questions of 13 have none."""

    def __init__(self):
        self.asked = []

    def __call__(self, queries, k):
        self.asked += sorted(r.text for r in queries.collect())
        ranks = F.explode(F.sequence(F.lit(1).cast("long"), F.lit(k).cast("long"))).alias("rank")
        return queries.where("text not like '%13'").select("q_id", ranks).select("q_id", "rank", F.col("rank").alias("doc_id"), (1.0 / F.col("rank")).alias("score"))


def rows(df):
    return sorted((r.q_id, r["rank"], r.doc_id, r.cached, r.short) for r in df.collect())


def test_misses_are_searched_and_spliced_back(spark):
    cache, search = Cache(spark, scratch(spark, "cache"), 8), Searcher()
    first = rows(cache.ask(questions(spark, [1, 2, 13]), 3, search))
    assert first == [(q, n, n, False, False) for q in (1, 2) for n in (1, 2, 3)]
    again = Cache(spark, cache.path, 8)  # as another session would open it
    both = rows(again.ask(questions(spark, [1, 2, 3, 13]), 3, search))
    assert both == [(q, n, n, q < 3, False) for q in (1, 2, 3) for n in (1, 2, 3)]
    assert search.asked == ["question 1", "question 13", "question 2", "question 3"]  # one without results is no miss again


def test_equal_texts_are_searched_once(spark):
    cache, search = Cache(spark, scratch(spark, "cache"), 4), Searcher()
    same = spark.createDataFrame([(1, "same"), (2, "same")], "q_id long, text string")
    assert rows(cache.ask(same, 2, search)) == [(q, n, n, False, False) for q in (1, 2) for n in (1, 2)]
    assert search.asked == ["same"]


def test_short_hits_are_warned_of(spark):
    cache, search = Cache(spark, scratch(spark, "cache"), 4), Searcher()
    cache.ask(questions(spark, [1]), 2, search).collect()
    with pytest.warns(UserWarning, match="1 cached"):
        got = rows(cache.ask(questions(spark, [1]), 5, search))
    assert got == [(1, 1, 1, True, True), (1, 2, 2, True, True)]
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        assert rows(cache.ask(questions(spark, [1]), 1, search)) == [(1, 1, 1, True, False)]


def test_only_touched_partitions_are_rewritten(spark):
    cache, search = Cache(spark, scratch(spark, "cache"), 16), Searcher()
    cache.ask(questions(spark, range(40)), 2, search).collect()
    folder = cache.path.removeprefix("file:").replace("//", "/")
    before = {s: sorted(os.listdir(f"{folder}/{s}")) for s in os.listdir(folder) if s.startswith("slot=")}
    found = spark.createDataFrame([("question 5", 1, 99, 1.0)], "query string, rank long, doc_id long, score double")
    (slot,) = cache.store(found.select("query"), found, 2)
    after = {s: sorted(os.listdir(f"{folder}/{s}")) for s in os.listdir(folder) if s.startswith("slot=")}
    assert {s for s in after if after[s] != before[s]} == {f"slot={slot}"}
    assert [r.doc_id for r in cache.table().where("query = 'question 5'").collect()] == [99]
    assert cache.table().select("query").distinct().count() == 40


def test_empty_and_null_queries(spark):
    cache, search = Cache(spark, scratch(spark, "cache"), 4), Searcher()
    assert rows(cache.ask(questions(spark, []), 2, search)) == []
    odd = spark.createDataFrame([(1, None), (2, "q")], "q_id long, text string")
    assert [r[0] for r in rows(cache.ask(odd, 1, search))] == [2]
