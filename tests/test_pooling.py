"""Pooling of token vectors, rankers by brute force."""

import zlib

import pytest
from pyspark.sql import functions as F

from corvid.operators import routing as ro
from corvid.plans import refine_queries, registry

SF = "/root/testdata/sf0.001"


def test_pooling_with_masks(spark):
    rows = [(1, [[1.0, 2.0], [3.0, 6.0], [9.0, 9.0]], [True, True, False]), (2, [[1.0, 2.0]], [False]), (3, [], []), (4, [[5.0, 7.0]], [True]), (5, None, None)]
    df = spark.createDataFrame(rows, "id int, t array<array<double>>, m array<boolean>")
    got = {r.id: (r.a, r.b) for r in df.select("id", ro.pooled_vector(F.col("t"), F.col("m")).alias("a"), ro.pooled_vector(F.col("t"), F.col("m"), "cls").alias("b")).collect()}
    assert got == {1: ([2.0, 4.0], [1.0, 2.0]), 2: (None, [1.0, 2.0]), 3: (None, None), 4: ([5.0, 7.0], [5.0, 7.0]), 5: (None, None)}
    with pytest.raises(ValueError):
        ro.pooled_vector(F.col("t"), F.col("m"), "max")
    with pytest.raises(ValueError):
        ro.pooled_vector(F.col("t"), F.col("m"), "pooler")


def test_ranking_by_compression(spark):
    def distance(a, b):
        m, n, both = (len(zlib.compress(x.encode())) for x in (a, b, f"{a} {b}"))
        return round((both - min(m, n)) / max(m, n), 6)

    rows = [(1, 10, "the red fox", "the red fox runs"), (1, 11, "the red fox", "quite other things"), (2, 10, "things", "the red fox runs")]
    c = spark.createDataFrame(rows, "q_id long, doc_id long, query string, text string")
    got = {(r.q_id, r.doc_id): round(-r.s, 6) for r in refine_queries.gzip_scores(c).collect()}
    assert got == {(q, k): distance(a, b) for q, k, a, b in rows}


def test_new_rankers_rank_the_same_contexts(spark):
    one, two = (registry.queries()[n](spark, SF).collect() for n in ("rf10_by_gzip", "rf10_rank_contexts"))
    assert {(r.q_id, r.doc_id) for r in one} == {(r.q_id, r.doc_id) for r in two}
