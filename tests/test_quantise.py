"""Product quantisation: recall with a quarter of the cells, passes of queries, codes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvid.operators import quantise as qz
from corvid.operators import retrieval as rt
from corvid.session import scratch, table

DATA = "/root/testdata"


def sets(spark, sf):
    v = table(spark, f"{DATA}/{sf}", "embeddings")
    return v.select(F.col("vec_id").alias("item"), F.col("embedding").alias("v")), v.where("vec_id % 20 = 0").select(F.col("vec_id").alias("q_id"), F.col("embedding").alias("q"))


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_with_a_quarter_of_the_cells(spark, sf):
    v, q = sets(spark, sf)
    index = qz.build(v, scratch(spark, "pq"))
    got = {(r.q_id, r.item): r.score for r in qz.search(index, q, 10).collect()}
    want = {(r.q_id, r.item): r.score for r in rt.blas_search(v, q, 10).collect()}
    recall = len(got.keys() & want.keys()) / len(want)
    print(sf, "recall", recall)
    assert recall >= 0.9
    assert all(got[x] == want[x] for x in got.keys() & want.keys())  # exact scores
    r = index.codes().agg(F.count("*").alias("n"), F.max(F.length("code")).alias("width"), F.count_distinct("item").alias("items")).first()
    assert r.width == 16 and r.items == v.count() and r.n == 2 * r.items


def test_all_cells_and_deep_candidates_are_exact(spark, monkeypatch):
    v, q = sets(spark, "sf0.001")
    index = qz.build(v, scratch(spark, "pq"), parts=8, copies=1)
    monkeypatch.setattr(qz, "PASS_BYTES", 8 * 256 * 4 * 7)  # seven queries a pass
    rows = lambda df: sorted((r.q_id, r["rank"], r.item) for r in df.collect())
    assert rows(qz.search(index, q, 5, share=1.0, depth=10**6)) == rows(rt.dense_search(v, q, 5))


def test_clustered_vectors_need_few_cells(spark):
    r = np.random.default_rng(2)
    x = (r.normal(size=(40, 32))[r.integers(0, 40, 3000)] + 0.1 * r.normal(size=(3000, 32))).astype(float)
    v = spark.createDataFrame([(k, row.tolist()) for k, row in enumerate(x)], "item long, v array<float>")
    q = v.where("item % 50 = 0").select(F.col("item").alias("q_id"), F.col("v").alias("q"))
    index = qz.build(v, scratch(spark, "pq"), cells=64, parts=8, copies=1)
    want = {(a.q_id, a.item) for a in rt.blas_search(v, q, 10).collect()}
    got = {(a.q_id, a.item) for a in qz.search(index, q, 10, share=0.1).collect()}
    assert len(got & want) >= 0.9 * len(want)


def test_odd_input(spark):
    one = spark.createDataFrame([(1, [1.0, 0.0])], "item long, v array<float>")
    index = qz.build(one, scratch(spark, "pq"), parts=2)
    asked = spark.createDataFrame([(7, [1.0, 1.0])], "q_id long, q array<float>")
    assert [(r.item, r.score) for r in qz.search(index, asked, 3).collect()] == [(1, 1.0)]
    assert qz.search(index, asked.limit(0), 3).count() == 0
    with pytest.raises(ValueError):
        qz.build(one.limit(0), scratch(spark, "pq"))
    with pytest.raises(ValueError):
        qz.build(one, scratch(spark, "pq"), parts=3)
