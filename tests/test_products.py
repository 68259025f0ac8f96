"""Dense search by products: the expressions' results, odd vectors, and pairs that never leave their task."""

import numpy as np
from pyspark.sql import functions as F

from corvid.operators import retrieval as rt


def key(df):
    return sorted((r.q_id, r["rank"], r.item, r.score) for r in df.collect())


def both(vectors, queries, k, monkeypatch):
    """The search by products, and by expressions as another metric would be."""
    for metric, up in ((rt.dot, False), (rt.squared_distance, True)):
        other = lambda a, b, metric=metric: metric(a, b)
        want = key(rt.dense_search(vectors, queries, k, other, up))
        assert want and key(rt.dense_search(vectors, queries, k, metric, up)) == want


def test_products_give_the_expressions_results(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(n, [float(x) for x in rng.normal(size=8) * 10 ** (n % 4)]) for n in range(300)] + [(1000 + n, [1.0] * 8) for n in range(100)]
    vectors = spark.createDataFrame(rows, "item long, v array<double>").repartition(3)
    queries = vectors.where("item % 20 = 0").select(F.col("item").alias("q_id"), F.col("v").alias("q"))
    both(vectors, queries, 6, monkeypatch)
    monkeypatch.setattr(rt, "WIDTH", 3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        both(vectors, queries, 6, monkeypatch)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_nulls_and_other_lengths_have_no_score(spark, monkeypatch):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [0.5, 0.5]), (4, [1.0])]
    vectors = spark.createDataFrame(rows, "item long, v array<double>")
    queries = vectors.where("item < 2").select(F.col("item").alias("q_id"), F.col("v").alias("q"))
    for metric, up in ((rt.dot, False), (rt.squared_distance, True)):
        other = lambda a, b, metric=metric: metric(a, b)
        got, want = (rt.dense_search(vectors, queries, 4, m, up).collect() for m in (metric, other))
        as_rows = lambda found: sorted((r.q_id, r["rank"], r.item, str(r.score)) for r in found)
        assert as_rows(got) == as_rows(want) and len(got) == 8


def test_pairs_stay_in_their_task(spark):
    vectors = spark.range(0, 4000, 1, 4).select(F.col("id").alias("item"), F.array(*[F.sin(F.col("id") * k) for k in range(1, 9)]).alias("v"))
    queries = vectors.where("item % 20 = 0").select(F.col("item").alias("q_id"), F.col("v").alias("q"))
    plan = rt.dense_search(vectors, queries, 10)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
