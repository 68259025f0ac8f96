"""Query sets of several blocks."""

from corvid.operators import retrieval as rt


def test_blas_search_answers_all_queries(spark, monkeypatch):
    rows = [(n, [float(n % 7), float(n % 5), float(n % 3)]) for n in range(60)]
    vectors = spark.createDataFrame(rows, "item long, v array<double>")
    queries = vectors.where("item % 2 = 0").selectExpr("item as q_id", "v as q")
    key = lambda df: sorted((r.q_id, r["rank"], r.item, r.score) for r in df.collect())
    whole = key(rt.dense_search(vectors, queries, 4))
    assert len({r[0] for r in whole}) == 30
    monkeypatch.setattr(rt, "SMALL", 7)
    assert key(rt.blas_search(vectors, queries, 4)) == whole
    monkeypatch.setattr(rt, "WIDTH", 2)
    assert key(rt.blas_search(vectors, queries, 4)) == whole
    assert rt.blas_search(vectors, queries.limit(0), 4).count() == 0


def test_dense_search_answers_all_queries(spark, monkeypatch):
    rows = [(n, [float(n % 7), float(n % 5), float(n % 3)]) for n in range(60)]
    vectors = spark.createDataFrame(rows, "item long, v array<double>")
    queries = vectors.where("item % 2 = 0").selectExpr("item as q_id", "v as q")
    key = lambda df: sorted((r.q_id, r["rank"], r.item, r.score) for r in df.collect())
    whole = key(rt.dense_search(vectors, queries, 4)), key(rt.dense_search(vectors, queries, 4, rt.squared_distance, True))
    monkeypatch.setattr(rt, "SMALL", 7)
    assert key(rt.dense_search(vectors, queries, 4)) == whole[0]
    assert key(rt.dense_search(vectors, queries, 4, rt.squared_distance, True)) == whole[1]
