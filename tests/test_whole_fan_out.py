"""Searches that all have to answer: one that is lost is an error, not a smaller result."""

import threading
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from corvid.operators import forward as fw
from corvid.operators import routing as ro
from corvid.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("where", ["doc_id % 2 = 0", "doc_id % 2 = 1"])
@pytest.mark.parametrize("in_task", [False, True])
def test_two_modalities_need_both(spark, monkeypatch, where, in_task):
    made, build, search = [], fw.build, fw.Forward.search

    def broken(self, queries, k, condition="true", **more):
        hits = search(self, queries, k, condition, **more)
        if condition != where:
            return hits
        if in_task:
            return hits.withColumn("score", F.when(F.col("score") >= 0, F.raise_error(F.lit("this modality is lost"))).otherwise(F.col("score")))
        raise ConnectionError("this modality is lost")

    monkeypatch.setattr(fw, "build", lambda docs, path, **more: made.append(path) or build(docs, path, **more))
    monkeypatch.setattr(fw.Forward, "search", broken)
    with pytest.raises(RuntimeError, match="this modality is lost"):
        registry.queries()["pl18_two_modalities"](spark, SF)
    assert made and not any(Path(p.removeprefix("file:")).exists() for p in made)


def test_the_others_are_ended(spark):
    good = spark.createDataFrame([(1, 2)], "q_id long, doc_id long")

    @F.udf("long")
    def wait(x):
        time.sleep(600)
        return x

    def slow():
        for _ in range(20):  # jobs that begin after the first was cancelled
            try:
                good.select("q_id", wait("doc_id").alias("doc_id")).collect()
            except Exception:  # noqa: BLE001
                if done.is_set():
                    raise
                done.set()
        return good

    def broken():
        time.sleep(3)
        raise OSError("down")

    done, start, before = threading.Event(), time.time(), threading.active_count()
    with pytest.raises(RuntimeError, match="source broken is lost: down") as raised:
        ro.fan_out({"slow": slow, "broken": broken, "good": lambda: good}, whole=True)
    assert isinstance(raised.value.__cause__, OSError)
    assert done.is_set() and time.time() - start < 120 and threading.active_count() <= before + 1


def test_a_late_source_is_an_error(spark):
    good = spark.createDataFrame([(1, 2)], "q_id long, doc_id long")
    wait = F.udf(lambda x: time.sleep(600) or x, "long")
    with pytest.raises(RuntimeError, match="source slow is lost: no result within 8 seconds"):
        ro.fan_out({"good": lambda: good, "slow": lambda: good.select("q_id", wait("doc_id").alias("doc_id"))}, seconds=8, whole=True)
    got = ro.fan_out({"a": lambda: good, "b": lambda: good}, seconds=float("inf"), whole=True)
    assert sorted((r.q_id, r.source) for r in got.collect()) == [(1, "a"), (1, "b")]
