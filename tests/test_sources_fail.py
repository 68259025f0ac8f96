"""Fan-out over sources that fail in tasks or never end, and models that run out of memory."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvid.operators import generation as gn
from corvid.operators import routing as ro


def test_a_source_that_fails_in_a_task_is_left_out(spark):
    good = spark.createDataFrame([(1, 2)], "q_id long, doc_id long")
    bad = lambda: good.select("q_id", F.when(F.col("doc_id") > 0, F.raise_error(F.lit("lost"))).otherwise(F.col("doc_id")).alias("doc_id"))
    with pytest.warns(UserWarning, match="source bad is left out"):
        assert [(r.q_id, r.source) for r in ro.fan_out({"bad": bad, "good": lambda: good}).collect()] == [(1, "good")]
    with pytest.warns(UserWarning), pytest.raises(RuntimeError, match="no source"):
        ro.fan_out({"bad": bad})


def test_a_source_that_never_ends_is_cancelled(spark):
    good = spark.createDataFrame([(1, 2)], "q_id long, doc_id long")

    @F.udf("long")
    def wait(x):
        time.sleep(600)
        return x

    start = time.time()
    with pytest.warns(UserWarning, match="no result within"):
        got = ro.fan_out({"slow": lambda: good.select("q_id", wait("doc_id").alias("doc_id")), "good": lambda: good}, seconds=30)
    assert [r.source for r in got.collect()] == ["good"] and time.time() - start < 300


def test_batches_keep_to_the_budget_and_halve():
    seen = []

    def call(part):
        seen.append(part)
        if sum(part) > 40:
            raise MemoryError
        return [2 * x for x in part]

    items = [9, 1, 30, 4, 4, 12, 2, 7, 3]
    assert ro.by_budget(call, items, items, 100) == [2 * x for x in items]
    done = [p for p in seen if sum(p) <= 40]
    assert sorted(x for p in done for x in p) == sorted(items) and len(seen) > len(done)
    assert all(len(p) * max(p) <= 100 for p in seen)
    assert ro.by_budget(call, [], [], 10) == []
    with pytest.raises(MemoryError):
        ro.by_budget(call, [50], [50], 10)


class Small(ro.Encoder):
    """A model that can't take more than four texts at once."""

    def encode(self, texts):
        if len(texts) > 4:
            raise MemoryError
        return np.array([[len(x), 1.0] for x in texts])


class Echo(gn.Generator):
    def generate(self, prompts, stop=(), max_words=None):
        if len(prompts) > 3:
            raise MemoryError
        return [p.upper() for p in prompts]


def test_seams_back_off(spark):
    rows = spark.createDataFrame([(k, "x" * (k % 7)) for k in range(50)] + [(50, None)], "id long, text string").coalesce(1)
    got = {r.id: list(r.embedding) for r in Small().apply(rows).collect()}
    assert got == {k: [float(k % 7), 1.0] for k in range(50)} | {50: [0.0, 1.0]}
    assert {r.id: r.pred for r in Echo().apply(rows, "text").collect()} == {k: "X" * (k % 7) for k in range(50)} | {50: ""}
