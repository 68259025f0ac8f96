"""Rows that repeat a document in another input partition."""

import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from corvid.llm import suffixdedup

from .conftest import frame


def test_suffix_dedup_keeps_a_document_of_two_partitions(spark):
    r = random.Random(6)
    say = lambda k: " ".join(f"w{r.randrange(5000)}" for _ in range(k))
    passage = say(60)
    rows = [(1, say(200), "en", "s"), (2, passage + " " + say(50), "en", "s"), (3, say(40) + " " + passage, "en", "s")]
    docs = frame(spark, rows * 2)
    assert docs.select("doc_id", F.spark_partition_id()).distinct().count() == 6
    got = suffixdedup.dedup(docs).collect()
    assert len(got) == 6
    kept = {n: hashlib.sha256(t.encode()).hexdigest() for n, t, *_ in rows}
    for row in got:
        if row.doc_id < 3:
            assert (row.n_removed, row.n_spans, row.kept_sha256) == (0, 0, kept[row.doc_id])
        else:
            assert row.n_removed >= len(passage)
    assert len({tuple(row) for row in got}) == 3


def test_rows_of_one_document_in_two_tasks_are_no_repeat(spark):
    r = random.Random(7)
    text = " ".join(f"w{r.randrange(5000)}" for _ in range(200))
    _, at, _, _ = suffixdedup.anchors(np.frombuffer(text.encode(), np.uint8))
    places = [bytearray(at.astype(np.int32).tobytes())]
    joined = spark.createDataFrame(spark.sparkContext.parallelize([(1, text, places)] * 2, 2), "doc_id long, text string, lists array<binary>")
    assert joined.select(F.spark_partition_id()).distinct().count() == 2
    assert suffixdedup.repeated_anchors(joined.select("doc_id", "text"), 3).count() == 0
    assert suffixdedup.contexts(joined).count() == 2 * len(at)
    assert suffixdedup.marks(suffixdedup.contexts(joined), 3).count() == 0
