"""Rows without an id in the pipeline's quality rules."""

import corpus_pipeline


def test_quality_rules_judge_rows_of_null_ids(spark):
    good = " ".join(f"word{k}" for k in range(40))
    rows = [(1, good, "en", "s", 7), (None, good + " more", "en", "s", 8), (None, "too short", "en", "s", 9), (2, None, "en", "s", None), (3, "short", None, "s", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.quality_rules(spark, docs, "")
    assert got.columns == docs.columns and [f.dataType for f in got.schema] == [f.dataType for f in docs.schema]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(rows[:2], key=str)
