"""Connectors over small files, and the chunkers that have no SQL."""

import pytest
from pyspark.sql import functions as F

from corvid.operators import compression as cp
from corvid.sources import files


def test_csv(spark, tmp_path):
    (tmp_path / "w.csv").write_text('web_id,title,text\n1,T,"a long enough\ntext, said ""x"""\n,T,no id at all here\n3,,short\n4,,\n')
    path = str(tmp_path / "w.csv")
    assert [(r.id, r.text) for r in files.read_websites(spark, path).collect()] == [("1", 'a long enough\ntext, said "x"')]
    assert {r.id for r in files.read_websites(spark, path, validate=False).collect()} == {"1", "3", "4"}
    assert {r.reason: r.n for r in files.skipped_websites(spark, path).collect()} == {"missing id": 1, "short": 1, "empty": 1}
    (tmp_path / "q.csv").write_text("q_id,query\n1,what\n0,zero\nx,word\n3,\n")
    assert [tuple(r) for r in files.read_questions(spark, str(tmp_path / "q.csv")).collect()] == [(1, "what")]


def test_jsonl_and_splits(spark, tmp_path):
    (tmp_path / "test.jsonl").write_text('{"id": "b", "title": "é", "text": "x"}\n\n{broken\n{"id": "a", "title": "t", "text": "y"}\n')
    rows = files.read_corpus(spark, str(tmp_path / "test.jsonl"))
    assert sorted((r.id, r.contents) for r in rows.collect()) == [("a", "t\ny"), ("b", "é\nx")]
    files.write_jsonl(rows, str(tmp_path / "out.jsonl"))
    assert files.read_corpus(spark, str(tmp_path / "out.jsonl")).count() == 2
    assert files.find_split(spark, str(tmp_path), "test").endswith("test.jsonl") and files.find_split(spark, str(tmp_path), "dev") is None
    assert files.read_split(spark, str(tmp_path), "test", "id string", 1).first().id == "a"
    assert files.read_split(spark, str(tmp_path), "test", "id string", 1, seed=3).count() == 1
    with pytest.raises(ValueError):
        files.read_corpus(spark, "x.txt")


def test_wiki_dump(spark, tmp_path):
    (tmp_path / "AA").mkdir()
    (tmp_path / "AA" / "wiki_00").write_text('{"id": "1", "title": "A", "text": "[[b|c]] d"}\n{"id": "2", "title": "List of x", "text": "y"}\n')
    assert [tuple(r) for r in files.read_wiki_dump(spark, str(tmp_path)).collect()] == [("1", "A", "c d")]


def test_recursive_chunks(spark):
    text = "a b c\n" + "One two three. Four five! " + " ".join("w%d" % k for k in range(11)) + "\n\nend"
    got = spark.createDataFrame([(text,), (None,), ("",)], "t string").select(cp.recursive_chunks(F.col("t"), 4).alias("x")).collect()
    assert " ".join(got[0].x).split() == text.split() and max(len(x.split()) for x in got[0].x) <= 4
    assert got[1].x is None and got[2].x == []


def test_combined_score(spark):
    rows = spark.createDataFrame([(2.0, 0.5, 0.1, 0.0), (0.0, 0.5, 0.1, 0.0), (0.0, 0.0, 0.1, 0.2)], "r double, n double, h double, d double")
    got = rows.select(F.round(cp.combined_score(*(F.col(c) for c in "rnhd")), 6).alias("x")).collect()
    assert [r.x for r in got] == [1.51, 0.34, 0.13]


def test_gzip_distance(spark):
    rows = spark.createDataFrame([("the cat sat " * 9, "the cat sat " * 9, "zq xj kv wp " * 9), (None, None, "x")], "a string, b string, c string")
    got = rows.select(cp.gzip_distance("a", "b").alias("x"), cp.gzip_distance("a", "c").alias("y")).collect()
    assert got[0].x < got[0].y and got[1].x is not None
