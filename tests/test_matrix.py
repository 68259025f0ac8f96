"""The data sources: ranges, pushed filters, commits and aborts, a failing service."""

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvid.session import table
from corvid.sources.matrix import MatrixReader, MatrixSource, Rows, search_source


@pytest.fixture(scope="module")
def session(spark):
    spark.dataSource.register(MatrixSource)
    return spark


def vectors(spark):
    return table(spark, "/root/testdata/sf0.01", "embeddings").select(F.col("vec_id").alias("row"), F.col("embedding").alias("v"))


def write(df, path, mode="append"):
    df.write.format("f32matrix").mode(mode).option("path", path).save()


def test_round_trip_and_raw_bytes(session, tmp_path):
    path, v = str(tmp_path / "m"), vectors(session).repartitionByRange(3, "row").sortWithinPartitions("row")
    write(v, path)
    want = {r.row: r.v for r in v.collect()}
    back = session.read.format("f32matrix").option("partitionRows", 70).load(path)
    assert {r.row: r.v for r in back.collect()} == want
    files = [n for n, _ in json.load(open(f"{path}/manifest.json"))["files"]]
    raw = b"".join(open(f"{path}/{n}", "rb").read() for n in files)
    assert raw == np.array([want[k] for k in sorted(want)], "<f4").tobytes()
    (tmp_path / "bare.f32").write_bytes(raw)  # as another program would write it
    bare = session.read.format("f32matrix").option("columns", 64).load(str(tmp_path / "bare.f32"))
    assert {r.row: r.v for r in bare.collect()} == want


def test_ranges_skip_partitions_and_bytes(session, tmp_path):
    (tmp_path / "x.f32").write_bytes(np.arange(3000, dtype="<f4").tobytes())
    reader = MatrixReader({"path": str(tmp_path / "x.f32"), "columns": "3", "partitionrows": "100", "firstrow": "250", "endrow": "421"})
    assert [(p.first, p.last) for p in reader.partitions()] == [(250, 350), (350, 421)]
    read = lambda low, end: session.read.format("f32matrix").option("columns", 3).option("partitionRows", 100).option("firstRow", low).option("endRow", end).load(str(tmp_path / "x.f32"))
    assert [r.v for r in read(250, 255).orderBy("row").collect()] == [[3.0 * k, 3.0 * k + 1, 3.0 * k + 2] for k in range(250, 255)]
    assert read(250, 255).rdd.getNumPartitions() == 1 and read(0, 5000).rdd.getNumPartitions() == 10
    whole = read(0, 5000)
    assert (whole.where("row < 2").count(), whole.count(), read(5000, 6000).count()) == (2, 1000, 0)


def test_a_failed_write_leaves_the_old_matrix(session, tmp_path):
    path = str(tmp_path / "m")
    good = session.createDataFrame([(k, [float(k), 1.0]) for k in range(10)], "row long, v array<float>")
    write(good, path)
    broken = good.repartition(4).withColumn("v", F.when(F.col("row") == 7, F.array(F.lit(1.0).cast("float"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="one length"):
        write(broken, path, "overwrite")
    assert session.read.format("f32matrix").load(path).count() == 10
    with pytest.raises(Exception, match="holds a matrix"):
        write(good, path)
    write(good.limit(3), path, "overwrite")
    assert session.read.format("f32matrix").load(path).count() == 3
    assert len([f for f in os.listdir(path) if f in {n for n, _ in json.load(open(f"{path}/manifest.json"))["files"]}]) == len(json.load(open(f"{path}/manifest.json"))["files"])


def test_empty_and_short_files(session, tmp_path):
    write(vectors(session).limit(0), str(tmp_path / "none"))
    assert session.read.format("f32matrix").load(str(tmp_path / "none")).count() == 0
    (tmp_path / "odd.f32").write_bytes(b"12345")
    with pytest.raises(Exception, match="no rows of"):
        session.read.format("f32matrix").option("columns", 1).load(str(tmp_path / "odd.f32")).count()
    (tmp_path / "short.f32").write_bytes(np.arange(4, dtype="<f4").tobytes())
    reader = MatrixReader({"path": str(tmp_path / "short.f32"), "columns": "2"})
    with pytest.raises(OSError, match="ends early"):
        list(reader.read(Rows(str(tmp_path / "short.f32"), 2, 0, 0, 9)))


def test_a_service_that_fails_for_some_queries(session):
    def fetch(query, n):
        if query == "bad":
            raise TimeoutError("no answer")
        return [{"title": f"{query} {k}", "url": f"https://example.org/{k}"} for k in range(n + 2)]

    session.dataSource.register(search_source(fetch))
    read = session.read.format("websearch").option("queries", json.dumps([[1, "one"], [2, "bad"], [3, "three"]])).option("num", 2).option("pause", 0).option("partitionQueries", 1)
    got = [(r.q_id, r["rank"], r.title) for r in read.load().orderBy("q_id", "rank").collect()]
    assert got == [(1, 1, "one 0"), (1, 2, "one 1"), (3, 1, "three 0"), (3, 2, "three 1")]
    assert session.read.format("websearch").option("queries", "[]").load().count() == 0
