"""Session construction and table access shared by queries, tests and the bench."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def local_session(cpus: int | None = None, memory: str = "12g", partitions: int = 8) -> SparkSession:
    """A single-JVM session for tests and benches; on a cluster use the one that is there."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("corvid")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows of few files over all cores: a file of one row group is one task, however many splits it has.

    Tables of at least as many files as cores are left alone, so large ones are never shuffled here.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or the one set on the context.

    Where neither is set, a session of one machine uses that machine's temporary folder, and a
    cluster a folder of its warehouse; a cluster never gets a folder of one machine.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    context = spark.sparkContext
    held = context._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get()
    if context.master.split("[")[0] == "local":
        return "file://" + os.path.join(tempfile.gettempdir(), f"corvid-{os.getpid()}")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/corvid-scratch"


_scratch: list[tuple[SparkSession, str]] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one, deleted when the process ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _scratch.append((spark, path))
    return path


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """The shuffles of what is written within are deleted when a write ends, as nothing reads them again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@atexit.register
def _clean() -> None:
    for spark, path in _scratch:
        try:
            delete(spark, path)
        except Exception:  # noqa: BLE001  the JVM may have ended before; the folder is scratch
            return
