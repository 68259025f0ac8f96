"""A lasting retrieval cache: results by query text, kept between sessions, changed by touched partition.

The table lies in a folder as parquet, in partitions by the hash of the query. Storing results
rewrites only the partitions that new queries fall into, and writes them before the old ones
go, so a session that ends in between leaves the cache as it was. Asking takes each query's
cached results, searches the misses alone, stores what was found, and gives one list.
"""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.session import delete

from .loops import settled

SCHEMA = "query string, rank long, doc_id long, score double, depth long, slot int"


@dataclass
class Cache:
    """A cache in a folder that all machines share. slots: partitions of the table."""

    spark: SparkSession
    path: str
    slots: int = 64

    def _slot(self):
        return F.pmod(F.xxhash64("query"), F.lit(self.slots)).cast("int")

    def _folder(self, slot: int) -> str:
        return f"{self.path}/slot={slot}"

    def _exists(self, path: str) -> bool:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(where)

    def table(self) -> DataFrame:
        """(query, rank, doc_id, score, depth, slot); depth is how many results were asked for. A query
        without results has one row of rank 0."""
        if not self._exists(self.path):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).option("basePath", self.path).parquet(f"{self.path}/slot=*") if self._slots() else self.spark.createDataFrame([], SCHEMA)

    def _slots(self) -> list[int]:
        jvm = self.spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(self.path)
        found = where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).listStatus(where)
        return [int(n.split("=")[1]) for n in (s.getPath().getName() for s in found) if n.startswith("slot=")]

    def store(self, asked: DataFrame, found: DataFrame, depth: int) -> list[int]:
        """Puts results found (query, rank, doc_id, score) of all queries asked (query) in the place of
        older ones; returns the partitions that were rewritten."""
        new = asked.select("query").where("query is not null").dropDuplicates().join(found.select("query", F.col("rank").cast("long").alias("rank"), F.col("doc_id").cast("long").alias("doc_id"), F.col("score").cast("double").alias("score")), "query", "left")
        new = settled(new.withColumn("rank", F.coalesce("rank", F.lit(0).cast("long"))).withColumn("depth", F.lit(depth).cast("long")).withColumn("slot", self._slot()))
        touched = sorted(r.slot for r in new.select("slot").distinct().collect())  # `slots` at most
        if not touched:
            return []
        old = self.table().where(F.col("slot").isin(touched)).join(new.select("query").distinct(), "query", "left_anti")
        fresh = f"{self.path}-{uuid.uuid4().hex}"
        old.select(*new.columns).unionByName(new).repartition("slot").sortWithinPartitions("slot", "query", "rank").write.partitionBy("slot").parquet(fresh)
        fs_path = self.spark._jvm.org.apache.hadoop.fs.Path
        fs = fs_path(self.path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        fs.mkdirs(fs_path(self.path))
        for slot in touched:  # each is moved in whole
            fs.delete(fs_path(self._folder(slot)), True)
            fs.rename(fs_path(f"{fresh}/slot={slot}"), fs_path(self._folder(slot)))
        delete(self.spark, fresh)
        self.spark.catalog.refreshByPath(self.path)
        return touched

    def ask(self, queries: DataFrame, k: int, search: Callable[[DataFrame, int], DataFrame]) -> DataFrame:
        """(q_id, rank, doc_id, score, cached, short) for queries (q_id, text), the k best of each.

        search(queries, k) gives (q_id, rank, doc_id, score) of the misses. `short` marks cached results
        that were asked with a smaller depth and are fewer than k; they are used as they are, with a warning.
        Null queries have no results.
        """
        asked = settled(queries.select("q_id", F.col("text").alias("query")).where("query is not null"))
        slots = [r.slot for r in asked.select(self._slot().alias("slot")).distinct().collect()]  # `slots` at most
        held = self.table().where(F.col("slot").isin(slots))
        known = settled(asked.join(held, "query").select("q_id", "query", "rank", "doc_id", "score", "depth"))
        size = known.groupBy("q_id").agg(F.sum((F.col("rank") > 0).cast("long")).alias("size"), F.max("depth").alias("depth"))
        hits = known.join(size.select("q_id", ((F.col("size") < k) & (F.col("depth") < k)).alias("short")), "q_id").where((F.col("rank") > 0) & (F.col("rank") <= k))
        n_short = size.where((F.col("size") < k) & (F.col("depth") < k)).count()
        if n_short:
            warnings.warn(f"{n_short} cached queries have fewer than {k} results", stacklevel=2)
        misses = asked.join(known.select("q_id").distinct(), "q_id", "left_anti")
        # one search for each text, whatever the number of its questions
        first = misses.groupBy("query").agg(F.min("q_id").alias("q_id"))
        found = settled(search(first.select("q_id", F.col("query").alias("text")), k).join(first, "q_id").select("query", F.col("rank").cast("long").alias("rank"), "doc_id", "score"))
        self.store(first.select("query"), found, k)
        new = misses.join(found, "query").select("q_id", "rank", "doc_id", "score", F.lit(False).alias("cached"), F.lit(False).alias("short"))
        return hits.select("q_id", "rank", "doc_id", "score", F.lit(True).alias("cached"), "short").unionByName(new)
