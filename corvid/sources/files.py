"""File connectors: CSV and JSONL corpora, question sets, splits and dumps.

All read through Spark's own readers, so paths of any store that Spark knows work.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.functions import text as tx

FORMATS = ("jsonl", "json", "parquet")


def _csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.csv(path, schema=schema, header=True, multiLine=True, quote='"', escape='"')


def skip_reason(key: Column, title: Column, text: Column) -> Column:
    """Why a row of a corpus is skipped, or null."""
    return F.when(F.coalesce(F.trim(key), F.lit("")) == "", "missing id").otherwise(tx.quality_reason(text, title))


def read_websites(spark: SparkSession, path: str, validate: bool = True, mode: str | None = None) -> DataFrame:
    """(id, title, text, contents) of a CSV of (web_id, title, text); rows without an id always go, rejected texts if `validate`."""
    reason = skip_reason(F.col("web_id"), F.col("title"), F.col("text"))
    rows = _csv(spark, path, "web_id string, title string, text string").withColumn("reason", reason)
    rows = rows.where(F.col("reason").isNull() if validate else (F.col("reason").isNull() | (F.col("reason") != "missing id")))
    title, body = (tx.clean_text(F.coalesce(F.col(c), F.lit(""))) for c in ("title", "text"))
    if mode is not None:
        title, body = tx.normalize_for_retrieval(title, mode), tx.normalize_for_retrieval(body, mode)
    return rows.select(F.trim("web_id").alias("id"), title.alias("title"), body.alias("text")).withColumn("contents", F.concat_ws("\n", "title", "text"))


def skipped_websites(spark: SparkSession, path: str) -> DataFrame:
    """(reason, n) of the rows that read_websites skips."""
    rows = _csv(spark, path, "web_id string, title string, text string")
    return rows.select(skip_reason(F.col("web_id"), F.col("title"), F.col("text")).alias("reason")).where("reason IS NOT NULL").groupBy("reason").agg(F.count("*").alias("n"))


def read_questions(spark: SparkSession, path: str) -> DataFrame:
    """(q_id, query) of a CSV; ids that aren't positive and empty queries go."""
    rows = _csv(spark, path, "q_id string, query string").select(F.expr("try_cast(trim(q_id) AS bigint)").alias("q_id"), F.trim("query").alias("query"))
    return rows.where((F.col("q_id") > 0) & (F.col("query") != ""))


def read_jsonl(spark: SparkSession, path: str, schema: str, recursive: bool = False) -> DataFrame:
    """Rows of JSON lines; blank and malformed lines go."""
    return spark.read.json(path, schema=schema, mode="DROPMALFORMED", recursiveFileLookup=recursive)


def write_jsonl(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path, ignoreNullFields=False)


def read_corpus(spark: SparkSession, path: str, schema: str = "id string, title string, text string, contents string") -> DataFrame:
    """A corpus of JSONL or parquet with `contents` (else the text under the title)."""
    if path.rstrip("/").endswith(".parquet"):
        rows = spark.read.parquet(path)
    elif path.rstrip("/").endswith((".jsonl", ".json")):
        rows = read_jsonl(spark, path, schema)
    else:
        raise ValueError(f"no corpus format is known for {path}")
    have = [F.col(c) for c in ("title", "text") if c in rows.columns]
    made = F.concat_ws("\n", *have) if have else F.lit(None).cast("string")
    return rows.withColumn("contents", F.coalesce(F.col("contents"), made) if "contents" in rows.columns else made)


def read_wiki_dump(spark: SparkSession, path: str) -> DataFrame:
    """(id, title, text) of all JSON-lines files below a folder, markup removed; stubs go."""
    rows = read_jsonl(spark, path, "id string, title string, text string", recursive=True)
    return rows.where(~tx.is_wiki_stub(F.col("title"), F.col("text"))).select("id", "title", tx.wiki_clean(F.col("text")).alias("text"))


def find_split(spark: SparkSession, folder: str, split: str) -> str | None:
    """The first of {split}.jsonl, .json and .parquet that there is."""
    for kind in FORMATS:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{split}.{kind}")
        if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            return f"{folder}/{split}.{kind}"
    return None


def read_split(spark: SparkSession, folder: str, split: str, schema: str, n: int | None = None, seed: int | None = None) -> DataFrame:
    """A split's rows; with n, the first n by id, or a random n if a seed is given."""
    path = find_split(spark, folder, split)
    if path is None:
        raise FileNotFoundError(f"no {split} in {folder}")
    rows = spark.read.parquet(path) if path.endswith(".parquet") else read_jsonl(spark, path, schema)
    return rows if n is None else rows.orderBy("id" if seed is None else F.rand(seed)).limit(n)


def web_search(queries: DataFrame, fetch, n: int) -> DataFrame:
    """(q_id, rank, title, text, url) of a web search: fetch(q_id, query, n) gives dicts; a query whose fetch fails has no hits."""
    def run(frames):
        for f in frames:
            rows = []
            for q_id, query in zip(f["q_id"], f["text"], strict=True):
                try:
                    found = fetch(q_id, query, n)
                except Exception:  # noqa: BLE001  the network may fail in any way, and must not fail the job
                    found = []
                rows += [(q_id, k, x.get("title", ""), x.get("text", ""), x.get("url", "")) for k, x in enumerate(found[:n], 1)]
            yield pd.DataFrame(rows, columns=["q_id", "rank", "title", "text", "url"])

    return queries.select("q_id", "text").mapInPandas(run, "q_id long, rank long, title string, text string, url string")


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    """(q_id, doc_id) of a JSON map from questions to a document or a list of them."""
    whole = spark.read.text(path, wholetext=True)
    pairs = whole.select(F.explode(F.from_json("value", "map<string,string>")).alias("q", "d"))
    ids = F.regexp_extract_all("d", F.lit("-?[0-9]+"), F.lit(0))
    return pairs.select(F.col("q").cast("long").alias("q_id"), F.explode(ids).alias("d")).select("q_id", F.col("d").cast("long").alias("doc_id")).dropDuplicates()


def write_scored(items: DataFrame, metrics: dict[str, Column], path: str) -> None:
    """Items with their scores as JSON lines, and one line for each metric over them."""
    write_jsonl(items, f"{path}/items")
    rows = items.agg(*[c.alias(n) for n, c in metrics.items()]).select(F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in metrics])).alias("x"))
    write_jsonl(rows.select("x.*"), f"{path}/metrics")


def read_scored(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    return read_jsonl(spark, f"{path}/items", schema), read_jsonl(spark, f"{path}/metrics", "metric string, value double")


def write_float_rows(vectors: DataFrame, path: str) -> None:
    """(item, v) with v as little-endian float32 bytes, the rows of a memory-mapped matrix."""
    @F.pandas_udf("binary")
    def pack(v: pd.Series) -> pd.Series:
        import numpy as np

        return pd.Series([np.asarray(x, "<f4").tobytes() for x in v])

    vectors.select("item", pack(F.col("v")).alias("raw")).write.mode("overwrite").parquet(path)


def read_float_rows(spark: SparkSession, path: str) -> DataFrame:
    @F.pandas_udf("array<float>")
    def unpack(raw: pd.Series) -> pd.Series:
        import numpy as np

        return pd.Series([np.frombuffer(x, "<f4") for x in raw])

    return spark.read.schema("item long, raw binary").parquet(path).select("item", unpack("raw").alias("v"))
