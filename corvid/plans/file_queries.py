"""Connectors and sinks: each query writes a table's rows to the shared folder in a format and reads them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvid.functions import text as tx
from corvid.operators.loops import settled
from corvid.session import scratch, table
from corvid.sources import files
from corvid.sources.matrix import MatrixSource

from .registry import register
from .retrieval_queries import SQL_SPARSE, benchmark, sparse
from .text_queries import docs


def lines(frame, path):
    frame.select("value").write.text(path)
    return path


_CLEAN = r"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace({0}, ' +', ' ', 'g'), '(?m)^ ', '', 'g'), '(?m) $', '', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'), ' ' || chr(10))"
_REASON = "CASE WHEN doc_id % 10 = 3 THEN 'missing id' WHEN doc_id % 10 = 4 THEN 'short' WHEN len(list_filter(regexp_split_to_array(lower(text), '[ \n\t]+'), lambda x: x <> '')) > 100 AND len(list_distinct(list_filter(regexp_split_to_array(lower(text), '[ \n\t]+'), lambda x: x <> ''))) < 0.1 * len(list_filter(regexp_split_to_array(lower(text), '[ \n\t]+'), lambda x: x <> '')) THEN 'repetition' WHEN length(trim(text)) < 10 THEN 'short' END"


def websites(spark, d):
    """Documents as a CSV of web pages; some lack their id, some have a short text."""
    path = scratch(spark, "websites")
    n = F.col("doc_id") % 10
    rows = docs(spark, d).select(F.when(n != 3, F.col("doc_id").cast("string")).alias("web_id"), F.col("source").alias("title"), F.when(n == 4, "short").otherwise(F.col("text")).alias("text"))
    rows.write.csv(path, header=True, quote='"', escape='"')
    return path


@register("io1_csv_corpus", f"SELECT doc_id::VARCHAR AS id, sha256({_CLEAN.format('text')}) AS digest FROM documents WHERE ({_REASON}) IS NULL")
def io1(spark, d):
    return files.read_websites(spark, websites(spark, d)).select("id", F.sha2("text", 256).alias("digest"))


@register("io1_skipped", f"SELECT ({_REASON}) AS reason, count(*) AS n FROM documents WHERE ({_REASON}) IS NOT NULL GROUP BY 1")
def io1s(spark, d):
    return files.skipped_websites(spark, websites(spark, d))


@register("io2_csv_questions", "SELECT item_id AS q_id, trim(text) AS query FROM benchmark WHERE item_id > 0 AND item_id % 9 <> 4")
def io2(spark, d):
    path = scratch(spark, "questions")
    table(spark, d, "benchmark").select(F.col("item_id").alias("q_id"), F.when(F.col("item_id") % 9 != 4, F.col("text")).otherwise(" ").alias("query")).write.csv(path, header=True, quote='"', escape='"')
    return files.read_questions(spark, path)


@register("io3_jsonl", "SELECT doc_id AS id, sha256(text) AS digest FROM documents WHERE doc_id % 7 <> 2")
def io3(spark, d):
    """Lines of JSON, some broken off and some blank."""
    whole = F.to_json(F.struct(F.col("doc_id").alias("id"), "text"))
    value = F.when(F.col("doc_id") % 7 == 2, F.substring(whole, 1, 8)).otherwise(F.concat(whole, F.when(F.col("doc_id") % 7 == 3, "\n").otherwise("")))
    path = lines(docs(spark, d).select(value.alias("value")), scratch(spark, "lines"))
    return files.read_jsonl(spark, path, "id long, text string").where("id IS NOT NULL").select("id", F.sha2("text", 256).alias("digest"))


@register("io4_jsonl_sink", "SELECT doc_id, sha256(text) AS digest, lang IS NULL AS no_lang FROM documents")
def io4(spark, d):
    """Written as JSON lines, null fields and other scripts kept, and read back."""
    path = scratch(spark, "sink")
    files.write_jsonl(docs(spark, d).select("doc_id", "text", "lang"), path)
    return files.read_jsonl(spark, path, "doc_id long, text string, lang string").select("doc_id", F.sha2("text", 256).alias("digest"), F.col("lang").isNull().alias("no_lang"))


@register("io7_split", "SELECT item_id AS id FROM benchmark ORDER BY item_id LIMIT 7")
def io7(spark, d):
    """The split is found by its name, whatever its format, and its first items are taken."""
    path = scratch(spark, "splits")
    table(spark, d, "benchmark").select(F.col("item_id").alias("id"), "text").write.parquet(f"{path}/dev.parquet")
    return files.read_split(spark, path, "dev", "id long, text string", 7).select("id")


@register("io8_wiki_dump", "SELECT doc_id::VARCHAR AS id, sha256(trim(source || ' ' || source || ' end')) AS digest FROM documents WHERE doc_id % 5 <> 0")
def io8(spark, d):
    """Files in folders below folders; markup and stubs go."""
    path = scratch(spark, "dump")
    title = F.when(F.col("doc_id") % 5 == 0, "List of x").otherwise("page")
    text = F.concat("source", F.lit(" [[x|"), "source", F.lit("]] '''end'''"))
    rows = docs(spark, d).select(F.to_json(F.struct(F.col("doc_id").cast("string").alias("id"), title.alias("title"), text.alias("text"))).alias("value"), (F.col("doc_id") % 3).alias("part"))
    rows.write.partitionBy("part").text(path)
    return files.read_wiki_dump(spark, path).select("id", F.sha2("text", 256).alias("digest"))


@register("io9_web_search", "SELECT item_id AS q_id, n::BIGINT AS rank, 'page ' || n AS title, 'https://example.org/' || item_id || '/' || n AS url FROM benchmark, range(1, 4) r(n) WHERE item_id % 4 <> 1")
def io9(spark, d):
    """The connector with a fetcher of its own in place of the network; a query whose fetch fails has no hits."""

    def fetch(q_id, query, n):
        if q_id % 4 == 1:
            raise ConnectionError("no answer")
        return [{"title": f"page {k}", "text": query, "url": f"https://example.org/{q_id}/{k}"} for k in range(1, n + 1)]

    return files.web_search(benchmark(spark, d), fetch, 3).select("q_id", "rank", "title", "url")


@register("io10_truth_map", "SELECT item_id AS q_id, item_id * 10 AS doc_id FROM benchmark UNION ALL SELECT item_id, item_id * 10 + 1 FROM benchmark WHERE item_id % 2 = 0")
def io10(spark, d):
    """A JSON map of questions to one document or a list of them."""
    pair = F.when(F.col("item_id") % 2 == 0, F.format_string('"%d": [%d, "%d"]', F.col("item_id"), F.col("item_id") * 10, F.col("item_id") * 10 + 1)).otherwise(F.format_string('"%d": %d', F.col("item_id"), F.col("item_id") * 10))
    whole = table(spark, d, "benchmark").agg(F.concat(F.lit("{"), F.array_join(F.array_sort(F.collect_list(pair)), ", "), F.lit("}")).alias("value"))
    return files.read_truth(spark, lines(whole, scratch(spark, "truth")))


@register("io12_candidate_log", f"WITH {SQL_SPARSE} SELECT q_id, 'bm25' AS stage, rank, doc_id, score FROM sparse WHERE rank <= 5")
def io12(spark, d):
    """A line for each question with its candidates in order, written and read back."""
    found = sparse(spark, d, 5)
    log = found.groupBy("q_id").agg(F.array_sort(F.collect_list(F.struct("rank", "doc_id", "score"))).alias("candidates")).withColumn("stage", F.lit("bm25"))
    path = scratch(spark, "candidates")
    files.write_jsonl(log, path)
    back = files.read_jsonl(spark, path, "q_id long, stage string, candidates array<struct<rank:int,doc_id:long,score:double>>")
    return back.select("q_id", "stage", F.explode("candidates").alias("c")).select("q_id", "stage", "c.rank", "c.doc_id", "c.score")


@register("io13_scored_items", f"WITH {SQL_SPARSE} SELECT q_id AS id, round(max(score), 4) AS best, (SELECT round(avg(m), 4) FROM (SELECT max(score) AS m FROM sparse GROUP BY q_id)) AS mean FROM sparse GROUP BY q_id")
def io13(spark, d):
    """Items with their scores, and the metric file beside them."""
    items = settled(sparse(spark, d, 1).select(F.col("q_id").alias("id"), F.col("score").alias("best")))
    path = scratch(spark, "scored")
    files.write_scored(items, {"best": F.avg("best")}, path)
    back, metrics = files.read_scored(spark, path, "id long, best double")
    return back.crossJoin(F.broadcast(metrics)).select("id", F.round("best", 4).alias("best"), F.round(F.col("value"), 4).alias("mean"))


@register("io15_vectors", "SELECT vec_id AS item, round(embedding[1]::DOUBLE, 5) AS first, round(embedding[64]::DOUBLE, 5) AS last FROM embeddings")
def io15(spark, d):
    """Vectors as rows of raw float32 bytes, and back."""
    path = scratch(spark, "vectors")
    v = table(spark, d, "embeddings").select(F.col("vec_id").alias("item"), F.col("embedding").alias("v"))
    files.write_float_rows(v, path)
    back = files.read_float_rows(spark, path)
    return back.select("item", F.round(F.col("v")[0].cast("double"), 5).alias("first"), F.round(F.col("v")[63].cast("double"), 5).alias("last"))


@register("io15_matrix", "SELECT row_number() OVER (ORDER BY vec_id) - 1 AS row, round(embedding[1]::DOUBLE, 5) AS first, round(embedding[64]::DOUBLE, 5) AS last FROM embeddings")
def io15_matrix(spark, d):
    """Vectors as one raw float32 matrix without ids, written by tasks and read by ranges of rows."""
    spark.dataSource.register(MatrixSource)
    path = scratch(spark, "matrix").removeprefix("file://")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    v = table(spark, d, "embeddings").select(F.col("vec_id").alias("row"), F.col("embedding").alias("v"))
    v.repartitionByRange(n, "row").sortWithinPartitions("row").write.format("f32matrix").mode("append").option("path", path).save()
    back = spark.read.format("f32matrix").option("partitionRows", 100_000).load(path)
    return back.select("row", F.round(F.col("v")[0].cast("double"), 5).alias("first"), F.round(F.col("v")[63].cast("double"), 5).alias("last"))


_VOCABULARY = "byte_bpe_50k.json"


@register("ch1_bpe_chunks")
def ch1b(spark, d):
    """Windows of 128 tokens of a public byte-level vocabulary that overlap by 16; the windows hold the text as it stands."""
    import public_tokenizers

    return docs(spark, d).select("doc_id", F.posexplode(tx.token_windows(F.col("text"), public_tokenizers.path(_VOCABULARY), 128, 16)).alias("chunk", "text"))
