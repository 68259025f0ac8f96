"""Second passes, chunk fusion, compression and answer scoring with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvid.functions import text as tx
from corvid.operators import compression as cp
from corvid.operators import conditional as cd
from corvid.operators.loops import settled
from corvid.session import spread, table

from .registry import register
from .retrieval_queries import SQL_OVERLAP, SQL_QRELS, SQL_SPARSE, benchmark, qrels, reranked, sparse
from .text_queries import SENT, WORDS, ch8, docs, plain_sentences

_WORDS = f"w AS (SELECT doc_id, unnest({WORDS}) AS word, generate_subscripts({WORDS}, 1) - 1 AS pos FROM documents)"


def placed_words(spark, d):
    return docs(spark, d).select("doc_id", F.posexplode(tx.words(F.col("text"))).alias("pos", "word")).withColumn("pos", F.col("pos").cast("long"))


@register("rr5_second_pass", f"""WITH {SQL_SPARSE}, {SQL_OVERLAP},
h AS (SELECT s.q_id, s.doc_id, s.rank, score2 FROM sparse s LEFT JOIN (SELECT q_id, doc_id, score AS score2 FROM lap) USING (q_id, doc_id))
SELECT q_id, doc_id, row_number() OVER (PARTITION BY q_id ORDER BY CASE WHEN rank <= 10 THEN 0 ELSE 1 END, CASE WHEN rank <= 10 THEN score2 END DESC NULLS LAST, CASE WHEN rank > 10 THEN rank END, doc_id) AS rank FROM h""")
def rr5(spark, d):
    found = settled(sparse(spark, d))
    return cp.second_pass(found, reranked(spark, d, found.where("rank <= 10")), 10)


@register("fu14_best_chunk", f"""WITH {SQL_SPARSE}, {SQL_OVERLAP},
c AS (SELECT q_id, doc_id, s.rank, 'first' AS source, 0::DOUBLE AS r, 0::DOUBLE AS n, score AS h FROM sparse s UNION ALL
  SELECT q_id, doc_id, rank + 100, 'second', score, score / 2, 0 FROM rer),
s AS (SELECT *, CASE WHEN r > 0 THEN 0.7::DOUBLE * r + 0.2::DOUBLE * n + 0.1::DOUBLE * h WHEN n > 0 THEN 0.6::DOUBLE * n + 0.4::DOUBLE * h ELSE 0.7::DOUBLE * h END AS combined FROM c)
SELECT q_id, doc_id, source, round(combined, 9) AS combined FROM (SELECT *, row_number() OVER (PARTITION BY q_id, doc_id ORDER BY combined DESC, rank) AS k FROM s) WHERE k = 1""")
def fu14(spark, d):
    """Two candidates of a document: as found, and as reranked."""
    found = settled(sparse(spark, d))
    zero = F.lit(0.0)
    one = found.select("q_id", "doc_id", "rank", F.lit("first").alias("source"), zero.alias("r"), zero.alias("n"), F.col("score").alias("h"))
    two = reranked(spark, d, found).select("q_id", "doc_id", (F.col("rank") + 100).alias("rank"), F.lit("second").alias("source"), F.col("score").alias("r"), (F.col("score") / 2).alias("n"), zero.alias("h"))
    best = cp.best_chunks(one.unionByName(two), cp.combined_score(F.col("r"), F.col("n"), F.col("h"), zero), "rank")
    return best.select("q_id", "doc_id", "source", F.round("combined", 9).alias("combined"))


@register("ev10_precision", f"""WITH {SQL_SPARSE}, {SQL_QRELS}
SELECT q_id, round(count(r.doc_id) / count(*)::DOUBLE, 6) AS precision FROM sparse s LEFT JOIN (SELECT DISTINCT q_id, doc_id FROM qrels) r USING (q_id, doc_id) WHERE s.rank <= 10 GROUP BY q_id""")
def ev10(spark, d):
    good = qrels(spark, d).select("q_id", "doc_id").dropDuplicates().withColumn("good", F.lit(1))
    return sparse(spark, d).where("rank <= 10").join(good, ["q_id", "doc_id"], "left").groupBy("q_id").agg(F.round(F.count("good") / F.count("*"), 6).alias("precision"))


@register("ev15_input_tokens", f"SELECT source, round(avg(len({WORDS})), 6) AS tokens FROM documents GROUP BY source")
def ev15(spark, d):
    return docs(spark, d).groupBy("source").agg(F.round(F.avg(F.size(tx.words(F.col("text")))), 6).alias("tokens"))


_NUMBERS = "SELECT item_id AS q_id, unnest(list_distinct(regexp_extract_all(text || ' ' || item_id, '[0-9]+'))) AS number FROM benchmark"


@register("ev20_numeric_presence", f"""WITH {SQL_SPARSE}, n AS ({_NUMBERS})
SELECT q_id, number, count(*) FILTER (WHERE contains(d.text, number)) AS chunks FROM n JOIN (SELECT * FROM sparse WHERE rank <= 10) USING (q_id) JOIN documents d USING (doc_id) GROUP BY ALL""")
def ev20(spark, d):
    """The numbers of each question, which asks for its own id too, among its first ten hits."""
    n = benchmark(spark, d).select("q_id", F.explode(F.array_distinct(F.regexp_extract_all(F.concat_ws(" ", "text", "q_id"), F.lit("([0-9]+)"), F.lit(1)))).alias("number"))
    found = sparse(spark, d).where("rank <= 10").select("q_id", "doc_id").join(n, "q_id").join(docs(spark, d).select("doc_id", "text"), "doc_id")
    return found.groupBy("q_id", "number").agg(F.count_if(F.contains("text", "number")).alias("chunks"))


@register("sp9_gzip_rank")
def sp9(spark, d):
    """The first 20 hits in order of compression distance; no SQL compresses."""
    pairs = sparse(spark, d).select("q_id", "doc_id").join(benchmark(spark, d).withColumnRenamed("text", "query"), "q_id").join(docs(spark, d).select("doc_id", "text"), "doc_id")
    return pairs.select("q_id", "doc_id", F.round(cp.gzip_distance("query", "text"), 6).alias("distance"))


@register("rf6_sentence_budget", f"""
WITH s AS (SELECT doc_id, unnest(s) AS sentence, generate_subscripts(s, 1) - 1 AS pos FROM (SELECT doc_id, {SENT} AS s FROM documents)),
z AS (SELECT *, len({WORDS.replace('text', 'sentence')}) AS size, max(pos) OVER (PARTITION BY doc_id) AS top FROM s),
t AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY doc_id ORDER BY size + CASE WHEN pos = 0 OR pos = top THEN 5 ELSE 0 END DESC, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM z)
SELECT doc_id, pos::BIGINT AS pos, sentence, size::BIGINT AS size FROM t WHERE b <= 70""")
def rf6(spark, d):
    """Stand-in score: the sentence's words. Budget 50 words, times 1.4."""
    s = docs(spark, d).select("doc_id", F.posexplode(plain_sentences(F.col("text"))).alias("pos", "sentence")).withColumn("pos", F.col("pos").cast("long"))
    s = s.withColumn("size", F.size(tx.words(F.col("sentence"))).cast("long")).withColumn("score", F.col("size").cast("double"))
    return cp.sentence_budget(s, ["doc_id"], 70, 5.0).drop("score")


@register("rf7_token_compression", f"""
WITH {_WORDS}, f AS (SELECT word, count(*) AS n FROM w GROUP BY word), x AS (SELECT doc_id, pos, word, -n AS loss, pos // 200 AS win FROM w JOIN f USING (word)),
r AS (SELECT *, count(*) OVER (PARTITION BY doc_id, win) AS m, row_number() OVER (PARTITION BY doc_id, win ORDER BY loss DESC, pos) AS k FROM x),
t AS (SELECT doc_id, win, max(loss) AS cut FROM r WHERE k = greatest(floor(m * 0.5::DOUBLE), 1) GROUP BY ALL)
SELECT doc_id, pos::BIGINT AS pos, word FROM r JOIN t USING (doc_id, win) WHERE loss > cut""")
def rf7(spark, d):
    """Stand-in loss: rarer words of the corpus surprise more, so minus the count orders as -log p does."""
    w = placed_words(spark, d)
    loss = w.groupBy("word").agg((-F.count("*")).alias("loss"))
    return cp.keep_surprising(w.join(loss, "word"), ["doc_id"], 0.5).select("doc_id", "pos", "word")


@register("rf7_iterative")
def rf7_iterative(spark, d):
    """Half of each window of 200 words, judged by a pair model of the corpus and what was kept of the text before it."""
    texts = spread(docs(spark, d)).select("doc_id", tx.words(F.col("text")).alias("words"))
    return cd.compress_texts(texts, 0.5).select("doc_id", "pos", "word")


@register("rf8_word_selection", f"""
WITH {_WORDS}, p AS (SELECT *, CASE WHEN regexp_matches(word, '[0-9]') THEN 1.0::DOUBLE ELSE least(1.0::DOUBLE, length(word) / 16.0::DOUBLE) END AS prob, (length(word) + 3) // 4 AS pieces FROM w),
d AS (SELECT doc_id, prob, sum(sum(pieces)) OVER (PARTITION BY doc_id ORDER BY prob) AS upto FROM p GROUP BY doc_id, prob), z AS (SELECT doc_id, (max(upto) - 1) * 0.51::DOUBLE AS place FROM d GROUP BY doc_id),
t AS (SELECT doc_id, min(prob) FILTER (WHERE upto > floor(place)) * (1 - (place - floor(place))) + min(prob) FILTER (WHERE upto > ceil(place)) * (place - floor(place)) AS cut FROM d JOIN z USING (doc_id) GROUP BY doc_id, place)
SELECT doc_id, pos::BIGINT AS pos, word FROM p JOIN t USING (doc_id) WHERE prob > cut + 1e-12""")
def rf8(spark, d):
    """Stand-in probability: the word's length; words with digits are forced."""
    prob = F.when(F.col("word").rlike("[0-9]"), 1.0).otherwise(F.least(F.lit(1.0), F.length("word") / 16.0))
    w = placed_words(spark, d).withColumn("prob", prob).withColumn("pieces", F.floor((F.length("word") + 3) / 4))
    return cp.keep_probable(w, "doc_id", 0.5).select("doc_id", "pos", "word")


@register("ch4_recursive_chunks")
def ch4(spark, d):
    return docs(spark, d).select("doc_id", F.posexplode(cp.recursive_chunks(F.col("text"), 60)).alias("chunk", "text"))


@register("ch9_semantic_chunks")
def ch9(spark, d):
    """Segments at headings and tables, their cells re-joined, in runs of 120 words that overlap by 20."""
    title = docs(spark, d).select("doc_id", F.substring_index("text", "\n", 1).alias("title"))
    parts = ch8(spark, d).select("doc_id", "segment", "has_table", tx.words(tx.table_rows(F.col("text"))).alias("w")).where(F.size("w") > 0)
    chunks = parts.select("doc_id", "segment", "has_table", F.posexplode(tx.windows(F.col("w"), 120, 100)).alias("part", "w"))
    return chunks.join(title, "doc_id").select(F.concat_ws("_", "doc_id", "segment", "part").alias("id"), "doc_id", F.array_join("w", " ").alias("text"), F.concat_ws("\n", "title", F.array_join("w", " ")).alias("contents"), "has_table")
