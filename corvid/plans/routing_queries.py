"""Queries of routing, fusion's edges, encoders and dense indexes with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvid.functions import text as tx
from corvid.operators import retrieval as rt
from corvid.operators import routing as ro
from corvid.operators.loops import settled
from corvid.session import scratch, spread, table

from .registry import register
from .retrieval_queries import SQL_HITS, SQL_INDEX, SQL_OVERLAP, SQL_SPARSE, TOKS, benchmark, hits, reranked, sparse, submission, vectors

_TABLED = r"regexp_matches(d.text, '\|[^\n]*\|')"
_NUMERIC_Q = r"(regexp_matches(b.text, '[0-9]') OR regexp_matches(lower(b.text), '\b(rate|percent|limit|price|cost|fee|amount|tariff)\b'))"
_MINMAX = "CASE WHEN max(score) OVER w = min(score) OVER w THEN 0.5 ELSE round((score - min(score) OVER w) / (max(score) OVER w - min(score) OVER w), 6) END"


def documents(spark, d):
    return table(spark, d, "documents").select("doc_id", "text")


@register("fu1_tagging", f"WITH {SQL_SPARSE} SELECT q_id, rank, doc_id || '_0_' || rank AS chunk_id, doc_id::VARCHAR AS doc_id, 'bm25' AS source, 'documents' AS corpus, false AS multimodal FROM sparse")
def fu1(spark, d):
    """Chunk hits without a document id: it is the head of the chunk's id."""
    chunks = sparse(spark, d).select("q_id", "rank", F.concat_ws("_0_", "doc_id", "rank").alias("chunk_id"))
    return ro.tag(chunks, "bm25", "documents")


@register("fu2_fan_out", f"WITH {SQL_SPARSE}, {SQL_OVERLAP}, {SQL_HITS} SELECT q_id, source, count(*) AS n, min(rank) AS first FROM hits GROUP BY ALL")
def fu2(spark, d):
    s = settled(sparse(spark, d))
    cols = ("q_id", "doc_id", "score", "rank")

    def broken():
        raise ConnectionError("this source is down")

    def fails_in_a_task():
        return s.select("q_id", "doc_id", F.when(F.col("rank") > 0, F.raise_error(F.lit("lost on the way"))).otherwise(F.col("score")).alias("score"), "rank")

    found = ro.fan_out({"bm25": lambda: s.where("rank <= 10").select(*cols), "down": broken, "failing": fails_in_a_task, "overlap": lambda: reranked(spark, d, s).select(*cols)})
    return found.groupBy("q_id", "source").agg(F.count("*").alias("n"), F.min("rank").alias("first"))


@register("fu6_weights", "WITH c AS (SELECT source, avg(n_chars) - 2000 AS w FROM documents GROUP BY source), t AS (SELECT sum(greatest(w, 0)) AS total FROM c) SELECT source, round(CASE WHEN total > 0 THEN greatest(w, 0) / total ELSE 0.5 END, 6) AS weight FROM c, t")
def fu6(spark, d):
    """Raw weights by source, some of them negative."""
    c = table(spark, d, "documents").groupBy("source").agg((F.avg("n_chars") - 2000).alias("w"))
    total = c.agg(F.sum(F.greatest("w", F.lit(0.0))).alias("total"))
    return c.crossJoin(F.broadcast(total)).select("source", F.round(ro.share_of_weights(F.col("w"), F.col("total")), 6).alias("weight"))


@register("fu7_rerank_merge", f"WITH {SQL_SPARSE}, {SQL_OVERLAP}, {SQL_HITS}, u AS (SELECT DISTINCT q_id, doc_id FROM hits), s AS (SELECT q_id, doc_id, score FROM lap JOIN u USING (q_id, doc_id)) SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY score DESC, doc_id) AS rank FROM s) WHERE rank <= 5")
def fu7(spark, d):
    """The union of all sources, reranked as one list."""
    return reranked(spark, d, hits(spark, d).select("q_id", "doc_id").dropDuplicates(), 5)


@register("fu8_modality", f"WITH {SQL_SPARSE} SELECT q_id, doc_id, rank, CASE WHEN regexp_matches(b.text, '[0-9]') THEN 'table' ELSE 'text' END AS modality FROM sparse JOIN benchmark b ON q_id = item_id WHERE rank <= CASE WHEN regexp_matches(b.text, '[0-9]') THEN 3 ELSE 5 END")
def fu8(spark, d):
    """Questions with digits go to one search, others to another; each has its own depth."""
    docs = spread(documents(spark, d))
    search = lambda k: lambda q: rt.bm25_search(docs, q, k).select("q_id", "doc_id", "rank")
    return ro.route(benchmark(spark, d), F.when(F.col("text").rlike("[0-9]"), "table").otherwise("text"), {"text": search(5), "table": search(3)})


@register("fu9_over_fetch", f"WITH {SQL_SPARSE} SELECT q_id, count(*) AS n FROM sparse WHERE rank <= 12 GROUP BY q_id")
def fu9(spark, d):
    return sparse(spark, d, ro.over_fetch(10)).groupBy("q_id").agg(F.count("*").alias("n"))


_BOOSTED = f"""nm AS (SELECT *, {_MINMAX} AS norm FROM sparse WINDOW w AS (PARTITION BY q_id)),
bo AS (SELECT q_id, doc_id, rank, score AS dense, round(CASE WHEN {_NUMERIC_Q} AND {_TABLED} THEN score * 1.3::DOUBLE ELSE score END, 6) AS score, round(CASE WHEN {_NUMERIC_Q} AND {_TABLED} THEN least(norm * 1.3::DOUBLE, 1) ELSE norm END, 6) AS norm FROM nm JOIN benchmark b ON q_id = item_id JOIN documents d USING (doc_id))"""


def boosted(spark, d):
    numeric = benchmark(spark, d).select("q_id", tx.is_numeric_query(F.col("text")).alias("numeric"))
    tabled = documents(spark, d).select("doc_id", F.col("text").rlike(r"\|[^\n]*\|").alias("has_table"))
    found = ro.normalised(sparse(spark, d)).withColumn("dense", F.col("score"))
    return ro.table_boost(found.join(numeric, "q_id").join(tabled, "doc_id")).select("q_id", "doc_id", "rank", "dense", "score", "norm")


@register("fu12_table_boost", f"WITH {SQL_SPARSE}, {_BOOSTED} SELECT q_id, doc_id, score, norm FROM bo")
def fu12(spark, d):
    return boosted(spark, d).select("q_id", "doc_id", "score", "norm")


@register("fu13_best", f"WITH {SQL_SPARSE}, {_BOOSTED} SELECT q_id, doc_id, place FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY norm DESC, score DESC, dense DESC, doc_id) AS place FROM bo) WHERE place <= 5")
def fu13(spark, d):
    return ro.best(boosted(spark, d), ["norm", "score", "dense"], 5).select("q_id", "doc_id", "place")


@register("fu16_sort_and_pad", f"WITH {SQL_SPARSE}, {_BOOSTED}, p AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY norm DESC, score DESC, dense DESC, doc_id) AS place FROM bo WHERE norm >= 0.9), l AS (SELECT q_id, list(doc_id ORDER BY place) FILTER (WHERE place <= 5) AS ids FROM p GROUP BY q_id) SELECT item_id AS q_id, '[' || array_to_string(list_transform(generate_series(1, 5), lambda n: coalesce(ids[least(n, len(ids))], 1)), ',') || ']' AS web_list FROM benchmark LEFT JOIN l ON item_id = q_id")
def fu16(spark, d):
    """Few hits are near the best, so that most lists are padded with their last document."""
    return submission(ro.best(boosted(spark, d).where("norm >= 0.9"), ["norm", "score", "dense"], 5), benchmark(spark, d))


@register("fu17_first_of_each", f"WITH {SQL_SPARSE}, {SQL_OVERLAP}, {SQL_HITS} SELECT q_id, doc_id, source, rank FROM (SELECT *, row_number() OVER (PARTITION BY q_id, doc_id ORDER BY rank, source) AS n FROM hits) WHERE n = 1")
def fu17(spark, d):
    return ro.first_of_each(hits(spark, d), ["rank", "source"]).select("q_id", "doc_id", "source", "rank")


@register("rr4_ensemble", f"""WITH {SQL_SPARSE}, {SQL_OVERLAP}, {SQL_HITS}, r AS (SELECT h.q_id, h.doc_id, h.source, h.score, 5 * lap.score AS o, row_number() OVER (PARTITION BY h.q_id, h.source ORDER BY h.score DESC, h.doc_id) AS p, sum((h.source = 'bm25')::INT) OVER (PARTITION BY h.q_id) AS size FROM hits h JOIN lap USING (q_id, doc_id)),
m AS (SELECT q_id, doc_id, sum(CASE source WHEN 'bm25' THEN 0.7::DOUBLE ELSE 0.3::DOUBLE END * score) / count(*) AS mean, max(o) AS o FROM r WHERE p <= least(size, 10) GROUP BY ALL),
e AS (SELECT q_id, doc_id, round(CASE WHEN o > 0.8::DOUBLE * mean THEN greatest(o, mean) ELSE mean END, 8) AS score FROM m)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY score DESC, doc_id) AS rank FROM e) WHERE rank <= 5""")
def rr4(spark, d):
    """Two models; the original score is five times the overlap."""
    found = settled(hits(spark, d))
    original = reranked(spark, d, found.select("q_id", "doc_id").dropDuplicates(), 100).select("q_id", "doc_id", (F.col("score") * 5).alias("original"))
    return ro.ensemble(found.withColumnRenamed("source", "model").join(original, ["q_id", "doc_id"]), {"bm25": 0.7, "overlap": 0.3}, 5, "bm25")


_HASHED = f"""(SELECT KEY AS id, ('0x' || substr(md5(term), 1, 6))::BIGINT % 64 AS dim, count(*) AS n FROM (SELECT KEY, unnest({TOKS.format('text')}) AS term FROM ROWS_OF) GROUP BY ALL)"""


def _vectors(key, rows):
    return f"(SELECT id, dim, n / sqrt(sum(n * n) OVER (PARTITION BY id)) AS w FROM {_HASHED.replace('KEY', key).replace('ROWS_OF', rows)})"


@register("dn1_hash_encode", f"SELECT id, dim, round(w, 6) AS w FROM {_vectors('item_id', 'benchmark')}")
def dn1(spark, d):
    return ro.hash_vectors(table(spark, d, "benchmark"), "item_id").withColumn("w", F.round("w", 6))


@register("dn2_encoder_seam", f"SELECT id, dim, round(w, 3) AS w FROM {_vectors('item_id', 'benchmark')}")
def dn2(spark, d):
    """A model behind the seam; the offline one agrees with the expressions."""
    made = ro.HashEncoder().apply(table(spark, d, "benchmark"))
    flat = made.select(F.col("item_id").alias("id"), F.posexplode("embedding").alias("dim", "w")).where("w > 0")
    return flat.select("id", F.col("dim").cast("long").alias("dim"), F.round(F.col("w").cast("double"), 3).alias("w"))


@register("dn4_instruction", "SELECT item_id AS id, 'query: ' || text AS e5, 'Represent this sentence for searching relevant passages: ' || text AS bge, 'passage: ' || text AS passage FROM benchmark")
def dn4(spark, d):
    c = F.col("text")
    return table(spark, d, "benchmark").select(F.col("item_id").alias("id"), ro.instruct(c, "e5", True).alias("e5"), ro.instruct(c, "bge", True).alias("bge"), ro.instruct(c, "e5", False).alias("passage"))


@register("dn5_flat_index", "SELECT vec_id AS item, len(embedding)::BIGINT AS dim, round(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]), 4) AS norm FROM embeddings")
def dn5(spark, d):
    """The vectors written as an index and read back."""
    path = scratch(spark, "flat-index")
    ro.write_vectors(vectors(spark, d)[0], path)
    v = ro.read_vectors(spark, path)
    return v.select("item", F.size("v").cast("long").alias("dim"), F.round(rt.dot(F.col("v"), F.col("v")), 4).alias("norm"))


@register("dn7_ivf_search")
def dn7(spark, d):
    """Every 20th vector against all, by cells; recall against the exact search is tested."""
    v, q = vectors(spark, d)
    return ro.ivf_search(v, q, 10)


@register("dn9_modalities", "SELECT CASE WHEN label % 2 = 0 THEN 'text' ELSE 'image' END AS modal, count(*) AS n, round(avg(embedding[1]::DOUBLE), 6) AS mean FROM embeddings GROUP BY 1")
def dn9(spark, d):
    """Two vector tables by modality (the label's parity stands for it) behind one search."""
    v = vectors(spark, d)[0].withColumn("modal", F.when(F.col("label") % 2 == 0, "text").otherwise("image"))
    return v.groupBy("modal").agg(F.count("*").alias("n"), F.round(F.avg(F.col("v")[0].cast("double")), 6).alias("mean"))


@register("dn9_search", """WITH m AS (SELECT vec_id, embedding::DOUBLE[] AS v, CASE WHEN label % 2 = 0 THEN 'text' ELSE 'image' END AS modal FROM embeddings),
s AS (SELECT q.vec_id AS q_id, q.modal AS asked, b.modal, b.vec_id AS item, round(list_dot_product(q.v, b.v), 6) AS score FROM m q JOIN m b ON q.vec_id <> b.vec_id WHERE q.vec_id % 20 = 0)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q_id, modal ORDER BY score DESC, item) AS rank FROM s) WHERE rank <= 5""")
def dn9_search(spark, d):
    """Each query, of either modality, searches the vectors of both: the best five of each."""
    v, q = vectors(spark, d)
    kind = lambda x: F.when(F.col(x) % 2 == 0, "text").otherwise("image")
    found = ro.modal_search({m: v.where(kind("label") == m) for m in ("text", "image")}, q, 5)
    return found.join(v.select(F.col("item").alias("q_id"), kind("label").alias("asked")), "q_id")


@register("dn3_pooling", """WITH t AS (SELECT vec_id, label, embedding::DOUBLE[] AS e, unnest(generate_series(0, 7)) AS dim FROM embeddings)
SELECT vec_id, dim, round(list_sum(list_transform(generate_series(0, label % 8), lambda k: e[8 * k + dim + 1])) / (label % 8 + 1), 6) AS mean, round(e[dim + 1], 6) AS cls FROM t""")
def dn3_pooling(spark, d):
    """Vectors as eight tokens of eight numbers, of which as many count as the label says."""
    e = F.transform("embedding", lambda x: x.cast("double"))
    tokens = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda k: F.slice(e, k * 8 + 1, 8))
    mask = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda k: k <= F.col("label") % 8)
    rows = table(spark, d, "embeddings").select("vec_id", ro.pooled_vector(tokens, mask, "mean").alias("m"), ro.pooled_vector(tokens, mask, "cls").alias("c"))
    each = rows.select("vec_id", F.posexplode(F.arrays_zip("m", "c")).alias("dim", "x"))
    return each.select("vec_id", F.col("dim").cast("long").alias("dim"), F.round("x.m", 6).alias("mean"), F.round("x.c", 6).alias("cls"))


@register("rr2_bi_encoder", f"WITH {SQL_SPARSE}, qv AS {_vectors('item_id', 'benchmark')}, dv AS {_vectors('doc_id', 'documents')}, s AS (SELECT q_id, doc_id, round(sum(qv.w * dv.w), 6) AS score FROM sparse JOIN qv ON qv.id = q_id JOIN dv ON dv.id = doc_id AND dv.dim = qv.dim GROUP BY ALL) SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY score DESC, doc_id) AS rank FROM s) WHERE rank <= 5")
def rr2(spark, d):
    return ro.bi_rerank(settled(sparse(spark, d)), benchmark(spark, d), documents(spark, d), 5)


@register("rr7_search_and_rerank", f"WITH {SQL_SPARSE}, {SQL_OVERLAP} SELECT q_id, doc_id, score, rank FROM rer WHERE rank <= 5")
def rr7(spark, d):
    """Any search with a reranker behind it, as one function."""
    search = reranking(lambda q, k: rt.bm25_search(spread(documents(spark, d)), q, k), lambda found, k: reranked(spark, d, found, k), 20)
    return search(benchmark(spark, d), 5)


def reranking(search, rerank, depth: int):
    """search(queries, k) with rerank(hits, k) over `depth` candidates."""
    return lambda queries, k: rerank(settled(search(queries, depth)), k)


# --- sparse -------------------------------------------------------------------------------

_STOP = "(" + ", ".join(f"'{w}'" for w in tx.STOP_WORDS) + ")"
_STEM = r"CASE WHEN regexp_matches({0}, '[^ea]ies$') THEN regexp_replace({0}, 'ies$', 'y') WHEN regexp_matches({0}, '[^aeo]es$') THEN regexp_replace({0}, 's$', '') WHEN regexp_matches({0}, '[^us]s$') THEN regexp_replace({0}, 's$', '') ELSE {0} END"


@register("sp1_analyze", f"SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, {_STEM.format('x')} AS term FROM (SELECT doc_id, unnest({TOKS.format('text')}) AS x FROM documents) WHERE x NOT IN {_STOP}) GROUP BY ALL")
def sp1(spark, d):
    """Tokens without stop words, plurals stemmed."""
    return spread(documents(spark, d)).select("doc_id", F.explode(tx.analyzed(F.col("text"))).alias("term")).groupBy("doc_id", "term").agg(F.count("*").alias("n"))


@register("sp4_materialise", f"WITH {SQL_SPARSE} SELECT q_id, rank, doc_id || '_0' AS chunk_id, doc_id::VARCHAR AS doc_id, score, score AS bm25_score, split_part(text, chr(10), 1) AS title FROM sparse JOIN documents USING (doc_id) WHERE rank <= 5")
def sp4(spark, d):
    """Hits of chunks joined back to their texts, ids normalised."""
    chunks = documents(spark, d).select(F.concat("doc_id", F.lit("_0")).alias("chunk_id"), F.substring_index("text", "\n", 1).alias("title"))
    found = sparse(spark, d, 5).select("q_id", "rank", "score", F.concat("doc_id", F.lit("_0")).alias("chunk_id")).join(chunks, "chunk_id")
    return ro.tag(found, "bm25").select("q_id", "rank", "chunk_id", "doc_id", "score", F.col("score").alias("bm25_score"), "title")


@register("sp5_second_backend", f"WITH {SQL_SPARSE} SELECT q_id, rank, doc_id, trim(split_part(text, chr(10), 1), '\"') AS title, CASE WHEN contains(text, chr(10)) THEN substr(text, strpos(text, chr(10)) + 1) ELSE '' END AS body FROM sparse JOIN documents USING (doc_id) WHERE rank <= 3")
def sp5(spark, d):
    """The other backend's result shape: the first line, without quotes, is the title, the rest the body."""
    two = F.split("text", "\n", 2)
    return sparse(spark, d, 3).join(documents(spark, d), "doc_id").select("q_id", "rank", "doc_id", F.expr("trim(BOTH '\"' FROM substring_index(text, '\n', 1))").alias("title"), F.coalesce(F.try_element_at(two, F.lit(2)), F.lit("")).alias("body"))


_OKAPI = """oc AS (SELECT q_id, doc_id, d.text AS t, b.text AS q FROM sparse JOIN benchmark b ON q_id = item_id JOIN documents d USING (doc_id) WHERE rank <= 10),
ow AS (SELECT q_id, doc_id, len(list_filter(string_split(t, ' '), lambda x: x <> '')) AS dl FROM oc),
ost AS (SELECT q_id, count(*) AS n, avg(dl) AS avgdl FROM ow GROUP BY q_id),
otf AS (SELECT q_id, doc_id, term, count(*) AS tf FROM (SELECT q_id, doc_id, unnest(list_filter(string_split(t, ' '), lambda x: x <> '')) AS term FROM oc) GROUP BY ALL),
qt AS (SELECT q_id, term, count(*) AS times FROM (SELECT DISTINCT q_id, unnest(list_filter(string_split(q, ' '), lambda x: x <> '')) AS term FROM oc) GROUP BY ALL),
odf AS (SELECT q_id, term, count(*) AS df FROM otf JOIN qt USING (q_id, term) GROUP BY ALL),
sc AS (SELECT q_id, doc_id, sum(ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.5::DOUBLE / (tf + 1.5::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / avgdl))) AS s FROM otf JOIN odf USING (q_id, term) JOIN ow USING (q_id, doc_id) JOIN ost USING (q_id) GROUP BY ALL)"""


@register("sp8_context_bm25", f"WITH {SQL_SPARSE}, {_OKAPI} SELECT oc.q_id, oc.doc_id, round(coalesce(s, 0), 6) AS score FROM oc LEFT JOIN sc USING (q_id, doc_id)")
def sp8(spark, d):
    """Contexts of one question ranked among themselves, on words between spaces."""
    c = context_rows(spark, d)
    return c.select("q_id", "doc_id").join(context_scores(c), ["q_id", "doc_id"], "left").select("q_id", "doc_id", F.round(F.coalesce("s", F.lit(0.0)), 6).alias("score"))


def context_rows(spark, d, k=10):
    """(q_id, doc_id, rank, query, text) of the first k hits."""
    return settled(sparse(spark, d, k)).join(benchmark(spark, d).withColumnRenamed("text", "query"), "q_id").join(documents(spark, d), "doc_id")


def context_scores(c, k1=1.5, b=0.75):
    """(q_id, doc_id, s): BM25 with the statistics of each question's own contexts."""
    split = lambda x: F.filter(F.split(x, " "), lambda w: w != "")
    made = c.select("q_id", "doc_id", split("text").alias("t"), F.array_distinct(split("query")).alias("q"))
    sized = made.select("q_id", "doc_id", F.size("t").alias("dl"))
    stats = sized.groupBy("q_id").agg(F.count("*").alias("n"), F.avg("dl").alias("avgdl"))
    asked = made.select("q_id", "doc_id", F.filter("t", lambda x: F.array_contains("q", x)).alias("t"))
    tf = asked.select("q_id", "doc_id", F.explode("t").alias("term")).groupBy("q_id", "doc_id", "term").agg(F.count("*").alias("tf"))
    df = tf.groupBy("q_id", "term").agg(F.count("*").alias("df"))
    idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    norm = F.col("tf") + k1 * (1 - b + b * F.col("dl") / F.col("avgdl"))
    return tf.join(df, ["q_id", "term"]).join(sized, ["q_id", "doc_id"]).join(stats, "q_id").groupBy("q_id", "doc_id").agg(F.sum(idf * F.col("tf") * (k1 + 1) / norm).alias("s"))


@register("sp7_query_cut", f"""WITH {SQL_INDEX}, sp AS (SELECT doc_id, term, ln(1 + tf) * ln(1 + n_docs / df::DOUBLE) AS w FROM tf JOIN df USING (term), st),
q AS (SELECT item_id AS q_id, term, count(*) AS n FROM (SELECT item_id, unnest({TOKS.format('text')}) AS term FROM benchmark) GROUP BY ALL),
qw AS (SELECT q_id, term, round(ln(1 + n) * ln(1 + n_docs / df::DOUBLE), 9) AS w FROM q JOIN df USING (term), st),
cut AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY w DESC, term) AS r FROM qw) WHERE r <= 10),
s AS (SELECT q_id, doc_id, round(sum(sp.w * cut.w), 6) AS score FROM sp JOIN cut USING (term) GROUP BY ALL)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY score DESC, doc_id) AS rank FROM s) WHERE rank <= 10""")
def sp7(spark, d):
    """Sparse inner product over each query's ten heaviest terms; postings of other terms are never counted."""
    asked = benchmark(spark, d).select("q_id", F.explode(tx.tokens(F.col("text"))).alias("term")).groupBy("q_id", "term").agg(F.count("*").alias("n"))
    wanted = asked.select("term").unionByName(spark.range(1).select(F.lit(rt.ITSELF).alias("term"))).dropDuplicates()
    counts = rt.postings(spread(documents(spark, d)), terms=wanted)
    tf = counts.where(F.col("term") != rt.ITSELF)
    idf = tf.groupBy("term").agg(F.count("*").alias("df")).crossJoin(F.broadcast(counts.where(F.col("term") == rt.ITSELF).agg(F.count("*").alias("n_docs"))))
    idf = idf.select("term", F.log(1 + F.col("n_docs") / F.col("df")).alias("idf"))
    weighed = asked.join(idf, "term").select("q_id", "term", F.round(F.log1p("n") * F.col("idf"), 9).alias("x"))
    cut = rt.top_k(weighed, 10, "x", item="term", rank="r").select("q_id", "term", "x")
    scored = tf.join(idf, "term").join(cut, "term").groupBy("q_id", "doc_id").agg(F.round(F.sum(F.log1p("tf") * F.col("idf") * F.col("x")), 6).alias("score"))
    return rt.top_k(scored, 10)
