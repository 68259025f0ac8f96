"""Retrieval, fusion, evaluation and refinement queries with their SQL."""

from __future__ import annotations

import warnings

from pyspark.sql import Window
from pyspark.sql import functions as F

from corvid.functions import text as tx
from corvid.operators import evaluation as ev
from corvid.operators import retrieval as rt
from corvid.operators.cache import Cache
from corvid.operators.loops import settled
from corvid.session import scratch, spread, table

from .registry import register
from .text_queries import NORM, plain_sentences

TOKS = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}_]{{2,}}')"
#: The stated dense query set: vectors whose id is divisible by 20.
EVERY = 20

SQL_INDEX = f"""
tok AS (SELECT doc_id, unnest({TOKS.format('text')}) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY ALL),
dl AS (SELECT doc_id, len({TOKS.format('text')}) AS dl FROM documents),
st AS (SELECT count(*) AS n_docs, avg(dl) AS avgdl FROM dl),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
idx AS (SELECT term, doc_id, tf, ln(1 + (n_docs - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf / (tf + 1.5::DOUBLE * (1 - 0.75::DOUBLE + 0.75::DOUBLE * dl / avgdl)) AS weight FROM tf JOIN df USING (term) JOIN dl USING (doc_id), st)"""
SQL_SPARSE = (
    SQL_INDEX
    + f""",
q AS (SELECT item_id AS q_id, unnest(list_distinct({TOKS.format('text')})) AS term FROM benchmark),
sh AS (SELECT q_id, doc_id, round(sum(weight), 6) AS score FROM idx JOIN q USING (term) GROUP BY ALL),
sparse AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY score DESC, doc_id) AS rank FROM sh) WHERE rank <= 20)"""
)
SQL_OVERLAP = f"""
lap AS (SELECT q_id, doc_id, round(len(list_intersect(list_distinct({TOKS.format('b.text')}), list_distinct({TOKS.format('d.text')}))) / greatest(len(list_distinct({TOKS.format('b.text')})), 1)::DOUBLE, 6) AS score
  FROM sparse JOIN benchmark b ON q_id = item_id JOIN documents d USING (doc_id)),
rer AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY score DESC, doc_id) AS rank FROM lap) WHERE rank <= 10)"""
SQL_HITS = "hits AS (SELECT q_id, doc_id, 'bm25' AS source, score, rank FROM sparse WHERE rank <= 10 UNION ALL SELECT q_id, doc_id, 'overlap', score, rank FROM rer)"
SQL_QRELS = "qrels AS (SELECT item_id AS q_id, doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text))"


def benchmark(spark, d):
    return table(spark, d, "benchmark").select(F.col("item_id").alias("q_id"), "text")


def index(spark, d):
    return rt.bm25_index(spread(table(spark, d, "documents").select("doc_id", "text")))


def sparse(spark, d, k=20):
    return rt.bm25_search(spread(table(spark, d, "documents").select("doc_id", "text")), benchmark(spark, d), k)


def reranked(spark, d, hits=None, k=10):
    hits = sparse(spark, d) if hits is None else hits
    texts = table(spark, d, "documents").select("doc_id", "text")
    pairs = hits.select("q_id", "doc_id").join(benchmark(spark, d).withColumnRenamed("text", "query"), "q_id").join(texts, "doc_id")
    return rt.overlap_rerank(pairs, k)


def hits(spark, d):
    s = settled(sparse(spark, d))  # a few rows for each question, used twice
    cols = ["q_id", "doc_id", "source", "score", "rank"]
    return s.where("rank <= 10").withColumn("source", F.lit("bm25")).select(cols).unionByName(reranked(spark, d, s).withColumn("source", F.lit("overlap")).select(cols))


def qrels(spark, d):
    """Documents that hold a benchmark passage.

    Candidates share the passage's longest inner word (it may begin or end inside a word of the
    document); texts are fetched for candidates alone. A passage without an inner word is
    compared with every text, in a pass of its own.
    """
    words = lambda c: F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    b, t = benchmark(spark, d), table(spark, d, "documents").select("doc_id", F.col("text").alias("doc"))
    small = b.count() <= rt.SMALL
    inner = b.withColumn("w", words(F.col("text"))).withColumn("w", F.slice("w", 2, F.greatest(F.size("w") - 2, F.lit(0))))
    keyed = inner.select("q_id", "text", F.array_max(F.transform("w", lambda x: F.struct(F.length(x), x.alias("word"))))["word"].alias("g"))
    few = lambda df: F.broadcast(df) if small else df
    held = t.select("doc_id", F.explode(F.array_distinct(words(F.col("doc")))).alias("g"))
    candidates = held.join(few(keyed.where("g IS NOT NULL")), "g").select("q_id", "doc_id", "text")
    found = t.join(candidates, "doc_id").where(F.contains("doc", F.col("text"))).select("q_id", "doc_id")
    bare = t.join(few(keyed.where("g IS NULL")), F.contains("doc", F.col("text"))).select("q_id", "doc_id")
    return found.unionByName(bare).dropDuplicates()


@register("sp2_bm25_index", f"WITH {SQL_INDEX} SELECT term, doc_id, tf, round(weight, 6) AS weight FROM idx")
def sp2(spark, d):
    return index(spark, d).withColumn("weight", F.round("weight", 6))


@register("sp3_bm25_search", f"WITH {SQL_SPARSE} SELECT * FROM sparse")
def sp3(spark, d):
    return sparse(spark, d)


@register("sp6_sparse_encode", f"WITH {SQL_INDEX} SELECT doc_id, term, round(ln(1 + tf) * ln(1 + n_docs / df::DOUBLE), 4) AS w FROM tf JOIN df USING (term), st")
def sp6(spark, d):
    """Deterministic stand-in for a learned encoder: log1p(tf) * idf."""
    counts = rt.postings(table(spark, d, "documents"))
    tf = counts.where(F.col("term") != rt.ITSELF).drop("dl")
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    n = counts.where(F.col("term") == rt.ITSELF).agg(F.count("*").alias("n_docs"))
    return tf.join(df, "term").crossJoin(F.broadcast(n)).select("doc_id", "term", F.round(F.log1p("tf") * F.log(1 + F.col("n_docs") / F.col("df")), 4).alias("w"))


def vectors(spark, d):
    v = spread(table(spark, d, "embeddings"))
    return v.select(F.col("vec_id").alias("item"), F.col("embedding").alias("v"), "label"), v.where(F.col("vec_id") % EVERY == 0).select(F.col("vec_id").alias("q_id"), F.col("embedding").alias("q"))


_DENSE = "SELECT a.vec_id AS q_id, b.vec_id AS item, round(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS score FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0"
_KNN = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY score DESC, item) AS rank FROM s) WHERE rank <= 10"


@register("dn6_dense_search", f"WITH s AS ({_DENSE}) {_KNN}")
def dn6(spark, d):
    v, q = vectors(spark, d)
    return rt.dense_search(v, q, 10)


@register("dn6_blas_search", f"WITH s AS ({_DENSE}) {_KNN}")
def dn6b(spark, d):
    v, q = vectors(spark, d)
    return rt.blas_search(v, q, 10)


_L2 = "SELECT a.vec_id AS q_id, b.vec_id AS item, b.label, round(list_sum(list_transform(list_zip(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 6) AS score FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0"


@register("dn8_l2_knn", f"WITH s AS ({_L2}) SELECT q_id, item, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY score, item) AS rank FROM s) WHERE rank <= 10")
def dn8(spark, d):
    v, q = vectors(spark, d)
    return rt.dense_search(v, q, 10, rt.squared_distance, True)


@register("dn3_mean_pooling", "SELECT label, n AS dim, round(avg(x), 6) AS mean FROM (SELECT label, unnest(embedding::DOUBLE[]) AS x, generate_subscripts(embedding, 1) - 1 AS n FROM embeddings) GROUP BY ALL")
def dn3(spark, d):
    return table(spark, d, "embeddings").select("label", F.posexplode("embedding").alias("dim", "x")).groupBy("label", F.col("dim").cast("long").alias("dim")).agg(F.round(F.avg(F.col("x").cast("double")), 6).alias("mean"))


@register("jd1_skr_judge", f"""WITH s AS ({_L2}), top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY score, item) AS rank FROM s) WHERE rank <= 5),
p AS (SELECT count(*) FILTER (WHERE label % 2 = 0) - count(*) FILTER (WHERE label % 2 = 1) AS delta, count(*) AS n FROM embeddings),
k AS (SELECT q_id, count(*) FILTER (WHERE label % 2 = 0) - count(*) FILTER (WHERE label % 2 = 1) AS dk FROM top GROUP BY q_id)
SELECT q_id, dk, CASE WHEN delta < 0 THEN NOT (dk < 0 AND dk <= trunc(delta * 5 / n::DOUBLE)) ELSE dk > 0 AND dk >= trunc(delta * 5 / n::DOUBLE) END AS judge FROM k, p""")
def jd1(spark, d):
    """k-nearest-neighbour judge; labels of even classes are positive."""
    v, q = vectors(spark, d)
    sign = F.when(F.col("label") % 2 == 0, 1).otherwise(-1)
    near = rt.dense_search(v, q, 5, rt.squared_distance, True).join(v.select("item", "label"), "item").groupBy("q_id").agg(F.sum(sign).cast("long").alias("dk"))
    prior = v.agg(F.sum(sign).alias("delta"), F.count("*").alias("n"))
    cut = (F.col("delta") * 5 / F.col("n")).cast("long")
    verdict = F.when(F.col("delta") < 0, ~((F.col("dk") < 0) & (F.col("dk") <= cut))).otherwise((F.col("dk") > 0) & (F.col("dk") >= cut))
    return near.crossJoin(F.broadcast(prior)).select("q_id", "dk", verdict.alias("judge"))


@register("rr1_rerank", f"WITH {SQL_SPARSE}, {SQL_OVERLAP} SELECT * FROM rer")
def rr1(spark, d):
    return reranked(spark, d)


@register("rr3_squash", f"WITH {SQL_SPARSE} SELECT q_id, doc_id, round(1 / (1 + pow(2.718::DOUBLE, -score / 2)), 6) AS p FROM sparse")
def rr3(spark, d):
    return sparse(spark, d).select("q_id", "doc_id", F.round(1 / (1 + F.pow(F.lit(2.718), -F.col("score") / 2)), 6).alias("p"))


@register("fu3_concat", f"""WITH {SQL_SPARSE}, {SQL_OVERLAP}, {SQL_HITS} SELECT q_id, doc_id, source, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY q_id, doc_id ORDER BY source, rank) AS n FROM hits) WHERE n = 1""")
def fu3(spark, d):
    return rt.concat(hits(spark, d), ["bm25", "overlap"]).drop("place")


SQL_RRF = "fz AS (SELECT q_id, doc_id, round(sum(1 / (60::DOUBLE + rank)), 9) AS score FROM hits GROUP BY ALL), rrf AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY score DESC, doc_id) AS rank FROM fz) WHERE rank <= 10)"


@register("fu4_rrf", f"WITH {SQL_SPARSE}, {SQL_OVERLAP}, {SQL_HITS}, {SQL_RRF} SELECT * FROM rrf")
def fu4(spark, d):
    return rt.rrf(hits(spark, d), 10)


SQL_WEIGHTED = """nm AS (SELECT *, CASE WHEN max(score) OVER w = min(score) OVER w THEN 1.0 ELSE round((score - min(score) OVER w) / (max(score) OVER w - min(score) OVER w), 9) END AS norm FROM hits WINDOW w AS (PARTITION BY q_id, source)),
wf AS (SELECT q_id, doc_id, round(sum(CASE source WHEN 'bm25' THEN 0.6::DOUBLE ELSE 0.4::DOUBLE END * norm), 6) AS score, string_agg(DISTINCT source, ',' ORDER BY source) AS sources FROM nm GROUP BY ALL),
wt AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY score DESC, doc_id) AS rank FROM wf) WHERE rank <= 10)"""


@register("fu5_weighted", f"WITH {SQL_SPARSE}, {SQL_OVERLAP}, {SQL_HITS}, {SQL_WEIGHTED} SELECT * FROM wt")
def fu5(spark, d):
    return rt.weighted(hits(spark, d), {"bm25": 0.6, "overlap": 0.4}, 10)


@register("fu10_minmax", f"WITH {SQL_SPARSE} SELECT q_id, doc_id, CASE WHEN max(score) OVER w = min(score) OVER w THEN 0.5 ELSE round((score - min(score) OVER w) / (max(score) OVER w - min(score) OVER w), 6) END AS norm FROM sparse WINDOW w AS (PARTITION BY q_id)")
def fu10(spark, d):
    return sparse(spark, d).select("q_id", "doc_id", rt.minmax("score", ["q_id"], 0.5, 6).alias("norm"))


@register("fu11_threshold", f"WITH {SQL_SPARSE} SELECT q_id, doc_id, score FROM sparse WHERE score >= 5")
def fu11(spark, d):
    return sparse(spark, d).where("score >= 5").select("q_id", "doc_id", "score")


SQL_FILL = """ch AS (SELECT q_id, doc_id, rank FROM rer WHERE rank <= 3),
al AS (SELECT q_id, doc_id, 0 AS part, rank FROM ch UNION ALL SELECT q_id, doc_id, 1, rank FROM sparse WHERE (q_id, doc_id) NOT IN (SELECT (q_id, doc_id) FROM ch)),
fi AS (SELECT q_id, doc_id, place FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY part, rank, doc_id) AS place FROM al) WHERE place <= 5)"""


@register("fu15_backfill", f"WITH {SQL_SPARSE}, {SQL_OVERLAP}, {SQL_FILL} SELECT q_id, doc_id, place FROM fi")
def fu15(spark, d):
    s = settled(sparse(spark, d))
    return rt.backfill(reranked(spark, d, s, 3), s, 5)


def submission(filled, queries, k=5):
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("place", "doc_id"))), lambda x: x["doc_id"])
    lists = filled.groupBy("q_id").agg(ordered.alias("ids"))
    all_ = queries.select("q_id").join(lists, "q_id", "left").select("q_id", F.coalesce("ids", F.array().cast("array<long>")).alias("ids"))
    return all_.select("q_id", F.to_json(rt.pad(F.col("ids"), k)).alias("web_list"))


@register("io11_submission", f"WITH {SQL_SPARSE}, {SQL_OVERLAP}, {SQL_FILL}, l AS (SELECT q_id, list(doc_id ORDER BY place) AS ids FROM fi GROUP BY q_id) SELECT item_id AS q_id, '[' || array_to_string(list_transform(generate_series(1, 5), lambda n: coalesce(ids[least(n, len(ids))], 1)), ',') || ']' AS web_list FROM benchmark LEFT JOIN l ON item_id = q_id")
def io11(spark, d):
    s = settled(sparse(spark, d))
    return submission(rt.backfill(reranked(spark, d, s, 3), s, 5), benchmark(spark, d))


_METRICS = """truth AS (SELECT q_id, count(*) AS relevant FROM qrels GROUP BY q_id),
good AS (SELECT q_id, count(*) AS found, min(rank) AS first, sum(1 / log2(rank + 1.0::DOUBLE)) AS dcg FROM {0} JOIN qrels USING (q_id, doc_id) WHERE rank <= 5 GROUP BY q_id),
per AS (SELECT b.item_id AS q_id, relevant, found, first, dcg, list_sum(list_transform(generate_series(1, least(relevant, 5)), lambda n: 1 / log2(n + 1.0::DOUBLE))) AS ideal FROM benchmark b LEFT JOIN truth ON b.item_id = truth.q_id LEFT JOIN good ON b.item_id = good.q_id)
SELECT round(avg(CASE WHEN found > 0 THEN 1.0 ELSE 0.0 END), 6) AS hit, round(avg(coalesce(found / relevant::DOUBLE, 0)), 6) AS recall, round(avg(coalesce(1 / first::DOUBLE, 0)), 6) AS mrr, round(avg(coalesce(dcg / ideal, 0)), 6) AS ndcg, count(*) AS num_queries, count(relevant) AS num_queries_with_gt FROM per"""


@register("io10_qrels", f"WITH {SQL_QRELS} SELECT * FROM qrels")
def io10(spark, d):
    return qrels(spark, d)


@register("ev1_retrieval_metrics", f"WITH {SQL_SPARSE}, {SQL_QRELS}, {_METRICS.format('sparse')}")
def ev1(spark, d):
    return ev.retrieval_metrics(sparse(spark, d), qrels(spark, d), 5, benchmark(spark, d))


@register("pl0_hybrid", f"WITH {SQL_SPARSE}, {SQL_OVERLAP}, {SQL_HITS}, {SQL_RRF}, {SQL_QRELS}, {_METRICS.format('rrf')}")
def pl0(spark, d):
    """Retrieve, rerank, fuse and evaluate: one lazy plan."""
    return ev.retrieval_metrics(rt.rrf(hits(spark, d), 10), qrels(spark, d), 5, benchmark(spark, d))


@register("ev9_answer_recall", f"WITH {SQL_SPARSE} SELECT q_id, max(contains(d.text, b.text)::INT) AS recall, round(avg(contains(d.text, b.text)::INT), 6) AS precision FROM sparse JOIN benchmark b ON q_id = item_id JOIN documents d USING (doc_id) WHERE rank <= 5 GROUP BY q_id")
def ev9(spark, d):
    t = table(spark, d, "documents").select("doc_id", F.col("text").alias("doc"))
    hit = F.contains("doc", F.col("text")).cast("int")
    return sparse(spark, d, 5).join(benchmark(spark, d), "q_id").join(t, "doc_id").groupBy("q_id").agg(F.max(hit).alias("recall"), F.round(F.avg(hit), 6).alias("precision"))


def answers(spark, d):
    """Predictions: the best document's whole text; gold: the passage."""
    t = table(spark, d, "documents").select("doc_id", F.col("text").alias("pred"))
    return sparse(spark, d, 1).join(t, "doc_id").join(benchmark(spark, d), "q_id").select(F.col("q_id").alias("id"), "pred", F.col("text").alias("gold"), F.lit(0).alias("gold_id"))


SQL_ANS = SQL_SPARSE + ", ans AS (SELECT q_id AS id, d.text AS pred, b.text AS gold FROM sparse JOIN documents d USING (doc_id) JOIN benchmark b ON q_id = item_id WHERE rank = 1)"
_WORDS_OF = lambda c: f"list_filter(string_split({NORM.format(c)}, ' '), lambda x: x <> '')"


@register("ev6_token_f1", f"""WITH {SQL_ANS}, w AS (SELECT id, {_WORDS_OF('pred')} AS p, {_WORDS_OF('gold')} AS g FROM ans),
pc AS (SELECT id, x, count(*) AS n FROM (SELECT id, unnest(p) AS x FROM w) GROUP BY ALL), gc AS (SELECT id, x, count(*) AS n FROM (SELECT id, unnest(g) AS x FROM w) GROUP BY ALL),
m AS (SELECT id, sum(least(pc.n, gc.n)) AS c FROM pc JOIN gc USING (id, x) GROUP BY id), c AS (SELECT id, p, g, coalesce(c, 0) AS c FROM w LEFT JOIN m USING (id))
SELECT id, round(CASE WHEN c > 0 THEN 2.0 * c / (len(p) + len(g)) ELSE 0 END, 6) AS f1, round(c / greatest(len(p), 1)::DOUBLE, 6) AS precision, round(c / greatest(len(g), 1)::DOUBLE, 6) AS recall FROM c""")
def ev6(spark, d):
    return ev.token_scores(answers(spark, d))


@register("ev7_exact_sub_match", f"WITH {SQL_ANS} SELECT id, ({NORM.format('pred')} = {NORM.format('gold')})::INT AS em, contains({NORM.format('pred')}, {NORM.format('gold')})::INT AS sub_em FROM ans")
def ev7(spark, d):
    return answers(spark, d).select("id", ev.exact_match(F.col("pred"), F.col("gold")).alias("em"), ev.sub_match(F.col("pred"), F.col("gold")).alias("sub_em"))


@register("ev11_rouge_1", f"""WITH {SQL_ANS}, a AS (SELECT id, g, count(*) AS n FROM (SELECT id, unnest({TOKS.format('pred')}) AS g FROM ans) GROUP BY ALL), b AS (SELECT id, g, count(*) AS n FROM (SELECT id, unnest({TOKS.format('gold')}) AS g FROM ans) GROUP BY ALL)
SELECT id, round(max(2.0 * c / (x + y)), 6) AS score FROM (SELECT coalesce(a.id, b.id) AS id, sum(least(coalesce(a.n, 0), coalesce(b.n, 0))) AS c, sum(coalesce(a.n, 0)) AS x, sum(coalesce(b.n, 0)) AS y FROM a FULL JOIN b ON a.id = b.id AND a.g = b.g GROUP BY 1) GROUP BY id""")
def ev11(spark, d):
    return ev.rouge_n(answers(spark, d), 1)


@register("ev11_rouge_l")
def ev11l(spark, d):
    return answers(spark, d).select("id", ev.rouge_l(F.col("pred"), F.col("gold")).alias("score"))


@register("io14_cache", f"WITH {SQL_SPARSE} SELECT q_id, count(*) AS n, q_id % 2 = 0 AS cached FROM sparse WHERE rank <= 5 GROUP BY q_id")
def io14(spark, d):
    """Cached results for even queries; the misses are searched and spliced in."""
    q = benchmark(spark, d)
    docs = table(spark, d, "documents")
    cache = settled(rt.bm25_search(docs, q.where("q_id % 2 = 0"), 8).withColumn("cached", F.lit(True)))
    misses = q.join(cache.select("q_id").distinct(), "q_id", "left_anti")
    found = rt.bm25_search(docs, misses, 5).withColumn("cached", F.lit(False))
    return cache.where("rank <= 5").unionByName(found).groupBy("q_id", "cached").agg(F.count("*").alias("n")).select("q_id", "n", "cached")


@register("io14_lasting_cache", f"WITH {SQL_SPARSE} SELECT q_id, rank, doc_id, score, q_id % 2 = 0 AS cached, q_id % 4 = 0 AS short FROM sparse WHERE rank <= CASE WHEN q_id % 4 = 0 THEN 3 ELSE 5 END")
def io14_lasting(spark, d):
    """Even questions were asked before, every fourth for three results alone; the others are searched and spliced in."""
    q, docs = benchmark(spark, d), table(spark, d, "documents")
    path = scratch(spark, "cache")
    search = lambda asked, k: rt.bm25_search(docs, asked, k)
    Cache(spark, path).ask(q.where("q_id % 4 = 0"), 3, search)
    Cache(spark, path).ask(q.where("q_id % 4 = 2"), 5, search)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")  # of the short ones, which the column tells
        return Cache(spark, path).ask(q, 5, search)


@register("pr1_references", f"WITH {SQL_SPARSE} SELECT q_id, string_agg('Doc ' || rank || '(Title: ' || source || ') ' || text || chr(10), '' ORDER BY rank) AS refs FROM sparse JOIN documents USING (doc_id) WHERE rank <= 3 GROUP BY q_id")
def pr1(spark, d):
    return references(sparse(spark, d, 3).join(table(spark, d, "documents"), "doc_id"))


def references(found):
    line = F.format_string("Doc %d(Title: %s) %s\n", "rank", "source", "text")
    return found.groupBy("q_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", line.alias("line")))), lambda x: x["line"]), "").alias("refs"))


@register("rf1_extractive", f"""WITH {SQL_SPARSE}, s AS (SELECT q_id, b.text AS query, unnest(list_filter(string_split(regexp_replace(d.text, '([.!?])[ \\n]+', '\\1' || chr(1), 'g'), chr(1)), lambda x: trim(x) <> '')) AS s,
  generate_subscripts(list_filter(string_split(regexp_replace(d.text, '([.!?])[ \\n]+', '\\1' || chr(1), 'g'), chr(1)), lambda x: trim(x) <> ''), 1) - 1 AS pos FROM sparse JOIN benchmark b ON q_id = item_id JOIN documents d USING (doc_id) WHERE rank = 1),
c AS (SELECT *, len(list_intersect(list_distinct({TOKS.format('query')}), list_distinct({TOKS.format('s')}))) AS n FROM s)
SELECT q_id, string_agg(s, ' ' ORDER BY pos) AS context FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY n DESC, pos) AS r FROM c) WHERE r <= 3 GROUP BY q_id""")
def rf1(spark, d):
    """The three sentences that share most terms with the question, in the document's order."""
    t = table(spark, d, "documents").select("doc_id", plain_sentences(F.col("text")).alias("s"))
    s = sparse(spark, d, 1).select("q_id", "doc_id").join(t, "doc_id").join(benchmark(spark, d), "q_id").select("q_id", "text", F.posexplode("s").alias("pos", "s"))
    shared = F.size(F.array_intersect(F.array_distinct(tx.tokens(F.col("text"))), F.array_distinct(tx.tokens(F.col("s")))))
    best = rt.top_k(s.withColumn("n", shared), 3, "n", item="pos", rank="r")
    return best.groupBy("q_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "s"))), lambda x: x["s"]), " ").alias("context"))


@register("rf5_context_budget", f"""WITH {SQL_SPARSE}, l AS (SELECT q_id, doc_id, rank, len({TOKS.format('text')}) AS n FROM sparse JOIN documents USING (doc_id))
SELECT q_id, doc_id, rank, before::BIGINT AS before FROM (SELECT *, coalesce(sum(n) OVER (PARTITION BY q_id ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM l) WHERE before <= 1000""")
def rf5(spark, d):
    """Contexts by rank until the budget is overshot; the overshooting one stays."""
    n = table(spark, d, "documents").select("doc_id", F.size(tx.tokens(F.col("text"))).alias("n"))
    w = Window.partitionBy("q_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    return sparse(spark, d).join(n, "doc_id").withColumn("before", F.coalesce(F.sum("n").over(w), F.lit(0))).where("before <= 1000").select("q_id", "doc_id", "rank", "before")


@register("rf3_selective_context", f"""WITH t AS (SELECT doc_id, unnest({TOKS.format('text')}) AS term, generate_subscripts({TOKS.format('text')}, 1) - 1 AS pos FROM documents),
p AS (SELECT term, count(*) AS n FROM t GROUP BY term), s AS (SELECT sum(n) AS total FROM p),
i AS (SELECT doc_id, pos, term, round(-ln(n / total::DOUBLE), 6) AS info FROM t JOIN p USING (term), s),
c AS (SELECT doc_id, quantile_cont(info, 0.5) AS cut FROM i GROUP BY doc_id)
SELECT doc_id, count(*) AS kept, sha256(string_agg(term, ' ' ORDER BY pos)) AS digest FROM i JOIN c USING (doc_id) WHERE info >= cut GROUP BY doc_id""")
def rf3(spark, d):
    """Keeps the terms at or above the median self-information of their document (corpus unigrams)."""
    t = table(spark, d, "documents").select("doc_id", F.posexplode(tx.tokens(F.col("text"))).alias("pos", "term"))
    p = t.groupBy("term").agg(F.count("*").alias("n"))
    total = p.agg(F.sum("n").alias("total"))
    info = t.join(p, "term").crossJoin(F.broadcast(total)).select("doc_id", "pos", "term", F.round(-F.log(F.col("n") / F.col("total")), 6).alias("info"))
    cut = info.groupBy("doc_id").agg(F.percentile("info", F.lit(0.5)).alias("cut"))
    kept = info.join(cut, "doc_id").where("info >= cut")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "term"))), lambda x: x["term"]), " ")
    return kept.groupBy("doc_id").agg(F.count("*").alias("kept"), F.sha2(joined, 256).alias("digest"))


@register("kg3_dedup", "SELECT min(doc_id) AS doc_id, sha256(text) AS id FROM documents GROUP BY 2")
def kg3(spark, d):
    return table(spark, d, "documents").groupBy(F.sha2("text", 256).alias("id")).agg(F.min("doc_id").alias("doc_id"))
