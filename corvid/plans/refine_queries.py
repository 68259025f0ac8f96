"""Refiners, compression, triples and chains with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvid.functions import text as tx
from corvid.operators import compression as cp
from corvid.operators import refine as rf
from corvid.operators import retrieval as rt
from corvid.operators import routing as ro
from corvid.operators.loops import settled

from .registry import register
from .retrieval_queries import SQL_SPARSE, TOKS, _DENSE, benchmark, sparse, vectors
from .routing_queries import _OKAPI, _vectors, context_rows, context_scores, documents
from .text_queries import WORDS, docs

_W = lambda c: f"list_filter(regexp_split_to_array({c}, '[ \n\t]+'), lambda x: x <> '')"
_SENT = r"""list_filter(list_transform(string_split(regexp_replace(trim(substr(d.text || chr(10), strpos(d.text || chr(10), chr(10)) + 1), ' ' || chr(10) || chr(9)), '([!?]|(?:^|[^A-Za-z])\.)\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x, ' ' || chr(10) || chr(9))), lambda x: length(x) > 5)"""


@register("rf1_refined", f"""WITH {SQL_SPARSE}, s AS (SELECT q_id, doc_id, unnest({_SENT}) AS s, generate_subscripts({_SENT}, 1) - 1 AS pos FROM sparse JOIN documents d USING (doc_id) WHERE rank = 1),
qv AS (SELECT q_id, dim, n / sqrt(sum(n * n) OVER (PARTITION BY q_id)) AS w FROM (SELECT item_id AS q_id, ('0x' || substr(md5(term), 1, 6))::BIGINT % 64 AS dim, count(*) AS n FROM (SELECT item_id, unnest({TOKS.format('text')}) AS term FROM benchmark) GROUP BY ALL)),
sv AS (SELECT q_id, pos, dim, n / sqrt(sum(n * n) OVER (PARTITION BY q_id, pos)) AS w FROM (SELECT q_id, pos, ('0x' || substr(md5(term), 1, 6))::BIGINT % 64 AS dim, count(*) AS n FROM (SELECT q_id, pos, unnest({TOKS.format('s')}) AS term FROM s) GROUP BY ALL)),
c AS (SELECT s.q_id, s.pos, any_value(s.s) AS s, round(coalesce(sum(qv.w * sv.w), 0), 6) AS x FROM s LEFT JOIN sv USING (q_id, pos) LEFT JOIN qv ON qv.q_id = s.q_id AND qv.dim = sv.dim GROUP BY s.q_id, s.pos)
SELECT q_id, string_agg(s, ' ' ORDER BY pos) AS context FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY x DESC, pos) AS r FROM c) WHERE r <= 3 GROUP BY q_id""")
def rf1r(spark, d):
    """The three sentences nearest to the question by their vectors, in the document's order; the title line is dropped."""
    best = sparse(spark, d, 1).select("q_id", "doc_id").join(documents(spark, d), "doc_id")
    s = settled(best.select("q_id", F.posexplode(rf.refined_sentences(F.col("text"))).alias("pos", "s")).withColumn("key", F.concat_ws("_", "q_id", "pos")))
    q = ro.hash_vectors(benchmark(spark, d), "q_id").select(F.col("id").alias("q_id"), "dim", F.col("w").alias("x"))
    v = ro.hash_vectors(s, "key", "s").select(F.col("id").alias("key"), "dim", F.col("w").alias("y"))
    near = s.join(v, "key").join(q, ["q_id", "dim"]).groupBy("key").agg(F.sum(F.col("x") * F.col("y")).alias("dot"))
    scored = s.join(near, "key", "left").withColumn("dot", F.round(F.coalesce("dot", F.lit(0.0)), 6))
    chosen = rt.top_k(scored, 3, "dot", item="pos", rank="r")
    return chosen.groupBy("q_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "s"))), lambda x: x["s"]), " ").alias("context"))


@register("rf2_abstractive_prompt", f"WITH {SQL_SPARSE} SELECT q_id, rank, 'Question: ' || b.text || chr(10) || ' Document: ' || d.text || chr(10) || ' Summary: ' AS prompt FROM sparse JOIN benchmark b ON q_id = item_id JOIN documents d USING (doc_id) WHERE rank <= 2")
def rf2(spark, d):
    """The summariser's prompt; the model is behind the generator seam."""
    return context_rows(spark, d, 2).select("q_id", "rank", F.concat(F.lit("Question: "), "query", F.lit("\n Document: "), "text", F.lit("\n Summary: ")).alias("prompt"))


_CTX = f"c AS (SELECT q_id, doc_id, rank, len({_W('d.text')}) AS size, len({_W('b.text')}) AS asked, d.text, b.text AS query FROM sparse JOIN benchmark b ON q_id = item_id JOIN documents d USING (doc_id) WHERE rank <= 10)"


def sized(spark, d):
    return context_rows(spark, d).select("q_id", "doc_id", "rank", F.size(tx.words(F.col("text"))).cast("long").alias("size"), F.size(tx.words(F.col("query"))).cast("long").alias("asked"), "text", "query")


@register("rf4_prompt_wrapper", f"""WITH {SQL_SPARSE}, {_CTX}, p AS (SELECT q_id, 'Answer the question.' || chr(10) || chr(10) || string_agg(replace(text, chr(10), ' '), chr(10) || chr(10) ORDER BY rank) || chr(10) || chr(10) || any_value(query) AS prompt FROM c GROUP BY q_id),
s AS (SELECT q_id, string_split(prompt, chr(10) || chr(10)) AS s FROM p), x AS (SELECT q_id, s[1] AS instruction, s[len(s)] AS question, unnest(s[2:len(s) - 1]) AS ctx, generate_subscripts(s[2:len(s) - 1], 1) AS n FROM s),
z AS (SELECT *, len({_W('ctx')}) AS size FROM x), b AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY q_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(size) OVER (PARTITION BY q_id) AS total FROM z)
SELECT q_id, any_value(instruction) AS instruction, count(*) AS kept, sum(size)::BIGINT AS words FROM b WHERE before <= 0.55::DOUBLE * total + 100 GROUP BY q_id""")
def rf4(spark, d):
    """A prompt taken apart at blank lines: instruction, contexts, question; contexts by rank until 0.55 of the words and 100 more are overshot."""
    from pyspark.sql import Window

    c = context_rows(spark, d)
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", F.replace(F.col("text"), F.lit("\n"), F.lit(" ")).alias("t")))), lambda x: x["t"]), "\n\n")
    prompts = c.groupBy("q_id").agg(F.concat(F.lit("Answer the question.\n\n"), body, F.lit("\n\n"), F.first("query")).alias("prompt"))
    s = F.split("prompt", "\n\n")
    parts = prompts.select("q_id", s[0].alias("instruction"), F.posexplode(F.slice(s, 2, F.size(s) - 2)).alias("n", "ctx")).withColumn("size", F.size(tx.words(F.col("ctx"))).cast("long"))
    by = Window.partitionBy("q_id")
    b = parts.withColumn("before", F.coalesce(F.sum("size").over(by.orderBy("n").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("total", F.sum("size").over(by))
    return b.where(F.col("before") <= 0.55 * F.col("total") + 100).groupBy("q_id").agg(F.first("instruction").alias("instruction"), F.count("*").alias("kept"), F.sum("size").alias("words"))


@register("rf7a_target", f"WITH {SQL_SPARSE}, {_CTX}, t AS (SELECT q_id, any_value(asked) AS q, sum(size) AS n FROM c GROUP BY q_id), z AS (SELECT *, (7 + q + n) * 0.5::DOUBLE - 7 - q AS target FROM t) SELECT q_id, round(target, 6) AS target, round((7 + q + n) / (7 + q + target), 6) AS ratio, round((7 + q + target) / (7 + q + n), 6) AS rate, round((n - target) * 0.06::DOUBLE / 1000, 6) AS saving FROM z")
def rf7a(spark, d):
    t = sized(spark, d).groupBy("q_id").agg(F.first("asked").alias("q"), F.sum("size").alias("n"))
    t = t.withColumn("target", rf.compression_target(7, F.col("q"), F.col("n"), 0.5))
    before, after = 7 + F.col("q") + F.col("n"), 7 + F.col("q") + F.col("target")
    return t.select("q_id", F.round("target", 6).alias("target"), *rf.compression_statistics(before, after))


@register("rf7b_window_ratios", f"""WITH {SQL_SPARSE}, {_CTX}, a AS (SELECT *, count(*) OVER w AS n, sum(size) OVER w AS total, coalesce(sum(size) OVER (PARTITION BY q_id ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a FROM c WINDOW w AS (PARTITION BY q_id)),
r AS (SELECT *, a + size AS b, round(greatest(0, least(1, 800::DOUBLE / (total + 1) + 0.2::DOUBLE * CASE WHEN n > 1 THEN 1 - 2 * (rank - 1) / (n - 1)::DOUBLE ELSE 0 END)), 6) AS ratio FROM a WHERE size > 0),
l AS (SELECT *, unnest(generate_series((a // 200)::BIGINT, ((b - 1) // 200)::BIGINT)) AS w FROM r)
SELECT q_id, doc_id, w AS "window", (least(b, (w + 1) * 200) - greatest(a, w * 200))::BIGINT AS tokens, ratio FROM l""")
def rf7b(spark, d):
    return rf.window_ratios(sized(spark, d), 800.0, 0.2)


@register("rf7c_conditional_loss", f"""WITH {SQL_SPARSE}, {_CTX}, u AS (SELECT term, count(*) AS n FROM (SELECT unnest({TOKS.format('text')}) AS term FROM documents) GROUP BY term), z AS (SELECT sum(n) AS total FROM u),
qt AS (SELECT DISTINCT q_id, doc_id, rank, unnest({TOKS.format('query')}) AS term FROM c WHERE rank <= 3), ct AS (SELECT DISTINCT q_id, doc_id, unnest({TOKS.format('text')}) AS term FROM c WHERE rank <= 3)
SELECT q_id, doc_id, round(avg(CASE WHEN ct.term IS NULL THEN -ln(coalesce(n, 1) / total::DOUBLE) ELSE 0 END), 6) AS after, round(avg(-ln(coalesce(n, 1) / total::DOUBLE)), 6) AS alone FROM qt LEFT JOIN ct USING (q_id, doc_id, term) LEFT JOIN u USING (term), z GROUP BY q_id, doc_id""")
def rf7c(spark, d):
    """Mean loss of the question's terms alone and after a context; in the unigram stand-in a term of the context costs nothing."""
    c = settled(context_rows(spark, d, 3))
    counts = documents(spark, d).select(F.explode(tx.tokens(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    asked = c.select("q_id", "doc_id", F.explode(F.array_distinct(tx.tokens(F.col("query")))).alias("term"))
    held = c.select("q_id", "doc_id", F.explode(F.array_distinct(tx.tokens(F.col("text")))).alias("term")).withColumn("held", F.lit(True))
    loss = -F.log(F.coalesce("n", F.lit(1)) / F.col("total"))
    wanted = counts.join(F.broadcast(asked.select("term").dropDuplicates()), "term", "left_semi")
    rows = asked.join(held, ["q_id", "doc_id", "term"], "left").join(wanted, "term", "left").crossJoin(F.broadcast(total))
    return rows.groupBy("q_id", "doc_id").agg(F.round(F.avg(F.when(F.col("held").isNull(), loss).otherwise(0.0)), 6).alias("after"), F.round(F.avg(loss), 6).alias("alone"))


@register("rf8a_context_filter", f"""WITH {SQL_SPARSE}, {_CTX}, p AS (SELECT q_id, doc_id, rank, round(coalesce(list_avg(list_transform({_W('text')}, lambda x: least(1.0::DOUBLE, length(x) / 16.0::DOUBLE))), 0), 9) AS prob FROM c),
t AS (SELECT q_id, quantile_cont(prob, 0.3) AS t FROM p GROUP BY q_id) SELECT q_id, doc_id, round(prob, 6) AS prob FROM p JOIN t USING (q_id) WHERE prob >= t - 1e-12 OR rank = 1""")
def rf8a(spark, d):
    """Contexts by the mean probability of their words (the stand-in of rf8); the best hit is forced."""
    w = tx.words(F.col("text"))
    mean = F.aggregate(w, F.lit(0.0), lambda s, x: s + F.least(F.lit(1.0), F.length(x) / 16.0)) / F.greatest(F.size(w), F.lit(1))
    c = context_rows(spark, d).select("q_id", "doc_id", F.round(mean, 9).alias("prob"), (F.col("rank") == 1).alias("forced"))
    return rf.keep_contexts(c, "q_id", 0.7).select("q_id", "doc_id", F.round("prob", 6).alias("prob"))


_MARKS = r"list_filter(string_split(regexp_replace(regexp_replace(text, '\n', ' ' || chr(1) || ' ', 'g'), '\.( |$)', ' .\1', 'g'), ' '), lambda x: x <> '')"


@register("rf8b_boundary_chunks", f"""WITH RECURSIVE t AS (SELECT doc_id, {_MARKS} AS t FROM documents),
c AS (SELECT doc_id, t, 0 AS start FROM t WHERE len(t) > 0
  UNION ALL SELECT doc_id, t, CASE WHEN cut_at > 0 THEN start + cut_at ELSE start + 50 END FROM (SELECT *, coalesce(list_max(list_transform(generate_series(1, 50), lambda n: CASE WHEN t[start + n] IN ('.', chr(1)) THEN n ELSE 0 END)), 0) AS cut_at FROM c WHERE len(t) - start >= 50) WHERE CASE WHEN cut_at > 0 THEN start + cut_at ELSE start + 50 END < len(t))
SELECT doc_id, start::BIGINT AS start FROM c""")
def rf8b(spark, d):
    """Chunks of at most 50 tokens that end behind a full stop or a line, where there is one."""
    marked = F.regexp_replace(F.regexp_replace("text", "\n", " \u0001 "), r"\.( |$)", " .$1")
    t = F.filter(F.split(marked, " "), lambda x: x != "")
    return docs(spark, d).select("doc_id", F.explode(rf.boundary_chunks(t, 50, (".", "\u0001"))).alias("start")).withColumn("start", F.col("start").cast("long"))


@register("rf9_structured_prompt", f"SELECT doc_id, (n - 1)::BIGINT AS pos, CASE (n - 1) % 3 WHEN 0 THEN 0.5::DOUBLE END AS rate, (n - 1) % 3 <> 1 AS compress, len({_W('x')})::BIGINT AS words FROM (SELECT doc_id, unnest(l) AS x, generate_subscripts(l, 1) AS n FROM (SELECT doc_id, list_prepend(source, string_split(text, chr(10))) AS l FROM documents WHERE text IS NOT NULL))")
def rf9(spark, d):
    """The source and every line of a text as a segment: in turns with a rate, not to be compressed, and plain."""
    head = lambda n: F.when(n % 3 == 0, "<part, rate = 0.5>").when(n % 3 == 1, " and <part, compress=False>").otherwise("<part>")
    lines = F.concat(F.array("source"), F.split("text", "\n"))
    prompt = F.array_join(F.transform(lines, lambda x, n: F.concat(head(n), x, F.lit("</part>"))), "")
    rows = docs(spark, d).select("doc_id", F.posexplode(rf.prompt_segments(prompt)).alias("pos", "x"))
    return rows.select("doc_id", F.col("pos").cast("long").alias("pos"), "x.rate", "x.compress", F.size(tx.words(F.col("x.text"))).cast("long").alias("words"))


def gzip_scores(c):
    """The nearer a context compresses with the question, the higher."""
    return c.select("q_id", "doc_id", (-cp.gzip_distance("query", "text")).alias("s"))


def vector_scores(c):
    ask = c.select("q_id", F.col("query").alias("text")).dropDuplicates(["q_id"])
    return ro.bi_rerank(c.select("q_id", "doc_id"), ask, c.select("doc_id", "text").dropDuplicates(["doc_id"]), 10).select("q_id", "doc_id", F.col("score").alias("s"))


RANKERS = {"bm25": context_scores, "gzip": gzip_scores, "vectors": vector_scores}


def ranked_contexts(spark, d, name):
    c = settled(context_rows(spark, d))
    scored = c.select("q_id", "doc_id").join(RANKERS[name](c), ["q_id", "doc_id"], "left").select("q_id", "doc_id", F.round(F.coalesce("s", F.lit(0.0)), 6).alias("score"))
    return rt.top_k(scored, 10, rank="place").select("q_id", "doc_id", "place")


@register("rf10_rank_contexts", f"WITH {SQL_SPARSE}, {_OKAPI} SELECT q_id, doc_id, row_number() OVER (PARTITION BY q_id ORDER BY round(coalesce(s, 0), 6) DESC, doc_id) AS place FROM oc LEFT JOIN sc USING (q_id, doc_id)")
def rf10(spark, d):
    """The contexts of a question by one of the rankers."""
    return ranked_contexts(spark, d, "bm25")


@register("rf10_by_vectors", f"WITH {SQL_SPARSE}, qv AS {_vectors('item_id', 'benchmark')}, dv AS {_vectors('doc_id', 'documents')}, s AS (SELECT q_id, doc_id, round(coalesce(sum(qv.w * dv.w), 0), 6) AS score FROM (SELECT * FROM sparse WHERE rank <= 10) LEFT JOIN (SELECT q.id AS q_id, v.id AS doc_id, q.w AS w, v.w AS v FROM qv q JOIN dv v ON q.dim = v.dim) p USING (q_id, doc_id) GROUP BY ALL) SELECT q_id, doc_id, row_number() OVER (PARTITION BY q_id ORDER BY score DESC, doc_id) AS place FROM s".replace("sum(qv.w * dv.w)", "sum(p.w * p.v)"))
def rf10v(spark, d):
    return ranked_contexts(spark, d, "vectors")


@register("rf10_by_gzip")
def rf10g(spark, d):
    return ranked_contexts(spark, d, "gzip")


@register("rf11_recover", f"SELECT doc_id, array_to_string(w[1:greatest(1, ((len(w) - 1) // 2) * 2 + 1)], ' ') AS out FROM (SELECT doc_id, {WORDS} AS w FROM documents) WHERE len(w) > 0")
def rf11(spark, d):
    """Every second word is kept and answered with; the answer comes back with the words between."""
    w = tx.words(F.col("text"))
    kept = docs(spark, d).select("doc_id", w.alias("w")).where(F.size("w") > 0)
    kept = kept.withColumn("places", F.sequence(F.lit(0), F.size("w") - 1, F.lit(2)))
    answer = F.array_join(F.transform("places", lambda n: F.element_at("w", n + 1)), " ")
    return kept.select("doc_id", rf.recover(answer, F.array_join("w", " "), "places").alias("out"))


# --- triples ------------------------------------------------------------------------------


@register("kg1_exemplars", f"WITH s AS ({_DENSE} AND b.label = 0) SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY score DESC, item) AS rank FROM s) WHERE rank <= 3")
def kg1(spark, d):
    """Vectors of one class are the demonstrations."""
    v, q = vectors(spark, d)
    return rf.exemplars(v.where("label = 0"), q)


_TRIPLES = f"tr AS (SELECT doc_id AS triple, list_distinct({TOKS.format('text')}[1:3]) AS terms FROM documents WHERE len({TOKS.format('text')}) >= 3)"


def triples_of(spark, d):
    """A triple for each document: its first three terms."""
    t = tx.tokens(F.col("text"))
    return documents(spark, d).select(F.col("doc_id").alias("triple"), t.alias("t")).where("size(t) >= 3").select("triple", F.slice("t", 1, 3).alias("terms"))


@register("kg4_first_hop", f"""WITH {_TRIPLES}, q AS (SELECT item_id AS q_id, unnest(list_distinct({TOKS.format('text')})) AS term FROM benchmark),
n AS (SELECT q_id, triple, count(*) AS n FROM q JOIN (SELECT triple, unnest(terms) AS term FROM tr) USING (term) GROUP BY ALL),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY n DESC, triple) AS r FROM n) WHERE r <= 5)
SELECT q_id, triple, round(exp(n - max(n) OVER w) / sum(exp(n)) OVER w * exp(max(n) OVER w), 6) AS prob FROM b WINDOW w AS (PARTITION BY q_id)""")
def kg4(spark, d):
    got = rf.chains(benchmark(spark, d), triples_of(spark, d), 1, settled).where("size(path) > 0")
    return got.select("q_id", F.element_at("path", 1).alias("triple"), F.round("prob", 6).alias("prob"))


@register("kg4_beam")
def kg4b(spark, d):
    """Chains of two hops; a driver loop of bounded rounds over the beam table."""
    return rf.chains(benchmark(spark, d), triples_of(spark, d), 2, settled)


@register("kg5_chain_context", f"""WITH {SQL_SPARSE}, t AS (SELECT q_id, '<' || source || '; is in; ' || lang || '>' AS text, min(rank) AS first_at FROM sparse JOIN documents USING (doc_id) WHERE rank <= 5 AND lang IS NOT NULL GROUP BY ALL),
n AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY first_at, text) AS n FROM t) SELECT q_id, string_agg(n || '. ' || text, chr(10) ORDER BY n) AS context FROM n GROUP BY q_id""")
def kg5(spark, d):
    """A chain for each of the best documents, of one triple on its source and language."""
    found = sparse(spark, d, 10).join(docs(spark, d).select("doc_id", "source", "lang"), "doc_id").where("lang IS NOT NULL")
    return rf.chain_context(found.select("q_id", F.col("rank").alias("chain"), F.lit(0).alias("pos"), F.concat(F.lit("<"), "source", F.lit("; is in; "), "lang", F.lit(">")).alias("text")))


@register("kg2_triples", "SELECT doc_id, source AS head, 'of; in' AS relation, lang AS tail FROM documents WHERE lang IS NOT NULL")
def kg2(spark, d):
    """Triples read back from a generated text: the right split keeps a head with semicolons, malformed ones are skipped."""
    from .text_queries import triples

    made = F.concat(F.lit("<"), "source", F.lit("; of| in; "), "lang", F.lit("> <bad> <a;b>"))
    got = triples(docs(spark, d).where("lang IS NOT NULL").select("doc_id", made.alias("text")))
    return got.select("doc_id", "head", F.replace(F.col("relation"), F.lit("|"), F.lit(";")).alias("relation"), "tail")
