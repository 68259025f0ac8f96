"""Pipelines: the hybrid retrieval pipeline in full, and the iterative ones for a fixed number of rounds with SQL."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from corvid.functions import text as tx
from corvid.operators import compression as cp
from corvid.operators import evaluation as ev
from corvid.operators import forward as fw
from corvid.operators import generation as gn
from corvid.operators import retrieval as rt
from corvid.operators import routing as ro
from corvid.operators.loops import pooled, settled, written
from corvid.session import scratch, spread

from .generation_queries import _FIRST
from .registry import register
from .retrieval_queries import _L2, _METRICS, SQL_INDEX, SQL_QRELS, SQL_SPARSE, TOKS, benchmark, jd1, qrels, reranked, sparse, submission
from .routing_queries import context_rows, documents
from .text_queries import WORDS

_IDX = SQL_INDEX.replace("idx AS (", "idx AS MATERIALIZED (")
_NW = f"len({WORDS})"


def rounds_sql(rounds: int, grow: str, why: str) -> str:
    """The states of an agent as CTEs: st0, st1, ... with the finish reason of each question."""
    out = "st0 AS (SELECT item_id AS q_id, text, text AS query, '' AS answer, []::VARCHAR[] AS trail, NULL::VARCHAR AS reason FROM benchmark)"
    for k in range(1, rounds + 1):
        end = f"coalesce({why}, 'rounds')" if k == rounds else why
        out += f""",
g{k} AS MATERIALIZED (SELECT * FROM st{k - 1} WHERE reason IS NULL),
x{k} AS (SELECT q_id, unnest(list_distinct({TOKS.format('query')})) AS term FROM g{k}),
h{k} AS (SELECT q_id, doc_id, round(sum(weight), 6) AS score FROM idx JOIN x{k} USING (term) GROUP BY ALL),
b{k} AS (SELECT q_id, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY score DESC, doc_id) AS r FROM h{k}) WHERE r = 1),
n{k} AS (SELECT g.*, coalesce({_FIRST.format('d.text')}, '') AS new FROM g{k} g LEFT JOIN b{k} USING (q_id) LEFT JOIN documents d USING (doc_id)),
st{k} AS MATERIALIZED (SELECT q_id, text, {grow} AS query, CASE WHEN new = '' THEN answer ELSE new END AS answer, list_append(trail, new) AS trail, {end} AS reason FROM n{k} UNION ALL SELECT * FROM st{k - 1} WHERE reason IS NOT NULL)"""
    return out


_GROW = "concat_ws(' ', text, new)"
_EMPTY_OR_REPEAT = "CASE WHEN new = '' THEN 'empty' WHEN new = answer THEN 'repeat' END"
#: query name: (policy, next query, finish reason)
_AGENTS = {
    "pl6_iter_retgen": ("iterative", _GROW, "NULL::VARCHAR"),
    "pl8_flare": ("confident", "concat_ws(' ', text, array_to_string(list_filter(string_split(new, ' '), lambda w: length(w) > 3), ' '))", "CASE WHEN len(list_filter(string_split(new, ' '), lambda w: length(w) <= 1)) = 0 THEN 'confident' END"),
    "pl9_self_ask": ("self-ask", "concat_ws(' ', text, 'Intermediate answer:', new)", _EMPTY_OR_REPEAT),
    "pl12_reasoning": ("reasoning", _GROW, "CASE WHEN new = '' THEN 'no answer' WHEN new = answer THEN 'answer found' END"),
    "pl13_boxed": ("boxed", _GROW, "CASE WHEN new = answer THEN 'boxed' END"),
    "pl14_tagged": ("tagged", "concat_ws(' ', query, new)", _EMPTY_OR_REPEAT),
    "pl16_thought_and_action": ("thought and action", _GROW, "CASE WHEN new = answer THEN 'repeat' WHEN new = '' THEN 'finish' END"),
    "pl17_sub_queries": ("chain of sub-queries", "new", "NULL::VARCHAR"),
}


def forward(spark, d):
    """The index of all documents, written once for all rounds. Beside it lie their first sentences, so that a round that
    answers with them doesn't read every text again."""
    return fw.build(spread(documents(spark, d)), scratch(spark, "forward"), keep=F.regexp_extract("text", r"^([^.!?\n]*)", 1))


def best_of(held):
    return lambda q: held.search(q, 1).select("q_id", "doc_id", "rank")


def searching(spark, d):
    return best_of(forward(spark, d))


def with_index(spark, d, run):
    """run(index) with the index of all documents, which is deleted as it returns: its result is settled by then. Else a
    session of many queries would hold about the size of the texts for each of them."""
    held = forward(spark, d)
    try:
        return run(held)
    finally:
        held.drop()


def agent(spark, d, name, questions=None):
    asked = benchmark(spark, d) if questions is None else questions
    return with_index(spark, d, lambda held: gn.run_agent(asked, best_of(held), held.kept, gn.POLICIES[name], written))


def _register(name, policy, grow, why):
    rounds = gn.POLICIES[policy].rounds

    def query(spark, d):
        out = agent(spark, d, policy)
        return out.select("q_id", "answer", F.size("trail").cast("long").alias("rounds"), F.array_join("trail", "|").alias("trail"), "reason")

    query.__doc__ = f"The `{policy}` agent: {rounds} rounds at most."
    register(name, f"WITH {_IDX}, {rounds_sql(rounds, grow, why)} SELECT q_id, answer, len(trail)::BIGINT AS rounds, array_to_string(trail, '|') AS trail, reason FROM st{rounds}")(query)


for _name, (_policy, _grow, _why) in _AGENTS.items():
    _register(_name, _policy, _grow, _why)


@register("pl10_ircot", f"""WITH {_IDX}, r1 AS (SELECT item_id AS q_id, text FROM benchmark),
x1 AS (SELECT q_id, unnest(list_distinct({TOKS.format('text')})) AS term FROM r1), h1 AS (SELECT q_id, doc_id, round(sum(weight), 6) AS score FROM idx JOIN x1 USING (term) GROUP BY ALL), t1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY score DESC, doc_id) AS rank FROM h1) WHERE rank <= 5),
r2 AS (SELECT q_id, r1.text || ' ' || {_FIRST.format('d.text')} AS text FROM r1 JOIN t1 USING (q_id) JOIN documents d USING (doc_id) WHERE rank = 1 AND {_FIRST.format('d.text')} <> ''),
x2 AS (SELECT q_id, unnest(list_distinct({TOKS.format('text')})) AS term FROM r2), h2 AS (SELECT q_id, doc_id, round(sum(weight), 6) AS score FROM idx JOIN x2 USING (term) GROUP BY ALL), t2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY score DESC, doc_id) AS rank FROM h2) WHERE rank <= 5),
p AS (SELECT q_id, doc_id, max(score) AS score FROM (SELECT * FROM t1 UNION ALL SELECT * FROM t2) GROUP BY ALL)
SELECT q_id, doc_id, score, row_number() OVER (PARTITION BY q_id ORDER BY score, doc_id DESC) AS place FROM p""")
def pl10(spark, d):
    """Two rounds with a growing pool that keeps each document's best score; order ascending."""
    return with_index(spark, d, lambda held: pooled(benchmark(spark, d), held.search, held.kept, rounds=2, k=5))


@register("pl15_several_queries")
def pl15(spark, d):
    """Up to three queries in a step, their answers joined for each question."""
    out = agent(spark, d, "several queries")
    return out.select("q_id", "answer", F.size("trail").cast("long").alias("rounds"), "reason")


@register("pl11_query_tree")
def pl11(spark, d):
    """Rewrite, decompose or disambiguate, two levels; the best leaf of each question."""
    return with_index(spark, d, lambda held: gn.query_tree(benchmark(spark, d), best_of(held), documents(spark, d), 2, written))


_DEEP = SQL_SPARSE.replace("rank <= 20", "rank <= 216")
_HEAD = f"""lap AS (SELECT q_id, doc_id, round(len(list_intersect(list_distinct({TOKS.format('b.text')}), list_distinct({TOKS.format('d.text')}))) / greatest(len(list_distinct({TOKS.format('b.text')})), 1)::DOUBLE, 6) AS score FROM sparse JOIN benchmark b ON q_id = item_id JOIN documents d USING (doc_id) WHERE rank <= 55),
ch AS (SELECT q_id, doc_id, rank FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY score DESC, doc_id) AS rank FROM lap) WHERE rank <= 5 AND score > 0.5),
al AS (SELECT q_id, doc_id, 0 AS part, rank FROM ch UNION ALL SELECT q_id, doc_id, 1, rank FROM sparse WHERE (q_id, doc_id) NOT IN (SELECT (q_id, doc_id) FROM ch)),
fi AS (SELECT q_id, doc_id, place AS rank FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY part, rank, doc_id) AS place FROM al) WHERE place <= 5)"""


def staged(spark, d):
    """180 candidates and a fifth more, the first 55 reranked, the five best over 0.5, backfilled from the candidates."""
    candidates = settled(sparse(spark, d, ro.over_fetch(180)))
    chosen = reranked(spark, d, candidates.where("rank <= 55"), 5).where("score > 0.5")
    return settled(rt.backfill(settled(ro.first_of_each(chosen, ["rank"])), candidates, 5))


@register("pl0_full", f"WITH {_DEEP}, {_HEAD}, {SQL_QRELS}, {_METRICS.format('fi')}")
def pl0f(spark, d):
    """All stages of the hybrid pipeline, evaluated."""
    return ev.retrieval_metrics(staged(spark, d).withColumnRenamed("place", "rank"), qrels(spark, d), 5, benchmark(spark, d))


@register("pl0_submission", f"WITH {_DEEP}, {_HEAD}, l AS (SELECT q_id, list(doc_id ORDER BY rank) AS ids FROM fi GROUP BY q_id) SELECT item_id AS q_id, '[' || array_to_string(list_transform(generate_series(1, 5), lambda n: coalesce(ids[least(n, len(ids))], 1)), ',') || ']' AS web_list FROM benchmark LEFT JOIN l ON item_id = q_id")
def pl0s(spark, d):
    return submission(staged(spark, d), benchmark(spark, d))


def submission_problems(lists, questions, k):
    """(q_id, problem) of a submission (q_id, web_list): questions that lack a row, rows without a
    question, repeated rows, lists of another length."""
    ids = F.from_json("web_list", "array<bigint>")
    rows = lists.groupBy("q_id").agg(F.count("*").alias("n"), F.max(F.size(ids) != k).alias("bad"))
    both = questions.select("q_id", F.lit(True).alias("asked")).dropDuplicates(["q_id"]).join(rows, "q_id", "full")
    found = F.array(
        F.when(F.col("n").isNull(), F.lit("missing")),
        F.when(F.col("asked").isNull(), F.lit("extra")),
        F.when(F.col("n") > 1, F.lit("repeated")),
        F.when(F.col("bad"), F.lit("length")),
    )
    return both.select("q_id", F.explode(F.filter(found, lambda x: x.isNotNull())).alias("problem"))


@register("io11_validate", "SELECT item_id AS q_id, 'missing' AS problem FROM benchmark WHERE item_id % 5 = 0 UNION ALL SELECT item_id + 1000000, 'extra' FROM benchmark WHERE item_id % 7 = 0 UNION ALL SELECT item_id, 'length' FROM benchmark WHERE item_id % 5 = 1")
def io11v(spark, d):
    """A submission broken on purpose: rows missing, rows too many, lists too short."""
    q = benchmark(spark, d).select("q_id")
    good = F.when(F.col("q_id") % 5 == 1, "[1,2]").otherwise("[1,2,3,4,5]")
    made = q.where("q_id % 5 <> 0").select("q_id", good.alias("web_list")).unionByName(q.where("q_id % 7 = 0").select((F.col("q_id") + 1000000).alias("q_id"), F.lit("[5,4,3,2,1]").alias("web_list")))
    return submission_problems(made, q, 5)


_PL1 = f"ans1 AS (SELECT item_id AS q_id, b.text AS gold, coalesce({_FIRST.format('d.text')}, '') AS answer, doc_id FROM benchmark b LEFT JOIN sparse ON item_id = q_id AND rank = 1 LEFT JOIN documents d USING (doc_id))"


@register("pl1_sequential", f"WITH {SQL_SPARSE}, {_PL1} SELECT q_id, answer FROM ans1")
def pl1(spark, d):
    """Retrieve, put the references into a prompt, generate, parse."""
    ctx = context_rows(spark, d, 3)
    prompt = gn.numbered_documents(ctx.withColumn("title", F.lit("document")))
    generated = gn.FirstSentence("(1)Title: document Text: ").apply(prompt, "docs")
    parsed = generated.select("q_id", gn.PARSERS["basic"](F.col("pred")).alias("answer"))
    return benchmark(spark, d).select("q_id").join(parsed, "q_id", "left").select("q_id", F.coalesce("answer", F.lit("")).alias("answer"))


_JUDGED = f"""knn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY score, item) AS rank FROM ({_L2})) WHERE rank <= 5),
pri AS (SELECT count(*) FILTER (WHERE label % 2 = 0) - count(*) FILTER (WHERE label % 2 = 1) AS delta, count(*) AS n FROM embeddings),
dk AS (SELECT q_id, count(*) FILTER (WHERE label % 2 = 0) - count(*) FILTER (WHERE label % 2 = 1) AS dk FROM knn GROUP BY q_id),
jud AS (SELECT q_id, CASE WHEN delta < 0 THEN NOT (dk < 0 AND dk <= trunc(delta * 5 / n::DOUBLE)) ELSE dk > 0 AND dk >= trunc(delta * 5 / n::DOUBLE) END AS judge FROM dk, pri)"""


@register("pl2_conditional", f"WITH {SQL_SPARSE}, {_JUDGED}, v AS (SELECT item_id AS id, coalesce(judge, true) AS judge FROM benchmark LEFT JOIN jud ON item_id = q_id) SELECT id, CASE WHEN judge THEN 'retrieved' ELSE 'naive' END AS route, CASE WHEN judge THEN doc_id END AS doc_id FROM v LEFT JOIN sparse ON id = q_id AND rank = 1")
def pl2(spark, d):
    """Questions go by the nearest-neighbour judge's verdict (of the vector with their id; without one, they are
    retrieved for) through retrieval or past it, and are merged by id."""
    verdict = jd1(spark, d).select("q_id", "judge")
    q = settled(benchmark(spark, d).join(verdict, "q_id", "left").withColumn("judge", F.coalesce("judge", F.lit(True))))
    yes, no = q.where("judge"), q.where("NOT judge")
    found = with_index(spark, d, lambda held: written(held.search(yes.select("q_id", "text"), 1).select("q_id", "doc_id")))
    kept = yes.join(found, "q_id", "left").select(F.col("q_id").alias("id"), F.lit("retrieved").alias("route"), "doc_id")
    return kept.unionByName(no.select(F.col("q_id").alias("id"), F.lit("naive").alias("route"), F.lit(None).cast("long").alias("doc_id")))


@register("pl3_adaptive", f"WITH {_IDX}, {rounds_sql(3, _GROW, 'NULL::VARCHAR')}, k AS (SELECT item_id AS q_id, CASE WHEN {_NW} <= 15 THEN 'A' WHEN {_NW} <= 30 THEN 'B' ELSE 'C' END AS route FROM benchmark) SELECT q_id, route, CASE route WHEN 'A' THEN '' WHEN 'B' THEN st1.answer ELSE st3.answer END AS answer FROM k JOIN st1 USING (q_id) JOIN st3 USING (q_id)")
def pl3(spark, d):
    """No retrieval, one, or three rounds, by the kind of question."""
    q = benchmark(spark, d).withColumn("route", gn.adaptive_route(F.col("text")))
    once = gn.Policy(1, finish=lambda answer, last: F.lit(None).cast("string"))
    run = lambda held, kind, policy: gn.run_agent(q.where(F.col("route") == kind).select("q_id", "text"), best_of(held), held.kept, policy, written).select("q_id", F.lit(kind).alias("route"), "answer")
    none = q.where("route = 'A'").select("q_id", "route", F.lit("").alias("answer"))
    return with_index(spark, d, lambda held: none.unionByName(run(held, "B", once)).unionByName(run(held, "C", gn.POLICIES["iterative"])))


@register("pl5_sure", f"""WITH {SQL_SPARSE}, c AS (SELECT q_id, rank, {_FIRST.format('d.text')} AS answer, len(list_intersect(list_distinct({TOKS.format('b.text')}), list_distinct({TOKS.format(_FIRST.format('d.text'))}))) AS n FROM sparse JOIN benchmark b ON q_id = item_id JOIN documents d USING (doc_id) WHERE rank <= 3),
w AS (SELECT a.q_id, a.rank, sum(CASE WHEN a.n > b.n THEN 1.0::DOUBLE WHEN a.n = b.n THEN 0.5::DOUBLE ELSE 0 END) AS wins FROM c a JOIN c b ON a.q_id = b.q_id AND a.rank <> b.rank GROUP BY ALL),
t AS (SELECT q_id, rank, answer, (n > 0)::INT + coalesce(wins, 0) AS total FROM c LEFT JOIN w USING (q_id, rank))
SELECT q_id, answer, total::DOUBLE AS total FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY total DESC, rank) AS r FROM t) WHERE r = 1""")
def pl5(spark, d):
    """First sentences of three documents as candidates; valid if they share a term with the question, more shared terms win a duel."""
    said = F.regexp_extract("text", r"^([^.!?\n]*)", 1)
    c = context_rows(spark, d, 3).select("q_id", F.col("rank").alias("pos"), said.alias("answer"), F.size(F.array_intersect(F.array_distinct(tx.tokens(F.col("query"))), tx.tokens(said))).alias("n"))
    c = settled(c.withColumn("valid", F.when(F.col("n") > 0, 1.0).otherwise(0.0)))
    a, b = c.select("q_id", F.col("pos").alias("a"), F.col("n").alias("x")), c.select("q_id", F.col("pos").alias("b"), F.col("n").alias("y"))
    duels = a.join(b, "q_id").where("a <> b").select("q_id", "a", "b", F.when(F.col("x") > F.col("y"), 1.0).when(F.col("x") == F.col("y"), 0.5).otherwise(0.0).alias("won"))
    return cp.sure_choice(c, duels)


_SELF = "exp(-1 / s.score) + lap.score + (lap.score + 0.5::DOUBLE * (1 - lap.score)) / (lap.score + (1 - lap.score) + 0.1::DOUBLE) + 0.5::DOUBLE * (0.5::DOUBLE * lap.score)"
_LAP3 = f"lap AS (SELECT q_id, doc_id, round(len(list_intersect(list_distinct({TOKS.format('b.text')}), list_distinct({TOKS.format('d.text')}))) / greatest(len(list_distinct({TOKS.format('b.text')})), 1)::DOUBLE, 6) AS score FROM sparse JOIN benchmark b ON q_id = item_id JOIN documents d USING (doc_id) WHERE rank <= 3)"


@register("pl7_self_rag", f"""WITH {SQL_SPARSE}, {_LAP3}, z AS (SELECT s.q_id, s.doc_id, s.rank, round({_SELF}, 6) AS total FROM sparse s JOIN lap USING (q_id, doc_id) WHERE rank <= 3),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY total DESC, rank) AS r FROM z) WHERE r = 1)
SELECT item_id AS q_id, {_NW} > 10 AS retrieved, CASE WHEN {_NW} > 10 THEN doc_id END AS doc_id, CASE WHEN {_NW} > 10 THEN total END AS total FROM benchmark LEFT JOIN b ON item_id = q_id""")
def pl7(spark, d):
    """A gate, one generation for each of three documents, and the best by critique. Stand-ins: long questions
    retrieve; relevance and support are the shared terms, the sequence probability the retrieval score."""
    q = benchmark(spark, d).withColumn("retrieved", F.size(tx.words(F.col("text"))) > 10)
    found = settled(sparse(spark, d, 3))
    lap = reranked(spark, d, found, 3).select("q_id", "doc_id", F.col("score").alias("lap"))
    both = found.join(lap, ["q_id", "doc_id"])
    rel = F.col("lap")
    useful = F.array(F.lit(0.0), F.lit(0.0), 1 - rel, rel, F.lit(0.0))
    scored = both.withColumn("total", F.round(cp.critique_score(-1 / F.col("score"), rel, rel, 1 - rel, F.lit(0.1), useful), 6))
    best = ro.best(scored.withColumn("first", -F.col("rank")), ["total", "first"], 1).select("q_id", "doc_id", "total")
    yes = F.col("retrieved")
    return q.join(best, "q_id", "left").select("q_id", "retrieved", F.when(yes, F.col("doc_id")).alias("doc_id"), F.when(yes, F.col("total")).alias("total"))


@register("pl18_two_modalities", f"WITH {SQL_SPARSE} SELECT q_id, doc_id, modal, place FROM (SELECT q_id, doc_id, CASE WHEN doc_id % 2 = 0 THEN 'text' ELSE 'image' END AS modal, row_number() OVER (PARTITION BY q_id, doc_id % 2 ORDER BY score DESC, doc_id) AS place FROM sh) WHERE place <= 3")
def pl18(spark, d):
    """Two searches, by the documents' modality (the parity of the id stands for it), their hits concatenated. Both are
    needed, however long they take: hits of one modality alone would look like a result."""
    parts = {"text": "doc_id % 2 = 0", "image": "doc_id % 2 = 1"}
    found = with_index(spark, d, lambda held: ro.fan_out({k: (lambda v=v: held.search(benchmark(spark, d), 3, v)) for k, v in parts.items()}, seconds=math.inf, whole=True))
    return found.select("q_id", "doc_id", F.col("source").alias("modal"), F.col("rank").alias("place"))
