"""Agents that follow their markup, with SQL for their turns over the text of the scripted writer."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvid.operators import protocol as pr
from corvid.operators.loops import written

from .agent_queries import _IDX, best_of, with_index
from .generation_queries import _FIRST
from .registry import register
from .retrieval_queries import TOKS, benchmark
from .text_queries import WORDS


def text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def turns_sql(p: pr.Protocol) -> str:
    """The states as CTEs st0, st1, ...; the writer's text is made and parsed again in each turn."""
    tail = lambda tags: text(tags[1] + " and so on " + p.answer[0] + "no" + p.answer[1])
    said = lambda tags, c: f"{text('I think about it. ' + tags[0])} || translate({c}, '\"{{}}' || chr(10), '''() ') || {tail(tags)}"
    search, answer = (text(p.pattern(t)) for t in (p.search, p.answer))
    out = "st0 AS (SELECT item_id AS q_id, text, []::VARCHAR[] AS asked, '' AS last, NULL::VARCHAR AS answer, NULL::VARCHAR AS reason FROM benchmark)"
    for k in range(1, p.rounds + 1):
        over, end = ("'rounds'", "coalesce(result, '')") if k == p.rounds else ("NULL", "NULL")
        query = f"CASE WHEN length(text) % 5 = 2 OR {k} = 1 THEN text WHEN length(text) % 5 = 0 THEN text || ' ' || last ELSE array_to_string(list_slice({WORDS}, {k}, 1000000), ' ') END"
        asks = f"length(text) % 5 IN (2, 4) OR (length(text) % 5 = 0 AND {k} <= 2) OR (length(text) % 5 = 1 AND {k} <= 1)"
        out += f""",
w{k} AS MATERIALIZED (SELECT *, CASE WHEN length(text) % 5 = 3 THEN 'There is nothing to add.' WHEN {asks} THEN {said(p.search, query)} ELSE {said(p.answer, 'last')} END AS said FROM st{k - 1} WHERE reason IS NULL),
p{k} AS (SELECT *, CASE WHEN regexp_matches(said, {search}) THEN strpos(said, regexp_extract(said, {search}, 0)) END AS qa, CASE WHEN regexp_matches(said, {answer}) THEN strpos(said, regexp_extract(said, {answer}, 0)) END AS aa FROM w{k}),
r{k} AS (SELECT *, CASE WHEN qa IS NOT NULL AND (aa IS NULL OR qa < aa) THEN trim(regexp_extract(said, {search}, 1)) END AS query, CASE WHEN aa IS NOT NULL AND (qa IS NULL OR aa < qa) THEN trim(regexp_extract(said, {answer}, 1)) END AS found FROM p{k}),
y{k} AS MATERIALIZED (SELECT *, CASE WHEN found IS NOT NULL THEN 'answer' WHEN query IS NULL THEN 'no tag' WHEN query = '' THEN 'empty query' WHEN list_contains(asked, query) THEN 'repeat' END AS why FROM r{k}),
x{k} AS (SELECT q_id, unnest(list_distinct({TOKS.format('query')})) AS term FROM y{k} WHERE why IS NULL),
h{k} AS (SELECT q_id, doc_id, round(sum(weight), 6) AS score FROM idx JOIN x{k} USING (term) GROUP BY ALL),
b{k} AS (SELECT q_id, {_FIRST.format('text')} AS result FROM (SELECT q_id, doc_id, row_number() OVER (PARTITION BY q_id ORDER BY score DESC, doc_id) AS r FROM h{k}) JOIN documents USING (doc_id) WHERE r = 1),
st{k} AS MATERIALIZED (SELECT * FROM st{k - 1} WHERE reason IS NOT NULL
  UNION ALL SELECT q_id, text, asked, last, coalesce(found, ''), why FROM y{k} WHERE why IS NOT NULL
  UNION ALL SELECT q_id, text, list_append(asked, query), coalesce(result, ''), {end}, {over} FROM y{k} LEFT JOIN b{k} USING (q_id) WHERE why IS NULL)"""
    return out


def run(spark, d, name):
    p = pr.PROTOCOLS[name]
    return with_index(spark, d, lambda held: pr.run_protocol(benchmark(spark, d), best_of(held), held.kept, p, pr.scripted(p), written))


def _register(query_name: str, name: str) -> None:
    p = pr.PROTOCOLS[name]

    def query(spark, d):
        return run(spark, d, name).select("q_id", "answer", F.size("asked").cast("long").alias("searches"), F.array_join("asked", "|").alias("asked"), "reason")

    query.__doc__ = f"The `{name}` markup, {p.rounds} turns at most."
    register(query_name, f"WITH {_IDX}, {turns_sql(p)} SELECT q_id, answer, len(asked)::BIGINT AS searches, array_to_string(asked, '|') AS asked, reason FROM st{p.rounds}")(query)


for _query, _name in (("pl12_markup", "reasoning"), ("pl13_markup", "boxed"), ("pl14_markup", "tagged"), ("pl16_markup", "actions"), ("pl17_markup", "sub-queries")):
    _register(_query, _name)
