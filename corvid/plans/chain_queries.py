"""Reasoning chains over the triples of retrieved documents, and trees of queries, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvid.operators import chains as ch
from corvid.operators import generation as gn
from corvid.operators import refine as rf
from corvid.operators.loops import settled, written
from corvid.session import table

from .agent_queries import best_of, with_index
from .generation_queries import _FIRST
from .registry import register
from .retrieval_queries import SQL_INDEX, SQL_SPARSE, TOKS, benchmark
from .routing_queries import documents
from .text_queries import WORDS

HOPS = 4

_COUNTS = f"list_transform(range(64), lambda k: len(list_filter(list_transform({TOKS}, lambda t: ('0x' || substr(md5(t), 1, 6))::BIGINT % 64), lambda x: x = k))::DOUBLE)"
_TERMS = f"list_filter(list_transform(regexp_split_to_array(text, '[.!?\\n]+'), lambda s: {TOKS.format('s')}), lambda t: len(t) >= 3)"
_TRIPLES = f"""hit AS (SELECT q_id, doc_id, rank FROM sparse WHERE rank <= 5),
ds AS (SELECT doc_id, unnest({_TERMS}) AS t, generate_subscripts({_TERMS}, 1) - 1 AS n FROM documents WHERE doc_id IN (SELECT doc_id FROM hit)),
dv AS MATERIALIZED (SELECT doc_id, n, array_to_string(t, ' ') AS said, {_COUNTS.format("array_to_string(t, ' ')")} AS v FROM ds),
tr AS MATERIALIZED (SELECT q_id, rank::BIGINT * {ch.PLACES} + n AS triple, doc_id, said, v FROM hit JOIN dv USING (doc_id))"""


def beam_sql(hops: int) -> str:
    """The beams as CTEs: bm0, bm1, ..."""
    out = f"bm0 AS MATERIALIZED (SELECT item_id AS q_id, []::BIGINT[] AS path, {_COUNTS.format('text')} AS v, 1.0::DOUBLE AS prob, false AS done FROM benchmark)"
    dot = "list_inner_product({0}, {1})"
    cosine = f"round({dot.format('b.v', 't.v')} / greatest(sqrt({dot.format('b.v', 'b.v')}) * sqrt({dot.format('t.v', 't.v')}), 1e-12), 6)"
    for k in range(1, hops + 1):
        b = f"bm{k - 1}"
        out += f""",
ca{k} AS (SELECT b.q_id, path, prob, triple, {cosine} AS score, t.v, b.v AS pv FROM {b} b JOIN tr t ON b.q_id = t.q_id WHERE NOT done AND NOT list_contains(path, triple)),
ne{k} AS (SELECT q_id, path, prob, triple, round(8 * score, 6) AS logit, v, pv FROM (SELECT *, row_number() OVER (PARTITION BY q_id, path ORDER BY score DESC, triple) AS r FROM ca{k}) WHERE r <= 5
  UNION ALL SELECT q_id, path, prob, -1, len(path)::DOUBLE, NULL, NULL FROM {b} WHERE NOT done),
so{k} AS (SELECT *, round(w / sum(w) OVER (PARTITION BY q_id, path), 9) AS choice FROM (SELECT *, exp(logit - max(logit) OVER (PARTITION BY q_id, path)) AS w FROM ne{k})),
gr{k} AS (SELECT q_id, list_append(path, triple) AS path, list_transform(list_zip(pv, v), lambda x: x[1] + x[2]) AS v, round(prob * choice, 9) AS prob, triple = -1 AS done FROM (SELECT *, row_number() OVER (PARTITION BY q_id, path ORDER BY choice DESC, triple) AS r FROM so{k}) WHERE r <= 5 AND choice >= 1e-4
  UNION ALL SELECT q_id, path, v, prob, done FROM {b} WHERE done),
bm{k} AS MATERIALIZED (SELECT q_id, path, v, prob, done FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY prob DESC, path) AS r FROM gr{k}) WHERE r <= 20)"""
    return out + f",\nchn AS (SELECT q_id, row_number() OVER (PARTITION BY q_id ORDER BY prob DESC, path) AS chain, path, prob FROM bm{hops})"


_CHAINS = f"{SQL_SPARSE}, {_TRIPLES}, {beam_sql(HOPS)}"
_ROWS = "cr AS (SELECT q_id, chain, pos, doc_id, said FROM (SELECT q_id, chain, unnest(path) AS triple, generate_subscripts(path, 1) - 1 AS pos FROM chn WHERE chain <= 5) JOIN tr USING (q_id, triple))"


def found_chains(spark, d):
    """(chains, triples): four hops over the triples of the five best documents of each question."""
    hits = with_index(spark, d, lambda held: settled(held.search(benchmark(spark, d), 5)))
    own = settled(ch.triples_of_hits(hits, documents(spark, d)))
    return ch.chains(benchmark(spark, d), own, settled, HOPS), own


@register("kg4_chains", f"WITH {_CHAINS} SELECT q_id, chain, array_to_string(path, ',') AS path, prob FROM chn")
def kg4_chains(spark, d):
    """Chains of at most four hops by vectors, twenty for a question, with the choice to end."""
    got, _ = found_chains(spark, d)
    return got.select("q_id", F.col("chain").cast("long").alias("chain"), F.array_join(F.col("path").cast("array<string>"), ",").alias("path"), "prob")


@register("kg5_chain_triples", f"""WITH {_CHAINS}, {_ROWS}, f AS (SELECT q_id, said, min({{'chain': chain, 'pos': pos}}) AS first FROM cr GROUP BY ALL), n AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY first, said) AS n FROM f)
SELECT q_id, string_agg(n || '. ' || said, chr(10) ORDER BY n) AS context FROM n GROUP BY q_id""")
def kg5_triples(spark, d):
    """The triples of the five most probable chains, each once, numbered."""
    return rf.chain_context(ch.chain_triples(*found_chains(spark, d)))


@register("kg5_chain_documents", f"""WITH {_CHAINS}, {_ROWS}, f AS (SELECT q_id, doc_id, count(*) AS c, min({{'chain': chain, 'pos': pos}}) AS first FROM cr GROUP BY ALL), n AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY c DESC, first, doc_id) AS n FROM f)
SELECT q_id, string_agg('Doc ' || n || '(Title: ' || coalesce(source, '') || ') ' || coalesce(text, '') || chr(10), '' ORDER BY n) AS context FROM n JOIN documents USING (doc_id) GROUP BY q_id""")
def kg5_documents(spark, d):
    """The documents of the five most probable chains by their number of triples; the source stands for a title."""
    texts = table(spark, d, "documents").select("doc_id", F.col("source").alias("title"), "text")
    return ch.chain_documents(ch.chain_triples(*found_chains(spark, d)), texts)


# --- trees of queries ---------------------------------------------------------------------

_IDX = SQL_INDEX.replace("idx AS (", "idx AS MATERIALIZED (")


def tree_sql(levels: int, width: int = 3) -> str:
    """The levels of a tree as CTEs: fr0 is the questions, se1 what they found, fr1 the nodes that go on, ..."""
    share = f"len(list_intersect(list_distinct({TOKS.format('query')}), {TOKS.format('text')})) / greatest(len(list_distinct({TOKS.format('query')})), 1)::DOUBLE"
    words = WORDS.replace("text", "query")
    half = f"ceil(len({words}) / 2)::INT"
    out = "fr0 AS (SELECT item_id AS q_id, text AS query, '' AS path, 0.0::DOUBLE AS total FROM benchmark)"
    for k in range(1, levels + 1):
        out += f""",
tq{k} AS (SELECT q_id, path, unnest(list_distinct({TOKS.format('query')})) AS term FROM fr{k - 1}),
th{k} AS (SELECT q_id, path, doc_id, round(sum(weight), 6) AS score FROM idx JOIN tq{k} USING (term) GROUP BY ALL),
tb{k} AS (SELECT q_id, path, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY q_id, path ORDER BY score DESC, doc_id) AS r FROM th{k}) WHERE r = 1),
se{k} AS MATERIALIZED (SELECT q_id, path, query, {_FIRST.format('text')} AS answer, total + {share} AS total FROM fr{k - 1} JOIN tb{k} USING (q_id, path) JOIN documents USING (doc_id)),
ac{k} AS (SELECT q_id, path || 'R' AS path, concat_ws(' ', query, answer) AS query, total FROM se{k} WHERE query <> '' UNION ALL SELECT q_id, path || 'D', array_to_string(({words})[1:{half}], ' '), total FROM se{k} WHERE query <> '' UNION ALL SELECT q_id, path || 'B', array_to_string(({words})[{half} + 1:], ' '), total FROM se{k} WHERE query <> ''),
fr{k} AS MATERIALIZED (SELECT q_id, query, path, total FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY total DESC, path) AS r FROM ac{k} WHERE query <> '') WHERE r <= {width})"""
    leaves = " UNION ALL ".join(f"SELECT q_id, path || 'A' AS path, answer, round(total / {k}, 6) AS prob FROM se{k}" for k in range(1, levels + 1))
    return out + f",\nlv AS ({leaves})"


@register("pl11_three_levels", f"WITH {_IDX}, {tree_sql(3)} SELECT q_id, path, answer, prob FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY prob DESC, path) AS r FROM lv) WHERE r = 1")
def pl11_three(spark, d):
    """Answer, rewrite, decompose or disambiguate on three levels; the best leaf of each question."""
    return with_index(spark, d, lambda held: gn.query_tree(benchmark(spark, d), best_of(held), documents(spark, d), 3, written))
