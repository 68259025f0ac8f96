"""Prompts, parsers, judges, evaluation and datasets with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvid.functions import segmentation as sg
from corvid.functions import text as tx
from corvid.operators import compression as cp
from corvid.operators import evaluation as ev
from corvid.operators import generation as gn
from corvid.operators.loops import settled
from corvid.session import table

from .registry import register
from .retrieval_queries import SQL_ANS, SQL_QRELS, SQL_SPARSE, TOKS, answers, benchmark, qrels, sparse
from .routing_queries import context_rows, documents
from .text_queries import NORM, WORDS, docs

_FIRST = r"regexp_extract({0}, '^([^.!?\n]*)', 1)"
_NW = f"len({WORDS})"


def items(spark, d):
    return table(spark, d, "benchmark")


@register("pr2_prompts", "SELECT item_id AS id, 'You answer briefly.' || chr(10) || chr(10) || 'Question: ' || text || chr(10) || 'Answer:' AS prompt, '[{\"role\":\"system\",\"content\":\"You answer briefly.\"},{\"role\":\"user\",\"content\":' || to_json('Question: ' || text)::VARCHAR || '}]' AS chat FROM benchmark")
def pr2(spark, d):
    q = F.col("text")
    chat = gn.messages("You answer briefly.", "Question: {q}", q=q)
    return items(spark, d).select(F.col("item_id").alias("id"), gn.assemble("You answer briefly.", "Question: {q}\nAnswer:", q=q).alias("prompt"), F.to_json(chat).alias("chat"))


@register("pr3_message_budget", f"WITH w AS (SELECT conv_id, turn, {WORDS} AS w FROM conversations), b AS (SELECT *, coalesce(sum(len(w)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM w) SELECT conv_id, turn, array_to_string(w[1:(60 - before)::BIGINT], ' ') AS text FROM b WHERE before < 60")
def pr3b(spark, d):
    return gn.message_budgets(table(spark, d, "conversations").select("conv_id", "turn", "text"), 60)


@register("pr4_fit_exemplars", f"""WITH {SQL_SPARSE}, l AS (SELECT q_id, rank, {_NW} AS n FROM sparse JOIN documents USING (doc_id) WHERE rank <= 5),
h AS (SELECT q_id, min(rank) AS head FROM l WHERE n <= 400 GROUP BY q_id), s AS (SELECT l.q_id, rank, sum(n) OVER (PARTITION BY l.q_id ORDER BY rank) AS upto FROM l JOIN h ON l.q_id = h.q_id AND rank >= head)
SELECT q.q_id, coalesce(string_agg((rank - 1)::VARCHAR, ',' ORDER BY rank) FILTER (WHERE upto <= 400), '') AS kept FROM (SELECT DISTINCT q_id FROM l) q LEFT JOIN s USING (q_id) GROUP BY q.q_id""")
def pr4(spark, d):
    """The best documents as exemplars, as many as 400 words take."""
    sizes = context_rows(spark, d, 5).groupBy("q_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", F.size(tx.words(F.col("text"))).alias("n")))), lambda x: x["n"]).alias("sizes"))
    return sizes.select("q_id", F.array_join(gn.fit_exemplars(F.col("sizes"), 400), ",").alias("kept"))


@register("pr6_kinds", "SELECT item_id AS id, CASE item_id % 3 WHEN 0 THEN 'Choose one of A to D.' || chr(10) || text || chr(10) || 'A. yes' || chr(10) || 'Answer:' WHEN 1 THEN 'Choose all that are right.' || chr(10) || text || chr(10) || 'A. yes' || chr(10) || 'Answers:' ELSE text || chr(10) || 'Answer:' END AS prompt FROM benchmark")
def pr6(spark, d):
    kind = F.when(F.col("item_id") % 3 == 0, "single choice").when(F.col("item_id") % 3 == 1, "multiple choice").otherwise("open")
    return items(spark, d).select(F.col("item_id").alias("id"), gn.prompt_of_kind(kind, F.col("text"), F.lit("A. yes")).alias("prompt"))


@register("gn1_generate", f"SELECT item_id AS id, {_FIRST.format('text')} AS pred FROM benchmark")
def gn1(spark, d):
    prompt = gn.assemble("Say it again.", "Text:{t}", t=F.col("text"))
    return gn.FirstSentence("Text:").apply(items(spark, d).withColumn("prompt", prompt), "prompt").select(F.col("item_id").alias("id"), "pred")


@register("gn3_stop_words", "SELECT doc_id, array_to_string(string_split(regexp_replace(text, '(?s)(\\. |\\n).*$', ''), ' ')[1:20], ' ') AS out FROM documents")
def gn3(spark, d):
    return docs(spark, d).select("doc_id", gn.cut_at_stop(F.col("text"), (". ", "\n"), 20).alias("out"))


@register("gn4_fused_token", f"""WITH {SQL_SPARSE}, t AS (SELECT q_id, doc_id, any_value(score) AS score, term AS token, round(ln(1 + count(*)), 9) AS logit FROM (SELECT q_id, doc_id, score, unnest({TOKS.format('text')}) AS term FROM sparse JOIN documents USING (doc_id) WHERE rank <= 3) GROUP BY q_id, doc_id, term),
s AS (SELECT q_id, sum(score) AS total FROM (SELECT DISTINCT q_id, doc_id, score FROM t) GROUP BY q_id), f AS (SELECT q_id, token, round(sum(score / total * logit), 6) AS score FROM t JOIN s USING (q_id) GROUP BY ALL)
SELECT q_id, token, score FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY score DESC, token) AS r FROM f) WHERE r = 1""")
def gn4(spark, d):
    """The fused next token over three documents; a token's logit is the log of its count."""
    return gn.fused_token(token_logits(spark, d))


def token_logits(spark, d):
    t = settled(sparse(spark, d, 3)).join(documents(spark, d), "doc_id").select("q_id", "doc_id", "score", F.explode(tx.tokens(F.col("text"))).alias("token"))
    return t.groupBy("q_id", "doc_id", "token").agg(F.first("score").alias("score"), F.round(F.log1p(F.count("*")), 9).alias("logit"))


@register("pl4_replug", f"""WITH {SQL_SPARSE}, t AS (SELECT q_id, doc_id, any_value(score) AS score, term AS token, round(ln(1 + count(*)), 9) AS logit FROM (SELECT q_id, doc_id, score, unnest({TOKS.format('text')}) AS term FROM sparse JOIN documents USING (doc_id) WHERE rank <= 3) GROUP BY q_id, doc_id, term),
e AS (SELECT q_id, doc_id, any_value(exp(score - top)) AS score FROM (SELECT *, max(score) OVER (PARTITION BY q_id) AS top FROM t) GROUP BY ALL), s AS (SELECT q_id, sum(score) AS total FROM e GROUP BY q_id),
f AS (SELECT t.q_id, token, round(sum(e.score / total * logit), 6) AS score FROM t JOIN e USING (q_id, doc_id) JOIN s USING (q_id) GROUP BY ALL)
SELECT q_id, token, score FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY score DESC, token) AS r FROM f) WHERE r = 1""")
def pl4(spark, d):
    """One generation step for each document, fused by the softmax of the documents' scores."""
    from pyspark.sql import Window

    t = token_logits(spark, d)
    top = F.max("score").over(Window.partitionBy("q_id"))
    return gn.fused_token(t.withColumn("score", F.exp(F.col("score") - top)))


# --- parsers ------------------------------------------------------------------------------

@register("ap1_answers", "SELECT doc_id, p AS parser, CASE p WHEN 'ircot' THEN source || '.' WHEN 'multiple choice' THEN 'BD' ELSE source END AS answer FROM documents, (VALUES ('selfask'), ('ircot'), ('basic'), ('multiple choice'), ('boxed'), ('tagged')) v(p)")
def ap1(spark, d):
    """Answers parsed back from generations made of each document's source."""
    s = F.col("source")
    said = {
        "selfask": F.concat(F.lit("x\nSo the final answer is: "), s, F.lit("\nmore")),
        "ircot": F.concat(F.lit("a b. So the answer is: "), s, F.lit(".")),
        "basic": F.concat(s, F.lit("\nsecond")),
        "multiple choice": F.concat(F.lit("I think D and B, or "), s),
        "boxed": F.concat(F.lit("so \\boxed{x} or \\boxed{"), s, F.lit("}")),
        "tagged": F.concat(F.lit("y <answer>"), s, F.lit("</answer>")),
    }
    rows = docs(spark, d).select("doc_id", F.explode(F.array(*[F.struct(F.lit(k).alias("parser"), gn.PARSERS[k](t).alias("answer")) for k, t in said.items()])).alias("x"))
    return rows.select("doc_id", "x.parser", "x.answer")


_CAND = """c AS (SELECT item_id AS q_id, n, list_filter(string_split(text, ' '), lambda x: regexp_matches(x, '^[a-z]+$'))[n + 1] AS answer FROM benchmark, range(0, 3) r(n)),
k AS (SELECT *, CASE WHEN length(answer) % 2 = 0 THEN 1.0::DOUBLE ELSE 0 END AS valid FROM c WHERE answer IS NOT NULL),
w AS (SELECT a.q_id, a.n, sum(CASE WHEN length(a.answer) > length(b.answer) THEN 1.0::DOUBLE WHEN length(a.answer) = length(b.answer) THEN 0.5::DOUBLE ELSE 0 END) AS wins FROM k a JOIN k b ON a.q_id = b.q_id AND a.n <> b.n GROUP BY ALL)"""


@register("ap2_sure", f"WITH {_CAND}, t AS (SELECT q_id, n, answer, valid + coalesce(wins, 0) AS total FROM k LEFT JOIN w USING (q_id, n)) SELECT q_id, answer, total FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY total DESC, n) AS r FROM t) WHERE r = 1")
def ap2(spark, d):
    """Candidates parsed from `(a) x (b) y`; an answer of even length is valid, the longer one wins a duel."""
    plain = F.filter(F.split("text", " "), lambda x: x.rlike("^[a-z]+$"))
    listed = F.array_join(F.transform(F.slice(plain, 1, 3), lambda x, n: F.concat(F.lit("("), F.element_at(F.array(*map(F.lit, "abc")), n + 1), F.lit(") "), x)), " ")
    c = benchmark(spark, d).select("q_id", F.posexplode(gn.sure_candidates(listed)).alias("pos", "x")).select("q_id", "pos", "x.answer")
    c = c.withColumn("valid", F.when(F.length("answer") % 2 == 0, 1.0).otherwise(0.0))
    a, b = c.select("q_id", F.col("pos").alias("a"), F.length("answer").alias("la")), c.select("q_id", F.col("pos").alias("b"), F.length("answer").alias("lb"))
    duels = a.join(b, "q_id").where("a <> b").select("q_id", "a", "b", F.when(F.col("la") > F.col("lb"), 1.0).when(F.col("la") == F.col("lb"), 0.5).otherwise(0.0).alias("won"))
    return cp.sure_choice(c, duels)


_E = lambda n: f"abs(embedding[{n}]::DOUBLE)"
_CRITIQUE = f"exp(-{_E(1)}) + {_E(2)} + ({_E(3)} + 0.5::DOUBLE * {_E(4)}) / ({_E(3)} + {_E(4)} + {_E(5)} + 0.000001::DOUBLE) + 0.5::DOUBLE * (-1 * {_E(6)} - 0.5::DOUBLE * {_E(7)} + 0 * {_E(8)} + 0.5::DOUBLE * {_E(9)} + {_E(10)})"


@register("ap3_critique", f"SELECT label AS answer, round(sum(round({_CRITIQUE}, 9)), 6) AS score, count(*) AS n FROM embeddings WHERE {_E(11)} / ({_E(11)} + {_E(12)} + 0.000001::DOUBLE) > 0.2 GROUP BY label")
def ap3(spark, d):
    """Token probabilities stand in the vectors; past the retrieval gate, scores are summed for each answer (the label)."""
    e = lambda n: F.abs(F.col("embedding")[n - 1].cast("double"))
    v = table(spark, d, "embeddings").where(e(11) / (e(11) + e(12) + 0.000001) > 0.2)
    score = cp.critique_score(-e(1), e(2), e(3), e(4), e(5) + 0.000001, F.array(*[e(n) for n in range(6, 11)]))
    return v.groupBy(F.col("label").alias("answer")).agg(F.round(F.sum(F.round(score, 9)), 6).alias("score"), F.count("*").alias("n"))


@register("ap4_flare_gate", f"WITH t AS (SELECT item_id AS id, list_filter(string_split({_FIRST.format('text')}, ' '), lambda x: x <> '') AS t FROM benchmark) SELECT id, CASE WHEN len(list_filter(t, lambda x: length(x) / 16.0::DOUBLE <= 0.2)) > 0 THEN array_to_string(list_filter(t, lambda x: length(x) / 16.0::DOUBLE > 0.2), ' ') END AS query FROM t")
def ap4(spark, d):
    """First sentences; a token's stand-in probability is its length over 16."""
    t = F.filter(F.split(F.regexp_extract("text", r"^([^.!?\n]*)", 1), " "), lambda x: x != "")
    rows = items(spark, d).select(F.col("item_id").alias("id"), t.alias("t"))
    return rows.select("id", cp.confident_query(F.col("t"), F.transform("t", lambda x: F.length(x) / 16.0)).alias("query"))


@register("ap5_actions", "SELECT doc_id, 'look at ' || source AS thought, CASE WHEN doc_id % 2 = 0 THEN 'search' ELSE 'finish' END AS function, source || ' ' || lang AS query FROM documents WHERE lang IS NOT NULL")
def ap5(spark, d):
    """Steps of a reasoning agent, parsed back: a thought and a JSON action in backticks."""
    even = F.col("doc_id") % 2 == 0
    act = F.concat(F.lit('{"function": "'), F.when(even, "search").otherwise("finish"), F.lit('", "parameters": {"'), F.when(even, "query").otherwise("answer"), F.lit('": "'), "source", F.lit(" "), "lang", F.lit('"}}'))
    step = F.concat(F.lit("Thought: look at "), "source", F.lit("\nAction: ```json\n"), act, F.lit("\n```"))
    return docs(spark, d).where("lang IS NOT NULL").select("doc_id", step.alias("t")).select("doc_id", *gn.action_blocks(F.col("t")))


@register("ap6_numbered_documents", f"WITH {SQL_SPARSE} SELECT q_id, string_agg('(' || rank || ')Title: ' || source || ' Text: ' || text || chr(10), '' ORDER BY rank) AS docs FROM sparse JOIN documents USING (doc_id) WHERE rank <= 3 GROUP BY q_id")
def ap6(spark, d):
    """Titles with a number before them, which goes."""
    t = docs(spark, d).select("doc_id", F.concat(F.col("doc_id").cast("string"), F.lit(" "), "source").alias("title"), "text")
    return gn.numbered_documents(sparse(spark, d, 3).join(t, "doc_id"))


@register("ev14_judge_parse", "SELECT doc_id, CASE WHEN doc_id % 3 > 0 THEN (doc_id % 10) / 10.0::DOUBLE END AS score FROM documents")
def ev14(spark, d):
    """Ratings parsed back from a judge's text; one without a rating gives null."""
    said = F.when(F.col("doc_id") % 3 > 0, F.concat(F.lit("ok. Total rating: "), (F.col("doc_id") % 10).cast("string"), F.lit(" of 10"))).otherwise("none of 7")
    x = F.regexp_extract("t", r"Total rating:\D*([0-9]+(?:\.[0-9]+)?)", 1)
    return docs(spark, d).select("doc_id", said.alias("t")).select("doc_id", F.when(x != "", x.cast("double") / 10).alias("score"))


@register("jd2_adaptive", f"SELECT item_id AS id, CASE WHEN {_NW} <= 15 THEN 'A' WHEN {_NW} <= 30 THEN 'B' ELSE 'C' END AS route FROM benchmark")
def jd2(spark, d):
    return items(spark, d).select(F.col("item_id").alias("id"), gn.adaptive_route(F.col("text")).alias("route"))


# --- evaluation ---------------------------------------------------------------------------


def _grams(text, n):
    return f"(SELECT id, g, count(*) AS n FROM (SELECT id, unnest(list_transform(generate_series(1, len(t) - {n - 1}), lambda i: array_to_string(t[i:i + {n - 1}], ' '))) AS g FROM (SELECT id, {TOKS.format(text)} AS t FROM ans) WHERE len(t) >= {n}) GROUP BY ALL)"


@register("ev11_rouge_2", f"""WITH {SQL_ANS}, a AS {_grams('pred', 2)}, b AS {_grams('gold', 2)}
SELECT id, round(max(2.0 * c / (x + y)), 6) AS score FROM (SELECT coalesce(a.id, b.id) AS id, sum(least(coalesce(a.n, 0), coalesce(b.n, 0))) AS c, sum(coalesce(a.n, 0)) AS x, sum(coalesce(b.n, 0)) AS y FROM a FULL JOIN b ON a.id = b.id AND a.g = b.g GROUP BY 1) GROUP BY id""")
def ev11b(spark, d):
    return ev.rouge_n(settled(answers(spark, d)), 2)


_CHARS = "list_filter(string_split(regexp_replace(lower({0}), '\\s+', '', 'g'), ''), lambda x: x <> '')"


@register("ev12_rouge_characters", f"""WITH {SQL_ANS}, a AS (SELECT id, g, count(*) AS n FROM (SELECT id, unnest({_CHARS.format('pred')}) AS g FROM ans) GROUP BY ALL), b AS (SELECT id, g, count(*) AS n FROM (SELECT id, unnest({_CHARS.format('gold')}) AS g FROM ans) GROUP BY ALL)
SELECT id, round(max(2.0 * c / (x + y)), 6) AS score FROM (SELECT coalesce(a.id, b.id) AS id, sum(least(coalesce(a.n, 0), coalesce(b.n, 0))) AS c, sum(coalesce(a.n, 0)) AS x, sum(coalesce(b.n, 0)) AS y FROM a FULL JOIN b ON a.id = b.id AND a.g = b.g GROUP BY 1) GROUP BY id""")
def ev12(spark, d):
    """ROUGE-1 for scripts without spaces: characters are the tokens."""
    return ev.rouge_n(settled(answers(spark, d)), 1, ev.characters)


@register("ev12_rouge_words")
def ev12_words(spark, d):
    """ROUGE-1 over words that are found again in texts without blanks, by a dictionary of the corpus' words."""
    counts = documents(spark, d).select(F.explode(tx.tokens(F.col("text"))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    words = sg.segmenter(spark, sg.dictionary(counts))
    bare = lambda c: F.regexp_replace(c, r"\s+", "").alias(c)
    return ev.rouge_n(settled(answers(spark, d).select("id", "gold_id", bare("pred"), bare("gold"))), 1, words)


def _mteval(text):
    for mark, value in (("'<skipped>'", "''"), ("'-' || chr(10)", "''"), ("chr(10)", "' '"), *[(f"'{a}'", f"'{b}'") for a, b in tx.MTEVAL_ENTITIES]):
        text = f"replace({text}, {mark}, {value})"
    text = f"' ' || {text} || ' '"
    for pattern, value in tx.MTEVAL_RULES:
        text = f"regexp_replace({text}, '{pattern}', '{value.replace('$', chr(92))}', 'g')"
    return rf"list_filter(regexp_split_to_array({text}, '\s+'), lambda x: x <> '')"


def _bleu_grams(tokens, n):
    return f"(SELECT id, g, count(*) AS n FROM (SELECT id, unnest(list_transform(generate_series(1, len({tokens}) - {n - 1}), lambda i: array_to_string({tokens}[i:i + {n - 1}], ' '))) AS g FROM tk WHERE len({tokens}) >= {n}) GROUP BY ALL)"


_BLEU = f"tk AS (SELECT id, {_mteval('pred')} AS pt, {_mteval('gold')} AS gt FROM ans), " + ", ".join(f"a{n} AS {_bleu_grams('pt', n)}, b{n} AS {_bleu_grams('gt', n)}" for n in range(1, 5))
_BLEU_N = " UNION ALL ".join(f"SELECT ans.id, {n} AS n, coalesce(sum(least(a.n, coalesce(b.n, 0))), 0) AS hit, coalesce(sum(a.n), 0) AS total FROM ans LEFT JOIN a{n} a ON a.id = ans.id LEFT JOIN b{n} b ON b.id = a.id AND b.g = a.g GROUP BY ans.id" for n in range(1, 5))
_BLEU_L = "l AS (SELECT id, len(pt) AS c, len(gt) AS r FROM tk)"
_BP = "CASE WHEN c >= r THEN 1.0::DOUBLE WHEN c = 0 THEN 0 ELSE exp(1 - r / c::DOUBLE) END"


@register("ev13_bleu", f"""WITH {SQL_ANS}, {_BLEU}, {_BLEU_L}, k AS ({_BLEU_N}), s AS (SELECT n, sum(hit) AS hit, sum(total) AS total FROM k GROUP BY n), p AS (SELECT min(hit) AS least, avg(ln(hit / total::DOUBLE)) FILTER (WHERE hit > 0) AS mean FROM s), z AS (SELECT sum(c) AS c, sum(r) AS r FROM l)
SELECT round(CASE WHEN least > 0 THEN {_BP} * exp(mean) ELSE 0 END, 6) AS bleu, c::BIGINT AS pred_tokens, r::BIGINT AS gold_tokens FROM p, z""")
def ev13(spark, d):
    counts = settled(ev.bleu_counts(settled(answers(spark, d))))
    lengths = counts.where("n = 1").agg(F.sum("c").cast("long").alias("pred_tokens"), F.sum("r").cast("long").alias("gold_tokens"))
    return ev.bleu_score(counts, []).crossJoin(lengths)


@register("ev13_bleu_items", f"""WITH {SQL_ANS}, {_BLEU}, {_BLEU_L}, k AS ({_BLEU_N}), p AS (SELECT id, avg(ln((hit + 1) / (total + 1)::DOUBLE)) AS mean FROM k GROUP BY id)
SELECT id, round({_BP} * exp(mean), 6) AS bleu FROM p JOIN l USING (id)""")
def ev13i(spark, d):
    """Smoothed, for each item."""
    return ev.bleu_score(ev.bleu_counts(settled(answers(spark, d))), ["id"], smooth=True)


_GAOKAO = "SELECT d.source AS subject, CASE WHEN quality = 1 THEN 'multiple choice' ELSE 'single choice' END AS kind, CASE l.doc_id % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'AC' WHEN 2 THEN 'B' ELSE '' END AS pred, CASE l.doc_id % 3 WHEN 0 THEN 'A' ELSE 'AC' END AS gold FROM labels l JOIN documents d USING (doc_id)"


@register("ev16_rollup", f"SELECT coalesce(subject, 'all') AS subject, round(avg(CASE WHEN pred = gold THEN 1.0::DOUBLE WHEN kind = 'multiple choice' AND pred <> '' AND contains(gold, pred) THEN 0.5::DOUBLE ELSE 0 END), 6) AS score, count(*) AS n FROM ({_GAOKAO}) GROUP BY ROLLUP (subject)")
def ev16(spark, d):
    """Choices graded by kind, for each subject and over all; kinds and answers are made of the labels' ids."""
    n = F.col("doc_id")
    rows = table(spark, d, "labels").join(docs(spark, d).select("doc_id", "source"), "doc_id")
    pred = F.when(n % 4 == 0, "A").when(n % 4 == 1, "AC").when(n % 4 == 2, "B").otherwise("")
    gold = F.when(n % 3 == 0, "A").otherwise("AC")
    score = ev.graded_answer(F.when(F.col("quality") == 1, "multiple choice").otherwise("single choice"), pred, gold)
    return rows.select(F.col("source").alias("subject"), score.alias("x")).rollup("subject").agg(F.round(F.avg("x"), 6).alias("score"), F.count("*").alias("n")).select(F.coalesce("subject", F.lit("all")).alias("subject"), "score", "n")


@register("ev17_choice_answers", f"SELECT item_id AS id, array_to_string(list_transform(list_filter([item_id % 40, 1, len(c) - 1, len(c)], lambda n: n >= 0 AND n < len(c)), lambda n: c[n + 1]), '|') AS golds FROM (SELECT item_id, {TOKS.format('text')} AS c FROM benchmark)")
def ev17(spark, d):
    """Places among the choices (the tokens) as their texts; a place beyond them is no answer."""
    rows = items(spark, d).select(F.col("item_id").alias("id"), tx.tokens(F.col("text")).alias("c"))
    rows = rows.withColumn("a", F.array((F.col("id") % 40).cast("int"), F.lit(1), F.size("c") - 1, F.size("c")))
    return rows.select("id", F.array_join(ev.choice_answers(F.col("c"), F.col("a")), "|").alias("golds"))


@register("ev18_evaluate", f"WITH {SQL_ANS} SELECT round(avg(({NORM.format('pred')} = {NORM.format('gold')})::INT), 6) AS em, round(avg(contains({NORM.format('pred')}, {NORM.format('gold')})::INT), 6) AS sub_em, round(avg(len({WORDS.replace('text', 'pred')})), 6) AS input_tokens, count(*) AS n FROM ans")
def ev18(spark, d):
    """Metrics by name, their means over all items."""
    return ev.evaluate(settled(answers(spark, d)), ["em", "sub_em", "input_tokens"])[1]


_FAIL = f"""late AS (SELECT q_id, doc_id, rank - 1 AS rank FROM sparse WHERE rank > 1),
tru AS (SELECT DISTINCT q_id FROM qrels), good AS (SELECT q_id, min(rank) AS deeper, min(rank) <= 1 AS ok FROM late JOIN qrels USING (q_id, doc_id) GROUP BY q_id),
fa AS (SELECT b.item_id AS q_id, b.text, deeper, list_distinct(regexp_extract_all(b.text, '[0-9]+')) AS numbers FROM benchmark b JOIN tru ON tru.q_id = b.item_id LEFT JOIN good ON good.q_id = b.item_id WHERE NOT coalesce(ok, false)),
nu AS (SELECT q_id, count(DISTINCT number) FILTER (WHERE contains(d.text, number)) AS hit FROM (SELECT q_id, unnest(numbers) AS number FROM fa) JOIN late USING (q_id) JOIN documents d USING (doc_id) WHERE rank <= 10 GROUP BY q_id),
rec AS (SELECT q_id, deeper IS NOT NULL AS found, len(numbers) > 0 AS numeric, coalesce(hit, 0) AS numbers_found,
  list_filter([CASE WHEN deeper IS NOT NULL THEN 'rerank: truth at rank ' || deeper END, CASE WHEN deeper IS NULL THEN 'retrieval: truth is not among the candidates' END, CASE WHEN len(numbers) > 0 AND coalesce(hit, 0) < len(numbers) THEN 'numbers: not all are in the first hits' END, CASE WHEN {_NW} < 20 THEN 'query: short, expand it' END], lambda x: x IS NOT NULL) AS s FROM fa LEFT JOIN nu USING (q_id))"""


def failures(spark, d):
    """Of a search that misses its best hit: the others move up."""
    late = sparse(spark, d).where("rank > 1").withColumn("rank", F.col("rank") - 1)
    return ev.failure_records(settled(late), settled(qrels(spark, d)), benchmark(spark, d), documents(spark, d), 1)


@register("ev19_failures", f"WITH {SQL_SPARSE}, {SQL_QRELS}, {_FAIL} SELECT q_id, found, numeric, numbers_found, array_to_string(s, '; ') AS suggestions FROM rec")
def ev19(spark, d):
    """Questions whose first hit is not relevant, with what to do about each."""
    return failures(spark, d).withColumn("suggestions", F.array_join("suggestions", "; "))


@register("ev21_failure_summary", f"WITH {SQL_SPARSE}, {SQL_QRELS}, {_FAIL}, t AS (SELECT 'suggestion ' || split_part(x, ':', 1) AS kind, count(*) AS n FROM (SELECT unnest(s) AS x FROM rec) GROUP BY 1 ORDER BY n DESC, kind LIMIT 5) SELECT 'failures' AS kind, count(*) AS n FROM rec UNION ALL SELECT 'found', count(*) FILTER (WHERE found) FROM rec UNION ALL SELECT 'numeric', count(*) FILTER (WHERE numeric) FROM rec UNION ALL SELECT * FROM t")
def ev21(spark, d):
    return ev.failure_summary(settled(failures(spark, d)))


@register("ev22_recall_before_rerank", f"""WITH {SQL_SPARSE.replace('rank <= 20', 'rank <= 50')}, {SQL_QRELS}, t AS (SELECT q_id, count(*) AS n FROM qrels GROUP BY q_id), g AS (SELECT q_id, count(*) AS f FROM sparse JOIN qrels USING (q_id, doc_id) GROUP BY q_id)
SELECT round(avg(coalesce(f, 0) / n::DOUBLE), 6) AS recall_50, count(*) AS num_queries FROM t LEFT JOIN g USING (q_id)""")
def ev22(spark, d):
    """Recall of 50 candidates, over all questions with truth."""
    truth = settled(qrels(spark, d))
    found = sparse(spark, d, 50).join(truth, ["q_id", "doc_id"], "left_semi").groupBy("q_id").agg(F.count("*").alias("f"))
    per = truth.groupBy("q_id").agg(F.count("*").alias("n")).join(found, "q_id", "left")
    return per.agg(F.round(F.avg(F.coalesce("f", F.lit(0)) / F.col("n")), 6).alias("recall_50"), F.count("*").alias("num_queries"))


# --- datasets -----------------------------------------------------------------------------


@register("ds1_filter", "SELECT item_id AS id FROM benchmark WHERE length(text) > 150 AND item_id % 2 = 0")
def ds1(spark, d):
    """Items that all of several predicates, columns of any text function, keep."""
    keep = F.lit(True)
    for p in (F.length("text") > 150, F.col("item_id") % 2 == 0):
        keep = keep & p
    return items(spark, d).where(keep).select(F.col("item_id").alias("id"))


@register("ds3_batches", "SELECT count(*) AS items FROM benchmark")
def ds3(spark, d):
    """Items in batches of at most 16, merged again: none is lost and no batch is larger."""
    rows = gn.batches_of(items(spark, d).withColumnRenamed("item_id", "id"), 16)
    return rows.groupBy("batch").agg(F.count("*").alias("n")).where("n <= 16").agg(F.sum("n").alias("items"))


@register("ds4_update", "SELECT item_id AS id, text, CASE WHEN item_id % 2 = 0 THEN length(text) END AS pred FROM benchmark")
def ds4(spark, d):
    b = items(spark, d).withColumnRenamed("item_id", "id")
    made = b.where("id % 2 = 0").select("id", F.length("text").cast("long").alias("pred"))
    return gn.update_column(b.withColumn("pred", F.lit(0)), made, "pred")


@register("tx8_clean", rf"""WITH f AS (SELECT doc_id, source || chr(10) || text || chr(10) || 'Contact us' || chr(10) || 'all rights reserved' AS text FROM documents),
c AS (SELECT doc_id, trim(regexp_replace(text, ' +', ' ', 'g')) AS text FROM f),
k AS (SELECT doc_id, array_to_string(list_filter(string_split(text, chr(10)), lambda x: NOT regexp_full_match(lower(trim(x)), '{"|".join(tx.FOOTERS)}')), chr(10)) AS text FROM c)
SELECT doc_id, trim(regexp_replace(regexp_replace(lower(text), '[^\p{{L}}0-9\s]', ' ', 'g'), '\s+', ' ', 'g')) AS out FROM k""")
def tx8(spark, d):
    """Cleaning, footers, normalising, one behind the other; each text gets two footer lines more."""
    text = F.concat_ws("\n", "source", "text", F.lit("Contact us"), F.lit("all rights reserved")).alias("text")
    return docs(spark, d).where("text IS NOT NULL").select("doc_id", text).select("doc_id", tx.normalize_for_retrieval(tx.remove_footer(tx.clean_text(F.col("text")))).alias("out"))


_MARKUP = "'''Ann''' &amp; [[Bob|Robert]] {{cite|x}}<ref>no</ref> met [[Carl]].<!-- gone --> "


@register("tx12_wiki", "SELECT doc_id, trim('Ann & Robert met Carl. ' || source) AS out, lang = 'fr' AS stub FROM documents WHERE lang IS NOT NULL")
def tx12(spark, d):
    """Markup around each document's source; titles of one language are lists."""
    title = F.concat(F.when(F.col("lang") == "fr", "List of ").otherwise("On "), "source")
    text = F.concat(F.lit(_MARKUP), "source")
    return docs(spark, d).where("lang IS NOT NULL").select("doc_id", tx.wiki_clean(text).alias("out"), tx.is_wiki_stub(title, text).alias("stub"))
