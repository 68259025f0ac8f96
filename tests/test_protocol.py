"""Protocol agents: every transition by a parsed tag."""

import pytest
from pyspark.sql import functions as F

from corvid.operators import generation as gn
from corvid.operators import protocol as pr
from corvid.operators.loops import written

TEXTS = [(1, "Paris is a town. More."), (2, "Rome is old! Yes."), (3, "nothing here")]


def search(spark):
    """The document whose first word the query holds."""
    docs = spark.createDataFrame([(d, t.split()[0].lower()) for d, t in TEXTS], "doc_id long, w string")
    return lambda q: q.join(docs, F.contains(F.lower("text"), F.col("w"))).select("q_id", "doc_id", F.lit(1).alias("rank"))


def play(spark, name, lines):
    """A run whose writer says lines[q_id][turn - 1]."""
    rows = spark.createDataFrame([(q, n, x) for q, all_ in lines.items() for n, x in enumerate(all_, 1)], "q_id long, turn int, said string")
    questions = spark.createDataFrame([(q, f"question {q}") for q in lines], "q_id long, text string")
    write = lambda open_, turn: open_.join(rows.where(F.col("turn") == turn).drop("turn"), "q_id", "left")
    out = pr.run_protocol(questions, search(spark), spark.createDataFrame(TEXTS, "doc_id long, text string"), pr.PROTOCOLS[name], write, written)
    return {r.q_id: r for r in out.collect()}


@pytest.mark.parametrize("name", sorted(pr.PROTOCOLS))
def test_every_reason_is_reached(spark, name):
    p = pr.PROTOCOLS[name]
    ask, tell = (lambda x, t=t: t[0] + x + t[1] for t in (p.search, p.answer))
    got = play(spark, name, {
        1: [ask("about paris") + tell("too early"), tell("A town")],
        2: [ask("rome"), ask("rome")],
        3: ["no tag at all"],
        4: [ask("  ")],
        5: [tell("") + ask("paris")],
        6: [ask(f"paris {n}") for n in range(20)],
        7: [ask("unknown thing"), "done"],
        8: [],
    })
    assert {q: (r.answer, r.reason, len(r.asked)) for q, r in got.items()} == {
        1: ("A town", "answer", 1), 2: ("", "repeat", 1), 3: ("", "no tag", 0), 4: ("", "empty query", 0), 5: ("", "answer", 0),
        6: ("Paris is a town", "rounds", p.rounds), 7: ("", "no tag", 1), 8: ("", "no tag", 0)}
    assert got[1].transcript == ask("about paris") + p.result[0] + "Paris is a town" + p.result[1] + tell("A town")  # what stood behind the tag is cut
    assert p.result[0] + p.result[1] in got[7].transcript  # a search without hits gives an empty result


def test_scripted_writer_and_seam(spark):
    p = pr.PROTOCOLS["tagged"]
    questions = spark.createDataFrame([(k, "paris " + "x" * k) for k in range(5)], "q_id long, text string")
    texts = spark.createDataFrame(TEXTS, "doc_id long, text string")
    out = pr.run_protocol(questions, search(spark), texts, p, pr.scripted(p), written)
    assert sorted(r.reason for r in out.collect()) == ["answer", "answer", "empty query", "no tag", "repeat"]  # two words are soon used up

    class Model(gn.Generator):
        def generate(self, prompts, stop=(), max_words=None):
            return ["<answer>Rome</answer>" if "<information>" in x else "<search>rome</search>" for x in prompts]

    got = pr.run_protocol(questions, search(spark), texts, p, pr.with_model(Model()), written).collect()
    assert {(r.answer, r.reason, tuple(r.asked)) for r in got} == {("Rome", "answer", ("rome",))}
    assert pr.run_protocol(questions.limit(0), search(spark), texts, p, pr.scripted(p), written).count() == 0
