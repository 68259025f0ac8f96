"""Prompts, parsers, chunkers, refiners and plumbing on fixtures that the tables don't reach."""

import pytest
from pyspark.sql import functions as F

from corvid.functions import text as tx
from corvid.operators import evaluation as ev
from corvid.operators import generation as gn
from corvid.operators import refine as rf
from corvid.operators.loops import settled


def one(spark, expression, **columns):
    return spark.createDataFrame([tuple(columns.values())], list(columns)).select(expression.alias("x")).first().x


def test_numerics_and_expansion(spark):
    got = one(spark, tx.numeric_contexts("t"), t="it costs $5.50 today, 3 % more, 12.01.2024, 70 per day and 123456 in all")
    assert [(r.kind, r.value) for r in got] == [("rate", "70 per day"), ("currency", "$5.50"), ("percentage", "3 %"), ("date", "12.01.2024"), ("large_number", "2024"), ("large_number", "123456")]
    assert got[1].context == "it costs $5.50 today, 3 % more, 12"
    assert one(spark, tx.number_variants(F.col("t")), t="7 and 3,5 and 1234567") == ["7.0", "7,0", "3.5", "3", "1234567.0", "1234567,0", "1 234 567"]
    wide = one(spark, tx.expand_query(F.col("t"), {"tariff": ("price", "fee", "cost", "charge")}, extra_chars=10), t="the tariff")
    assert wide == "the tariff price fee"
    assert one(spark, tx.expand_query(F.col("t"), {"tariff": ("price", "fee", "cost", "charge")}, ("tariff",)), t="the tariff") == "the tariff price fee cost charge"
    assert one(spark, tx.prepared_query(F.col("t"), {}, ("rate",)), t="The Rate!") == "the rate rate"
    assert one(spark, tx.prepared_query(F.col("t"), {"x": ("y",)}, ()), t="  ") == " " and one(spark, tx.prepared_query(F.col("t"), {"x": ("y",)}, ()), t="?!") == "?!"
    assert one(spark, tx.keywords(F.col("t"), ("rate", "licen")), t="Rates and a license at") == ["at", "license", "rates"]


def test_footers_are_whole_lines(spark):
    page = "We like a good cookie.\n© 2024 Me\nPrivacy Policy\n\nPlease subscribe to reason, not to anger.\nContact us\nAll rights reserved.\nPowered by steam"
    assert one(spark, tx.remove_footer(F.col("t")), t=page) == "We like a good cookie.\n\nPlease subscribe to reason, not to anger."


def test_token_windows_hold_the_text(spark):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    text = "The quick brown fox, 日本語 and 🎉🎉 jumps over\nthe lazy dog " * 5
    parts = one(spark, tx.token_windows(F.col("t"), path, 9), t=text)
    assert "".join(parts) == text and len(parts) > 5
    over = one(spark, tx.token_windows(F.col("t"), path, 9, 3), t=text)
    assert len(over) > len(parts) and one(spark, tx.token_windows(F.col("t"), path, 9), t="") == []


def test_prompts_and_parsers(spark):
    assert one(spark, gn.assemble("S {a}", "U", a=F.col("t")), t="x") == "S x\n\nU"
    assert one(spark, gn.fit_exemplars(F.array(*map(F.lit, (900, 10, 20, 80, 5))), 100), t="") == [1, 2]
    assert one(spark, gn.fit_exemplars(F.array(F.lit(900)), 100), t="") == []
    assert one(spark, gn.cut_at_stop(F.col("t"), ("END", "\n"), 3), t="a b c d END e") == "a b c"
    assert [tuple(r) for r in one(spark, gn.sure_candidates(F.col("t")), t="(a) Paris (b) New York")] == [("a", "Paris"), ("b", "New York")]
    row = spark.createDataFrame([('Thought: go\non\nAction: ```json\n{"function": "search", "parameters": {"query": "x y"}}\n```',)], "t string").select(*gn.action_blocks(F.col("t"))).first()
    assert tuple(row) == ("go\non", "search", "x y")
    assert gn.FirstSentence("A:").generate(["q A:One two. Three"], stop=("two",)) == ["One "]
    assert one(spark, ev.exact_match(F.col("p"), F.col("g"), pattern=True), p="Fort Worth", g="Fort\\s+W.*") == 1


def test_refiners(spark):
    assert one(spark, rf.boundary_chunks(F.split("t", " "), 4), t="a b . c d e f g h . i") == [0, 3, 7, 10]
    segments = one(spark, rf.prompt_segments(F.col("t")), t="<part, rate=0.3>a b</part> x <part, compress=False>c</part>")
    assert [tuple(r) for r in segments] == [(0.3, True, "a b"), (None, False, "c")]
    got = one(spark, rf.json_segments(F.col("t"), {"title": 1.0}, 0.5), t='{"title": "T", "text": "long text here"}')
    assert [(r.key, r.rate, r.compress, r.text) for r in got] == [("title", 1.0, False, "T"), ("text", 0.5, True, "long text here")]
    assert one(spark, rf.squeeze(F.col("t"), F.lit(0.5)), t="a long sentence of words") == "long sentence words"
    rows = spark.createDataFrame([("big fox unknown jumps", "the big brown fox that jumps", [1, 3, 5])], "a string, o string, k array<int>")
    assert rows.select(rf.recover("a", "o", "k").alias("x")).first().x == "big brown fox unknown jumps"
    assert one(spark, rf.refined_sentences(F.col("t")), t="Title\nMr. A. is here. Yes! No? A long one.") == ["Mr. A. is here. Yes!", "A long one."]


def test_beam_never_uses_a_triple_twice(spark):
    triples = spark.createDataFrame([(n, [f"a{n}", f"a{n + 1}", "x"]) for n in range(12)], "triple long, terms array<string>")
    q = spark.createDataFrame([(1, "a3 x"), (2, "nothing known")], "q_id long, text string")
    got = rf.chains(q, triples, 3, settled, width=3, most=7).collect()
    mine = [r for r in got if r.q_id == 1]
    assert 0 < len(mine) <= 7 and all(len(r.path) == len(set(r.path)) == 3 for r in mine) and sum(r.prob for r in mine) <= 1 + 1e-6
    assert [(r.path, r.prob) for r in got if r.q_id == 2] == [([], 1.0)]


def test_rouge_l_against_brute_force(spark):
    import random

    r = random.Random(5)
    rows = [(" ".join(r.choice("aa bb cc dd".split()) for _ in range(r.randint(0, 90))), " ".join(r.choice("aa bb cc ee".split()) for _ in range(r.randint(0, 70)))) for _ in range(30)]

    def lcs(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
        return row[-1]

    got = [x.x for x in spark.createDataFrame(rows, "p string, g string").select(ev.rouge_l(F.col("p"), F.col("g")).alias("x")).collect()]
    want = [round(2 * lcs(p.split(), g.split()) / (len(p.split()) + len(g.split())), 6) if p and g else 0.0 for p, g in rows]
    assert got == want


def test_bleu_of_several_golds(spark):
    rows = spark.createDataFrame([(1, 0, "the the cat", "the cat"), (1, 1, "the the cat", "the the dog sat")], "id int, gold_id int, pred string, gold string")
    counts = {r.n: (r.hit, r.total, r.c, r.r) for r in ev.bleu_counts(rows, 2).collect()}
    assert counts == {1: (3, 3, 3, 2), 2: (2, 2, 3, 2)}
    assert ev.bleu_score(ev.bleu_counts(rows, 2), ["id"]).first().bleu == 1.0


def test_evaluate_and_plumbing(spark):
    pairs = spark.createDataFrame([(1, "The cat", "cat"), (2, "dog", "cat")], "id int, pred string, gold string")
    items, means = ev.evaluate(pairs, ["em", "sub_em"])
    assert items.count() == 2 and means.first().em == 0.5
    with pytest.raises(ValueError, match="nonsense"):
        ev.evaluate(pairs, ["nonsense"])
    assert gn.fitting_batch_size(21) == 7 and gn.fitting_batch_size(0) == 64
    sizes = gn.batches_of(spark.range(100), 8, groups=3).groupBy("batch").count().collect()
    assert sum(r["count"] for r in sizes) == 100 and max(r["count"] for r in sizes) <= 8
    assert gn.Config().over({"k_final": 3}, {"k_final": 4}).k_final == 4
    with pytest.raises(ValueError):
        gn.Config().over({"k_nothing": 1})
    with pytest.raises(KeyError):
        gn.made_by(gn.POLICIES, "none")
