"""The registered queries of iterative compression and of words without blanks, against brute force."""

from collections import Counter

import regex

from corvid.functions import segmentation as sg
from corvid.functions import text as tx
from corvid.plans import registry
from corvid.plans.retrieval_queries import answers
from corvid.session import table

from .test_conditional import brute

SF = "/root/testdata/sf0.001"


def test_iterative_compression(spark):
    docs = {r.doc_id: [w for w in regex.split(r"[ \n\t]+", r.text) if w] for r in table(spark, SF, "documents").collect()}
    got = {tuple(r) for r in registry.queries()["rf7_iterative"](spark, SF).collect()}
    want = brute({d: w for d, w in docs.items() if w}, 0.5, 200)
    assert len(got ^ want) <= 0.001 * len(want), sorted(got ^ want)[:5]  # sums of logarithms may tie otherwise


def test_rouge_of_words_found_again(spark):
    words = lambda x: regex.findall(tx.WORD, x.lower())
    counts = Counter(w for r in table(spark, SF, "documents").collect() for w in words(r.text))
    own = sg.Dictionary.of(dict(counts))
    cut = lambda x: Counter(w for run in regex.findall(sg.RUN, regex.sub(r"\s+", "", x).lower()) for w in own.words(run))
    got = {r.id: r.score for r in registry.queries()["ev12_rouge_words"](spark, SF).collect()}
    for r in answers(spark, SF).collect():
        a, b = cut(r.pred), cut(r.gold)
        assert abs(got[r.id] - 2 * sum((a & b).values()) / (sum(a.values()) + sum(b.values()))) < 2e-6
