"""Chains against a beam search in plain Python, documents of chains, trees of three levels."""

import hashlib
import math
import re

import pytest
from pyspark.sql import functions as F

from corvid.operators import chains as ch
from corvid.operators.loops import settled

TEXTS = {
    1: "the red fox runs fast. a blue bird sings low! the red bird flies south\nno two",
    2: "the fox eats the bird. the fox eats the bird. birds eat red berries",
    3: "",
    4: None,
    5: " ".join(f"node {k} leads to node {k + 1}." for k in range(400)),
    6: "one two. x y z",
}
HITS = [(10, 1, 1), (10, 2, 2), (11, 2, 1), (11, 3, 2), (11, 4, 3), (12, 5, 1), (13, 3, 1), (15, 5, 2), (15, 2, 1)]
QUESTIONS = [(10, "which bird eats the red fox"), (11, None), (12, "node 7 leads"), (13, "nothing is found"), (14, "no hits at all"), (15, "the fox of node 3"), (15, "the fox of node 3")]


def tokens(s):
    return [t for t in re.findall(r"\w+", (s or "").lower()) if len(t) >= 2]


def counts(s):
    v = [0] * 64
    for t in tokens(s):
        v[int(hashlib.md5(t.encode()).hexdigest()[:6], 16) % 64] += 1
    return v


def triples():
    out = {}
    for q, d, rank in HITS:
        terms = [t for t in (tokens(s) for s in re.split(r"[.!?\n]+", TEXTS[d] or "")) if len(t) >= 3]
        for n, t in enumerate(terms):
            out.setdefault(q, {})[rank * ch.PLACES + n] = (d, " ".join(t))
    return out


def beam_search(text, own, hops=4, width=5, branches=5, most=20, least=1e-4):
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True))
    beam = [([], counts(text), 1.0, False)]
    for _ in range(hops):
        new = []
        for path, v, p, done in beam:
            if done:
                new.append((path, v, p, True))
                continue
            near = sorted((-round(dot(v, counts(s)) / max(math.sqrt(dot(v, v)) * math.sqrt(dot(counts(s), counts(s))), 1e-12), 6), t) for t, (_, s) in own.items() if t not in path)[:width]
            logits = [(round(-8 * s, 6), t) for s, t in near] + [(float(len(path)), ch.END)]
            top = max(x for x, _ in logits)
            total = sum(math.exp(x - top) for x, _ in logits)
            chosen = sorted((-round(math.exp(x - top) / total, 9), t) for x, t in logits)[:branches]
            for c, t in chosen:
                if -c >= least:
                    v2 = v if t == ch.END else [a + b for a, b in zip(v, counts(own[t][1]), strict=True)]
                    new.append((path + [t], v2, round(p * -c, 9), t == ch.END))
        beam = sorted(new, key=lambda x: (-x[2], x[0]))[:most]
    return [(x[0], x[2]) for x in beam]


@pytest.fixture(scope="module")
def found(spark):
    texts = spark.createDataFrame(list(TEXTS.items()), "doc_id long, text string")
    hits = spark.createDataFrame(HITS, "q_id long, doc_id long, rank int")
    own = settled(ch.triples_of_hits(hits, texts))
    questions = spark.createDataFrame(QUESTIONS, "q_id long, text string")
    return settled(ch.chains(questions, own, settled)), own


def test_triples_of_whole_texts(found):
    got = {}
    for r in found[1].collect():
        got.setdefault(r.q_id, {})[r.triple] = (r.doc_id, r.said)
    assert got == triples()
    assert len(got[12]) == 400


def test_chains_by_brute_force(found):
    own = triples()
    got = {}
    for r in sorted(found[0].collect(), key=lambda r: (r.q_id, r.chain)):
        got.setdefault(r.q_id, []).append((list(r.path), r.prob))
    assert set(got) == {q for q, _ in QUESTIONS}
    for q, text in QUESTIONS:
        want = beam_search(text, own.get(q, {}))
        assert [p for p, _ in got[q]] == [p for p, _ in want], q
        assert [x for _, x in got[q]] == pytest.approx([x for _, x in want], abs=2e-8)
        assert len(got[q]) <= 20
    assert got[13] == got[14] == [([ch.END], 1.0)]


def test_documents_of_chains(spark):
    rows = spark.createDataFrame([(1, 1, 0, 7), (1, 1, 1, 8), (1, 2, 0, 8), (1, 3, 0, 9), (1, 6, 0, 9), (1, 6, 1, 9), (2, 1, 0, 9)], "q_id long, chain int, pos int, doc_id long")
    texts = spark.createDataFrame([(7, "T7", "x7"), (8, None, "x8"), (9, "T9", None)], "doc_id long, title string, text string")
    got = {r.q_id: r.context for r in ch.chain_documents(rows, texts).collect()}
    assert got == {1: "Doc 1(Title: ) x8\nDoc 2(Title: T7) x7\nDoc 3(Title: T9) \n", 2: "Doc 1(Title: T9) \n"}


def test_no_hits(spark, found):
    none = spark.createDataFrame([], "q_id long, doc_id long, rank int")
    texts = spark.createDataFrame([(1, "a text of words")], "doc_id long, text string")
    own = ch.triples_of_hits(none, texts)
    assert own.count() == 0
    questions = spark.createDataFrame([], "q_id long, text string")
    assert ch.chains(questions, own, settled, 2).count() == 0
    assert found[1].where(F.col("length") <= 0).count() == 0
