"""The beam over triples: against a search of all by all in plain Python, and the rows it shuffles."""

import math
import random

import pytest

from corvid.operators import refine as rf
from corvid.operators.loops import settled


def beam_search(questions, triples, hops, width, most, least=1e-4):
    more, said = {}, {}
    for t, terms in triples:
        if t is not None and terms:
            more[t] = min(more.get(t, terms), terms)
            said.setdefault(t, []).append(set(terms))
    out = {}
    for q in {q for q, _ in questions}:
        asked = [text.split() for k, text in questions if k == q]
        beam = [([], asked, 1.0)]
        for _ in range(hops):
            grown = []
            for path, terms, p in beam:
                near = [(-sum(len(set(a) & b) for a in terms for b in rows), t) for t, rows in said.items() if t not in path]
                near = sorted((n, t) for n, t in near if n)[:width]
                weights = [math.exp(near[0][0] - n) for n, _ in near]
                for (_, t), w in zip(near, weights, strict=True):
                    x = round(p * w / sum(weights), 9)
                    if x >= least:
                        grown.append((path + [t], [terms[0] + more[t]], x))
            beam = sorted(grown, key=lambda x: (-x[2], x[0]))[:most] or beam
        out[q] = [(path, p) for path, _, p in beam]
    return out


def some_triples(seed):
    """Frequent and rare terms; repeated, empty, missing and long ones; ids that stand twice or are missing."""
    r = random.Random(seed)
    term = lambda: f"t{int(r.paretovariate(0.7)) % 40}"
    rows = [(n, [term() for _ in range(r.choice((0, 1, 2, 3, 3, 3, 3)))]) for n in range(300)]
    rows += [(n, [term() for _ in range(r.randint(7, 15))]) for n in range(300, 330)]
    rows += [(n, [term() for _ in range(3)]) for n in range(5, 300, 40)] + [(None, ["t1", "t2", "t3"]), (400, None)]
    r.shuffle(rows)
    return rows, [(q, " ".join(term() for _ in range(r.randint(1, 12)))) for q in range(12)]


@pytest.mark.parametrize("seed, hops, width, most", [(1, 1, 5, 20), (2, 3, 2, 4), (3, 2, 5, 20)])
def test_beam_by_brute_force(spark, seed, hops, width, most):
    triples, questions = some_triples(seed)
    questions += [questions[0], (50, "nothing known"), (51, "")]
    got = {}
    for x in rf.chains(spark.createDataFrame(questions, "q_id long, text string"), spark.createDataFrame(triples, "triple long, terms array<string>"), hops, settled, width=width, most=most).collect():
        got.setdefault(x.q_id, []).append((x.path, x.prob))
    want = beam_search(questions, triples, hops, width, most)
    want[0] = want[0] if want[0][0][0] else want[0] * 2
    assert set(got) == set(want)
    for q in want:
        assert sorted(p for p, _ in got[q]) == sorted(p for p, _ in want[q]), q
        assert dict((tuple(p), x) for p, x in got[q]) == pytest.approx(dict((tuple(p), x) for p, x in want[q]), abs=1e-8)


def shuffled_rows(spark, n):
    sc = spark.sparkContext
    triples = spark.range(n).selectExpr("id AS triple", "array('common', concat('x', id % 50), concat('y', id % 7)) AS terms")
    questions = spark.range(30).selectExpr("id AS q_id", "concat('common x', id, ' y', id % 7) AS text")
    sc.setJobGroup(f"beam-{n}", "")
    try:
        assert rf.chains(questions, triples, 2, settled).count() == 30 * 20
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    stages = {s for j in sc.statusTracker().getJobIdsForGroup(f"beam-{n}") for s in sc.statusTracker().getJobInfo(j).stageIds}
    return sum(sc._jsc.sc().statusStore().lastStageAttempt(s).shuffleWriteRecords() for s in stages)


def test_triples_of_a_frequent_term_do_not_meet_every_path(spark):
    few, many = shuffled_rows(spark, 2_000), shuffled_rows(spark, 8_000)
    assert many - few < 10 * 6_000
