"""The registered searches on written indexes without SQL: against exact scoring or brute force."""

import math
from collections import Counter, defaultdict

import regex

from corvid.functions import stemming as sm
from corvid.functions import text as tx
from corvid.plans import registry
from corvid.session import table

SF = "/root/testdata/sf0.01"


def pairs(df):
    return {(r[0], r[1]) for r in df.select(*df.columns[:2]).collect()}


def test_seismic_against_the_exact_cut(spark):
    want, got = (registry.queries()[n](spark, SF) for n in ("sp7_query_cut", "sp7_seismic"))
    want, got = ({(r.q_id, r.doc_id): r.score for r in x.collect()} for x in (want, got))
    same = want.keys() & got.keys()
    print("recall", len(same) / len(want))
    assert len(same) >= 0.9 * len(want)
    assert all(abs(want[x] - got[x]) < 2e-6 for x in same)


def test_ivfpq_against_the_exact_search(spark):
    want, got = (pairs(registry.queries()[n](spark, SF)) for n in ("dn6_dense_search", "dn7_ivfpq_search"))
    assert len(want & got) >= 0.9 * len(want)


def analysed(text, language):
    words = regex.findall(tx.WORD, text.lower())
    return [sm.STEMMERS[language](w) if language in sm.STEMMERS else w for w in words if w not in sm.STOP_LISTS.get(language, ())]


def test_snowball_terms(spark):
    small = "/root/testdata/sf0.001"
    want = Counter((r.doc_id, w) for r in table(spark, small, "documents").collect() for w in analysed(r.text, r.lang))
    assert Counter({(r.doc_id, r.term): r.n for r in registry.queries()["sp1_snowball"](spark, small).collect()}) == want


def test_stemmed_search(spark):
    small = "/root/testdata/sf0.001"
    docs = {r.doc_id: Counter(analysed(r.text, "en")) for r in table(spark, small, "documents").collect()}
    mean, df = sum(sum(c.values()) for c in docs.values()) / len(docs), Counter(t for c in docs.values() for t in c)
    want = defaultdict(list)
    for q in table(spark, small, "benchmark").collect():
        for d, c in docs.items():
            own = [t for t in set(analysed(q.text, "en")) if t in c]
            if own:
                score = sum(math.log(1 + (len(docs) - df[t] + 0.5) / (df[t] + 0.5)) * c[t] / (c[t] + 1.5 * (0.25 + 0.75 * sum(c.values()) / mean)) for t in own)
                want[q.item_id].append((-round(score, 6), d))
    got = defaultdict(list)
    for r in registry.queries()["sp3_stemmed_search"](spark, small).orderBy("q_id", "rank").collect():
        got[r.q_id].append((r.score, r.doc_id))
    assert got.keys() == want.keys()
    for q, hits in got.items():
        best = sorted(want[q])[:10]
        assert [round(-s, 5) for s, _ in best] == [round(s, 5) for s, _ in hits]
        assert {d for _, d in best[:5]} - {d for _, d in hits} == set()
