"""Written blocks: a search shuffles each question's best alone, and an index its documents once."""

import re

from pyspark.sql import functions as F

from corvid.functions import stemming as sm
from corvid.operators import blockmax as bm
from corvid.operators import retrieval as rt
from corvid.session import table

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((r.q_id, r["rank"], r.doc_id, r.score) for r in df.collect())


def test_a_search_shuffles_no_postings(spark, tmp_path):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    asked = table(spark, SF, "benchmark").select(F.col("item_id").alias("q_id"), "text")
    found = bm.bm25_search(bm.bm25(docs, str(tmp_path / "b")), asked, 5)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"hashpartitioning\((\w+)#[^)]*\)", plan) and not re.search(r"hashpartitioning\([^)]*(doc_id|term|block)", plan)
    assert not re.search("SortMergeJoin|ShuffledHashJoin", plan)


def test_repeated_ids_ties_and_parts(spark, tmp_path, monkeypatch):
    odd = [(n, t) for n, t in enumerate(["same words here"] * 70 + ["", "a", "x " * 50 + "same same", None])] + [(3, "words again"), (3, "same"), (None, "same words")]
    docs = spark.createDataFrame(odd, "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame([("a", "same words, same"), ("b", "again"), ("c", "qqqq"), ("d", ""), ("e", None)], "q_id string, text string")
    want = [x for x in rows(rt.bm25_search(docs.where("doc_id <> 3 AND doc_id IS NOT NULL"), asked, 7))]
    held = bm.bm25(docs.where("doc_id <> 3"), str(tmp_path / "b"))
    assert rows(bm.bm25_search(held, asked, 7)) == want and len(want) >= 7
    merged = bm.bm25(docs, str(tmp_path / "c"))
    lists = {(r.term, d) for r in merged.lists().collect() for d in r.docs}
    assert {t for t, d in lists if d == 3} == {"same", "words", "here", "again"}
    assert {r.term: r.df for r in merged.terms().collect()}["again"] == 1
    for name, small in (("PAIRS", 7), ("WIDTH", 2), ("SMALL", 2)):
        monkeypatch.setattr(bm, name, small)
    assert rows(bm.bm25_search(held, asked, 7)) == want


def test_terms_of_tokens(spark, tmp_path):
    docs = spark.createDataFrame([(1, "the runners running"), (2, "the of and"), (3, "")], "doc_id long, text string")
    held = bm.bm25(docs, str(tmp_path / "s"), term_of=sm.stem_or_none("en"))
    want = {r.term for r in sm.analyse(spark.createDataFrame([("runners",), ("running",), ("the",)], "term string"), F.lit("en")).collect()}
    assert {r.term for r in held.terms().collect()} == want
    assert held.rows().agg(F.sum(F.size("ids"))).first()[0] == 3


def test_chains_shuffle_no_postings(spark, monkeypatch):
    from corvid.plans import chain_queries as cq

    plans, keep = [], cq.settled
    monkeypatch.setattr(cq, "settled", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or keep(df))
    cq.found_chains(spark, SF)
    dealt = re.findall(r"hashpartitioning\(([^)]*)\)", plans[0])
    assert dealt and not any("doc_id" in x or "term" in x for x in dealt)
