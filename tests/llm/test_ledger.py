"""The ledger of line dedup: batches write in proportion to themselves, and merging changes nothing."""

import random

import pytest
from pyspark.sql import functions as F

from corvid.llm import linededup

LINE = "line number {} of some length that is over forty characters"


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def state(refs):
    return {bytes(r.key): (r.refs, r.keeper) for r in refs.collect()}


def entries(ledger):
    filters = [linededup.CuckooFilter.load(bytes(r["filter"])) for r in ledger.read("filters").collect()]
    return sum(int((f.table != 0).sum()) + len(f.stash) for f in filters)


@pytest.mark.parametrize("few", [0, 10_000])
def test_any_series_of_batches_equals_a_recount(spark, few):
    r = random.Random(few)
    texts = {n: "\n".join(LINE.format(r.randrange(25)) for _ in range(r.randrange(1, 5))) for n in range(40)}
    ledger, held = linededup.Ledger(spark, shards=2, few=few), set()
    for turn in range(4 if few == 0 else 3):
        some = r.sample(sorted(texts), 15)
        if turn in (1, 3):
            ledger.delete(spark.createDataFrame([(n,) for n in [*some, 999]], "doc_id long"))
            held -= set(some)
        else:
            ledger.insert(docs(spark, [(n, texts[n]) for n in some]))
            held |= set(some)
        want = state(linededup.references(linededup.occurrences(docs(spark, [(n, texts[n]) for n in sorted(held)]))))
        assert state(ledger.refs) == want and entries(ledger) == len(want)
        assert ledger.occ.count() == sum(n for n, _ in want.values())
    assert {(x.doc_id, bytes(x.key)) for x in ledger.drops(2).collect()} == {(x.doc_id, bytes(x.key)) for x in ledger.occ.collect() if want[bytes(x.key)][0] >= 2 and want[bytes(x.key)][1] != x.doc_id}


def test_a_batch_writes_as_much_as_it_holds(spark):
    def made(first, end):
        own = F.format_string("the line of document %d alone, and of no other document", "id")
        shared = F.format_string("a passage number %d that many documents hold in common", F.col("id") % 5000)
        return spark.range(first, end).select(F.col("id").alias("doc_id"), F.concat_ws("\n", own, shared).alias("text"))

    ledger = linededup.Ledger(spark)
    ledger.insert(made(0, 100_000))
    assert ledger.refs.count() == 105_000
    before = dict(ledger.written)
    ledger.insert(made(100_000, 101_000))
    added = {name: ledger.written[name] - before[name] for name in before}
    assert added["occurrences"] == added["references"] == 2000 and added["documents"] == 1000
    before = dict(ledger.written)
    ledger.delete(spark.range(100_000, 101_000).select(F.col("id").alias("doc_id")))
    taken = {name: ledger.written[name] - before[name] for name in before}
    assert taken["occurrences"] == taken["references"] == 2000 and taken["documents"] == 1000
    assert ledger.refs.count() == 105_000 and ledger.refs.agg(F.sum("refs")).first()[0] == 200_000
    assert ledger.refs.agg(F.max("keeper")).first()[0] == 99_999


def test_more_shards_hold_the_same(spark, monkeypatch):
    monkeypatch.setattr(linededup, "LEDGER_KEYS", 10)
    rows = [(n, "\n".join(LINE.format(k) for k in range(n, n + 3))) for n in range(60)]
    ledger = linededup.Ledger(spark, shards=2)
    ledger.insert(docs(spark, rows[:30]))
    assert ledger.shards == 8
    ledger.insert(docs(spark, rows))
    ledger.delete(spark.createDataFrame([(n,) for n in range(10)], "doc_id long"))
    want = state(linededup.references(linededup.occurrences(docs(spark, rows[10:]))))
    assert state(ledger.refs) == want and entries(ledger) == len(want)
