"""Every query with SQL against DuckDB at the smallest scale, and fixtures the tables don't reach."""

import pytest
from pyspark.sql import functions as F

from corvid.functions import text as tx
from corvid.operators import evaluation as ev
from corvid.operators import retrieval as rt
from corvid.plans import registry

from .oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_oracle(spark, con, name):
    assert compare(con, registry.queries()[name](spark, SF), registry.oracle_sql()[name]) is None


def one(spark, expression, **columns):
    return spark.createDataFrame([tuple(columns.values())], list(columns)).select(expression.alias("x")).first().x


def test_text_fixtures(spark):
    c = F.col("t")
    assert one(spark, tx.merge_short_paragraphs(c), t="ab\ncd\n\n" + "x" * 60 + "\nyy\nzz") == "ab cd\n" + "x" * 60 + "\nyy zz"
    assert [one(spark, tx.detect_table(c), t=t) for t in ("a | b | c", "a\tb\nc\td", "a b")] == [True, True, False]
    assert one(spark, tx.table_rows(c), t="|x|y|\n|---|---|\n|1|2|") == "x | y\n1 | 2"
    assert one(spark, tx.last_between(c, "<a>", "</a>"), t="<a>x</a><a>y\nz</a>") == "y\nz"
    assert one(spark, tx.quality_reason(c), t="same " * 101) == "repetition"
    assert one(spark, tx.normalize_answer(c), t="The U.S.A!") == "usa"
    assert one(spark, F.to_json(tx.windows(F.split(c, " "), 3, 2)), t="a b c d e f g") == '[["a","b","c"],["c","d","e"],["e","f","g"]]'


def test_fusion_and_metrics_fixtures(spark):
    rows = [(1, 1, "a", 1), (1, 2, "a", 2), (1, 3, "a", 3), (1, 3, "b", 1), (1, 4, "b", 2)]
    got = rt.rrf(spark.createDataFrame(rows, "q_id int, doc_id int, source string, rank int"), 10).orderBy("rank").collect()
    assert [(r.doc_id, round(r.score, 6)) for r in got] == [(3, 0.032266), (1, 0.016393), (2, 0.016129), (4, 0.016129)]
    hits = spark.createDataFrame([(1, d, n) for n, d in enumerate((5, 2, 7), 1)], "q_id int, doc_id int, rank int")
    m = ev.retrieval_metrics(hits, spark.createDataFrame([(1, 2), (1, 9)], "q_id int, doc_id int"), 5, spark.createDataFrame([(1,)], "q_id int")).first()
    assert (m.recall, m.mrr, m.ndcg) == (0.5, 0.5, 0.386853)
    f = ev.token_scores(spark.createDataFrame([(1, "the cat sat on mat", "a cat on the mat mat"), (2, "yes", "yes it is")], "id int, pred string, gold string")).orderBy("id").collect()
    assert (f[0].f1, f[0].precision, f[0].recall) == (0.75, 0.75, 0.75) and f[1].f1 == 0
    padded = spark.createDataFrame([([7, 3],), ([],)], "a array<long>").select(rt.pad(F.col("a"), 5).alias("x")).collect()
    assert [r.x for r in padded] == [[7, 3, 3, 3, 3], [1, 1, 1, 1, 1]]
    runs = spark.createDataFrame([(1, 1, "m", 4.0), (1, 1, "n", 2.0), (1, 2, "m", 3.0)], "q_id int, doc_id int, model string, score double")
    assert {r.doc_id: r.score for r in rt.ensemble(runs, {"m": 0.7, "n": 0.3}, 5).collect()} == {1: 1.7, 2: 2.1}
