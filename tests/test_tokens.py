"""Fixtures of the mteval tokenizer and of abbreviations with signs that patterns give a meaning."""

from pyspark.sql import functions as F

from corvid.functions import text as tx
from corvid.operators import evaluation as ev


def first(spark, expression, text):
    return spark.createDataFrame([(text,)], "t string").select(expression.alias("x")).first().x


def test_mteval_tokens(spark):
    t = lambda text: first(spark, tx.mteval_tokens(F.col("t")), text)
    assert t("Hello, World.") == ["Hello", ",", "World", "."]
    assert t("1,000.5 and 3. (x-y) 3-4 a-b") == ["1,000.5", "and", "3", ".", "(", "x-y", ")", "3", "-", "4", "a-b"]
    assert t("it's &quot;so&quot; &amp;lt; R&amp;D<skipped>") == ["it's", '"', "so", '"', "<", "R", "&", "D"]
    assert t("hy-\nphen\nline") == ["hyphen", "line"]
    assert t("") == [] and t("  ") == [] and t(None) is None
    assert t("a b") == ["a", "b"]


def test_bleu_counts_marks_and_case(spark):
    pairs = spark.createDataFrame([(1, 1, "The cat, the mat.", "The cat, a mat."), (2, 1, "the Cat", "The cat")], "id int, gold_id int, pred string, gold string")
    got = {(r.id, r.n): (r.hit, r.total, r.c, r.r) for r in ev.bleu_counts(pairs).collect()}
    assert got[1, 1] == (5, 6, 6, 6) and got[1, 2] == (3, 5, 6, 6) and got[1, 4] == (0, 3, 6, 6)
    assert got[2, 1] == (0, 2, 2, 2) and got[2, 4] == (0, 0, 2, 2)


def test_abbreviations_are_taken_literally(spark):
    e = lambda text, table: first(spark, tx.expand_abbreviations(F.col("t"), table), text)
    assert e("a.c abc xa.c", {"a.c": "alternating"}) == "a.c alternating abc xa.c"
    assert e("C++ is C", {"C++": "a $1 language\\"}) == "C++ a $1 language\\ is C"
