"""The filter audit against brute force over all orders."""

import random
import re
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from corvid.llm import filteraudit as fa
from corvid.llm.common import Stash

from .conftest import frame

COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def fails(rows):
    """The filters that each row fails."""
    least = {}
    for i, text, *_ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    for i, text, *_ in rows:
        x = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", x)
        yield "".join(f for f, t in (("A", len(words) < 100), ("B", 100 * len(set(words)) < 80 * len(words)), ("C", 100 * len(re.findall("[A-Z]", x)) > 10 * len(x)), ("D", bool(re.search(r"[#$%&*|]", x))), ("E", i is not None and i > least[x])) if t)


def brute(rows, labels):
    out, shap = {}, Counter()
    good, bad = {i for i, q, _ in labels if q == 1}, {i for i, _, t in labels if t == 1}
    judged = [(lang or "", f, i in good and i is not None, i in bad and i is not None) for (i, _, lang, _), f in zip(rows, fails(rows), strict=True)]
    parts = {p for p, *_ in judged}
    for order in map("".join, permutations("ABCDE")):
        for k, f in enumerate(order):
            for p in parts:
                own = [x for x in judged if x[0] == p]
                left = [x for x in own if not set(x[1]) & set(order[:k])]
                gone = [x for x in left if f in x[1]]
                out[p, order, k + 1] = [len(left) - len(gone), len(gone), sum(f in x[1] for x in own) - len(gone), sum(x[1] == f for x in own), sum(x[2] for x in gone), sum(x[3] for x in gone)]
                shap[p, f] += len(gone)
    return {(p, o, s): (*v, shap[p, o[s - 1]]) for (p, o, s), v in out.items()}


def rows_of(seed=4, n=260):
    r = random.Random(seed)
    base = [" ".join(r.choice(["alpha", "beta", "Gamma", "x%d" % k, "UPPER", "|", "é"]) + str(r.randint(0, 90)) for k in range(r.randint(1, 180))) for _ in range(60)]
    near = [b[:-1] + "~" for b in base[:10]]  # one length, one prefix
    odd = ["", " ", None, "a" * 64, "a" * 65, "#", "A", "word " * 200, "日本語 " * 150]
    rows = [(k, r.choice(base + near + odd), r.choice(["en", "fr", None, ""]), "s") for k in range(n)]
    return rows + rows[:5] + [(3, "another text of id 3", "en", None), (None, rows[0][1], "en", None), (None, "no id", None, None), (n, "b" * 300_000, "en", None), (n + 1, "b" * 300_000, "en", None), (n + 2, "b" * 299_999 + "c", "en", None)]


def test_audit(spark):
    rows = rows_of()
    labels = [(k, k % 2, k % 3 == 0) for k in range(0, 250, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (9999, 1, 1)]
    labels = [(i, int(q), int(t)) for i, q, t in labels]
    df = frame(spark, rows).repartition(5)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {(r["part"], r.filter_order, r.step): tuple(r[c] for c in COUNTS) for r in fa.audit(df, marks).collect()}
    assert got == brute(rows, labels)
    assert fa.audit(df.limit(0), marks).count() == 0
    assert fa.audit(df.limit(3), marks.limit(0)).agg(F.sum("good_lost")).first()[0] == 0


def test_repeats_in_any_order(spark):
    rows = rows_of(9)
    least = {}
    for i, t, *_ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    want = {i for i, t, *_ in rows if i is not None and i > least[t or ""]}
    for seed in (1, 2):
        mixed = rows[:]
        random.Random(seed).shuffle(mixed)
        found = fa.repeats(frame(spark, mixed), Stash(spark, "t")).select("doc_id").collect()
        assert {r.doc_id for r in found} == want


def test_equal_hashes_are_told_apart(spark, monkeypatch):
    """All texts of one class: only whole texts count."""
    monkeypatch.setattr(fa, "block_hashes", lambda text: F.array(F.lit(1).cast("long")))
    rows = [(1, "aa", None, None), (2, "bb", None, None), (3, "aa", None, None), (4, "bb", None, None), (5, "cc", None, None)]
    assert {r.doc_id for r in fa.repeats(frame(spark, rows), Stash(spark, "t")).collect()} == {3, 4}


@pytest.mark.parametrize("large", [1, 5])
def test_large_classes(spark, monkeypatch, large):
    monkeypatch.setattr(fa, "_HOT", large)
    rows = [(k, "same" if k % 3 else f"own {k}", None, None) for k in range(90)]
    assert fa.repeats(frame(spark, rows), Stash(spark, "t")).count() == 59


def test_very_long_texts(spark):
    x = "word " * 4_000_000
    df = spark.createDataFrame([(1, x), (2, x), (3, x[:-1] + "!")], "doc_id long, text string")
    assert [r.doc_id for r in fa.repeats(df, Stash(spark, "t")).collect()] == [2]
