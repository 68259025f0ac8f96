"""Iterative compression and segmentation against brute force."""

import itertools
import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from corvid.functions import segmentation as sg
from corvid.operators import conditional as cd


def texts(seed=1, n=12):
    r = random.Random(seed)
    return {k: r.choices([f"w{x}" for x in range(25)], weights=range(1, 26), k=r.choice([1, 5, 37, 120])) for k in range(n)}


def brute(docs, ratio, window, gain=False):
    pairs, single, heads = Counter(), Counter(), Counter()
    prev = lambda d, i: docs[d][i - 1] if i % window else None
    for d, words in docs.items():
        for i, w in enumerate(words):
            single[w] += 1
            if prev(d, i):
                pairs[prev(d, i), w] += 1
                heads[prev(d, i)] += 1
    total, out = sum(single.values()), set()
    for d, words in docs.items():
        kept = []
        for start in range(0, len(words), window):
            values = []
            for i in range(start, min(len(words), start + window)):
                w, p = words[i], single[words[i]] / total
                if prev(d, i):
                    p = 0.6 * pairs[prev(d, i), w] / heads[prev(d, i)] + 0.4 * p
                loss = -math.log(0.7 * p + 0.3 * kept.count(w) / len(kept)) if kept else -math.log(p)
                values.append((round(-math.log(p) - loss if gain else loss, 9), i, w))
            cut = sorted((v for v, _, _ in values), reverse=True)[max(int(len(values) * ratio), 1) - 1]
            chosen = [(i, w) for v, i, w in values if v > cut]
            kept += [w for _, w in chosen]
            out |= {(d, i, w) for i, w in chosen}
    return out


def frame_of(spark, docs):
    return spark.createDataFrame([(d, i, w) for d, words in docs.items() for i, w in enumerate(words)], "doc_id long, pos long, word string").repartition(5)


@pytest.mark.parametrize("gain", [False, True])
def test_fold_against_brute_force(spark, gain):
    docs = texts()
    got = cd.compress(cd.probabilities(frame_of(spark, docs), 10), 0.5, 10, gain=gain)
    assert {(r.doc_id, r.pos, r.word) for r in got.collect()} == brute(docs, 0.5, 10, gain)
    assert cd.compress(cd.probabilities(frame_of(spark, docs).limit(0), 10), 0.5, 10).count() == 0


def test_a_dropped_window_changes_the_next_choice():
    window = lambda at, words: [(at + i, w, p) for i, (w, p) in enumerate(words)]
    first = window(0, [("rare", 0.01), ("the", 0.3), ("odd", 0.02), ("of", 0.2)])
    second = window(4, [("rare", 0.01), ("new", 0.05), ("the", 0.3), ("of", 0.2)])
    with_first = list(cd.fold([first, second], 0.75))[1]
    without = list(cd.fold([second], 0.75))[0]
    assert "rare" in [w for _, w, _ in without] and [w for _, w, _ in with_first] != [w for _, w, _ in without]


def test_other_corpus_and_null_keys(spark):
    docs = texts(3, 4)
    rows = frame_of(spark, docs).unionByName(spark.createDataFrame([(None, 0, "w1")], "doc_id long, pos long, word string"))
    corpus = spark.createDataFrame([(1, 0, "w1")], "doc_id long, pos long, word string")
    scored = cd.probabilities(rows, 10, corpus=corpus)
    assert scored.where("p <= 0 or p > 1 or p is null").count() == 0
    assert cd.compress(scored, 0.9, 10).where("doc_id is null").count() == 0


def every_path(own, line):
    """The best words of a line by trying all cuts."""
    best = None
    for cuts in itertools.product((0, 1), repeat=max(0, len(line) - 1)):
        edges = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(line)]
        words = [line[a:b] for a, b in itertools.pairwise(edges)]
        if all(w in own.logs or len(w) == 1 for w in words):
            score = sum(own.logs.get(w, own.floor) for w in words)
            if best is None or score > best[0] + 1e-9:
                best = score, words
    return best


def test_segmentation_against_all_paths():
    r = random.Random(8)
    for _ in range(150):
        counts = {"".join(r.choices("abc", k=r.randint(1, 4))): r.randint(1, 50) for _ in range(12)}
        own, line = sg.Dictionary.of(counts), "".join(r.choices("abcd", k=r.randint(1, 9)))
        words = own.words(line)
        assert "".join(words) == line
        assert math.isclose(sum(own.logs.get(w, own.floor) for w in words), every_path(own, line)[0], rel_tol=1e-12)


def test_segments_in_a_frame(spark):
    counts = spark.createDataFrame([("中文", 50), ("分词", 40), ("中", 5), ("文分", 1), ("x", 0)], "word string, n long")
    own = sg.dictionary(counts)
    rows = spark.createDataFrame([(1, "中文分词, 中文"), (2, None), (3, ""), (4, "未知 中")], "id long, t string")
    got = {r.id: r.w for r in rows.select("id", sg.segmenter(spark, own)(F.col("t")).alias("w")).collect()}
    assert got == {1: ["中文", "分词", "中文"], 2: [], 3: [], 4: ["未", "知", "中"]}
    assert sg.dictionary(counts, 1).logs.keys() == {"中文"}


def test_words_without_spaces_are_found_again(spark):
    """Text with its blanks taken out, the dictionary of its own words."""
    r = random.Random(4)
    counts = defaultdict(int)
    lines = [[r.choice(["alpha", "beta", "gamma", "delta", "epsilon", "omega"]) for _ in range(8)] for _ in range(20)]
    for line in lines:
        for w in line:
            counts[w] += 1
    own = sg.Dictionary.of(dict(counts))
    assert [own.words("".join(line)) for line in lines] == lines


def test_texts_in_chunks_keep_what_token_rows_keep(spark, monkeypatch):
    import random

    from pyspark.sql import functions as F

    from corvid.operators import conditional as cd

    rng = random.Random(5)
    rows = [(n, [rng.choice("a b c dd ee ff gg the the the".split()) for _ in range(rng.choice([0, 1, 5, 57]))]) for n in range(60)] + [(100, None), (101, ["lone"])]
    texts = spark.createDataFrame(rows, "doc_id long, words array<string>")
    tokens = texts.select("doc_id", F.posexplode("words").alias("pos", "word"))
    key = lambda df: sorted((r.doc_id, r.pos, r.word, round(r.loss, 9)) for r in df.collect())
    scored = cd.probabilities(tokens, 10)
    want = key(cd.compress(scored, 0.5, 10))
    assert want and key(cd.compress_texts(texts, 0.5, 10)) == want
    assert key(cd.compress_texts(texts, 0.5, 10, gain=True)) == key(cd.compress(scored, 0.5, 10, gain=True))
    monkeypatch.setattr(cd, "CHUNK", 50)
    monkeypatch.setattr(cd, "BUCKET", 20)
    assert key(cd.compress_texts(texts, 0.5, 10)) == want
    assert cd.compress_texts(texts.limit(0), 0.5, 10).count() == 0


def test_tokens_are_not_shuffled(spark):
    from corvid.plans import registry

    plan = registry.queries()["rf7_iterative"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.split("\n") if "hashpartitioning(" in line]
    assert dealt and not any("word#" in line or "prev#" in line or "doc_id#" in line.split("ENSURE")[0].split("hashpartitioning")[1] for line in dealt)
