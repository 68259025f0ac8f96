"""Operators that compare documents, against brute force on small corpora with odd rows."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corvid.llm import hierbayes, jaccard, langid, linededup, ngramlm, suffixdedup
from corvid.llm.common import Stash

from .conftest import frame

PIECES = P.path("piece_bpe_32k.model")
LINE = "This very line is long enough to be counted as boilerplate, surely."
PASSAGE = " ".join(f"passage{k}" for k in range(60))


def corpus(seed=1, n=60):
    r = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    say = lambda k: " ".join(r.choice(words) for _ in range(k))
    texts = [None, "", " ", "one", "two words", "same four words here", "same four words here"]
    for k in range(n):
        t = say(r.randint(5, 120)) + "\n" + say(12)
        if k % 4 == 0:
            t += f"\n  {LINE.upper() if k % 8 else LINE}\t\n{LINE}"
        if k % 5 == 0:
            t = say(10) + " " + PASSAGE + " " + say(r.randint(0, 200))
        texts.append(t)
    base = say(120)
    for k in range(12):  # near copies: a chain of edits
        w = base.split()
        w[k * 9] = f"edit{k}"
        texts.append(" ".join(w))
    texts += [base, base, base.upper(), "x" * 350, "ab" * 300, "é" * 120, "long " * 3000 + say(300)]
    rows = [(n, t, "en", f"s{n % 3}") for n, t in enumerate(texts)]
    return rows


def docs(spark, rows):
    return frame(spark, [*rows, rows[-2], (None, PASSAGE + "\n" + LINE, None, None)])


def test_line_dedup(spark):
    rows = corpus()
    got = linededup.dedup(docs(spark, rows)).collect()
    assert len(got) == len(rows) + 2
    by = {r.doc_id: r for r in got}
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\r\x0b\x0c"))
    holders = defaultdict(set)
    for n, t, *_ in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 40:
                holders[key(line)].add(n)
    dropped = 0
    for n, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(holders.get(key(x), ())) >= 5 and n != max(holders[key(x)]))]
        dropped += len(lines) - len(kept)
        assert by[n][1:] == (len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())
    assert dropped > 10 and by[None].n_dropped == 0
    assert linededup.dedup(docs(spark, rows).limit(0)).count() == 0


def test_cuckoo_filter():
    r = np.random.default_rng(3)
    keys = np.unique(r.integers(0, 2**63, 20_000).astype(np.uint64))
    f = linededup.CuckooFilter(len(keys))
    f.insert(keys)
    assert f.contains(keys).all()
    other = r.integers(0, 2**63, 50_000).astype(np.uint64)
    assert f.contains(other).mean() < 0.01
    f = linededup.CuckooFilter.load(f.dump())
    f.delete(keys[:10_000])
    assert f.contains(keys[10_000:]).all() and f.contains(keys[:10_000]).mean() < 0.01
    crowded = linededup.CuckooFilter(4)
    crowded.insert(keys[:200])
    assert crowded.contains(keys[:200]).all()


def test_ledger_is_reversible(spark):
    rows = corpus()
    one, two = frame(spark, rows[:40]), frame(spark, rows[40:])
    ledger = linededup.Ledger(spark)
    ledger.insert(one)
    before = sorted((bytes(r.key), r.refs, r.keeper) for r in ledger.refs.collect())
    ledger.insert(two)
    ledger.insert(two)  # documents already held change nothing
    whole = sorted((bytes(r.key), r.refs, r.keeper) for r in linededup.references(linededup.occurrences(frame(spark, rows))).collect())
    assert sorted((bytes(r.key), r.refs, r.keeper) for r in ledger.refs.collect()) == whole
    assert {(r.doc_id, bytes(r.key)) for r in ledger.drops().collect()} == {(r.doc_id, bytes(r.key)) for r in linededup.find_drops(Stash(spark, "t"), ledger.occ, ledger.refs.where("refs >= 5")).collect()}
    ledger.delete(two)
    assert sorted((bytes(r.key), r.refs, r.keeper) for r in ledger.refs.collect()) == before


def test_ledger_touches_only_its_shards_and_its_filters_follow(spark):
    line = lambda k: f"line number {k} of some length that is over forty characters"
    rows = [(n, "\n".join(line(k) for k in range(n, n + 4))) for n in range(60)]
    ledger = linededup.Ledger(spark, shards=16)
    ledger.insert(spark.createDataFrame(rows[:1], "doc_id long, text string"))
    first = {k: list(v) for k, v in ledger.paths["references"].items()}
    assert 0 < len(first) <= 4
    ledger.insert(spark.createDataFrame(rows, "doc_id long, text string"))
    before = {name: {k: list(v) for k, v in held.items()} for name, held in ledger.paths.items()}
    ledger.insert(spark.createDataFrame([(1000, line(999))], "doc_id long, text string"))
    for name in ("references", "filters", "documents"):
        changed = [k for k in ledger.paths[name] if ledger.paths[name][k] != before[name].get(k)]
        assert len(changed) == 1, name

    def entries():
        return {r.shard: linededup.CuckooFilter.load(bytes(r["filter"])) for r in ledger.read("filters").collect()}

    keys = {k: linededup.line_key(line(k)) for k in [*range(63), 999]}
    held = lambda: sum(np.count_nonzero(f.table) + len(f.stash) for f in entries().values())
    assert held() == ledger.refs.count() == 64
    ledger.delete(spark.createDataFrame([(1000,), (0,), (None,)], "doc_id long"))
    assert held() == ledger.refs.count() == 62  # lines 999 and 0 are held by no document any more
    want = {bytes(r.key): (r.refs, r.keeper) for r in linededup.references(linededup.occurrences(spark.createDataFrame(rows[1:], "doc_id long, text string"))).collect()}
    assert {bytes(r.key): (r.refs, r.keeper) for r in ledger.refs.collect()} == want and keys[0] not in want
    low = np.array([np.frombuffer(k, np.uint64)[0] for k in want], np.uint64)
    assert sum(f.contains(low) for f in entries().values()).min() >= 1
    ledger.delete(spark.createDataFrame([(n,) for n in range(60)], "doc_id long"))
    assert ledger.refs.count() == held() == ledger.occ.count() == 0
    ledger.insert(spark.createDataFrame(rows[1:], "doc_id long, text string"))
    assert {bytes(r.key): (r.refs, r.keeper) for r in ledger.refs.collect()} == want


def brute_components(rows):
    sets = {}
    for n, t, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[n] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
    root = {n: n for n in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: (len(s), find(n)) for n, s in sets.items()}


@pytest.mark.parametrize("common", [50, 1])
def test_jaccard(spark, monkeypatch, common):
    monkeypatch.setattr(jaccard, "COMMON", common)
    rows = corpus()
    got = jaccard.join(docs(spark, rows)).collect()
    assert len(got) == len(rows) + 2
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == brute_components(rows)


def test_jaccard_tree_finds_all_pairs():
    r = np.random.default_rng(5)
    base = r.integers(0, 2**60, 300).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[: r.integers(150, 300)], r.integers(0, 2**60, r.integers(0, 60)).astype(np.uint64)])) for _ in range(150)]
    n = np.array([len(s) for s in sets])
    points = np.stack([np.frombuffer(jaccard.point(s), np.uint8) for s in sets])
    tree = jaccard.RTree(n, points)
    found = {(i, j) for i, js in tree.meet(tree) for j in js}
    for i in range(150):
        for j in range(150):
            if jaccard.enough(len(np.intersect1d(sets[i], sets[j])), n[i], n[j]):
                assert (i, j) in found


def test_packed_points_keep_their_counts():
    r = np.random.default_rng(7)
    sets = [np.unique(r.integers(0, 2**60, n).astype(np.uint64)) for n in (0, 1, 40, 300, 900, 40_000)] + [np.arange(0, 256 * 300, 256, dtype=np.uint64)]
    packed = [jaccard.packed_point(s) for s in sets]
    assert {len(p) for p in packed} == {64, 128, 256}
    assert jaccard.points_of(pa.chunked_array([pa.array(packed, pa.binary())])).tolist() == [list(jaccard.point(s)) for s in sets]


def test_pairs_of_many_cells_leave_once():
    """Two documents that share a passage but are too unlike to link meet in many cells."""
    passage = " ".join(f"p{k}" for k in range(60))
    texts = [" ".join([passage, *(f"w{n}x{k}" for k in range(30))]) for n in range(12)]
    members = [(c, n) for c in range(40) for n in range(12)]
    named = sorted(range(40))[: jaccard.NAMED]
    sets = jaccard.shingle_sets(texts)
    rows = [(c + 1, 0, 0, 0, n, n, len(sets[n]), jaccard.packed_point(sets[n]), [x + 1 for x in named]) for c, n in members]
    monkey, jaccard.enough = jaccard.enough, lambda *a: np.ones(len(a[0]), bool)
    try:
        cells = np.array([r[0] for r in rows])
        order = np.argsort(cells, kind="stable")
        cols = [np.array([rows[k][x] for k in order]) for x in (0, 4, 5, 6)]
        points = jaccard.points_of(pa.chunked_array([pa.array([rows[k][7] for k in order], pa.binary())]))
        a, b = jaccard.small_pairs(*cols, points, np.array([rows[k][8] for k in order]))
    finally:
        jaccard.enough = monkey
    assert len(a) == 12 * 11 // 2


def test_jaccard_empty(spark):
    assert jaccard.join(docs(spark, corpus()).limit(0)).count() == 0


def test_suffix_dedup(spark):
    rows = corpus()
    got = {r.doc_id: r for r in suffixdedup.dedup(docs(spark, rows)).collect()}
    seen = set()
    for n, t, *_ in rows:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - 99):
            w = raw[k : k + 100]
            if w in seen:
                gone[k : k + 100] = b"\1" * 100
            seen.add(w)
        spans = sum(gone[k] and not (k and gone[k - 1]) for k in range(len(raw)))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        assert got[n][1:] == (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()), n
    assert got[None].n_removed == 0
    assert suffixdedup.dedup(docs(spark, rows).limit(0)).count() == 0


def test_collection_orders_strings(tmp_path):
    strings = np.random.default_rng(0).integers(0, 3, (200, 14), dtype=np.uint8)
    strings[50:80] = strings[:30]
    order, shared = suffixdedup.Collection(str(tmp_path)).build(strings)
    rows = [strings[i].tobytes() for i in order]
    assert rows == sorted(rows)
    for k in range(1, 200):
        assert shared[k] == next((c for c in range(14) if rows[k][c] != rows[k - 1][c]), 14)
    assert not list(tmp_path.iterdir())


@pytest.mark.parametrize("order", [1, 2, 3])
def test_lm_scoring(spark, order):
    rows = corpus()
    got = {r.doc_id: r for r in ngramlm.score(frame(spark, rows), order).collect()}
    words = {n: (t or "").lower().split() for n, t, *_ in rows}
    c = Counter(tuple(w[k : k + m]) for w in words.values() for m in range(1, order + 1) for k in range(len(w) - m + 1))
    total = sum(map(len, words.values()))
    for n, w in words.items():
        score = 0.0
        for k in range(len(w)):
            for m in range(min(order, k + 1), 0, -1):
                g = tuple(w[k - m + 1 : k + 1])
                if m == 1 or c[g] >= 2:
                    score += math.log(c[g] / (c[g[:-1]] if m > 1 else total)) + (order - m) * math.log(0.4)
                    break
        assert got[n].n_words == len(w) and got[n].log_score == pytest.approx(score, rel=1e-9, abs=1e-9)
    assert ngramlm.score(frame(spark, rows).limit(0)).count() == 0


def test_langid_forward_sums_all_segmentations():
    p = langid.inventory(PIECES)
    r = np.random.default_rng(0)
    table = np.vstack([r.random((p.size, 2)), np.zeros(2)])
    at = {x: n for n, x in enumerate(p.pieces)}
    longest = max(p.pieces, key=len)
    words = [b" the", b" of", b"a", b" thanes", " éreau".encode(), b" " + b"z" * 31, longest, b" " + longest.strip() * 2, b" xyz" + b"the" * 20, b" " + b"ab" * 90]
    assert len(longest) > 12
    got = langid.forward(p, table, words)
    for w, row in zip(words, got):
        for lang in (0, 1):
            a = [1.0] + [0.0] * len(w)
            for j in range(1, len(w) + 1):
                a[j] = sum(a[i] * table[at[w[i:j]], lang] for i in range(j) if w[i:j] in at)
            assert row[lang] == pytest.approx(math.log(a[-1]))


def test_langid_log_probabilities_stay_in_range():
    p = langid.inventory(PIECES)
    table = np.full((p.size + 1, 2), 1e-12)
    table[:, 1] = 1e-3
    table[-1] = 0
    words = [b" " + b"\x01\x02" * k for k in (2, 15, 31, 40, 6000)]
    got = langid.forward(p, table, words)
    assert np.isfinite(got).all()
    for w, row in zip(words, got):  # pieces of bytes alone: one segmentation
        assert row.tolist() == pytest.approx([len(w) * math.log(1e-12), len(w) * math.log(1e-3)], rel=1e-9)


def test_langid_expected_counts_by_enumeration(monkeypatch):
    p = langid.inventory(PIECES)
    at = {x: n for n, x in enumerate(p.pieces)}

    def ways(w):
        if not w:
            yield ()
        for k in range(1, len(w) + 1):
            if w[:k] in at:
                for rest in ways(w[k:]):
                    yield (at[w[:k]], *rest)

    words = [b" the", b" nation", " été".encode(), b" information"]
    weights = np.array([[1.0, 2, 0, 3], [0, 0, 4, 1]])
    want = np.zeros((2, p.size))
    for n, w in enumerate(words):
        found = list(ways(w))
        shares = np.array([(1 / p.size) ** len(x) for x in found])
        for x, share in zip(found, shares / shares.sum()):
            for piece in x:
                want[:, piece] += weights[:, n] * share
    assert np.allclose(langid.expected_counts(p, words, weights), want)
    monkeypatch.setattr(langid, "WIDTHS", (1,))  # all words byte by byte
    monkeypatch.setattr(langid, "BLOCK", 5)
    assert np.allclose(langid.expected_counts(p, words, weights), want)


def test_langid_odd_tables(spark):
    rows = [(n, "the other thing and the rest", "en") for n in range(8)] + [(20, "les choses " * 5 + "z" * 20_000, "fr"), (21, "é" * 9000, None), (22, "les choses", "fr"), (25, "les", "fr"), (20, "les", "fr")]
    got = langid.identify(frame(spark, rows), PIECES).collect()
    assert len(got) == len(rows) and all(0 <= x.score <= 1 for x in got)
    assert langid.identify(frame(spark, rows).limit(0), PIECES).count() == 0


def test_langid(spark):
    r = random.Random(1)
    words = {"en": ["the", "thing", "other", "and", "with"], "fr": ["les", "était", "chose", "avec", "où"]}
    rows = [(n, " ".join(r.choice(words[lang]) for _ in range(20)), lang) for n in range(60) for lang in [("en", "fr")[n % 2]]]
    rows += [(100, None, "en"), (101, "12 34 !!", "fr"), (102, "", None), (103, "les " * 30000, None), (None, "the other thing", None), (1, rows[1][1], "fr")]
    got = langid.identify(frame(spark, rows), PIECES).collect()
    by = {x.doc_id: x for x in got}
    assert len(got) == len(rows) and {x.lang_pred for x in got} == {"en", "fr", "und"}
    assert all(by[n].lang_pred == lang and 0 <= by[n].score <= 1 for n, _, lang in rows[:60])
    assert by[100].lang_pred == by[101].lang_pred == by[102].lang_pred == "und" and by[103].lang_pred == "fr" and by[None].lang_pred == "en"
    import zlib

    assert all(x.held_out == (x.doc_id is not None and zlib.crc32(str(x.doc_id).encode()) % 4 == 2) for x in got)
    assert {x.lang_pred for x in langid.identify(frame(spark, [(1, "words", None)]), PIECES).collect()} == {"und"}


def test_quality(spark):
    r = random.Random(4)
    good = [f"g{k}" for k in range(30)]
    rows, labels = [], []
    for n in range(300):
        bad = n % 3 == 0
        t = " ".join(r.choice(good) for _ in range(15)) + (" scum idiot" if bad else "")
        rows.append((n, t, "en", "dirty" if n % 2 else "clean"))
        if n < 200:
            labels.append((n, 0 if bad else 1, int(bad)))
    rows += [(900, None, None, None), (901, "", "en", "rare"), (None, "g1 scum idiot", "en", "clean")]
    lab = spark.createDataFrame([*labels, labels[0], (None, 1, 0), (5000, 0, 0)], "doc_id long, quality int, toxic int")
    d = frame(spark, rows)
    got = {x.doc_id: x for x in hierbayes.classify(d, lab, d["source"], F.concat_ws("/", d["source"], d["lang"]), ["quality", "toxic"]).collect()}
    assert len(got) == len(rows)
    assert all((got[n].toxic > 0.5) == (n % 3 == 0) for n in range(300)) and all((got[n].quality > 0.5) == (n % 3 != 0) for n in range(300))
    assert 0 < got[901].toxic < 1 and got[None].toxic > 0.5
    none = hierbayes.classify(d, lab.limit(0), d["source"], d["lang"], ["quality"])
    assert {round(x.quality_doc, 6) for x in none.collect()} == {0.5}


def test_shrinkage_pulls_sparse_sites_to_the_corpus(spark):
    rows = [("big", "big/a", 0.9)] * 200 + [("other", "other/a", 0.1)] * 200 + [("tiny", "tiny/a", 0.9)]
    got = {x.path: x for x in hierbayes.shrink(spark.createDataFrame(rows, "host string, path string, p double"), "p").collect()}
    assert got["big/a"].path_mean > 0.85 > got["tiny/a"].path_mean - 0.05
    assert got["big/a"].path_mean >= got["tiny/a"].path_mean


def test_means_reach_hot_and_cold_paths(spark):
    rows = [(n, "h", "hot" if n < 10 else None if n < 12 else f"cold{n}") for n in range(15)] + [(15, None, "hot")]
    d = spark.createDataFrame(rows, "doc_id long, host string, path string")
    means = d.groupBy(F.col("host").alias("h_"), F.col("path").alias("p_")).agg(F.count("*").alias("n_"), F.sum("doc_id").alias("mean"))
    for most in (1, 3, 10_000):  # no path, one and all of them hot
        got = {r.doc_id: r.mean for r in hierbayes.beside(d, means, most).collect()}
        assert got == {n: sum(m for m, *key in rows if key == [h, p]) for n, h, p in rows}


def test_pipeline_stages(spark, tmp_path):
    rows = [(n, t, "en", "s", len(t or "")) for n, t, *_ in corpus(n=40)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    d.write.parquet(f"{tmp_path}/documents.parquet")
    docs, before = spark.read.parquet(f"{tmp_path}/documents.parquet"), len(rows)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        got = out.collect()
        assert len(got) <= before and all(r.n_chars == (len(r.text) if r.text is not None else None) for r in got)
        before = len(got)
        docs = spark.createDataFrame(got, d.schema)
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in docs.collect()}
    last = {n: t for n, t, *_ in rows}
    copies = [n for n, t in last.items() if t and last[max(last) - 6].lower() == t.lower()]
    assert len([n for n in copies if n in {r.doc_id for r in packed}]) <= 1
