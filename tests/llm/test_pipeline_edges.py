"""Every stage of the pipeline on null ids and texts, repeated rows, clashing columns, very long texts and empty tables."""

import random

import corpus_pipeline

EXTRA = "drop_id long, drop_keys string, range_id long, copy_id long, whole_copy boolean, gone long, kept boolean, rep long, key string, n long, shard int, starts string, ends string"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"


def table(spark):
    r = random.Random(4)
    words = [f"{a}{b}" for a in "the of and river stone window paper light garden".split() for b in ("", "s", "ed", "ing")]
    say = lambda n: " ".join(r.choice(words) for _ in range(n))
    texts = [say(60) for _ in range(30)]
    long = "\n".join(" ".join(f"{r.choice(words)}{r.randrange(10**6)}" for _ in range(12)) for _ in range(70_000))
    assert len(long) > 9_000_000
    rows = [*enumerate(texts), (None, say(60)), (None, say(60)), (40, None), (41, ""), (42, long), (3, texts[3]), (43, texts[3]), (44, "x" * 50_000)]
    return [(k, t, "en", "s", None if t is None else len(t), 1, "a", 2, 3, True, 4, False, 5, "k", 6, 7, "s", "e") for k, t in rows]


def test_stages_on_odd_rows(spark):
    docs = spark.createDataFrame(table(spark), SCHEMA)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns and out.schema == docs.schema, name
        got = out.collect()
        assert {x.drop_keys for x in got} == {"a"} and {x.ends for x in got} == {"e"}, name
        ids = [x.doc_id for x in got]
        assert ids.count(None) == 2 and 42 in ids and ids.count(3) == 2, name
        assert all(x.n_chars == len(x.text or "") for x in got if x.text is not None), name
        docs = spark.createDataFrame(got, SCHEMA)
    assert 43 not in ids and 44 not in ids
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, "")
    assert {x.doc_id for x in packed.select("doc_id").distinct().collect()} == set(ids)


def test_stages_on_an_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.schema == docs.schema and out.count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == 0


def test_run_against_brute_force_stages(spark, tmp_path):
    """run() over clean documents with planted copies, lines and passages: each decision by its plain definition."""
    from collections import Counter

    r = random.Random(9)
    words = [f"{a}{b}{c}" for a in "ba be bi bo bu da de di do du".split() for b in "kl mn rst v".split() for c in "a e o u".split()]
    say = lambda n: " ".join(r.choice(words) for _ in range(n))
    line, passage = say(12), say(40)
    texts = {n: say(80) for n in range(60)}
    for n in (3, 9, 12, 20, 33):
        texts[n] += "\n" + line
    for n in (5, 25):
        texts[n] = say(40) + " " + passage + " " + say(40)
    texts[50] = texts[7]
    texts[51] = texts[8].replace(texts[8].split()[-1], "changed")
    rows = [(n, t, "en", "s", len(t)) for n, t in texts.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {x.doc_id: x.text for x in corpus_pipeline.quality_rules(spark, docs, "").collect()}
    held = Counter(x for t in kept.values() for x in set(t.split("\n")) if len(x) >= 40)
    last = {x: max(n for n, t in kept.items() if x in t.split("\n")) for x, k in held.items() if k >= 5}
    kept = {n: "\n".join(x for x in t.split("\n") if x not in last or last[x] == n) for n, t in kept.items()}
    sets = {n: {tuple(t.lower().split()[k : k + 5]) for k in range(len(t.split()) - 4)} for n, t in kept.items()}
    root = {n: n for n in kept}
    for a in sorted(kept):
        for b in sorted(kept):
            if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = {n: low if x == high else x for n, x in root.items()}
    kept = {n: t for n, t in kept.items() if root[n] == n}
    seen, want = set(), {}
    for n in sorted(kept):
        raw = kept[n].encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - 99):
            w = raw[k : k + 100]
            if w in seen:
                gone[k : k + 100] = b"\1" * 100
            seen.add(w)
        want[n] = bytes(b for b, g in zip(raw, gone) if not g).decode()
    final = corpus_pipeline.run(spark, str(tmp_path)).groupBy("doc_id").max("doc_tokens").collect()
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokens = {n: len(t.encode(x, add_special_tokens=False).ids) + 1 for n, x in want.items() if x}
    assert {x[0]: x[1] for x in final} == tokens
    assert 50 not in tokens and 51 not in tokens and len(want[25]) < len(kept[25])
