"""Rolling windows against brute force."""

import random
import zlib

import numpy as np
import pytest

from corvid.llm import rolling as ro

from .conftest import frame


def event(i):
    return None if i is None else 60 * ((i + zlib.crc32(str(i).encode()) % 4000) // 6)


def brute(rows, spans=ro.SPANS):
    out = []
    for i, _, _, source in rows:
        for w in spans:
            t = event(i)
            win = [] if t is None else [r for r in rows if r[3] == source and r[0] is not None and t - w <= event(r[0]) < t]
            size = sorted(len(r[1]) for r in win if r[1] is not None)
            m = len(size)
            out.append((i, w, t, len(win), sum(size), len({r[2] for r in win if r[2] is not None}), size[-(-m // 2) - 1] if m else None, size[-(-75 * m // 100) - 1] if m else None))
    return sorted(out, key=str)


def rows_of(seed=3, n=500, span=3000):
    r = random.Random(seed)
    rows = [(r.randrange(-50, span), r.choice([None, "", "é" * 3, "x" * r.randint(0, 40)]), r.choice(["en", "fr", "de", None]), r.choice(["a", "a", "a", "b", "", None])) for _ in range(n)]
    return rows + [rows[0]] * 40 + [(None, "no id", "en", "a"), (None, None, None, None), (10**12, "far", "en", "a")]


@pytest.mark.parametrize("chunk", [None, 3600, 7000, 100_000])
def test_rolling(spark, chunk):
    rows = rows_of()
    df = frame(spark, rows).repartition(6)
    out = ro.rolling(df, chunk=chunk)
    assert out.columns == ["doc_id", "window_s", "event_s", "n_events", "sum_chars", "n_langs", "median_chars", "high_chars"]
    assert sorted((tuple(r) for r in out.collect()), key=str) == brute(rows)


def test_empty_and_other_windows(spark):
    assert ro.rolling(frame(spark, rows_of(n=1)).limit(0)).count() == 0
    rows = rows_of(5, 200, 400)
    out = ro.rolling(frame(spark, rows), spans=(60, 5000, 90))
    assert sorted((tuple(r) for r in out.collect()), key=str) == brute(rows, (60, 5000, 90))


def test_ranks_with_weights_and_ties():
    r = np.random.default_rng(1)
    for _ in range(60):
        n, span = int(r.integers(1, 80)), int(r.integers(1, 50))
        time, value, weight = np.sort(r.integers(0, 200, n)), r.integers(0, 6, n), r.integers(1, 4, n)
        asked = np.unique(r.integers(0, 260, 40))
        for share in ((1, 2), (75, 100), (1, 100), (1, 1)):
            want = []
            for t in asked.tolist():
                own = sorted(np.repeat(value, weight)[(np.repeat(time, weight) >= t - span) & (np.repeat(time, weight) < t)].tolist())
                want.append(own[-(-share[0] * len(own) // share[1]) - 1] if own else None)
            assert ro.ranks(time, value, weight, asked, span, -span, share) == want


def test_one_time_of_many_rows_is_one_event_row(spark):
    """Rows of one source, time, length and language travel as one."""
    rows = [(7, "abc", "en", "a")] * 3000 + [(700, "x", "en", "a")]
    got = {r.window_s: r for r in ro.rolling(frame(spark, rows)).collect() if r.doc_id == 700}
    assert sorted((tuple(r) for r in got.values()), key=str) == [x for x in brute(rows) if x[0] == 700]


def test_very_long_texts(spark):
    df = spark.createDataFrame([(5000 + k, "é" * n, "en", "a") for k, n in enumerate((20_000_000, 3, 10))], "doc_id long, text string, lang string, source string")
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in df.collect()]
    assert sorted((tuple(r) for r in ro.rolling(df).collect()), key=str) == brute(rows)
