"""Words of any length in language identification: cut where no piece spans, in flat memory."""

import math
import random
import time
import tracemalloc

import numpy as np
import pytest

from corvid.llm import langid
from corvid.llm.queries import PIECES


def unspaced(n, seed=1):
    r = random.Random(seed)
    spans = ((0x4E00, 0x4FFF), (0x3041, 0x3090), (0xE01, 0xE30))
    return "".join(chr(r.randint(*r.choice(spans))) for _ in range(n)).encode()


def table_of(p, langs=3):
    made = np.random.default_rng(7).dirichlet(np.ones(p.size), langs).T
    return np.concatenate([made, np.zeros((1, langs))])


@pytest.mark.parametrize("word", [unspaced(400), b" " + b"thequingtionz" * 40, b" " + b"a" * 700, unspaced(60) + b"information" * 30 + unspaced(60)])
def test_sums_and_counts_equal_those_over_the_whole_word(word, monkeypatch):
    p = langid.inventory(PIECES)
    table = table_of(p)
    at = {x: n for n, x in enumerate(p.pieces)}
    edges = [(i, j, at[word[i:j]]) for i in range(len(word)) for j in range(i + 1, min(len(word), i + p.longest) + 1) if word[i:j] in at]
    for lang in range(3):  # in logarithms, over the whole word
        reach = [0.0] + [-math.inf] * len(word)
        for i, j, piece in edges:
            reach[j] = np.logaddexp(reach[j], reach[i] + math.log(table[piece, lang]))
        assert langid.forward(p, table, [word])[0, lang] == pytest.approx(reach[-1], rel=1e-10)
    whole = langid.long_counts(p, word)
    assert np.allclose(langid.expected_counts(p, [word, b" x"], np.array([[2.0, 0]]))[0], 2 * whole, atol=1e-8)
    monkeypatch.setattr(langid, "BLOCK", 37)
    monkeypatch.setattr(langid, "CUT_BLOCK", 41)
    assert np.allclose(langid.long_counts(p, word), whole, atol=1e-8)
    assert b"".join(x for some in p.parts(word) for x in some) == word
    sizes = np.array([len(p.pieces[k]) for k in range(p.size)])
    assert (whole * sizes).sum() == pytest.approx(len(word))  # the pieces of each segmentation cover the word


def test_texts_without_blanks_are_fast_and_need_no_room():
    p = langid.inventory(PIECES)
    table, word = table_of(p), unspaced(1_000_000)
    start = time.process_time()
    langid.forward(p, table, [word])
    langid.expected_counts(p, [word], np.ones((1, 1)))
    assert (time.process_time() - start) / len(word) < 6e-6  # a byte; some 0.5e-6 alone
    tracemalloc.start()
    try:
        langid.log_forward(p, table, b"ab" * 20_000)
        langid.long_counts(p, b"ab" * 20_000)
        small = tracemalloc.get_traced_memory()[1]
        tracemalloc.reset_peak()
        langid.log_forward(p, table, b"ab" * 100_000)
        langid.long_counts(p, b"ab" * 100_000)
        assert tracemalloc.get_traced_memory()[1] < 1.3 * small + (1 << 20)
    finally:
        tracemalloc.stop()
