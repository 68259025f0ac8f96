"""TIFF cells with any byte forged, and ids with two texts in any order of the rows."""

import random

import numpy as np

from corvid.llm import jaccard, tiff

from .conftest import frame


def test_no_forged_byte_fails_the_job(spark):
    """Every byte of header and directories takes several values; types and counts of every tag are forged."""
    image = np.arange(4 * 6 * 3, dtype=np.uint8).reshape(4, 6, 3)
    cells = []
    for tile, how in ((0, tiff.LZW), (16, tiff.ADOBE_DEFLATE), (0, tiff.PACKBITS)):
        good = tiff.write([image, image], [how] * 2, 1, 2, tile)
        for at in range(len(good)):
            for value in (0, 1, 2, 11, 12, 255, good[at] ^ 0x80):
                cells.append(good[:at] + bytes([value]) + good[at + 1 :])
        cells += [good[:n] for n in range(0, len(good), 3)]
    media = spark.createDataFrame([(n, c) for n, c in enumerate(cells)], "doc_id long, media binary")
    found = tiff.pages(media, most_bytes=1 << 20).select("doc_id", "error").collect()
    assert {r.doc_id for r in found} == set(range(len(cells)))
    assert any(r.error for r in found) and any(r.error is None for r in found)


def test_a_width_of_characters_or_floats_is_an_error(spark):
    good = bytearray(tiff.write([np.zeros((4, 6, 3), np.uint8)], [tiff.NONE], 1, 4, 0))
    at = good.index((256).to_bytes(2, "little"))
    for kind in (2, 11):
        good[at + 2] = kind
        r = tiff.pages(spark.createDataFrame([(1, bytes(good))], "doc_id long, media binary")).first()
        assert r.error and r.pixels is None


def test_one_result_for_ids_with_two_texts(spark):
    r = random.Random(5)
    say = lambda seed, n: " ".join(random.Random(seed).choices([f"w{k}" for k in range(4000)], k=n))
    rows = [(1, say(1, 60)), (2, say(1, 60)), (2, say(2, 60)), (3, say(2, 60)), (3, say(3, 60)), (4, say(3, 60)), (5, say(2, 60) + " more"), (6, ""), (6, say(1, 60)), (7, None)]
    rows = [(i, t, "en", "s") for i, t in rows]
    results = set()
    for _ in range(4):
        r.shuffle(rows)
        got = jaccard.join(frame(spark, rows).repartition(3)).select("doc_id", "n_shingles", "component_id").collect()
        assert len(got) == len(rows)
        results.add(tuple(sorted(map(tuple, got))))
    assert len(results) == 1
