"""Packing, fertility, byte-level BPE and TIFF against brute force and round trips."""

import base64
import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from corvid.llm import bytebpe, fertility, packing, tiff

from .conftest import frame

RANKS, JSON, PIECES = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
ODD = [None, "", " ", "a", "a  b   c", "x\ny", "\n\n a\tb\r\n", "é ß ñ 日本語 🎉🎉", "it's we'll 'tis ''s 12 3½", "a\x1cb\x85c\xa0d", "<|endoftext|> x <|endoftext|>", "word " * 700, "z" * 3000, "ab" * 5000 + " tail"]


def texts(seed=5, n=40):
    r = random.Random(seed)
    words = ["the", "of", "and", "thnter", "éreau", "ciónja", "blewh", "ing.", "|", "%%%", "idiot"]
    return ODD + ["\n".join(" ".join(r.choice(words) for _ in range(r.randint(1, 30))) for _ in range(r.randint(1, 6))) for _ in range(n)]


def docs(spark):
    rows = [(n, t, "en", "s") for n, t in enumerate(texts())]
    return frame(spark, [*rows, rows[-1], (None, "no id", None, None)]), rows


def hf():
    t = Tokenizer.from_file(JSON)
    t.encode_special_tokens = True
    return t


def test_packing(spark):
    df, rows = docs(spark)
    out = packing.pack(df, JSON, P.PATTERN).collect()
    t = hf()
    want = {n: [*t.encode(x or "", add_special_tokens=False).ids, 0] for n, x, *_ in rows}
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in out:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    assert set(by_doc) == {*want, None}
    for n, ids in want.items():
        at = sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in by_doc[n])
        if n == len(rows) - 1:  # repeated row
            assert at[::2] == at[1::2]
            at = at[::2]
        assert [a[0] for a in at] == [sum(b[1] for b in at[:k]) for k in range(len(at))] and sum(a[1] for a in at) == len(ids)
        for s, length, crc, total in at:
            assert total == len(ids) and crc == zlib.crc32(np.array(ids[s : s + length], "<u4").tobytes())
    for seq in by_seq.values():
        at = 0
        for r in sorted(seq, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    assert packing.pack(df.limit(0), JSON, P.PATTERN).count() == 0


def test_plan_is_gapless_and_tight():
    r = random.Random(2)
    h = Counter(min(1024, int(r.lognormvariate(5.5, 1)) + 1) for _ in range(20000))
    fill = defaultdict(int)
    seen = Counter()
    for length, a, b, first, offset in packing.plan(h):
        seen[length] += b - a
        for s in range(first, first + b - a):
            assert fill[s] == offset
            fill[s] += length
    assert seen == h and max(fill.values()) <= 1024
    assert sum(1024 - x for x in fill.values()) < 0.02 * 1024 * len(fill)


def brute_rules(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    covered = {k + j for k in range(len(words) - 7) if windows[tuple(words[k : k + 8])] > 1 for j in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), n < 20 or 100 * len(covered) > 30 * n


def test_fertility(spark):
    df, rows = docs(spark)
    out = fertility.rules(df, PIECES, RANKS, P.PATTERN)
    got = {r.doc_id: r for r in out.collect()}
    assert out.count() == len(rows) + 2
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for n, x, *_ in rows:
        r = got[n]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_rules(x), x
        ids = [i for w in re.findall(r"[^\x20\x09-\x0D]+", x or "") for i in sp.encode(w)]
        assert r.n_tokens == len(ids)
        if ids:
            c = Counter(ids).values()
            assert r.entropy == pytest.approx(-sum(v / len(ids) * math.log2(v / len(ids)) for v in c), abs=1e-9)
            assert r.byte_share == pytest.approx(sum(sp.is_byte(i) or sp.is_unknown(i) for i in ids) / len(ids))
        assert not (r.base_failed and r.kept)
    assert fertility.rules(df.limit(0), PIECES, RANKS, P.PATTERN).count() == 0


def test_fertility_bands_reject_outliers(spark):
    r = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta", "house", "river", "stone", "green", "window", "garden", "paper", "light"] + [f"w{k}" for k in range(200)]
    good = [" ".join(r.choice(words) for _ in range(60)) for _ in range(200)]
    rows = [(n, x, "en") for n, x in enumerate(good)] + [(900, " ".join(r.choice(words) + "ᚠᛇᚻ" for _ in range(40)), "en"), (901, " ".join(good[0].split()), "xx")]
    got = {x.doc_id: x for x in fertility.rules(frame(spark, rows), PIECES, RANKS, P.PATTERN).collect()}
    assert not got[900].kept and not got[900].base_failed and "byte_share" in got[900].outside
    assert sum(got[n].kept for n in range(200)) >= 198 and got[901].kept


def test_byte_bpe(spark):
    df, rows = docs(spark)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    enc = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r for r in bytebpe.digests(df, RANKS, P.PATTERN).collect()}
    full = {r.doc_id: r.ids for r in bytebpe.encode(df, RANKS, P.PATTERN).collect()}
    back = {r.doc_id: r.decoded for r in bytebpe.decode(bytebpe.encode(df, RANKS, P.PATTERN), RANKS, P.PATTERN).collect()}
    assert None in got
    for n, x, *_ in rows:
        ids = enc.encode_ordinary(x or "")
        assert full[n] == ids and bytes(back[n]) == (x or "").encode()
        assert got[n][1:] == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((x or "").encode()).hexdigest())


def test_byte_bpe_fuzz():
    bpe, _ = bytebpe.codec(RANKS, P.PATTERN)
    enc = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})
    r = random.Random(9)
    alphabet = " \n\t\r\x0b\x0c\x1c\x1f\x85\xa0 'sstreveabcABC0123éßñ²½٣一二🎉́_-##"
    some = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 50))) for _ in range(1500)]
    assert [x.tolist() for x in bpe.encode(some)] == [enc.encode_ordinary(x) for x in some]


@pytest.mark.parametrize("how", [tiff.NONE, tiff.LZW, tiff.ADOBE_DEFLATE, tiff.OLD_DEFLATE, tiff.PACKBITS])
@pytest.mark.parametrize("predictor", [1, 2])
@pytest.mark.parametrize("tile", [0, 16])
def test_tiff_layouts(how, predictor, tile):
    r = np.random.default_rng(1)
    images = [r.integers(0, 256, (37, 21, 3), dtype=np.uint8), np.repeat(r.integers(0, 4, (50, 5, 1), dtype=np.uint8), 9, axis=1)]
    got = tiff.read_pages(tiff.write(images, [how] * 2, predictor, 10, tile))
    assert [(p.height, p.width, p.samples, p.pixels) for p in got] == [(*x.shape, x.tobytes()) for x in images]


def test_tiff_codecs():
    r = random.Random(4)
    for size in (0, 1, 2, 127, 128, 129, 5000, 60000):
        for alphabet in (2, 256):
            data = bytes(r.randrange(alphabet) for _ in range(size))
            assert tiff.lzw_decode(tiff.lzw_encode(data)) == data and tiff.packbits_decode(tiff.packbits_encode(data)) == data


def test_tiff_big_endian_and_floating_predictor():
    image = np.linspace(-3, 9, 12 * 5).reshape(5, 12).astype(">f4")
    planes = image.view(np.uint8).reshape(5, 12, 4).transpose(0, 2, 1).reshape(5, -1)
    raw = zlib.compress(np.diff(planes, axis=1, prepend=np.zeros((5, 1), np.uint8)).astype(np.uint8).tobytes())
    tags = [(256, 4, 12), (257, 4, 5), (258, 3, 32 << 16), (259, 3, 8 << 16), (273, 4, 8), (277, 3, 1 << 16), (278, 4, 5), (279, 4, len(raw)), (317, 3, 3 << 16), (339, 3, 3 << 16)]
    at = 8 + len(raw)
    data = b"MM\0*" + struct.pack(">I", at) + raw + struct.pack(">H", len(tags)) + b"".join(struct.pack(">HHII", t, k, 1, v) for t, k, v in tags) + struct.pack(">I", at)
    (page,) = tiff.read_pages(data)  # the chain comes back to the first directory
    assert np.array_equal(np.frombuffer(page.pixels, "<f4").reshape(5, 12), image)


def test_lzw_of_long_data_resets_its_table():
    r = random.Random(8)
    data = "".join(r.choice("the of and a in is it that was for on are as with his they ").strip() or " " for _ in range(400_000)).encode()
    packed = tiff.lzw_encode(data)
    assert tiff.lzw_decode(packed) == data and len(packed) < len(data)
    assert tiff.lzw_decode(packed, 1000)[:1000] == data[:1000] and len(tiff.lzw_decode(packed, 1000)) < 6000
    with pytest.raises((ValueError, IndexError)):
        tiff.lzw_decode(np.packbits(np.unpackbits(np.array([[1, 0], [0, 65], [1, 255]], ">u2").reshape(-1).view(np.uint8)).reshape(3, 16)[:, 7:].ravel()).tobytes())


def test_decoders_stop_at_the_size_of_their_block():
    bomb = zlib.compress(bytes(50_000_000))
    assert len(tiff.inflate(bomb, 300)) == 300
    assert len(tiff.packbits_decode(b"\x81a" * 100_000, 300)) < 600
    good = tiff.write([np.zeros((4, 4, 3), np.uint8)], [tiff.ADOBE_DEFLATE])
    assert tiff.read_pages(good)[0].pixels == bytes(48)


@pytest.mark.parametrize("size", [10, 1536, 1728, 100_000])
def test_every_layout_takes_every_size(size):
    r = random.Random(size)
    seen = set()
    while len(seen) < len(tiff.LAYOUTS):
        payload = tiff.padded(bytes(r.randrange(32, 127) for _ in range(size)))
        seen.add(zlib.crc32(payload) % len(tiff.LAYOUTS))
        found = tiff.read_pages(tiff.store(payload))
        assert b"".join(p.pixels for p in found) == payload


@pytest.mark.parametrize("bits", [1, 2, 4])
@pytest.mark.parametrize("how", [tiff.NONE, tiff.PACKBITS, tiff.LZW, tiff.ADOBE_DEFLATE])
def test_samples_of_few_bits(bits, how):
    r = np.random.default_rng(bits)
    image = r.integers(0, 1 << bits, (5, 13), dtype=np.uint8)
    laid = ((image[:, :, None] >> np.arange(bits - 1, -1, -1)) & 1).reshape(5, -1).astype(np.uint8)
    rows = np.packbits(laid, axis=1)
    for fill in (1, 2):
        raw = b"".join(tiff.packbits_encode(x.tobytes()) for x in rows) if how == tiff.PACKBITS else tiff.ENCODERS[how](rows.tobytes())
        if fill == 2:
            raw = np.packbits(np.unpackbits(np.frombuffer(raw, np.uint8)), bitorder="little").tobytes()
        tags = [(256, 4, 13), (257, 4, 5), (258, 3, bits), (259, 3, how), (266, 3, fill), (273, 4, 8), (277, 3, 1), (278, 4, 5), (279, 4, len(raw))]
        data = b"II*\0" + struct.pack("<I", 8 + len(raw)) + raw + struct.pack("<H", len(tags)) + b"".join(struct.pack("<HHII", t, k, 1, v) for t, k, v in tags) + bytes(4)
        (page,) = tiff.read_pages(data)
        assert page.bits == bits and np.array_equal(np.frombuffer(page.pixels, np.uint8).reshape(5, 13), image)


def test_big_tiff_and_the_page_bound(spark):
    image = np.arange(60, dtype=np.uint8).reshape(5, 12)
    tags = [(256, 4, 12), (257, 4, 5), (258, 3, 8), (259, 3, 1), (273, 16, 16), (277, 3, 1), (278, 4, 5), (279, 16, 60)]
    data = b"II" + struct.pack("<HHHQ", 43, 8, 0, 76) + image.tobytes() + struct.pack("<Q", len(tags)) + b"".join(struct.pack("<HHQQ", t, k, 1, v) for t, k, v in tags) + bytes(8)
    (page,) = tiff.read_pages(data)
    assert page.pixels == image.tobytes()
    media = spark.createDataFrame([(1, data), (1, data)], "doc_id long, media binary")
    assert [r.error for r in tiff.pages(media, most_bytes=59).collect()] == ["size 12 x 5"] * 2
    assert [r.pixels for r in tiff.pages(media, most_bytes=60).collect()] == [image.tobytes()] * 2
    assert tiff.pages(media.limit(0)).count() == 0 and tiff.round_trip(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_tiff_operator_and_query(spark):
    good = tiff.write([np.zeros((4, 4, 3), np.uint8)] * 3, [tiff.LZW] * 3)
    media = spark.createDataFrame([(1, good), (2, b"junk"), (3, None), (4, good[:-80]), (None, good)], "doc_id long, media binary")
    got = defaultdict(list)
    for r in tiff.pages(media).collect():
        got[r.doc_id].append(r)
    assert [r.page for r in got[1]] == [0, 1, 2] and all(r.pixels == bytes(48) for r in got[1])
    assert got[2][0].error == "not a TIFF" and got[3][0].error == "empty" and got[4][-1].error and len(got[None]) == 3
    df, rows = docs(spark)
    out = {r.doc_id: r for r in tiff.round_trip(df).collect()}
    for n, x, *_ in rows:
        raw = (x or "").encode()
        payload = raw.ljust(max(192, -(-len(raw) // 192) * 192))
        r = out[n]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))


def test_word_hashes_tell_words_apart():
    from corvid.llm.common import word_hashes

    r = random.Random(3)
    alphabet = "abAB \t\n\r\x0b\x0c\x1c\x85\xa0éz"
    some = ["", " ", "A", "a b", *("".join(r.choice(alphabet) for _ in range(r.randint(0, 80))) for _ in range(300)), "x" * 5000 + " y " + "X" * 5000]
    hashes, count = word_hashes([x.encode() for x in some])
    want = [w for x in some for w in x.encode().lower().split()]
    assert count.tolist() == [len(x.encode().split()) for x in some]
    assert len(hashes) == len(want) and len(set(zip(want, hashes.tolist()))) == len(set(want)) == len(set(hashes.tolist()))
    assert word_hashes([b""])[1].tolist() == [0] and len(word_hashes([])[0]) == 0


def test_word_hashes_do_not_depend_on_blocks(monkeypatch):
    from corvid.llm import common

    some = ["the quick brown fox".encode(), b"", b" a  bb\nccc " * 9, b"x" * 300 + b" end", "日本 é".encode()]
    whole = common.word_hashes(some)
    for size in (1, 7, 64):
        monkeypatch.setattr(common, "HASH_BLOCK", size)
        assert [x.tolist() for x in common.word_hashes(some)] == [x.tolist() for x in whole]
