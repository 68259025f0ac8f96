"""SentencePiece encoding and decoding against the library."""

import hashlib
import random

import public_tokenizers as P
import pytest
import sentencepiece

from corvid.llm import sentencepieces as sp

from .conftest import frame

MODEL = P.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
ODD = ["", " ", "  ", "\n", " a", "a ", "a  b", "a\n b", "a \nb", "\n\na\n", "▁", "a▁b", "x▁ y", "=" * 700, "z" * 3000, "日本語" * 400, "a" * 255 + " " + "b" * 257, "\x00\x01", "<s> </s> <unk> <0x0A>", "é é", "🎉 🎉🎉", "　z\xa0", "�", "word " * 700]


def texts(n=400):
    r = random.Random(11)
    parts = ["the", "ing", "q", " ", " ", "  ", "\n", "é", "語", "🎉", "▁", "zz", "12", "--", "\t", "\x00", "Ω"]
    return ODD + ["".join(r.choice(parts) for _ in range(r.randint(1, 50))) for _ in range(n)]


@pytest.fixture(scope="module")
def pieces():
    return sp.Pieces(MODEL)


def test_encoding_is_the_librarys(pieces):
    made = texts() + ["".join(chr(random.Random(k).choice([32, 10, k + 33, 0x400 + k, 0x4E00 + k, 0x1F300 + k])) * (k % 5) for k in range(j, j + 40)) for j in range(100)]
    for text, own, theirs in zip(made, pieces.encode(made), LIBRARY.encode(made), strict=True):
        assert own.tolist() == theirs, text[:80]
        assert pieces.decode(own.tolist()) == LIBRARY.decode(theirs)


def test_decoding_any_ids(pieces):
    r = random.Random(2)
    for _ in range(3000):
        ids = [r.choice([r.randrange(32000), r.randrange(260), 28705, 0, 1, 2]) for _ in range(r.randint(1, 9))]
        assert pieces.decode(ids) == LIBRARY.decode(ids), ids


def test_rounds_and_heap_agree(pieces):
    r = random.Random(7)
    for _ in range(60):
        word = "▁" * r.randint(0, 20) + "".join(r.choice("aeinst▁="[: r.choice([6, 7, 8])]) for _ in range(r.randint(1, 200)))
        symbol = pieces._symbols(word)
        rounds, _ = pieces._rounds(symbol.copy(), __import__("numpy").array([len(symbol)]))
        assert rounds.tolist() == pieces._heap(symbol).tolist()


def test_digests_and_round_trip(spark):
    rows = [(n, t, "en", "s") for n, t in enumerate([None, *texts(60)])]
    df = frame(spark, [*rows, rows[5], (None, "no id", None, None)])
    got = {}
    for r in sp.digests(df, MODEL).collect():
        assert got.setdefault(r.doc_id, r) == r
    assert set(got) == {*range(len(rows)), None}
    for n, text, *_ in rows:
        ids = LIBRARY.encode(text or "")
        assert (got[n].n_tokens, got[n].ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()), text
        assert got[n].decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()
    back = {r.doc_id: r.decoded for r in sp.decode(sp.encode(df, MODEL), MODEL).collect()}
    assert all(back[n] == LIBRARY.decode(LIBRARY.encode(t or "")) for n, t, *_ in rows)
    assert sp.digests(df.limit(0), MODEL).count() == 0 and sp.encode(df.limit(0), MODEL).count() == 0


def test_words_are_forgotten_and_long_ones_not_kept(monkeypatch):
    words = sp.Words(sp.Pieces(MODEL))
    monkeypatch.setattr(sp, "ROOM", 3)
    for text in ("a b c", "d e f", "x" * 400 + " y"):
        long = words.learn([words.split(text)])
        assert "".join(words.written[w] for w in words.split(text))[:-1] == ",".join(map(str, LIBRARY.encode(text)))
        words.forget(long)
    assert "x" * 400 not in words.written


def test_very_long_texts(spark):
    """20 MB: ordinary words, no blank at all, and one letter."""
    for text in ("some words and more\n" * 1_000_000, "日本語の文章" * 1_100_000, "ab" * 1_000_000):
        df = spark.createDataFrame([(1, text)], "doc_id long, text string")
        r = sp.digests(df, MODEL).first()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
        ids = LIBRARY.encode(text[: len(text) // 20])
        assert r.n_tokens >= len(ids)


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as format

    model = format.ModelProto()
    model.ParseFromString(open(MODEL, "rb").read())
    model.normalizer_spec.remove_extra_whitespaces = True
    path = tmp_path / "other.model"
    path.write_bytes(model.SerializeToString())
    with pytest.raises(ValueError, match="keep texts"):
        sp.Pieces(str(path))
