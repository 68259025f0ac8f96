"""SentencePiece encoding and decoding by vectorised merge rounds over flat symbol arrays.

All words of a batch lie in one flat array of symbols. In every round the minimum pair rank of
each word is found by segments, each word merges its leftmost pair of that rank, all words at
once, the array is compacted, and the ranks beside the merges are looked up again; words
without a pair leave. Characters without a piece become bytes.

A word is a stretch that no merge can leave: no piece of the model joins a character to a space
mark behind it, or the characters on both sides of a border. A stretch of over LONG characters is
cut wherever the model has no piece with the two neighbours; what stays longer than that (one
letter a thousand times) is merged by the same rule over a heap, as rounds would cost its square.

Only models whose normaliser leaves texts as they are, with a space mark put before them, are read;
others raise ValueError, as do models with user-defined or unused pieces.

Defined results: null and empty texts have no ids, and no ids decode to an empty text; the
library's decoding takes a space mark of the text itself for a space, and so does this one;
rows that repeat a doc_id and null ids are encoded like any other; an empty table gives no rows;
texts of any length are taken in slices, long stretches in blocks.
"""

from __future__ import annotations

import hashlib
import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import batch, id_text, slices

MARK = "▁"
#: Characters of a stretch that is still merged in rounds.
LONG = 256
#: Symbols in the flat array of one batch, and words that a worker remembers.
SYMBOLS, ROOM = 1 << 18, 400_000
_NONE = np.int32(2**31 - 1)


class Pieces:
    """Encoder and decoder of one model file."""

    def __init__(self, model_file: str):
        from sentencepiece import sentencepiece_model_pb2 as format

        model = format.ModelProto()
        with open(model_file, "rb") as f:
            model.ParseFromString(f.read())
        rule, kinds = model.normalizer_spec, format.ModelProto.SentencePiece
        if model.trainer_spec.model_type != format.TrainerSpec.BPE or rule.precompiled_charsmap or not rule.add_dummy_prefix or rule.remove_extra_whitespaces or not rule.escape_whitespaces or not model.trainer_spec.byte_fallback:
            raise ValueError(f"{model_file}: only BPE models with byte fallback that keep texts as they are")
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces):
            raise ValueError(f"{model_file}: user-defined and unused pieces are not supported")
        self.ids = {p.piece: n for n, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        self.pieces = [p.piece for p in model.pieces]
        self.byte_of = {n: int(p.piece[3:-1], 16) for n, p in enumerate(model.pieces) if p.type == kinds.BYTE}
        self.control = {n for n, p in enumerate(model.pieces) if p.type == kinds.CONTROL}
        self.unknown = next(n for n, p in enumerate(model.pieces) if p.type == kinds.UNKNOWN)
        self.surface = model.trainer_spec.unk_surface
        self.byte_ids = np.empty(256, np.int32)
        for n, b in self.byte_of.items():
            self.byte_ids[b] = n
        self._tables({p: model.pieces[n].score for p, n in self.ids.items()})

    def _tables(self, scores: dict[str, float]) -> None:
        # characters of longer pieces that are no pieces themselves take numbers behind the ids
        symbols = dict(self.ids)
        for p in self.ids:
            for c in p:
                symbols.setdefault(c, len(self.pieces) + len(symbols) - len(self.ids))
        level = {s: k for k, s in enumerate(sorted(set(scores.values()), reverse=True))}
        pairs: dict[int, tuple[int, int]] = {}
        for p, n in self.ids.items():
            for cut in range(1, len(p)):
                left, right = symbols.get(p[:cut]), symbols.get(p[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = level[scores[p]], n
        self.pairs = pairs
        self.keys = np.array(sorted(pairs), np.int64)
        self.rank_of, self.id_of = (np.array([pairs[k][i] for k in self.keys.tolist()], np.int32) for i in (0, 1))
        # single characters: a number by code point, -1 - code point for those of no piece
        self.single = np.full(0x110000, -1, np.int32)
        for c, n in symbols.items():
            if len(c) == 1:
                self.single[ord(c)] = n
        self.names = {n: c for c, n in symbols.items()}
        joined = {ord(a) << 32 | ord(b) for p in self.ids for a, b in zip(p, p[1:], strict=False)}
        self.joined = np.array(sorted(joined), np.int64)
        self.mark_ends = any(c != MARK and d == MARK for p in self.ids for c, d in zip(p, p[1:], strict=False))
        self.feed_free = not any("\n" in p for p in self.ids if len(p) > 1)
        self.words = re.compile(rf"\n|{MARK}*[^{MARK}\n]+|{MARK}+")

    def _lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged id) of pairs; _NONE where there is no such piece."""
        keys = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = (self.keys[at] == keys) & (left >= 0) & (right >= 0)
        return np.where(hit, self.rank_of[at], _NONE), np.where(hit, self.id_of[at], 0)

    def _symbols(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        own = self.single[points]
        return np.where(own >= 0, own, -1 - points).astype(np.int64)

    def _rounds(self, symbol: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbols, word) after all merges of words of these sizes that lie one after the other."""
        word = np.repeat(np.arange(len(size)), size)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        rank, merged = np.full(len(symbol), _NONE), np.zeros(len(symbol), np.int32)
        inner = np.flatnonzero(word[1:] == word[:-1])
        rank[inner], merged[inner] = self._lookup(symbol[inner], symbol[inner + 1])
        while len(symbol):
            first = np.flatnonzero(np.diff(word, prepend=-1))
            length = np.diff(first, append=len(symbol))
            least = np.minimum.reduceat(rank, first)
            if (idle := least == _NONE).any():
                out = np.repeat(idle, length)
                done.append((symbol[out], word[out]))
                symbol, word, rank, merged = symbol[~out], word[~out], rank[~out], merged[~out]
                if not len(symbol):
                    break
                length, least = length[~idle], least[~idle]
            at = np.flatnonzero(rank == np.repeat(least, length))
            at = at[np.flatnonzero(np.diff(word[at], prepend=-1))]  # the leftmost of each word
            symbol[at] = merged[at]
            kept = np.ones(len(symbol), bool)
            kept[at + 1] = False
            at -= np.arange(len(at))  # one symbol before it has gone for each earlier word
            symbol, word, rank, merged = symbol[kept], word[kept], rank[kept], merged[kept]
            for left in (at, at - 1):
                left = left[left >= 0]
                inside = left + 1 < len(symbol)
                inside[inside] = word[left[inside]] == word[left[inside] + 1]
                rank[left[~inside]] = _NONE
                left = left[inside]
                rank[left], merged[left] = self._lookup(symbol[left], symbol[left + 1])
        symbol, word = (np.concatenate(x) for x in zip(*done, strict=True)) if done else (symbol, word)
        order = np.argsort(word, kind="stable")
        return symbol[order], word[order]

    def _heap(self, symbol: np.ndarray) -> np.ndarray:
        """One long stretch: the same merges by a heap of (rank, place) over a linked list."""
        held, n, get = symbol.tolist(), len(symbol), self.pairs.get
        right, left, heap = list(range(1, n + 1)), list(range(-1, n - 1)), []

        def offer(i):
            if i >= 0 and right[i] < n and held[i] >= 0 and held[right[i]] >= 0 and (found := get(held[i] << 32 | held[right[i]])):
                heapq.heappush(heap, (found[0], i, held[i], held[right[i]], found[1]))

        for i in range(n - 1):
            offer(i)
        gone = bytearray(n)
        while heap:
            _, i, a, b, made = heapq.heappop(heap)
            j = right[i]
            if gone[i] or j >= n or held[i] != a or held[j] != b:
                continue
            held[i], gone[j], right[i] = made, 1, right[j]
            if right[i] < n:
                left[right[i]] = i
            offer(i)
            offer(left[i])
        return np.array([x for x, g in zip(held, gone, strict=True) if not g], np.int64)

    def _cut(self, symbol_text: str) -> list[str]:
        """A long stretch in parts, cut between characters that no piece joins."""
        parts, start, block = [], 0, 1 << 20
        for at in range(0, len(symbol_text), block):
            points = np.frombuffer(symbol_text[at : at + block + 1].encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
            keys = points[:-1] << 32 | points[1:]
            found = np.minimum(np.searchsorted(self.joined, keys), len(self.joined) - 1)
            for border in (np.flatnonzero(self.joined[found] != keys) + at + 1).tolist():
                parts.append(symbol_text[start:border])
                start = border
        return [*parts, symbol_text[start:]]

    def encode_words(self, words: list[str]) -> list[np.ndarray]:
        """The ids of each word; a word's spaces are marks."""
        flat, owner = [], []
        for n, w in enumerate(words):
            parts = self._cut(w) if len(w) > LONG else [w] if w else []
            flat += parts
            owner += [n] * len(parts)
        ids: list[list[np.ndarray]] = [[] for _ in words]
        start = 0
        while start < len(flat):
            end, room = start, SYMBOLS
            while end < len(flat) and len(flat[end]) <= LONG and (room := room - len(flat[end])) > 0:
                end += 1
            if end == start:
                made = [self._final(self._heap(self._symbols(flat[start])) if len(flat[start]) > LONG else self._rounds(self._symbols(flat[start]), np.array([len(flat[start])]))[0])]
                end = start + 1
            else:
                symbol, word = self._rounds(self._symbols("".join(flat[start:end])), np.fromiter(map(len, flat[start:end]), np.int64, end - start))
                made = self._finals(symbol, word, end - start)
            for n, x in zip(owner[start:end], made, strict=True):
                ids[n].append(x)
            start = end
        return [np.concatenate(x) if x else np.empty(0, np.int32) for x in ids]

    def _bytes(self, symbol: int) -> np.ndarray:
        char = self.names[symbol] if symbol >= 0 else chr(-1 - symbol)
        return self.byte_ids[np.frombuffer(char.encode(), np.uint8)]

    def _final(self, symbol: np.ndarray) -> np.ndarray:
        odd = (symbol < 0) | (symbol >= len(self.pieces))
        if not odd.any():
            return symbol.astype(np.int32)
        known = {s: self._bytes(s) for s in np.unique(symbol[odd]).tolist()}
        return np.concatenate([known[s] if s in known else np.array([s], np.int32) for s in symbol.tolist()])

    def _finals(self, symbol: np.ndarray, word: np.ndarray, n: int) -> list[np.ndarray]:
        edges = np.searchsorted(word, np.arange(n + 1))
        odd = set(word[(symbol < 0) | (symbol >= len(self.pieces))].tolist())
        plain = symbol.astype(np.int32)
        return [self._final(symbol[edges[k] : edges[k + 1]]) if k in odd else plain[edges[k] : edges[k + 1]] for k in range(n)]

    def split(self, text: str) -> list[str]:
        """The words of a text, with its spaces and the one put before it as marks."""
        if not text:
            return []
        whole = MARK + text.replace(" ", MARK)
        return [whole] if self.mark_ends or not self.feed_free else self.words.findall(whole)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [self.split(x) for x in texts]
        distinct = list(dict.fromkeys(w for words in split for w in words))
        known = dict(zip(distinct, self.encode_words(distinct), strict=True))
        return [np.concatenate([known[w] for w in words]) if words else np.empty(0, np.int32) for words in split]

    def raw(self, ids) -> bytes:
        """The bytes of ids that stand inside a text; bytes that are no UTF-8 stay as they are."""
        return b"".join(bytes([self.byte_of[n]]) if n in self.byte_of else b"" if n in self.control else self.surface.encode() if n == self.unknown else self.pieces[n].replace(MARK, " ").encode() for n in ids)

    def decode(self, ids) -> str:
        """The text of ids: runs of byte pieces as UTF-8, a wrong byte as U+FFFD, and the first mark left out."""
        out, run, bare = [], bytearray(), True
        for n in ids:
            if n in self.byte_of:
                run.append(self.byte_of[n])
                continue
            if run:
                out.append(_utf8(bytes(run)))
                run.clear()
            bare = bare and not any(out)
            if n == self.unknown:
                out.append(self.surface)
            elif n not in self.control:
                piece = self.pieces[n]
                if bare and piece.startswith(MARK):
                    piece, bare = piece[1:], False
                out.append(piece.replace(MARK, " "))
        return "".join(out) + _utf8(bytes(run))


def _utf8(raw: bytes) -> str:
    try:
        return raw.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(raw):
            for size in (1, 2, 3, 4):
                try:
                    out.append(raw[at : at + size].decode())
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                size = 1
            at += size
        return "".join(out)


class Words:
    """What a worker remembers of words: their ids as text and their bytes.

    A word that begins a line is kept with its line feed; any other stands for itself with a mark before it.
    """

    def __init__(self, pieces: Pieces):
        self.pieces, self.written, self.bytes = pieces, {}, {}
        self.plain = pieces.feed_free and not pieces.mark_ends

    def split(self, text: str) -> list[str] | None:
        """The words, or None where spaces or marks stand together."""
        if not self.plain or "  " in text or text[0] == " " or MARK in text:
            return None
        return text.replace("\n", " \n").split(" ")

    def learn(self, split: list) -> list[str]:
        """Remembers the words of these texts; returns the long ones, to be forgotten after use."""
        words = set().union(*split) if split else set()
        new = words.difference(self.written)
        if len(self.written) + len(new) > ROOM:
            self.written.clear()
            self.bytes.clear()
            new = words
        new = list(new)
        units, count = [], []
        for w in new:
            own = ["\n", w[1:]] if w[:1] == "\n" else [MARK + w]
            own = [x for x in own if x]
            units += own
            count.append(len(own))
        made = iter(self.pieces.encode_words(units))
        for w, n in zip(new, count, strict=True):
            ids = [x for _ in range(n) for x in next(made).tolist()]
            self.written[w] = ",".join(map(str, ids)) + ","
            self.bytes[w] = self.pieces.raw(ids)
        return [w for w in new if len(w) > LONG]

    def forget(self, words: list[str]) -> None:
        for w in words:
            self.written.pop(w, None)
            self.bytes.pop(w, None)


_words: dict[str, Words] = {}


def codec(model_file: str) -> Words:
    """One codec for each worker and model."""
    if model_file not in _words:
        _words[model_file] = Words(Pieces(model_file))
    return _words[model_file]


def encode(docs: DataFrame, model_file: str) -> DataFrame:
    """(doc_id, ids array<int>)."""
    arrow = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches):
        for ids, texts in slices(batches):
            yield batch(arrow, ids, codec(model_file).pieces.encode(texts))

    return id_text(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model_file: str) -> DataFrame:
    """(doc_id, decoded string) of (doc_id, ids); null ids decode to an empty text."""
    arrow = pa.schema([("doc_id", pa.int64()), ("decoded", pa.string())])

    def run(batches):
        for b in batches:
            yield batch(arrow, b.column(0), [codec(model_file).pieces.decode(x or ()) for x in b.column(1).to_pylist()])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded string")


def digests(docs: DataFrame, model_file: str) -> DataFrame:
    """Encodes and decodes every text, and keeps counts and digests of both results."""
    arrow = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches):
        words = codec(model_file)
        for ids, texts in slices(batches):
            split = [words.split(x) if x else [] for x in texts]
            long = words.learn([x for x in split if x])
            count, sha, back = [], [], []
            written, raw = words.written.__getitem__, words.bytes.__getitem__
            for own, text in zip(split, texts, strict=True):
                if own is None:
                    found = words.pieces.encode([text])[0].tolist()
                    line, decoded = ",".join(map(str, found)), words.pieces.decode(found).encode()
                else:
                    line, decoded = "".join(map(written, own))[:-1], b"".join(map(raw, own))[1:]
                    decoded = decoded if text else b""
                count.append(line.count(",") + 1 if line else 0)
                sha.append(hashlib.sha256(line.encode()).hexdigest())
                back.append(hashlib.sha256(decoded).hexdigest())
            words.forget(long)
            yield batch(arrow, ids, count, sha, back)

    return id_text(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
