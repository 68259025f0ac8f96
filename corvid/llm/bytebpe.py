"""Byte-level BPE encoding and decoding by length-bucketed padded numpy matrices.

Pieces of the pre-tokenising pattern are rows of a matrix of ids, padded to their bucket's
width. In every round each row merges its leftmost pair of minimum rank; the ranks of pairs
come from a hash table that is looked up for whole matrices, rows are closed up after a
merge, and rows without a pair leave the matrix. A row wider than the widest bucket (one
word of thousands of bytes) is merged by the same rule over a linked list and a heap, as the
matrix would cost the square of its width.

Null and empty texts have no ids; decoding them gives empty bytes. Rows that repeat a doc_id
and null ids are encoded like any other.
"""

from __future__ import annotations

import base64
import hashlib
import heapq

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import Units, batch, id_text, slices

#: White space as the rank files' own library sees it; `regex` adds U+001C to U+001F to \s.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WIDTHS = (4, 8, 16, 32, 64, 128, 256)
_NONE = np.int32(2**31 - 1)


def explicit(pattern: str) -> str:
    """The pattern with its white-space classes spelled out."""
    return pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\s", f"[{SPACE}]").replace(r"\S", f"[^{SPACE}]")


class PairTable:
    """(left id, right id) -> id of the merged token, in open addressing over arrays."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs: dict[int, int] = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.pairs = pairs
        keys = np.fromiter(pairs, np.uint64, len(pairs))
        values = np.fromiter(pairs.values(), np.int32, len(pairs))
        self.shift = np.uint64(64 - max(4, int(np.ceil(np.log2(max(1, len(keys)) * 4)))))
        size = 1 << (64 - int(self.shift))
        self.keys = np.full(size, np.uint64(2**64 - 1))
        self.values = np.full(size, _NONE)
        at, self.probes = self._slot(keys), 0
        while len(keys):
            self.probes += 1
            free = self.keys[at] == np.uint64(2**64 - 1)
            _, one = np.unique(at, return_index=True)
            chosen = np.zeros(len(keys), bool)
            chosen[one] = True
            chosen &= free
            self.keys[at[chosen]], self.values[at[chosen]] = keys[chosen], values[chosen]
            keys, values, at = keys[~chosen], values[~chosen], (at[~chosen] + 1) % size

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merged id of each pair, or _NONE; ids below 0 are padding."""
        out = np.full(left.shape, _NONE)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        keys = left.ravel()[todo].astype(np.uint64) << np.uint64(32) | right.ravel()[todo].astype(np.uint64)
        at = self._slot(keys)
        flat = out.reshape(-1)
        for _ in range(self.probes):
            if not len(todo):
                break
            held = self.keys[at]
            hit = held == keys
            flat[todo[hit]] = self.values[at[hit]]
            on = ~hit & (held != np.uint64(2**64 - 1))
            todo, keys, at = todo[on], keys[on], (at[on] + 1) % len(self.keys)
        return out


class ByteBPE:
    """Encoder and decoder of one rank file."""

    def __init__(self, rank_file: str, pattern: str):
        with open(rank_file, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.tokens = {v: k for k, v in self.ranks.items()}
        self.pattern = regex.compile(explicit(pattern))
        self.pairs = PairTable(self.ranks)
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)

    def _matrix(self, pieces: list[bytes], width: int) -> list[np.ndarray]:
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ids = np.full((len(pieces), width), np.int32(-1))
        ids[np.arange(width) < lengths[:, None]] = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        out: list[np.ndarray | None] = [None] * len(pieces)
        rows, cols = np.arange(len(pieces)), np.arange(width)
        ranks = np.full((len(pieces), width), _NONE)
        ranks[:, :-1] = self.pairs.rank(ids[:, :-1], ids[:, 1:])
        while len(rows):
            best = ranks.argmin(axis=1)  # the first of equal ones: the leftmost
            low = ranks[np.arange(len(rows)), best]
            done = low == _NONE
            if done.any():
                for n in np.flatnonzero(done):
                    out[rows[n]] = ids[n][ids[n] >= 0]
                on = ~done
                rows, ids, ranks, best, low = rows[on], ids[on], ranks[on], best[on], low[on]
                if not len(rows):
                    break
            here = np.arange(len(rows))
            take = np.minimum(cols + (cols > best[:, None]), width - 1)
            ids, ranks = np.take_along_axis(ids, take, 1), np.take_along_axis(ranks, take, 1)
            ids[:, -1], ranks[:, -1] = -1, _NONE
            ids[here, best] = low
            after = np.minimum(best + 1, width - 1)
            ranks[here, best] = self.pairs.rank(ids[here, best], np.where(best + 1 < width, ids[here, after], -1))
            before = np.maximum(best - 1, 0)
            inner = best > 0
            ranks[here[inner], before[inner]] = self.pairs.rank(ids[here[inner], before[inner]], ids[here[inner], best[inner]])
        return out

    def _long(self, piece: bytes) -> np.ndarray:
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        n, pairs = len(ids), self.pairs.pairs
        after, before, version = list(range(1, n + 1)), list(range(-1, n - 1)), [0] * n
        heap = [(r, i, 0) for i in range(n - 1) if (r := pairs.get(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, seen = heapq.heappop(heap)
            if version[i] != seen or ids[i] < 0:
                continue
            j = after[i]
            ids[i], ids[j], after[i] = rank, -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            for k in (i, before[i]):
                if k >= 0:
                    version[k] += 1
                    if after[k] < n and (r := pairs.get(ids[k] << 32 | ids[after[k]])) is not None:
                        heapq.heappush(heap, (r, k, version[k]))
        return np.array([x for x in ids if x >= 0], np.int32)

    def merge(self, pieces: list[bytes]) -> list[np.ndarray]:
        """The ids of each piece."""
        out: list[np.ndarray | None] = [None] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for n, p in enumerate(pieces):
            buckets.setdefault(next((w for w in WIDTHS if len(p) <= w), 0), []).append(n)
        for width, members in buckets.items():
            step = max(1, (1 << 18) // width) if width else len(members)
            for k in range(0, len(members), step):
                some = members[k : k + step]
                done = self._matrix([pieces[n] for n in some], width) if width else [self._long(pieces[n]) for n in some]
                for n, x in zip(some, done, strict=True):
                    out[n] = x
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text; each distinct piece is merged once."""
        split = [[p.encode() for p in self.pattern.findall(x)] for x in texts]
        distinct = list(dict.fromkeys(p for pieces in split for p in pieces))
        known = dict(zip(distinct, self.merge(distinct), strict=True))
        return [np.concatenate([known[p] for p in pieces]) if pieces else np.empty(0, np.int32) for pieces in split]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


_codecs: dict[tuple, tuple[ByteBPE, Units]] = {}


def codec(rank_file: str, pattern: str) -> tuple[ByteBPE, Units]:
    """One codec for each worker, with its cache of words -> (ids, ids as text, decoded bytes)."""
    key = rank_file, pattern
    if key not in _codecs:
        bpe = ByteBPE(rank_file, pattern)

        def solve(strings: list[str]) -> list[tuple]:
            out = []
            for n in range(0, len(strings), 8192):
                for ids in bpe.encode(strings[n : n + 8192]):
                    ids = ids.tolist()
                    out.append((len(ids), " ".join(map(str, ids)), bpe.decode(ids)))
            return out

        _codecs[key] = bpe, Units(solve, 500_000)
    return _codecs[key]


def encode(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """(doc_id, ids array<int>)."""
    arrow = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches):
        bpe, _ = codec(rank_file, pattern)
        for ids, texts in slices(batches):
            yield batch(arrow, ids, bpe.encode(texts))

    return id_text(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """(doc_id, decoded binary) of (doc_id, ids); null ids decode to empty bytes."""
    arrow = pa.schema([("doc_id", pa.int64()), ("decoded", pa.binary())])

    def run(batches):
        bpe, _ = codec(rank_file, pattern)
        for b in batches:
            yield batch(arrow, b.column(0), [bpe.decode(x or ()) for x in b.column(1).to_pylist()])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")


DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def digests(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """Encodes and decodes every text, and keeps counts and digests of both results."""
    arrow = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches):
        _, units = codec(rank_file, pattern)
        for ids, texts in slices(batches):
            split = [units.split(x) for x in texts]
            units.learn([x for x in split if x])
            count, sha, back = [], [], []
            for s, x in zip(split, texts, strict=True):
                values = units.values(s) if s is not None else units.solve([x])
                n, written, raw = zip(*values, strict=True) if values else ((), (), ())
                count.append(sum(n))
                sha.append(hashlib.sha256(" ".join(written).encode()).hexdigest())
                back.append(hashlib.sha256(b"".join(raw)).hexdigest())
            yield batch(arrow, ids, count, sha, back)

    return id_text(docs).mapInArrow(run, DIGEST)
