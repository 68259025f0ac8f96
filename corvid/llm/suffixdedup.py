"""Suffix-array dedup by column-wise multi-document construction.

A collection of strings is sorted by inserting one symbol of every string each round, from
the last column to the first: Collection keeps the Burrows-Wheeler transform of all suffixes
inserted so far and the common prefixes of neighbours in files that every round reads and
writes once from front to back, one pile for each first symbol. At the end the whole strings
stand in order, with the common prefix of each with its neighbour.

A corpus is far too long for rounds over whole documents, so it is cut where matches can be
compared locally. Of every 100-byte window the 32-byte gram with the smallest hash is its
anchor; equal windows have equal anchors at equal distances. Anchors that occur once can't lie
in a repeat and are dropped. For the others the 68 bytes before and after the gram are the
strings of two collections (the left one reversed) for a shard of anchors: the window that
starts x bytes before the gram repeats an earlier one exactly if an earlier string shares x
symbols on the left and 68 - x on the right, which the common prefixes tell for every x. The
symbols are bytes, so a collection takes 68 rounds.

A task merges equal contexts before it sends them, so a passage in a third of all documents is
sent once by each task. Later copies of a whole text are found by its hash and need no search.

Matches never cross documents; a byte goes if a 100-byte string that covers it starts earlier
too (smaller doc_id, or the same document and an earlier start), judged on the input. Null or
empty text: nothing to remove. A null id takes no part and loses nothing. Rows that repeat an
id and its text are one document, and each gets its result; rows that repeat an id with another
text are judged together as one document's texts, and a range found in one is cut from both.
Ties: of equal strings of one document the one that starts first stays. An empty table gives an
empty result. A text of any length is held whole by one task, with its anchors. With
keep_columns, further columns come back as they are, whatever their names.
"""

from __future__ import annotations

import hashlib
import os
import tempfile

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stash, batch, fresh, hash64, id_text, powers, row_slices, slices
from .exchange import MOST_PARTITIONS, by_part, deal, parts, per_part, repeated

MATCH = 100
GRAM = 32
SPAN = MATCH - GRAM  # bytes, and symbols, of context on either side
#: Strings of one collection, and contexts that a task holds to merge equal ones.
STRINGS, HOLD = 8_192, 200_000
#: Tasks that share the copies of one text.
SALTS = 16

def grams(text: np.ndarray) -> np.ndarray:
    """A mixed 64-bit hash of the gram at each position."""
    n = len(text)
    up, down = powers(n)
    total = np.concatenate([[np.uint64(0)], np.cumsum((text.astype(np.uint64) + np.uint64(1)) * down[:n])])
    return hash64((total[GRAM:] - total[:-GRAM]) * up[: n - GRAM + 1])


def anchors(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, position, first window, last window) of each anchor: the leftmost smallest gram of each window."""
    low = h = grams(text)
    at, width, w = np.arange(len(h), dtype=np.int32), 1, SPAN + 1
    while width < w:  # smallest of 2, 4, ... and at last w neighbours; the left one of equals
        step = min(width, w - width)
        left = low[:-step] <= low[step:]
        at, low = np.where(left, at[:-step], at[step:]), np.where(left, low[:-step], low[step:])
        width += step
    cut = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    ends = np.concatenate([cut[1:], [len(at)]]) - 1
    where = at[cut].astype(np.int64)
    return h[where], where, cut, ends


def _least(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The least of values[first .. last] for each range; first <= last."""
    ranges = np.stack([first, last + 1], 1).ravel()
    return np.minimum.reduceat(np.append(values, values.dtype.type(255)), ranges)[::2]


class Collection:
    """Column-wise Burrows-Wheeler transform and common prefixes of equally long byte strings.

    bwt: the symbol before each suffix inserted so far; lcp: the symbols it shares with the
    suffix before it. Both stand in files in the order of the suffixes; a round reads and
    writes each once. The empty suffixes come first, in the strings' order.
    """

    def __init__(self, folder: str):
        self.folder, self.turn, self.files = folder, 0, ()

    def _write(self, *arrays: np.ndarray) -> None:
        """New files each round; the old ones go unflushed, where rewriting them would wait for the disk."""
        old, self.turn = self.files, self.turn + 1
        self.files = tuple(os.path.join(self.folder, f"{kind}{self.turn}") for kind in ("bwt", "lcp"))
        for name, x in zip(self.files, arrays, strict=True):
            x.tofile(name)
        for name in old:
            os.remove(name)

    def build(self, strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(order, lcp): the strings [string, column] in order, and what each shares with the one before."""
        n, length = strings.shape
        newest = np.arange(n)  # place of each string's newest suffix
        self._write(strings[:, -1], np.zeros(n, np.uint8))
        for column in range(length - 1, -1, -1):
            newest = self._round(n, strings[:, column - 1] if column else np.zeros(n, np.uint8), newest)
        order = np.argsort(newest)
        shared = np.zeros(n, np.uint8)
        if n > 1:
            shared[1:] = _least(np.fromfile(self.files[1], np.uint8), newest[order][:-1] + 1, newest[order][1:])
        for name in self.files:
            os.remove(name)
        return order, shared

    def _round(self, n: int, before: np.ndarray, newest: np.ndarray) -> np.ndarray:
        """Puts before every newest suffix the symbol that the transform holds for it.

        Extended suffixes stand, behind the n empty ones, in the order of their first symbol
        and then of what follows it: that is the stable order of the transform's symbols.
        """
        bwt, lcp = (np.fromfile(name, np.uint8) for name in self.files)
        source = np.argsort(bwt, kind="stable")
        place = np.empty(len(bwt), np.int64)
        place[source] = np.arange(n, n + len(bwt))
        new = place[newest]
        stays = np.ones(len(bwt) + n, bool)
        stays[new] = False
        bwt_out, lcp_out = np.empty(len(stays), np.uint8), np.empty(len(stays), np.uint8)
        bwt_out[stays], lcp_out[stays] = bwt, lcp
        bwt_out[new] = before
        # a new suffix and the one after it have new neighbours
        touched = np.zeros(len(stays) + 1, bool)
        touched[new] = touched[new + 1] = True
        at = np.flatnonzero(touched[:-1])
        own, other = source[at - n], source[np.maximum(at - n - 1, 0)]
        alike = (at > n) & (bwt[own] == bwt[other])
        lcp_out[at] = 0
        if alike.any():
            lcp_out[at[alike]] = 1 + _least(lcp, other[alike] + 1, own[alike])
        self._write(bwt_out, lcp_out)
        return new


def earlier(group: np.ndarray, left: np.ndarray, right: np.ndarray, low: np.ndarray, high: np.ndarray, folder: str) -> np.ndarray:
    """[string, x]: whether the window x bytes before the gram repeats that of a string above it.

    Strings of a group share their gram and come in order of (doc_id, position); each owns
    the windows low .. high.
    """
    n, turn = len(group), np.arange(len(group))
    classes = []
    for strings in (left, right):  # each distinct string is inserted once
        rows = np.ascontiguousarray(strings).view([("all", f"V{strings.shape[1]}")]).ravel()
        _, first, of = np.unique(rows, return_index=True, return_inverse=True)
        order, shared = Collection(folder).build(strings[first])
        classes.append((order, shared, of))
    out = np.zeros((n, SPAN + 1), bool)
    ids = [turn, turn]
    for x in range(SPAN + 1):
        own = (low <= x) & (x <= high)
        if not own.any():
            continue
        for k, ((order, shared, of), depth) in enumerate(zip(classes, (x, SPAN - x), strict=True)):
            level = np.empty(len(order), np.int64)
            level[order] = np.cumsum(shared < depth)
            ids[k] = level[of]
        some = turn[own]
        key = np.lexsort((some, ids[1][some], ids[0][some], group[some]))
        same = np.ones(max(0, len(key) - 1), bool)
        for values in (group, *ids):
            same &= values[some[key[1:]]] == values[some[key[:-1]]]
        out[some[key[1:]][same], x] = True
    return out


def first_texts(docs: DataFrame, stash: Stash) -> DataFrame:
    """(copy_id) of documents whose whole text a smaller doc_id has, from 128-bit hashes alone."""
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.binary())])

    def run(batches):
        for ids, texts in slices(batches):
            yield batch(schema, ids, [xxhash.xxh3_128_digest(x.encode("utf-8", "replace")) for x in texts])

    # shorter texts can't repeat a window; a text of a third of all documents is met by SALTS tasks
    keys = stash.keep(docs.where(F.octet_length("text") >= MATCH).mapInArrow(run, "doc_id long, key binary"), "keys")
    first = keys.groupBy("key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    first = first.select("key", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = keys.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    return stash.keep(salted.join(first, ["key", "salt"]).where("doc_id > first").select(F.col("doc_id").alias("copy_id")).dropDuplicates(), "copies")


def repeated_anchors(docs: DataFrame, n_parts: int) -> DataFrame:
    """(doc_id, place) of anchors whose hash occurs elsewhere too.

    A task deals a text once, for its smallest doc_id there; rows of one document that lie in
    different tasks meet here and count once.
    """
    sent = pa.schema([("part", pa.int32()), ("hashes", pa.binary()), ("docs", pa.binary()), ("places", pa.binary())])
    schema = pa.schema([("doc_id", pa.int64()), ("place", pa.int32())])

    def send(batches):
        held: dict[bytes, list] = {}
        size = 0

        def flush():
            h = np.concatenate([x[1] for x in held.values()])
            owner = np.concatenate([np.full(len(x[1]), x[0], np.int64) for x in held.values()])
            place = np.concatenate([x[2] for x in held.values()])
            for p, at in deal(h, n_parts):
                yield batch(sent, [p], [h[at].tobytes()], [owner[at].tobytes()], [place[at].tobytes()])
            held.clear()

        for ids, texts in slices(batches):
            for key, x in zip(ids.to_pylist(), texts, strict=True):
                raw = x.encode("utf-8", "replace")
                if len(raw) < MATCH:
                    continue
                c = xxhash.xxh3_128_digest(raw)
                if c in held:
                    held[c][0] = min(held[c][0], key)
                    continue
                h, at, _, _ = anchors(np.frombuffer(raw, np.uint8))
                held[c] = [key, h, at.astype(np.int32)]
                size += len(h)
            if size > 2_000_000:
                size = 0
                yield from flush()
        if held:
            yield from flush()

    def meet(batches):
        for _, rows in per_part(batches):
            columns: list[list] = [[], [], []]
            for b in rows:
                for k, kind in enumerate((np.uint64, np.int64, np.int32)):
                    columns[k] += [np.frombuffer(x, kind) for x in b.column(k + 1).to_pylist()]
            h, owner, place = map(np.concatenate, columns)
            order = np.argsort(h, kind="stable")
            some = order[repeated(h[order])]
            some = some[np.lexsort((place[some], owner[some], h[some]))]
            same = np.ones(max(0, len(some) - 1), bool)
            for x in (h, owner, place):
                same &= x[some[1:]] == x[some[:-1]]
            if same.any():
                some = some[np.concatenate([[True], ~same])]
                some = some[repeated(h[some])]
            for k in range(0, len(some), 200_000):
                at = some[k : k + 200_000]
                yield batch(schema, owner[at], place[at])

    return by_part(docs.mapInArrow(send, "part int, hashes binary, docs binary, places binary"), n_parts).mapInArrow(meet, "doc_id long, place int")


_CONTEXT = pa.schema([("gram", pa.int64()), ("context", pa.binary()), ("low", pa.int32()), ("high", pa.int32()), ("doc_id", pa.int64()), ("place", pa.int64()), ("end", pa.int64())])
CONTEXT = "gram long, context binary, low int, high int, doc_id long, place long, end long"


def _places(lists: list) -> np.ndarray:
    """Places as numbers, or packed as int32."""
    return np.frombuffer(b"".join(lists), np.int32) if isinstance(lists[0], (bytes, bytearray)) else np.asarray(lists, np.int32)


def contexts(joined: DataFrame) -> DataFrame:
    """Contexts of repeated anchors (end null), equal ones of a task as their first, and the marks
    (context null; place to end) of those that were merged away. joined: doc_id, text, lists."""

    def run(batches):
        held: dict[tuple, tuple] = {}
        marks: list[tuple] = []

        def flush():
            if held:
                keys, values = list(held), list(held.values())
                yield batch(_CONTEXT, [k[0] for k in keys], [k[1] for k in keys], [k[2] for k in keys], [k[3] for k in keys], [v[0] for v in values], [v[1] for v in values], [None] * len(keys))
                held.clear()
            if marks:
                # marks of a document in order, joined where they overlap
                out: list[list] = []
                for d, a, b in sorted(marks):
                    if out and out[-1][0] == d and a <= out[-1][2]:
                        out[-1][2] = max(out[-1][2], b)
                    else:
                        out.append([d, a, b])
                marks.clear()
                yield batch(_CONTEXT, [m[0] * 31 + m[1] for m in out], [None] * len(out), [0] * len(out), [0] * len(out), *map(list, zip(*out, strict=True)))

        for b in batches:
            done = 0
            for ids, texts in slices([b]):
                for key, x, lists in zip(ids.to_pylist(), texts, b.column(2).slice(done, len(texts)).to_pylist(), strict=True):
                    raw = x.encode("utf-8", "replace")
                    if not lists or len(raw) < MATCH:
                        continue
                    h, at, first, last = anchors(np.frombuffer(raw, np.uint8))
                    chosen = np.isin(at, _places(lists))
                    wide = bytes(SPAN) + raw + bytes(SPAN)
                    for g, a, p, q in zip(h[chosen].view(np.int64).tolist(), at[chosen].tolist(), first[chosen].tolist(), last[chosen].tolist(), strict=True):
                        entry = g, wide[a : a + 2 * SPAN + GRAM], a - q, a - p
                        old = held.get(entry)
                        if old is None:
                            held[entry] = key, a
                        elif old != (key, a):
                            if (key, a) < old:
                                held[entry] = key, a
                                marks.append((old[0], old[1] - entry[3], old[1] - entry[2] + MATCH))
                            else:
                                marks.append((key, p, q + MATCH))
                done += len(texts)
                if len(held) + len(marks) > HOLD:
                    yield from flush()
        yield from flush()

    return joined.select("doc_id", "text", "lists").mapInArrow(run, CONTEXT)


_MARK = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])


def marks(found: DataFrame, n_parts: int) -> DataFrame:
    """(doc_id, start, end) of bytes to remove, from contexts dealt by their gram."""
    dealt = found.repartition(min(n_parts, MOST_PARTITIONS), "gram").sortWithinPartitions("gram", "doc_id", "place")

    def shard(rows: list[tuple], folder: str):
        gram = np.array([r[0] for r in rows])
        whole = np.frombuffer(b"".join(r[1] for r in rows), np.uint8).reshape(len(rows), -1)
        low, high = np.array([r[2] for r in rows]), np.array([r[3] for r in rows])
        seen = earlier(gram, whole[:, SPAN - 1 :: -1] if SPAN else whole, whole[:, SPAN + GRAM :], low, high, folder)
        # runs of windows of each string as byte ranges; x falls as the start rises
        starts = seen[:, ::-1]
        edge = np.diff(np.pad(starts, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        (row, a), (_, b) = np.nonzero(edge == 1), np.nonzero(edge == -1)
        doc, place = np.array([r[4] for r in rows]), np.array([r[5] for r in rows])
        return doc[row], place[row] - SPAN + a, place[row] - SPAN + b - 1 + MATCH

    def run(batches):
        with tempfile.TemporaryDirectory() as folder:
            held: list[tuple] = []
            for b in batches:
                ready = b.column(1).is_valid()
                gone = b.filter(ready.cast(pa.int8()).to_numpy(zero_copy_only=False) == 0) if b.num_rows else b
                if gone.num_rows:
                    yield batch(_MARK, gone.column(4), gone.column(5), gone.column(6))
                for row in zip(*(c.to_pylist() for c in b.filter(ready).columns), strict=True):
                    if held and (held[-1][0], *held[-1][4:6]) == (row[0], *row[4:6]):
                        continue  # the same place of the same document, from a row in another task
                    if len(held) >= STRINGS and held[-1][0] != row[0]:
                        yield batch(_MARK, *shard(_paired(held), folder))
                        held = []
                    held.append(row)
            if held:
                yield batch(_MARK, *shard(_paired(held), folder))

    return dealt.mapInArrow(run, "doc_id long, start long, end long")


def _paired(rows: list[tuple]) -> list[tuple]:
    """Rows whose gram has another row; the rest can't repeat anything. At least one row stays."""
    out = [r for k, r in enumerate(rows) if (k and rows[k - 1][0] == r[0]) or (k + 1 < len(rows) and rows[k + 1][0] == r[0])]
    return out or rows[:1]


OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _cut(raw: bytes, is_copy: bool, starts, ends) -> tuple[bytes, int, int]:
    """(kept bytes, removed, runs)."""
    if len(raw) < MATCH:
        return raw, 0, 0
    if is_copy:
        return b"", len(raw), 1
    if not starts:
        return raw, 0, 0
    order = np.argsort(starts, kind="stable")
    s, e = np.asarray(starts)[order], np.maximum.accumulate(np.asarray(ends)[order])
    head = np.concatenate([[True], s[1:] > e[:-1]])
    s, e = s[head], np.append(e[np.flatnonzero(head)[1:] - 1], e[-1])
    kept, at = [], 0
    for a, b in zip(s.tolist(), e.tolist(), strict=True):
        kept.append(raw[at:a])
        at = b
    kept.append(raw[at:])
    return b"".join(kept), int((e - s).sum()), len(s)


def removals(docs: DataFrame, stash: Stash) -> tuple[DataFrame, DataFrame]:
    """(copies, ranges): the ids of whole copies, and lists of byte ranges for other documents."""
    base = id_text(docs).where(F.col("doc_id").isNotNull())
    copies = first_texts(base, stash)
    size = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_parts = parts(docs.sparkSession, 2 * size // (SPAN + 2), 500_000)
    # a copy is a row without a place: one aggregation gathers the lists and finds the copies, without a join below it
    copied = copies.select(F.col("copy_id").alias("doc_id"), F.lit(None).cast("int").alias("place"))
    places = repeated_anchors(base, n_parts).unionByName(copied).groupBy("doc_id").agg(F.collect_list("place").alias("lists"), F.count_if(F.col("place").isNull()).alias("copied"))
    lists = stash.keep(places.where("copied = 0").select("doc_id", "lists"), "places")
    found = contexts(base.join(lists, "doc_id"))
    ranges = marks(found, n_parts).groupBy("doc_id").agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends"))
    return copies, stash.keep(ranges.select(F.col("doc_id").alias("range_id"), "starts", "ends"), "ranges")


def dedup(docs: DataFrame, keep_columns: bool = False) -> DataFrame:
    """Counts and digest of each document without its repeats; or, with keep_columns, the documents
    themselves. Bytes that the cuts leave of a split character are dropped from such a text."""
    copies, ranges = removals(docs, Stash(docs.sparkSession, "suffixes"))
    source = docs if keep_columns else id_text(docs)
    names, text = source.columns, source.columns.index("text")
    range_id, copy_id, whole = (fresh(source, x) for x in ("range_id", "copy_id", "whole_copy"))
    starts, ends = fresh(source, "starts"), fresh(source, "ends")
    ranges = ranges.select(F.col("range_id").alias(range_id), F.col("starts").alias(starts), F.col("ends").alias(ends))
    flagged = copies.select(F.col("copy_id").alias(copy_id), F.lit(True).alias(whole))
    key = F.col("doc_id").cast("long")
    joined = source.join(ranges, key == F.col(range_id), "left").join(flagged, key == F.col(copy_id), "left").select(*names, starts, ends, whole)
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])

    def digests(batches):
        for b in batches:
            done = 0
            for ids, texts in slices([b]):
                more = [c.slice(done, len(texts)).to_pylist() for c in b.columns[2:]]
                done += len(texts)
                raws = [x.encode("utf-8", "replace") for x in texts]
                cut = [_cut(x, bool(w), s, e) for x, s, e, w in zip(raws, *more, strict=True)]
                yield batch(schema, ids, list(map(len, raws)), [c[1] for c in cut], [c[2] for c in cut], [hashlib.sha256(c[0]).hexdigest() for c in cut])

    def rewritten(batches):
        for b in row_slices(batches, text):
            starts, ends, whole = (c.to_pylist() for c in b.columns[-3:])
            out = []
            for x, s, e, w in zip(b.column(text).to_pylist(), starts, ends, whole, strict=True):
                out.append(x if x is None or not (s or w) else _cut(x.encode("utf-8", "replace"), bool(w), s, e)[0].decode("utf-8", "ignore"))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()) if n == text else c for n, c in enumerate(b.columns[:-3])], names=names)

    return joined.mapInArrow(rewritten, docs.schema) if keep_columns else joined.mapInArrow(digests, OUT)
