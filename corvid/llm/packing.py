"""Packing: shortest-pack-first over the length histogram.

Documents become token runs that end with id 0, runs are cut every `capacity` tokens, and
the pieces are packed into sequences. The packing looks at the histogram of lengths alone:
lengths are placed longest first, each into the packs that are shortest at that moment, and
a pattern's count is split when fewer pieces than packs are left. The plan is a list of
(length, first rank, last rank, first sequence, offset); a piece finds its place by its rank
among the pieces of its length. Histogram and plan are bounded by the capacity (1024 lengths,
a few thousand plan rows), however many documents there are.

Null text: one id, the closing 0. An empty table gives no rows. Rows that repeat a doc_id
are packed each. A null doc_id is packed like any other.
"""

from __future__ import annotations

import heapq
import json
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Stash, Units, batch, id_text, slices

CAPACITY = 1024
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
_ARROW = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")])
_encoders: dict[str, Units] = {}


def ranks_of(vocabulary: str) -> dict[bytes, int]:
    """The vocabulary file's tokens as bytes; its file writes bytes as visible characters."""
    with open(vocabulary, encoding="utf-8") as f:
        parsed = json.load(f)
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    byte = {chr(b): b for b in visible} | {chr(256 + n): b for n, b in enumerate(hidden)}
    special = {t["content"] for t in parsed["added_tokens"]}
    return {bytes(byte[c] for c in token): n for token, n in parsed["model"]["vocab"].items() if token not in special}


def encoder(vocabulary: str, pattern: str) -> Units:
    """Cached word -> little-endian uint32 ids.

    The ids are those of the tokenizers library for this file, with special tokens' strings
    taken as ordinary text (a test compares both); tiktoken finds them from the same file in
    a quarter of the time. Missing words are encoded as lines of one text.
    """
    if vocabulary not in _encoders:
        import tiktoken

        t = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks_of(vocabulary), special_tokens={})
        feed = t.encode_ordinary("\n")[0]

        def solve(strings: list[str]) -> list[bytes]:
            if len(strings) == 1:
                return [np.array(t.encode_ordinary(strings[0]), "<u4").tobytes()]
            out: list[bytes] = []
            for n in range(0, len(strings), 4096):
                ids = np.array(t.encode_ordinary("\n".join([*strings[n : n + 4096], "x"])), "<u4")
                ends = np.flatnonzero(ids == feed)
                raw, starts = ids.tobytes(), np.concatenate([[0], ends[:-1] + 1])
                out += [raw[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            return out

        _encoders[vocabulary] = Units(solve, 600_000)
    return _encoders[vocabulary]


def token_runs(batches, vocabulary: str, pattern: str):
    """(ids, list of token runs as bytes) for each slice; a run ends with id 0."""
    units = encoder(vocabulary, pattern)
    for ids, texts in slices(batches):
        split = [units.split(x) for x in texts]
        units.learn([x for x in split if x])
        yield ids, [b"".join(units.values(s) if s is not None else units.solve([x])) + b"\0\0\0\0" for s, x in zip(split, texts, strict=True)]


def token_pieces(docs: DataFrame, vocabulary: str, pattern: str, capacity: int = CAPACITY) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens."""

    def cut(batches):
        for ids, runs in token_runs(batches, vocabulary, pattern):
            at, start, length, crc, total = [], [], [], [], []
            for n, run in enumerate(runs):
                tokens = len(run) // 4
                for s in range(0, tokens, capacity):
                    piece = run[4 * s : 4 * (s + capacity)]
                    at.append(n)
                    start.append(s)
                    length.append(len(piece) // 4)
                    crc.append(zlib.crc32(piece))
                    total.append(tokens)
            yield batch(_ARROW, ids.take(pa.array(at, pa.int32())), start, length, crc, total)

    return docs.mapInArrow(cut, PIECES)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Rows (length, first rank, rank after the last, first sequence, offset) that place all pieces.

    Every group of packs with the same pattern is a range of sequence ids with one fill.
    """
    packs: dict[int, list[tuple[int, int]]] = {}  # room left -> ranges of sequences
    rooms: list[int] = []  # heap of -room
    out, sequences = [], 0
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            while rooms and not packs.get(-rooms[0]):
                packs.pop(-heapq.heappop(rooms), None)
            room = -rooms[0] if rooms else 0
            if room >= length:
                first, end = packs[room].pop()
                n = min(left, end - first)
                if first + n < end:
                    packs[room].append((first + n, end))
            else:
                room, first, n = capacity, sequences, left
                sequences += n
            out.append((length, rank, rank + n, first, capacity - room))
            rank, left, rest = rank + n, left - n, room - length
            if rest:
                if rest not in packs:
                    packs[rest] = []
                    heapq.heappush(rooms, -rest)
                packs[rest].append((first, first + n))
    return out


def place(pieces: DataFrame, capacity: int = CAPACITY, rows_per_rank_task: int = 200_000) -> DataFrame:
    """Adds sequence_id and offset to a written table of pieces.

    Ranks are found without bringing a length together: pieces are ranked within (length,
    salt), and the counts of the salts, a few numbers for each length, give the offsets. The
    salts follow the largest count, so a task ranks about rows_per_rank_task pieces.
    """
    spark = pieces.sparkSession
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    slots = spark.createDataFrame(plan(histogram, capacity) or [(0, 0, 0, 0, 0)], "slot_length long, rank_from long, rank_to long, first_sequence long, offset long")
    salts = max(256, max(histogram.values(), default=0) // rows_per_rank_task)
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start"), F.lit(salts)))
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    ranked = salted.withColumn("within", F.row_number().over(order) - 1)
    counts = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    placed = ranked.join(offsets, ["length", "salt"]).withColumn("rank", F.col("within") + F.col("ahead"))
    hit = (F.col("length") == F.col("slot_length")) & (F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_to"))
    return placed.join(F.broadcast(slots), hit).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("first_sequence") + F.col("rank") - F.col("rank_from")).alias("sequence_id"), "offset")


def pack(docs: DataFrame, vocabulary: str, pattern: str, capacity: int = CAPACITY) -> DataFrame:
    """Documents (doc_id, text) as packed pieces."""
    stash = Stash(docs.sparkSession, "packing")
    return place(stash.keep(token_pieces(id_text(docs), vocabulary, pattern, capacity), "pieces"), capacity)
