"""LM scoring: stupid-backoff scores, computed relationally.

Three relations: groups of documents with their words (a few hundred kilobytes a row), the
n-gram count tables partitioned by hash, and the exploded n-grams of the groups, each distinct
one with its group's count. The n-grams meet the count tables in their hash partition, the
counts go back to their group, and every document's score is summed there. N-grams travel as
sorted arrays of hashes (see exchange.py), pre-aggregated for each group; all arrays are written
as compressed byte planes, hashes as their differences. They travel in PASSES passes, each over
its share of the hashes and with its answers written, so that the disk holds one pass's shuffle.

score = sum over words of log S, where S = c(context word) / c(context) for the longest context
(up to ORDER - 1 words, within the document) with c(context word) >= CUTOFF, times BACKOFF for
each shorter step, and at last c(word) / N. Counts cover all documents. As every n-gram of a
document is in the corpus, those that are seen once count as unseen.

Words are runs of bytes other than the six ASCII blanks, with A-Z lower-cased. Null or empty
text: no words, score 0, mean null. Rows that repeat an id, and null ids, count and are scored
like any other. An empty table gives an empty result; a text of any length is a group of its
own, held by one task. Further columns are not read.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stash, batch, hash64, id_text, slices, word_hashes
from .exchange import by_part, deal, parts, per_part

ORDER = 3
BACKOFF = 0.4
CUTOFF = 2
GROUP_BYTES = 6 << 20
#: Passes over the groups, each for the hashes with its remainder.
PASSES = 2

_GROUP = pa.schema([("group", pa.string()), ("tokens", pa.int64()), ("docs", pa.list_(pa.int64())), ("sizes", pa.binary()), ("vocabulary", pa.binary()), ("words", pa.binary())])
GROUP = "group string, tokens long, docs array<long>, sizes binary, vocabulary binary, words binary"


def shrink(values: np.ndarray) -> bytes:
    """The array's byte planes, compressed: planes of high bytes that are nearly all zero cost next to nothing."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def widen(packed: bytes, kind: type) -> np.ndarray:
    """The array that shrink() got."""
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def steps(hashes: np.ndarray) -> np.ndarray:
    """Differences of ascending hashes; np.cumsum() restores them."""
    return np.diff(hashes, prepend=np.uint64(0))


def groups(docs: DataFrame) -> DataFrame:
    """Documents in groups: word hashes once, and each document's words by their place among them."""

    def run(batches):
        for ids, texts in slices(batches, GROUP_BYTES):
            hashes, sizes = word_hashes([x.encode("utf-8", "replace") for x in texts])
            vocabulary, at, times = np.unique(hashes, return_inverse=True, return_counts=True)
            # frequent words first, so that most places are small numbers
            order = np.argsort(-times, kind="stable")
            rank = np.empty(len(order), np.uint32)
            rank[order] = np.arange(len(order), dtype=np.uint32)
            packed = [shrink(sizes.astype(np.uint32))], [vocabulary[order].tobytes()], [shrink(rank[at])]
            yield batch(_GROUP, [uuid.uuid4().hex], [len(hashes)], [ids.to_pylist()], *packed)

    return docs.mapInArrow(run, GROUP)


def grams(sizes: np.ndarray, vocabulary: np.ndarray, words: np.ndarray, order: int) -> list[np.ndarray]:
    """For each order k, the hash of the k words that end at each position; 0 where the document has fewer."""
    place = np.arange(len(words)) - np.repeat(np.cumsum(sizes, dtype=np.int64) - sizes, sizes)
    hashes = vocabulary[words] if len(words) else np.empty(0, np.uint64)
    out = [hash64(hashes)]
    for k in range(2, order + 1):
        longer = np.zeros(len(words), np.uint64)
        if len(words) > 1:
            longer[1:] = hash64(out[-1][:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:] + np.uint64(k))
        longer[place < k - 1] = 0
        out.append(longer)
    return out


def share(found: list[np.ndarray], turn: int, passes: int) -> np.ndarray:
    """The n-grams of all orders that a pass takes, repeats included."""
    every = np.concatenate(found)
    return every[(every != 0) & (every % np.uint64(passes) == np.uint64(turn))]


def each_row(batches):
    """One row after the other, so that a batch's binaries are not all held as objects."""
    for b in batches:
        for n in range(b.num_rows):
            yield b.slice(n, 1).to_pylist()[0]


def _open(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return widen(row["sizes"], np.uint32).astype(np.int64), np.frombuffer(row["vocabulary"], np.uint64), widen(row["words"], np.uint32)


def count_grams(grouped: DataFrame, order: int, n_parts: int, turn: int = 0, passes: int = 1) -> DataFrame:
    """(group, part, counts): the corpus count of each n-gram of a group that this pass takes, in order of hash within the part."""
    sent = pa.schema([("part", pa.int32()), ("group", pa.string()), ("hashes", pa.binary()), ("counts", pa.binary())])
    back = pa.schema([("group", pa.string()), ("part", pa.int32()), ("counts", pa.binary())])

    def send(batches):
        for row in each_row(batches):
            h, n = np.unique(share(grams(*_open(row), order), turn, passes), return_counts=True)
            for p, at in deal(h, n_parts):
                yield batch(sent, [p], [row["group"]], [shrink(steps(h[at]))], [shrink(n[at].astype(np.uint32))])

    def table(batches):
        for part, rows in per_part(batches):
            asks = [x for b in rows for x in zip(b.column(1).to_pylist(), (np.cumsum(widen(x, np.uint64), dtype=np.uint64) for x in b.column(2).to_pylist()), (widen(x, np.uint32) for x in b.column(3).to_pylist()), strict=True)]
            h, n = np.concatenate([a[1] for a in asks]), np.concatenate([a[2] for a in asks])
            at = np.argsort(h)
            first = np.concatenate([[True], h[at][1:] != h[at][:-1]])
            total = np.add.reduceat(n[at].astype(np.int64), np.flatnonzero(first))
            known = np.empty(len(h), np.uint32)
            known[at] = total[np.cumsum(first) - 1]
            done = 0
            for group, own, _ in asks:
                yield batch(back, [group], [part], [shrink(known[done : done + len(own)])])
                done += len(own)

    rows = grouped.mapInArrow(send, "part int, group string, hashes binary, counts binary")
    return by_part(rows, n_parts).mapInArrow(table, "group string, part int, counts binary")


OUT = "doc_id long, n_words long, log_score double, mean_log_score double"


def score(docs: DataFrame, order: int = ORDER, backoff: float = BACKOFF, cutoff: int = CUTOFF, passes: int = PASSES) -> DataFrame:
    """(doc_id, n_words, log_score, mean_log_score) of every document."""
    stash = Stash(docs.sparkSession, "ngrams")
    grouped = stash.keep(groups(id_text(docs)), "groups")
    tokens = int(grouped.agg(F.sum("tokens")).first()[0] or 0)
    n_parts = parts(docs.sparkSession, order * tokens // passes)
    replies = None
    for turn in range(passes):
        own = stash.keep(count_grams(grouped, order, n_parts, turn, passes), f"counts-{turn}").withColumn("turn", F.lit(turn))
        replies = own if replies is None else replies.unionByName(own)
    answers = replies.groupBy("group").agg(F.collect_list(F.struct("turn", "part", "counts")).alias("answers"))
    joined = grouped.join(answers, "group", "left").select("docs", "sizes", "vocabulary", "words", "answers")
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("log_score", pa.float64()), ("mean_log_score", pa.float64())])

    def run(batches):
        for row in each_row(batches):
            sizes, vocabulary, words = _open(row)
            found = grams(sizes, vocabulary, words, order)
            held = {(a["turn"], a["part"]): widen(a["counts"], np.uint32) for a in row["answers"] or ()}
            c = np.zeros(order * len(words), np.int64)
            every = np.concatenate(found)
            for turn in range(passes):
                mine = np.flatnonzero((every != 0) & (every % np.uint64(passes) == np.uint64(turn)))
                h, at = np.unique(every[mine], return_inverse=True)
                count = np.zeros(len(h), np.int64)
                for p, places in deal(h, n_parts):
                    count[places] = held[turn, p]
                c[mine] = count[at]
            c = c.reshape(order, -1)
            log_s = np.log(c[0] / tokens) + (order - 1) * np.log(backoff) if len(words) else np.empty(0)
            for k in range(1, order):
                before = np.concatenate([[1], c[k - 1][:-1]]) if len(words) else np.empty(0)
                seen = c[k] >= cutoff
                log_s[seen] = np.log(c[k][seen] / before[seen]) + (order - 1 - k) * np.log(backoff)
            total = np.bincount(np.repeat(np.arange(len(sizes)), sizes), log_s, len(sizes)) if len(sizes) else np.empty(0)
            mean = pa.array(total / np.maximum(sizes, 1), pa.float64(), mask=sizes == 0)
            yield batch(schema, row["docs"], sizes, total, mean)

    return joined.mapInArrow(run, OUT)
