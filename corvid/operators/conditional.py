"""Iterative compression: each window of a text is judged given what was kept of the windows before it.

The model is relational: counts of words and of pairs of neighbours over the corpus give each token a
probability, interpolated, which is joined to the token. What depends on the earlier choices is a
cache, the counts of the words kept so far in the text; it is the state of a fold over the
text's windows. A word that was kept is expected again, so a later window keeps other words.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Weights of neighbour, word and cache.
PAIR, SINGLE, CACHE = 0.6, 0.4, 0.3


def probabilities(tokens: DataFrame, window: int = 200, key: str = "doc_id", corpus: DataFrame | None = None) -> DataFrame:
    """(key, pos, word, p) of tokens (key, pos, word): PAIR * P(word | the one before) + SINGLE * P(word).

    The first token of a window has no neighbour, as what stands before it may be dropped.
    corpus: the tokens that are counted, those of the texts themselves unless given.
    """
    before = F.lag("word").over(Window.partitionBy(key).orderBy("pos"))
    linked = lambda t: t.select(key, "pos", "word", F.when(F.col("pos") % window != 0, before).alias("prev"))
    counted = linked(tokens if corpus is None else corpus)
    single = counted.groupBy("word").agg(F.count("*").alias("n"))
    pair = counted.where("prev is not null").groupBy("prev", "word").agg(F.count("*").alias("n_pair"))
    head = counted.where("prev is not null").groupBy("prev").agg(F.count("*").alias("n_prev"))
    total = single.agg(F.sum("n").alias("total"))
    rows = linked(tokens).join(single, "word", "left").join(pair.join(head, "prev"), ["prev", "word"], "left").crossJoin(F.broadcast(total))
    alone = F.greatest(F.coalesce("n", F.lit(0)), F.lit(1)) / F.greatest(F.coalesce("total", F.lit(1)), F.lit(1))
    beside = F.coalesce(F.col("n_pair") / F.col("n_prev"), F.lit(0.0))
    return rows.select(key, "pos", "word", F.when(F.col("prev").isNull(), alone).otherwise(PAIR * beside + SINGLE * alone).alias("p"))


def fold(windows, ratio: float, cache: float = CACHE, gain: bool = False):
    """For each window, a list of (pos, word, p), the kept (pos, word, loss); the state goes from one to the next.

    Kept are tokens above the int(n ratio)-th largest value of their window: the loss given what was
    kept, or with gain what the state takes from the loss.
    """
    kept: Counter[str] = Counter()
    size = 0
    for window in windows:
        judged = []
        for pos, word, p in window:
            alone = -math.log(p)
            loss = -math.log((1 - cache) * p + cache * kept[word] / size) if size else alone
            judged.append((round(alone - loss if gain else loss, 9), pos, word, loss))
        order = sorted(judged, key=lambda x: (-x[0], x[1]))
        cut = order[max(int(len(order) * ratio), 1) - 1][0]
        chosen = [(pos, word, loss) for value, pos, word, loss in judged if value > cut]
        for _, word, _ in chosen:
            kept[word] += 1
        size += len(chosen)
        yield chosen


def compress(scored: DataFrame, ratio: float, window: int = 200, key: str = "doc_id", cache: float = CACHE, gain: bool = False) -> DataFrame:
    """(key, pos, word, loss) of the kept tokens of probabilities().

    A text is folded in one task, a window in memory at a time, beside the counts of the words it
    kept; rows without a key take no part.
    """
    n = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = scored.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("key"), F.col("pos").cast("long").alias("pos"), "word", "p")
    rows = rows.repartition(n, "key").sortWithinPartitions("key", "pos")
    arrow = pa.schema([("key", pa.int64()), ("pos", pa.int64()), ("word", pa.string()), ("loss", pa.float64())])

    def run(batches):
        out: list[tuple] = []
        texts = _texts(batches, window)
        for own, windows in texts:
            for chosen in fold(windows, ratio, cache, gain):
                out += [(own, *x) for x in chosen]
                if len(out) > 50_000:
                    yield _batch(arrow, out)
                    out = []
        if out:
            yield _batch(arrow, out)

    return rows.mapInArrow(run, "key long, pos long, word string, loss double").withColumnRenamed("key", key)


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(map(list, zip(*rows, strict=True)), schema, strict=True)], schema=schema)


def _texts(batches, window: int):
    """(key, its windows) one after the other; the windows must be taken before the next key."""
    from itertools import groupby

    rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
    for key, own in groupby(rows, key=lambda r: r[0]):
        yield key, ([(pos, word, p) for _, pos, word, p in part] for _, part in groupby(own, key=lambda r: r[1] // window))


# --- whole texts, in chunks ---------------------------------------------------------------

#: Tokens of one chunk of texts, and counts of one bucket of hashes, on average.
CHUNK, BUCKET = 2_000_000, 1_500_000


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """Another 64-bit hash of 64-bit hashes."""
    x = (x + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashes(words: pa.ChunkedArray | pa.Array, window: int):
    """(text, pos, tokens, word, head, pair, linked) of texts as arrays of words: a token's hash as a word, of the one
    before as a head, of both; linked is false where there is none before in its window."""
    words = words.combine_chunks() if isinstance(words, pa.ChunkedArray) else words
    size = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    tokens = words.flatten()
    own = pc.dictionary_encode(tokens)
    hashed = pd.util.hash_array(np.asarray(own.dictionary.to_pylist(), dtype=object), categorize=False) if len(own.dictionary) else np.zeros(0, np.uint64)
    h = hashed[own.indices.to_numpy(zero_copy_only=False).astype(np.int64)]
    text = np.repeat(np.arange(len(size)), size)
    pos = np.arange(len(h)) - np.repeat(np.cumsum(size) - size, size)
    before = np.concatenate([h[:1], h[:-1]])
    return text, pos, tokens, _mixed(h, 1), _mixed(before, 2), _mixed(_mixed(before, 3) ^ h, 4), pos % window != 0


def _in_buckets(word, head, pair, linked, buckets: int):
    """(distinct hashes of all three kinds ordered by bucket, their counts here, the buckets' offsets)."""
    held, n = np.unique(np.concatenate([word, head[linked], pair[linked]]), return_counts=True)
    order = np.argsort(held % np.uint64(buckets), kind="stable")
    held, n = held[order], n[order]
    return held, n, np.searchsorted(held % np.uint64(buckets), np.arange(buckets + 1))


def compress_texts(texts: DataFrame, ratio: float, window: int = 200, key: str = "doc_id", cache: float = CACHE, gain: bool = False) -> DataFrame:
    """compress(probabilities()) of texts (key, words), an array of words each, their own corpus; (key, pos, word, loss).

    Tokens don't travel: texts are dealt into chunks, a chunk sends each of its words and pairs once,
    as a 64-bit hash with its count, to the bucket of the hash, and gets the corpus' counts back. A
    frequent word is one number from each chunk. Two words of one hash would share their counts.
    """
    spark = texts.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = texts.agg(F.sum(F.size("words")).alias("n")).first().n or 0
    chunks, buckets = (max(n, -(-total // most)) for most in (CHUNK, BUCKET))
    held = texts.where("words IS NOT NULL").select(F.pmod(F.xxhash64(key), F.lit(chunks)).cast("long").alias("chunk"), F.col(key).cast("long").alias("key"), "words")

    def counts(table: pa.Table) -> pa.Table:
        h, c, at = _in_buckets(*_hashes(table.column("words"), window)[3:], buckets)
        full = np.nonzero(np.diff(at))[0]
        starts = pa.array(np.append(at[full], len(h)).astype(np.int32))
        lists = [pa.ListArray.from_arrays(starts, pa.array(x)) for x in (h.view(np.int64), c)]
        return pa.table([pa.array(np.full(len(full), table.column("chunk")[0].as_py())), pa.array(full), *lists], ["chunk", "bucket", "h", "n"])

    def totals(table: pa.Table) -> pa.Table:
        h, c = (table.column(x).combine_chunks() for x in ("h", "n"))
        distinct, at = np.unique(h.flatten().to_numpy(), return_inverse=True)
        summed = np.bincount(at, c.flatten().to_numpy(), len(distinct)).astype(np.int64)  # exact below 2^53
        upto = np.concatenate([[0], np.cumsum(pc.list_value_length(h).to_numpy())]).astype(np.int32)
        return pa.table([table.column("chunk"), table.column("bucket"), pa.ListArray.from_arrays(pa.array(upto), pa.array(summed[at]))], ["chunk", "bucket", "n"])

    arrow = pa.schema([("key", pa.int64()), ("pos", pa.int64()), ("word", pa.string()), ("loss", pa.float64())])

    def kept(own: pa.Table, back: pa.Table) -> pa.Table:
        text, pos, tokens, word, head, pair, linked = _hashes(own.column("words"), window)
        if not len(pos):
            return arrow.empty_table()
        h, _, _ = _in_buckets(word, head, pair, linked, buckets)
        back = back.sort_by("bucket")
        n = back.column("n").combine_chunks().flatten().to_numpy()
        order = np.argsort(h)
        h, n = h[order], n[order]
        count = lambda x: n[np.searchsorted(h, x)]
        p = np.maximum(count(word), 1) / max(total, 1)
        p[linked] = PAIR * (count(pair[linked]) / count(head[linked])) + SINGLE * p[linked]
        ids, out = own.column("key").to_pylist(), []
        cut = np.nonzero(np.diff(text, prepend=-1))[0].tolist() + [len(text)]
        for lo, hi in zip(cut, cut[1:], strict=False):
            name = ids[text[lo]]
            if name is None:
                continue
            said, prob = tokens.slice(lo, hi - lo).to_pylist(), p[lo:hi].tolist()
            windows = ([(k, said[k], prob[k]) for k in range(a, min(a + window, hi - lo))] for a in range(0, hi - lo, window))
            out += [(name, *x) for chosen in fold(windows, ratio, cache, gain) for x in chosen]
        return pa.Table.from_batches([_batch(arrow, out)]) if out else arrow.empty_table()

    sent = held.groupBy("chunk").applyInArrow(counts, "chunk long, bucket long, h array<long>, n array<long>")
    back = sent.groupBy("bucket").applyInArrow(totals, "chunk long, bucket long, n array<long>")
    found = held.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInArrow(kept, "key long, pos long, word string, loss double")
    return found.withColumnRenamed("key", key)
