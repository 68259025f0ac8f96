"""Rolling window features over sources of any skew.

Every source is cut into time chunks, and an event is copied to the chunks that its longest
window reaches, so a chunk is worked on alone: a source with a third of all rows is many
chunks. Events of one source, time, length and language are counted before they are
sent, and a window's features are found once for each distinct time of a source.

Order statistics: a chunk's events lie in blocks as long as the window, so that a window is a
suffix of one block and a prefix of the next. The lengths of both are presorted, and each block
is a linked list over that order. Events leave the older list in order of time; the newer list
is emptied backwards first, so that its events come back each at its own place. For each asked
rank a pointer into both lists moves by few steps when events come and go.

Defined results: rows without an id have no time, are in no window and have empty windows (0
events, 0 characters, 0 languages, null ranks); null sources are one source; a null text is an
event without a length, an empty one has length 0; rows that repeat are events each; events of
one time do not see each other; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stash, batch

#: The windows in seconds, and the ranks as shares (ceil(a * m / b) of m lengths).
SPANS = (3600, 21600)
SHARES = ((1, 2), (75, 100))
_FOUND = "n_events long, sum_chars long, n_langs long, median_chars long, high_chars long"


def events(docs: DataFrame) -> DataFrame:
    """(doc_id, source, event_s, length, lang) of documents."""
    row = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["source"].cast("string").alias("source"), docs["text"].cast("string").alias("text"), docs["lang"].cast("string").alias("lang"))
    jitter = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4000
    shifted = F.col("doc_id") + jitter
    sixth = F.expr("div(s - pmod(s, 6), 6)")  # the floor in whole numbers
    return row.withColumn("s", shifted).select("doc_id", "source", (60 * sixth).alias("event_s"), F.length("text").cast("long").alias("length"), "lang")


def ranks(time: np.ndarray, value: np.ndarray, weight: np.ndarray, asked: np.ndarray, span: int, base: int, share: tuple[int, int]) -> list:
    """For each asked time t, ascending and at least base + span, the value of number
    ceil(share * m) among the m values of [t - span, t), or None. Events are in order of time."""
    out, cut = [], 0
    while cut < len(asked):
        block = (int(asked[cut]) - base) // span
        border = base + block * span
        to = int(np.searchsorted(asked, border + span))
        first, middle, last = np.searchsorted(time, (border - span, border, border + span)).tolist()
        out += _two_blocks(time[first:last], value[first:last], weight[first:last], middle - first, asked[cut:to].tolist(), span, share)
        cut = to
    return out


def _two_blocks(time, value, weight, n_old: int, asked: list[int], span: int, share: tuple[int, int]) -> list:
    size = len(value)
    order = np.argsort(value, kind="stable")
    place = np.empty(size, np.int64)
    place[order] = np.arange(size)
    ahead, behind = np.zeros(size + 4, np.int64), np.zeros(size + 4, np.int64)
    for own, head, tail in ((place[:n_old], -1, size), (place[n_old:], -2, size + 1)):
        chain = np.concatenate([[head], np.sort(own), [tail]])
        ahead[chain[:-1]], behind[chain[1:]] = chain[1:], chain[:-1]
    ahead, behind, sorted_value, heavy = ahead.tolist(), behind.tolist(), value[order].tolist(), weight[order].tolist()
    place, times = place.tolist(), time.tolist()
    for e in reversed(place[n_old:]):
        ahead[behind[e]], behind[ahead[e]] = ahead[e], behind[e]
    total = sum(heavy[e] for e in place[:n_old])
    # below: weight of the events that stand before `pivot`; a and b: the first ones from there on
    pivot, below, a, b = 0, 0, ahead[-1], size + 1
    goes, comes, (up, down), out = 0, n_old, share, []
    for t in asked:
        while comes < size and times[comes] < t:
            e = place[comes]
            comes += 1
            ahead[behind[e]] = behind[ahead[e]] = e
            total += heavy[e]
            if e < pivot:
                below += heavy[e]
            elif e < b:
                b = e
        while goes < n_old and times[goes] < t - span:
            e = place[goes]
            goes += 1
            ahead[behind[e]], behind[ahead[e]] = ahead[e], behind[e]
            total -= heavy[e]
            if e < pivot:
                below -= heavy[e]
            elif e == a:
                a = ahead[e]
        if not total:
            out.append(None)
            continue
        number = -(-up * total // down)
        while below >= number:
            x, y = behind[a], behind[b]
            if x > y:
                pivot = a = x
            else:
                pivot = b = y
            below -= heavy[pivot]
        while below + heavy[e := min(a, b)] < number:
            below, pivot = below + heavy[e], e + 1
            if e == a:
                a = ahead[e]
            else:
                b = ahead[e]
        out.append(sorted_value[e])
    return out


def _distinct(time: np.ndarray, code: np.ndarray, asked: np.ndarray, span: int) -> np.ndarray:
    """Distinct codes in each window: an event stands for its code until the next of the code, or till it is out."""
    order = np.lexsort((time, code))
    t, c = time[order], code[order]
    new = np.ones(len(t), bool)
    new[1:] = (t[1:] != t[:-1]) | (c[1:] != c[:-1])
    t, c = t[new], c[new]
    until = t + span
    same = np.flatnonzero(c[1:] == c[:-1])
    until[same] = np.minimum(until[same], t[same + 1])
    change = np.bincount(np.searchsorted(asked, t, side="right"), minlength=len(asked) + 1) - np.bincount(np.searchsorted(asked, until, side="right"), minlength=len(asked) + 1)
    return np.cumsum(change)[: len(asked)]


def _chunk(rows: pa.Table, start: int, end: int, spans) -> tuple[np.ndarray, list[list]]:
    """(times of the chunk, for each window the columns of its features)."""
    time, n = rows["event_s"].to_numpy(), rows["n"].to_numpy()
    asked = np.unique(time[(time >= start) & (time < end)])
    has = pc.is_valid(rows["length"]).to_numpy(zero_copy_only=False)
    length = pc.fill_null(rows["length"], 0).to_numpy()
    lang = rows["lang"].combine_chunks()
    spoken = pc.is_valid(lang).to_numpy(zero_copy_only=False)
    code = pc.fill_null(lang.dictionary_encode().indices, 0).to_numpy(zero_copy_only=False).astype(np.int64)
    all_n, all_chars = np.concatenate([[0], np.cumsum(n)]), np.concatenate([[0], np.cumsum(n * length)])
    columns: list[list] = []
    for span in spans:
        old, new = np.searchsorted(time, asked - span), np.searchsorted(time, asked)
        near = has & (time >= start - span)
        order = [ranks(time[near], length[near], n[near], asked, span, start - span, share) for share in SHARES]
        columns.append([all_n[new] - all_n[old], all_chars[new] - all_chars[old], _distinct(time[spoken], code[spoken], asked, span), *order])
    return asked, columns


def features(counted: DataFrame, spans=SPANS, chunk: int | None = None) -> DataFrame:
    """(source, event_s, found) for each distinct time of each source; counted: (source, event_s,
    length, lang, n). found has, in the order of spans, the features of [event_s - span, event_s).

    chunk: the seconds of a chunk, the longest window unless given; each event goes to its own
    chunk and to those that a window reaches from it. A task holds one chunk at a time.
    """
    longest = max(spans)
    chunk = chunk or longest
    of = lambda c: F.expr(f"div({c} - pmod({c}, {chunk}L), {chunk}L)")
    dealt = counted.withColumn("until", F.col("event_s") + longest).withColumn("chunk", F.explode(F.sequence(of("event_s"), of("until")))).select("source", "chunk", "event_s", "length", "lang", "n")
    n_parts = int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(n_parts, "source", "chunk").sortWithinPartitions("source", "chunk", "event_s")
    kind = pa.list_(pa.struct([(x.split()[0], pa.int64()) for x in _FOUND.split(", ")]))
    arrow = pa.schema([("source", pa.string()), ("event_s", pa.int64()), ("found", kind)])

    def run(batches):
        for rows in _runs(batches):
            start = rows["chunk"][0].as_py() * chunk
            asked, columns = _chunk(rows, start, start + chunk, spans)
            if len(asked):
                made = [pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in window], fields=list(kind.value_type)) for window in columns]
                flat = pa.concat_arrays(made).take(pa.array(np.arange(len(asked) * len(spans)).reshape(len(spans), -1).T.ravel()))
                found = pa.ListArray.from_arrays(pa.array(np.arange(len(asked) + 1) * len(spans), pa.int32()), flat).cast(kind)
                yield batch(arrow, pa.repeat(rows["source"][0], len(asked)).cast(pa.string()), asked, found)

    return dealt.mapInArrow(run, f"source string, event_s long, found array<struct<{_FOUND.replace(' ', ':')}>>".replace(",:", ", "))


def _runs(batches):
    """Each run of one (source, chunk) as a table."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        source, chunk = pc.fill_null(b["source"], ""), b["chunk"].to_numpy()
        missing = pc.is_null(b["source"]).to_numpy(zero_copy_only=False)
        new = (chunk[1:] != chunk[:-1]) | (missing[1:] != missing[:-1]) | pc.not_equal(source[1:], source[:-1]).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(new) + 1).tolist(), b.num_rows]
        for start, end in zip(cuts, cuts[1:], strict=False):
            part = b.slice(start, end - start)
            if held and (held[0]["source"][0] != part["source"][0] or held[0]["chunk"][0] != part["chunk"][0]):
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)


def rolling(docs: DataFrame, spans=SPANS, chunk: int | None = None) -> DataFrame:
    """(doc_id, window_s, event_s, n_events, sum_chars, n_langs, median_chars, high_chars): a row
    for each row of documents and window."""
    own = Stash(docs.sparkSession, "rolling").keep(events(docs), "events")
    counted = own.where("event_s is not null").groupBy("source", "event_s", "length", "lang").agg(F.count("*").alias("n"))
    at = features(counted, spans, chunk).select(F.col("source").alias("of"), F.col("event_s").alias("at"), "found")
    timed = own.where("event_s is not null").join(at, F.col("source").eqNullSafe(F.col("of")) & (F.col("event_s") == F.col("at"))).select("doc_id", "event_s", "found")
    empty = F.array(*[F.struct(*[F.lit(None if k > 2 else 0).cast("long").alias(x.split()[0]) for k, x in enumerate(_FOUND.split(", "))]) for _ in spans])
    rows = timed.unionByName(own.where("event_s is null").select("doc_id", "event_s", empty.alias("found")))
    named = F.transform(F.arrays_zip("found", F.array(*[F.lit(s).cast("long") for s in spans]).alias("window_s")), lambda x: x)
    return rows.select("doc_id", "event_s", F.explode(named).alias("x")).select("doc_id", "x.window_s", "event_s", "x.found.*")
