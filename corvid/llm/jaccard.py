"""N-gram Jaccard join over a count-vector R-tree.

A document is the set of its distinct 5-word shingles. Shingles are hashed into GROUPS
groups, and the group counts are the document's point. For two points the sum of the
coordinate minima bounds the overlap of the sets from above, and for a box of points the same
sum with the box's upper corner does (points of long sets have more groups, which boxes fold
to GROUPS and pairs don't); a pair, a point and a box, or two boxes can only hold a
link where that bound reaches t / (1 + t) of both sizes. Survivors are verified on the sets.

One tree over all points can't prune: unlike documents of one size have nearly the same
counts in every group, so every box reaches every query and the search is a comparison of all
pairs. So the root's children are the cells of a prefix directory: with all shingles in one
global order, two sets that link share a shingle among the first n - ceil(t n) + 1 of each;
a cell has the documents with that shingle in their prefix, and is an R-tree of their points
(packed by size, then by counts). Any order is exact; ours has the shingles that most
documents hold last, so that passages shared by many documents don't fill cells.

Groups of copies: documents with equal sets are one class and never paired. In a cell of near
copies all pairs would be the square of the group; as only components are asked for, each
cell's members are first verified against its leader, the member that shares most cells, and
then only members that are still in different components are paired, in tree order.

Null or empty text and texts without words: no shingles, linked with nothing, their own
component. With fewer than five words the whole sequence is the one shingle. A null id takes
no part and gets a null component. Rows that repeat an id and its text are one document, and
each gets its result; of an id with several texts the one whose set has the smallest digest
counts, in any order of the rows. Equal sets are one class, whatever the texts' order or length; a class stands for its
smallest doc_id. A text of any length is one set in one task. An empty table gives an empty
result; further columns are not read, and one_of_each() returns them as they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stash, batch, fresh, hash64, id_text, slices, word_hashes
from .exchange import MOST_PARTITIONS, by_part, components, deal, parts, per_part, repeated

SHINGLE = 5
NUM, DEN = 3, 4  # links need NUM / DEN = 0.75
GROUPS = 256
#: Shingles that the order puts last: at most so many (a broadcast of 8 bytes each), each held
#: by over COMMON documents. Any such set is exact; it only shapes the cells.
MOST_COMMON, COMMON = 100_000, 50
#: Groups of a point up to which each shingle has one; more groups than this are for the longest sets.
MOST_SHARP = 1024
LEAF = 32
#: Members of a cell that one task compares; larger cells are dealt as pairs of blocks.
BLOCK = 4096
CHUNK = 30_000
#: Ids that are sent to all tasks rather than the texts to them (16 MB).
FEW_IDS = 1_000_000
#: Smallest cells of a member that its rows carry; a pair is left to a smaller cell that both name.
NAMED = 4


def shingle_sets(texts: list[str], size: int = SHINGLE) -> list[np.ndarray]:
    """Each text's sorted distinct shingle hashes."""
    raws = [x.encode("utf-8", "replace") for x in texts]
    words, count = word_hashes(raws)
    mixed = np.zeros(max(0, len(words)), np.uint64)
    for k in range(size):
        shifted = np.zeros(len(words), np.uint64)
        shifted[: max(0, len(words) - k)] = words[k:]
        mixed = hash64(mixed * np.uint64(0x9E3779B97F4A7C15) + shifted) if k else shifted
    out, at = [], 0
    for n, raw in zip(count.tolist(), raws, strict=True):
        if n >= size:
            own = np.sort(mixed[at : at + n - size + 1])
            out.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        else:
            out.append(np.array([xxhash.xxh3_64_intdigest(b" ".join(raw.lower().split()), n)] if n else [], np.uint64))
        at += n
    return out


def prefix_size(n: int) -> int:
    return n - -(-NUM * n // DEN) + 1


def point(shingles: np.ndarray, groups: int = GROUPS) -> bytes:
    """Group counts as bytes; what a count has beyond 255 is the point's excess, its size less its counts."""
    return np.minimum(np.bincount((shingles & np.uint64(groups - 1)).astype(np.int64), minlength=groups), 255).astype(np.uint8).tobytes()


def groups_of(n):
    """Groups of the points of sets of these sizes: one for each shingle at least up to MOST_SHARP, then some four to
    eight shingles each, GROUPS at least. Of fewer, the counts of two long unlike documents are much the same, and what
    two near copies don't share meets by chance, so that a group of copies just below the bound leaves as all its pairs."""
    bits = np.frexp(np.asarray(n, float))[1].astype(np.int64)
    return np.maximum(np.clip(1 << bits, GROUPS, MOST_SHARP), 1 << np.maximum(0, bits - 3))


def sharp_point(shingles: np.ndarray) -> bytes:
    """packed_point() over groups_of() the set's size."""
    return packed_point(shingles, int(groups_of(len(shingles))))


def packed_point(shingles: np.ndarray, groups: int = GROUPS) -> bytes:
    """The point with two, four or eight bits a count, the fewest that hold them all."""
    count = np.frombuffer(point(shingles, groups), np.uint8)
    top = int(count.max())
    for bits in (2, 4):
        if top < 1 << bits:
            return np.bitwise_or.reduce(count.reshape(-1, 8 // bits) << np.arange(0, 8, bits, dtype=np.uint8), axis=1).tobytes()
    return count.tobytes()


def fine_point(shingles: np.ndarray) -> bytes:
    """The point over as many groups as the set has shingles (a power of two): sharper for long documents."""
    return point(shingles, max(GROUPS, 1 << int(len(shingles)).bit_length()))


def fine_bound(p: bytes, q: bytes, n_p: int, n_q: int) -> int:
    """Summed coordinate minima of two fine points, the finer one folded to the coarser one's groups."""
    a, b = (np.frombuffer(x, np.uint8).astype(np.int64) for x in (p, q))
    groups = min(len(a), len(b))
    a, b = a.reshape(-1, groups).sum(axis=0), b.reshape(-1, groups).sum(axis=0)
    return int(np.minimum(a, b).sum()) + min(n_p - int(a.sum()), n_q - int(b.sum()))


def points_of(column, groups: int = GROUPS) -> np.ndarray:
    """[row, group] counts of packed points."""
    raw = column.to_pylist()
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    out = np.empty((len(raw), groups), np.uint8)
    for width in np.unique(size).tolist():
        at = np.flatnonzero(size == width)
        bits = 8 * width // groups
        held = np.frombuffer(b"".join([raw[n] for n in at.tolist()]), np.uint8).reshape(len(at), width, 1)
        out[at] = ((held >> np.arange(0, 8, bits, dtype=np.uint8)) & np.uint8((1 << bits) - 1)).reshape(len(at), groups)
    return out


class Points:
    """Sharp points of sets of sizes n: [row, group] counts folded to GROUPS in `coarse`, and those of long sets in all their groups."""

    def __init__(self, column, n: np.ndarray):
        self.n, self.groups, self.place = n, groups_of(n), np.zeros(len(n), np.int64)
        self.coarse, self.fine = np.empty((len(n), GROUPS), np.uint8), {}
        for groups in np.unique(self.groups).tolist():
            rows = np.flatnonzero(self.groups == groups)
            held = points_of(column.take(pa.array(rows)), groups)
            self.coarse[rows] = held if groups == GROUPS else np.minimum(held.reshape(len(rows), -1, GROUPS).sum(axis=1), 255)
            if groups > GROUPS:
                self.place[rows], self.fine[groups] = np.arange(len(rows)), held

    def _folded(self, rows: np.ndarray, groups: int) -> np.ndarray:
        out = np.empty((len(rows), groups), np.int64)
        for own in np.unique(self.groups[rows]).tolist():
            at = np.flatnonzero(self.groups[rows] == own)
            out[at] = self.fine[own][self.place[rows[at]]].reshape(len(at), -1, groups).sum(axis=1)
        return out

    def near(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether each pair of rows may link by the finest groups that both have; True where that is GROUPS."""
        out, groups = np.ones(len(i), bool), np.minimum(self.groups[i], self.groups[j])
        for w in np.unique(groups[groups > GROUPS]).tolist():
            at = np.flatnonzero(groups == w)
            step = max(1, 2_000_000 // w)
            for k in range(0, len(at), step):
                some = at[k : k + step]
                a, b = self._folded(i[some], w), self._folded(j[some], w)
                m, n = self.n[i[some]], self.n[j[some]]
                out[some] = enough(np.minimum(a, b).sum(axis=1) + np.minimum(m - a.sum(axis=1), n - b.sum(axis=1)), m, n)
        return out


def excess_of(n: np.ndarray, points: np.ndarray) -> np.ndarray:
    return n - points.sum(axis=1, dtype=np.int64)


def enough(overlap, a, b):
    """100 * overlap >= 75 * union, for sizes a and b."""
    return (NUM + DEN) * overlap >= NUM * (a + b)


def profile(docs: DataFrame, stash: Stash) -> DataFrame:
    """Rows of kind 0 (doc_id, class, n, point) and kind 1 (shingle, documents of a task that hold it in their prefix)."""
    schema = pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("class", pa.binary()), ("n", pa.int64()), ("point", pa.binary()), ("fine", pa.binary())])

    def run(batches):
        held, seen = [], set()

        def common():
            values, n = np.unique(np.concatenate(held), return_counts=True) if held else (np.empty(0, np.uint64),) * 2
            top = np.flatnonzero(n > 2)
            top = top[np.argsort(-n[top].astype(np.int64), kind="stable")][:MOST_COMMON]
            held.clear()
            if len(top):
                yield batch(schema, [1] * len(top), values[top].view(np.int64), [None] * len(top), n[top].astype(np.int64), [None] * len(top), [None] * len(top))

        size = 0
        for ids, texts in slices(batches):
            sets = shingle_sets(texts)
            classes = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            yield batch(schema, [0] * len(texts), ids, classes, list(map(len, sets)), list(map(sharp_point, sets)), list(map(fine_point, sets)))
            for c, s in zip(classes, sets, strict=True):
                if c and c not in seen:
                    seen.add(c)
                    held.append(s[: prefix_size(len(s))])
                    size += len(held[-1])
            if size > 4_000_000:
                size = 0
                seen.clear()
                yield from common()
        yield from common()

    return stash.keep(id_text(docs).where(F.col("doc_id").isNotNull()).mapInArrow(run, "kind int, doc_id long, class binary, n long, point binary, fine binary"), "profile")


def directory(docs: DataFrame, common: np.ndarray, n_parts: int) -> DataFrame:
    """(cell, doc_id) of all cells with two documents or more.

    A task deals each class once, so copies are aggregated before the shuffle.
    """
    sent = pa.schema([("part", pa.int32()), ("cells", pa.binary()), ("docs", pa.binary())])
    schema = pa.schema([("cell", pa.int64()), ("doc_id", pa.int64())])
    last = docs.sparkSession.sparkContext.broadcast(common)  # at most MOST_COMMON hashes

    def send(batches):
        order = last.value
        cells, owners, size, seen = [], [], 0, set()

        def flush():
            c, o = np.concatenate(cells), np.concatenate(owners)
            for p, at in deal(c, n_parts):
                yield batch(sent, [p], [c[at].tobytes()], [o[at].tobytes()])
            cells.clear()
            owners.clear()

        for ids, texts in slices(batches):
            for key, s in zip(ids.to_pylist(), shingle_sets(texts), strict=True):
                c = xxhash.xxh3_128_digest(s.tobytes())
                if not len(s) or c in seen:
                    continue
                seen.add(c)
                p = prefix_size(len(s))
                if len(order):
                    at = np.minimum(np.searchsorted(order, s), len(order) - 1)
                    is_last = order[at] == s
                    if is_last[:p].any():
                        s = np.concatenate([s[~is_last], s[is_last]])
                cells.append(s[:p])
                owners.append(np.full(p, key, np.int64))
                size += p
            if size > 2_000_000:
                size = 0
                seen.clear()
                yield from flush()
        if cells:
            yield from flush()

    def meet(batches):
        for _, rows in per_part(batches):
            c = np.concatenate([np.frombuffer(x, np.uint64) for b in rows for x in b.column(1).to_pylist()])
            o = np.concatenate([np.frombuffer(x, np.int64) for b in rows for x in b.column(2).to_pylist()])
            order = np.lexsort((o, c))
            c, o = c[order], o[order]
            some = np.flatnonzero(repeated(c))
            for k in range(0, len(some), 200_000):
                at = some[k : k + 200_000]
                yield batch(schema, c[at].view(np.int64), o[at])

    rows = id_text(docs).where(F.col("doc_id").isNotNull()).mapInArrow(send, "part int, cells binary, docs binary")
    return by_part(rows, n_parts).mapInArrow(meet, "cell long, doc_id long")


def overlap_bound(one: np.ndarray, many: np.ndarray, excess_one, excess_many) -> np.ndarray:
    """Sum of coordinate minima of a point (or corner) with each of many, counts beyond 255 included."""
    return np.minimum(one, many).sum(axis=1, dtype=np.int64) + np.minimum(excess_one, excess_many)


class RTree:
    """Points packed by size and then by their heaviest group, in leaves of LEAF with their boxes."""

    def __init__(self, n: np.ndarray, points: np.ndarray):
        self.order = np.lexsort((points.argmax(axis=1), n))
        self.n, self.points = n[self.order], points[self.order]
        self.starts = np.arange(0, len(n), LEAF)
        self.ends = np.append(self.starts[1:], len(n))
        self.excess = excess_of(self.n, self.points)
        self.high, self.high_excess = np.maximum.reduceat(self.points, self.starts, axis=0), np.maximum.reduceat(self.excess, self.starts)
        self.low_n, self.high_n = self.n[self.starts], self.n[self.ends - 1]

    def meet(self, other: RTree):
        """Positions (in the inputs' order) of pairs that the bounds leave: boxes first, then points."""
        for k in range(len(self.starts)):
            # sizes that link differ by 4 / 3 at most, and the least sizes ask for the least overlap
            near = np.flatnonzero((DEN * other.high_n >= NUM * self.low_n[k]) & (NUM * other.low_n <= DEN * self.high_n[k]))
            near = near[enough(overlap_bound(self.high[k], other.high[near], self.high_excess[k], other.high_excess[near]), self.low_n[k], other.low_n[near])]
            if not len(near):
                continue
            at = np.concatenate([np.arange(other.starts[m], other.ends[m]) for m in near])
            for i in range(self.starts[k], self.ends[k]):
                good = at[enough(overlap_bound(self.points[i], other.points[at], self.excess[i], other.excess[at]), self.n[i], other.n[at])]
                if len(good):
                    yield self.order[i], other.order[good]


def left_to_smaller(cell, named_a: np.ndarray, named_b: np.ndarray) -> np.ndarray:
    """Whether each pair of a cell also meets in a smaller cell that both sides name (rows of `named`, 0: none)."""
    out = np.zeros(len(named_b), bool)
    for k in range(NAMED):
        one = named_a[..., k, None]
        out |= ((named_b == one) & (one != 0) & (named_b < np.asarray(cell)[..., None])).any(axis=-1)
    return out


def small_pairs(cell: np.ndarray, rep: np.ndarray, comp: np.ndarray, n: np.ndarray, points: np.ndarray, named: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of many cells at once, each a tree of a single leaf: there the box is all of the cell,
    and the bound of point and point decides; rows stand in order of their cell."""
    out = [], []
    excess = excess_of(n, points)
    for step in range(1, LEAF):
        a = np.flatnonzero(cell[step:] == cell[:-step])
        if not len(a):
            break
        b = a + step
        some = (comp[a] != comp[b]) & (DEN * np.minimum(n[a], n[b]) >= NUM * np.maximum(n[a], n[b]))
        a, b = a[some], b[some]
        for k in range(0, len(a), 50_000):
            i, j = a[k : k + 50_000], b[k : k + 50_000]
            here = ~left_to_smaller(cell[i], named[i], named[j])
            i, j = i[here], j[here]
            good = enough(overlap_bound(points[i], points[j], excess[i], excess[j]), n[i], n[j])
            out[0].append(rep[i[good]])
            out[1].append(rep[j[good]])
    return tuple(np.concatenate(x) if x else np.empty(0, np.int64) for x in out)


_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def cell_pairs(members: DataFrame, n_parts: int) -> DataFrame:
    """Pairs (a < b) of members that are in different components and that the tree's bounds leave.

    Rows (cell, block_a, block_b, side, rep, comp, n, point, named) stream in order of their cell
    and blocks, so a task holds one cell's two blocks, or many small cells of CHUNK rows. A pair
    that meets in several cells leaves from the smallest that both its sides name, if they name
    one; every cell that a member names is open here, as both sides are in it and still apart.
    """
    dealt = members.repartition(min(n_parts, MOST_PARTITIONS), "cell", "block_a", "block_b").sortWithinPartitions("cell", "block_a", "block_b")

    def solve(table: pa.Table):
        cell, one, two, side, rep, comp, n = (table[c].to_numpy() for c in ("cell", "block_a", "block_b", "side", "rep", "comp", "n"))
        held = Points(table["point"], n)
        points = held.coarse
        named = table["named"].combine_chunks().flatten().to_numpy().reshape(-1, NAMED)
        cuts = np.flatnonzero(np.concatenate([[True], (cell[1:] != cell[:-1]) | (one[1:] != one[:-1]) | (two[1:] != two[:-1])]))
        size = np.diff(np.append(cuts, len(cell)))
        small = np.repeat((size <= LEAF) & (one[cuts] == two[cuts]), size)
        i, j = small_pairs(*(x[small] for x in (cell, np.arange(len(cell)), comp, n, points, named)))
        near = held.near(i, j)
        found = [(rep[i[near]], rep[j[near]])]
        for start, m in zip(cuts[~small[cuts]].tolist(), size[~small[cuts]].tolist(), strict=True):
            at = np.arange(start, start + m)
            diagonal = one[start] == two[start]
            first, second = (at, at) if diagonal else (at[side[at] == 0], at[side[at] == 1])
            if not (len(first) and len(second)):
                continue
            tree = RTree(n[first], points[first])
            for i, js in tree.meet(tree if diagonal else RTree(n[second], points[second])):
                i, js = first[i], second[js]
                js = js[(comp[js] != comp[i]) & ((rep[js] > rep[i]) | (not diagonal))]
                js = js[~left_to_smaller(cell[start], named[i], named[js])]
                js = js[held.near(np.full(len(js), i), js)]
                if len(js):
                    found.append((np.full(len(js), rep[i]), rep[js]))
        a, b = (np.concatenate([f[k] for f in found]) for k in (0, 1))
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
        if pairs.shape[1]:
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], schema=_PAIR)

    def run(batches):
        held, rows = [], 0
        for b in batches:
            if b.num_rows:
                held.append(b)
                rows += b.num_rows
            if rows >= CHUNK:
                table = pa.Table.from_batches(held)
                key = [table[c].to_numpy() for c in ("cell", "block_a", "block_b")]
                whole = np.flatnonzero(np.logical_or.reduce([k[1:] != k[:-1] for k in key]))
                if len(whole):  # the last group may go on
                    end = int(whole[-1]) + 1
                    yield from solve(table.slice(0, end))
                    held = table.slice(end).to_batches()
                    rows = table.num_rows - end
        if rows:
            yield from solve(pa.Table.from_batches(held))

    return dealt.mapInArrow(run, "a long, b long").dropDuplicates()


def verify(stash: Stash, docs: DataFrame, pairs: DataFrame, name: str, salts: int = 16) -> DataFrame:
    """The pairs (a, b) that link, by their sets.

    The sets of documents in pairs are made once; a pair's `a` is sent once for each salt, its
    partners stream past it, so no task holds more than one set and a batch.
    """
    ids = stash.keep(pairs.select(F.explode(F.array("a", "b")).alias("rep")).dropDuplicates(), f"{name}-ids")
    if ids.count() <= FEW_IDS:
        ids = F.broadcast(ids)  # else the texts are shuffled to them
    chosen = id_text(docs).join(ids, F.col("doc_id") == F.col("rep"), "left_semi")
    made = pa.schema([("rep", pa.int64()), ("class", pa.binary()), ("shingles", pa.binary())])

    def make(batches):
        for keys, texts in slices(batches):
            sets = [s.tobytes() for s in shingle_sets(texts)]
            some = [(k, xxhash.xxh3_128_digest(s), s) for k, s in zip(keys.to_pylist(), sets, strict=True) if s]
            if some:
                yield batch(made, *map(list, zip(*some, strict=True)))

    each = chosen.mapInArrow(make, "rep long, class binary, shingles binary")
    sets = stash.keep(each.groupBy("rep").agg(F.min(F.struct("class", "shingles")).alias("x")).select("rep", "x.shingles"), f"{name}-sets")
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(salts)).cast("int"))
    heads = salted.select("a", "salt").dropDuplicates().join(sets, F.col("a") == F.col("rep")).select("a", "salt", F.lit(-1).cast("long").alias("b"), F.lit(0).alias("kind"), "shingles")
    tails = salted.join(sets, F.col("b") == F.col("rep")).select("a", "salt", "b", F.lit(1).alias("kind"), "shingles")
    dealt = heads.unionByName(tails).repartition("a", "salt").sortWithinPartitions("a", "salt", "kind", "b")

    def compare(batches):
        head = np.empty(0, np.uint64)
        for rows in batches:
            a, b = [], []
            for x, y, kind, raw in zip(rows.column(0).to_pylist(), rows.column(2).to_pylist(), rows.column(3).to_pylist(), rows.column(4), strict=True):
                s = np.frombuffer(raw.as_buffer(), np.uint64)
                if kind == 0:
                    head = s.copy()
                elif enough(len(np.intersect1d(head, s, assume_unique=True)), len(head), len(s)):
                    a.append(x)
                    b.append(y)
            yield batch(_PAIR, a, b)

    return stash.keep(dealt.mapInArrow(compare, "a long, b long"), f"{name}-links")


def blocked(members: DataFrame, facts: DataFrame, block: int = BLOCK) -> DataFrame:
    """Members of cells as (cell, block_a, block_b, side, ...): small cells as one block, larger ones as pairs of blocks by hash."""
    size = members.groupBy("cell").agg(F.count("*").alias("size"), F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 != c1")
    open_ = members.join(size.select("cell", "size"), "cell")
    count = F.ceil(F.col("size") / block).cast("int")
    own = F.pmod(F.xxhash64("rep"), count).cast("int")
    open_ = open_.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), count - 1)))
    return open_.select("cell", F.least("own", "other").alias("block_a"), F.greatest("own", "other").alias("block_b"), (F.col("own") > F.col("other")).cast("int").alias("side"), "rep", "comp").join(facts.select("rep", "n", "point", "named"), "rep")


def join(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, links' class representative) of every document."""
    spark = docs.sparkSession
    stash = Stash(spark, "jaccard")
    rows = profile(docs, stash)
    sizes = rows.where("kind = 0")
    # one class for each id, so that a representative stands for one class alone; verify() takes the same text
    chosen = sizes.where("n > 0").groupBy("doc_id").agg(F.min(F.struct("class", F.col("n").alias("n_shingles"))).alias("x")).select("doc_id", "x.*")
    points = sizes.where("n > 0").groupBy("class").agg(F.first("n").alias("n"), F.first("point").alias("point"), F.first("fine").alias("fine"))
    classes = stash.keep(points.join(chosen.groupBy("class").agg(F.min("doc_id").alias("rep")), "class"), "classes")
    # documents without shingles have no class: they stay out of the joins, where they would share a task
    empty = stash.keep(sizes.where("n = 0").select("doc_id").dropDuplicates(), "empty")
    own = stash.keep(chosen.join(classes.select("class", "rep"), "class").select("doc_id", "n_shingles", "rep"), "own")
    often = rows.where("kind = 1").groupBy("doc_id").agg(F.sum("n").alias("n")).where(F.col("n") > COMMON).orderBy(F.desc("n"), "doc_id").limit(MOST_COMMON)
    common = np.sort(often.select("doc_id").toPandas()["doc_id"].to_numpy(np.int64).view(np.uint64))  # at most MOST_COMMON
    entries = sizes.agg(F.sum(F.col("n") / DEN + 1)).first()[0] or 0
    n_parts = parts(spark, int(entries))
    cells = directory(docs, common, n_parts)
    named = cells.join(own.select("doc_id", "rep"), "doc_id").select("cell", "rep").dropDuplicates()
    shared = named.groupBy("cell").agg(F.count("*").alias("size")).where("size > 1")
    members = stash.keep(named.join(shared.select("cell"), "cell"), "members")
    stash.drop("profile")
    # every cell's members against its leader, the member that shares most cells
    degree = members.groupBy("rep").agg(F.count("*").alias("degree"), F.slice(F.array_sort(F.collect_list("cell")), 1, NAMED).alias("cells"))
    facts = stash.keep(classes.select("rep", "n", "point", "fine").join(degree.select("rep", "degree", named_cells("cells")), "rep"), "facts")
    stash.drop("classes")
    whole = members.join(facts.select("rep", "degree"), "rep")
    leader = whole.groupBy("cell").agg(F.max(F.struct("degree", (-F.col("rep")).alias("back"))).alias("top")).select("cell", (-F.col("top.back")).alias("a"))
    stars = members.join(leader, "cell").where(F.col("a") != F.col("rep")).select("a", F.col("rep").alias("b")).dropDuplicates()
    stars = bounded(stars, facts)
    links = verify(stash, docs, stash.keep(stars, "stars"), "star")
    label = components(stash, links, "first")
    # what is still apart in a cell
    labelled = members.join(label.withColumnRenamed("node", "rep"), "rep", "left").select("cell", "rep", F.coalesce("root", "rep").alias("comp"))
    rest = stash.keep(cell_pairs(blocked(stash.keep(labelled, "labelled"), facts), n_parts), "rest")
    more = verify(stash, docs, stash.keep(bounded(rest, facts), "rest-near"), "rest")
    label = components(stash, links.unionByName(more), "last")
    out = own.join(label, F.col("rep") == F.col("node"), "left").select("doc_id", "n_shingles", F.coalesce("root", "rep").alias("component_id"), F.col("rep").alias("class_id"))
    none = empty.join(own.select("doc_id"), "doc_id", "left_anti").select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("class_id"))
    nulls = docs.where(docs["doc_id"].isNull()).select(docs["doc_id"].cast("long").alias("doc_id"))
    again = docs.select(docs["doc_id"].cast("long").alias("doc_id")).where(F.col("doc_id").isNotNull())
    return again.join(out.unionByName(none), "doc_id").unionByName(nulls, allowMissingColumns=True)


def named_cells(cells: str):
    """The smallest cells of a member, padded with 0 to NAMED."""
    return F.slice(F.concat(F.col(cells), F.array_repeat(F.lit(0).cast("long"), NAMED)), 1, NAMED).alias("named")


def bounded(pairs: DataFrame, facts: DataFrame) -> DataFrame:
    """Pairs that the summed coordinate minima leave; facts has each document's size and point."""
    side = lambda x: facts.select(F.col("rep").alias(x), F.col("n").alias(f"n_{x}"), F.col("fine").alias(f"p_{x}"))
    near = pairs.join(side("b"), "b").join(side("a"), "a").where((DEN * F.least("n_a", "n_b") >= NUM * F.greatest("n_a", "n_b")))

    def keep(batches):
        for rows in batches:
            if rows.num_rows:
                cols = dict(zip(rows.schema.names, rows.columns, strict=True))
                sides = zip(*(cols[c].to_pylist() for c in ("p_a", "p_b", "n_a", "n_b")), strict=True)
                ok = [bool(enough(fine_bound(p, q, m, n), m, n)) for p, q, m, n in sides]
                yield pa.RecordBatch.from_arrays([cols["a"], cols["b"]], schema=_PAIR).filter(pa.array(ok, pa.bool_()))

    return near.mapInArrow(keep, "a long, b long")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents without those that link to a smaller doc_id, directly or by others; columns as they are."""
    name = fresh(docs, "gone")
    gone = join(docs).where(F.col("component_id") < F.col("doc_id")).select(F.col("doc_id").alias(name)).dropDuplicates()
    return docs.join(gone, docs["doc_id"] == gone[name], "left_anti")
