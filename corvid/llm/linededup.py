"""Line dedup: exact reference-count tables with sharded cuckoo filters before them.

A line's key is the line without blanks at its ends and with A-Z lower-cased; only its
128-bit hash travels. `occurrences` has (key, doc_id) once for each document that holds an
eligible line, `references` the exact count of documents and the largest doc_id of each key,
and `filters` a cuckoo filter of 16-bit fingerprints for each shard of keys. Documents can be
inserted and deleted: a batch's keys pass the filters first, only keys that may be known are
joined to the references, and counts go up or down by exactly the batch's documents, so a
deletion undoes an insertion. Ledger keeps these tables by shard; a batch appends its changes.

A line is dropped where its key is in at least `min_docs` documents, except in the largest
doc_id that holds it. Finding the drops: keys with enough references fill the filters; the
occurrences stream past their shard's filter (salted by document, so a line of half the corpus
is met by many tasks); what passes, few rows, is joined to the exact references.

Null or empty text: one empty line. A null id holds no keys and loses nothing. Rows that
repeat an id are one document for the counts, whose lines are those of all its rows. Of equal
lines of the keeper all stay. An empty table gives an empty result. A text of any length is
split by one task. With keep_columns, further columns come back as they are, whatever their
names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Stash, batch, fresh, id_text, row_slices, slices

MIN_CHARS = 40
MIN_DOCS = 5
BLANKS = " \t\n\r\x0b\x0c"
#: Keys of one filter at most on average, and copies of each filter for the salted probe.
SHARD_KEYS = 100_000
SALTS = 32
#: A ledger's keys of one shard on average, its shards at most, and the changes of a shard that are never merged yet.
LEDGER_KEYS, MOST_SHARDS, FEW_CHANGES = 1_000_000, 20_000, 10_000


def line_key(line: str, min_chars: int = MIN_CHARS) -> bytes | None:
    """The key's hash, or None for a line that is too short to count."""
    bare = line.strip(BLANKS)
    if len(bare) < min_chars:
        return None
    return xxhash.xxh3_128_digest(bare.encode("utf-8", "replace").lower())  # bytes lower A-Z alone


class CuckooFilter:
    """16-bit fingerprints in buckets of four; a key's two buckets are each other's by its fingerprint."""

    SLOTS, KICKS = 4, 500

    def __init__(self, capacity: int):
        self.buckets = 1 << max(2, int(np.ceil(np.log2(max(1, capacity) / self.SLOTS / 0.85))))
        self.table = np.zeros((self.buckets, self.SLOTS), np.uint16)
        self.stash: list[tuple[int, int]] = []  # of entries that found no place; never lost

    @classmethod
    def load(cls, raw: bytes) -> CuckooFilter:
        self = cls.__new__(cls)
        head = np.frombuffer(raw[:16], np.int64)
        self.buckets, spare = int(head[0]), int(head[1])
        end = 16 + 2 * cls.SLOTS * self.buckets
        self.table = np.frombuffer(raw[16:end], np.uint16).reshape(-1, cls.SLOTS).copy()
        self.stash = [tuple(x) for x in np.frombuffer(raw[end:], np.int64).reshape(spare, 2).tolist()]
        return self

    def dump(self) -> bytes:
        return np.array([self.buckets, len(self.stash)], np.int64).tobytes() + self.table.tobytes() + np.array(self.stash, np.int64).tobytes()

    def room(self, more: int) -> bool:
        """Whether so many further entries leave the table at most 0.85 full."""
        return np.count_nonzero(self.table) + len(self.stash) + more <= 0.85 * self.table.size

    def _where(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprints and both buckets of 64-bit hashes."""
        print_ = (keys >> np.uint64(48)).astype(np.uint16)
        print_[print_ == 0] = 1
        one = (keys & np.uint64(self.buckets - 1)).astype(np.int64)
        return print_, one, one ^ self._jump(print_)

    def _jump(self, print_):
        return (print_.astype(np.int64) * 0x5BD1E995 >> 7) & (self.buckets - 1)

    def insert(self, keys: np.ndarray) -> None:
        print_, one, two = self._where(keys)
        rng = np.random.default_rng(self.buckets)
        for f, a, b in zip(print_.tolist(), one.tolist(), two.tolist(), strict=True):
            for _ in range(self.KICKS):
                for k in (a, b):
                    free = np.flatnonzero(self.table[k] == 0)
                    if len(free):
                        self.table[k, free[0]] = f
                        break
                else:
                    k, slot = (a, b)[int(rng.integers(2))], int(rng.integers(self.SLOTS))
                    f, self.table[k, slot] = int(self.table[k, slot]), f
                    a, b = k, k ^ int(self._jump(np.array([f], np.uint16))[0])
                    continue
                break
            else:
                self.stash.append((f, min(a, b)))

    def contains(self, keys: np.ndarray) -> np.ndarray:
        print_, one, two = self._where(keys)
        found = (self.table[one] == print_[:, None]).any(1) | (self.table[two] == print_[:, None]).any(1)
        if self.stash:
            low = np.minimum(one, two)
            for f, k in self.stash:
                found |= (print_ == f) & (low == k)
        return found

    def delete(self, keys: np.ndarray) -> None:
        """Takes one entry for each key; the keys must have been inserted."""
        print_, one, two = self._where(keys)
        for f, a, b in zip(print_.tolist(), one.tolist(), two.tolist(), strict=True):
            if (f, min(a, b)) in self.stash:
                self.stash.remove((f, min(a, b)))
                continue
            for k in (a, b):
                at = np.flatnonzero(self.table[k] == f)
                if len(at):
                    self.table[k, at[0]] = 0
                    break


def _low(column: pa.Array) -> np.ndarray:
    """The first 64 bits of 16-byte keys."""
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, np.uint64)[::2]


def occurrences(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(key, doc_id), once for each document's distinct eligible lines."""
    schema = pa.schema([("key", pa.binary()), ("doc_id", pa.int64())])

    def run(batches):
        for ids, texts in slices(batches):
            keys, at = [], []
            for n, text in enumerate(texts):
                own = {k for line in set(text.split("\n")) if len(line) >= min_chars and (k := line_key(line, min_chars))}
                keys += own
                at += [n] * len(own)
            yield batch(schema, keys, ids.take(pa.array(at, pa.int32())))

    return id_text(docs).where(F.col("doc_id").isNotNull()).mapInArrow(run, "key binary, doc_id long")


def references(occ: DataFrame) -> DataFrame:
    """(key, refs, keeper): exact counts of documents, and the largest doc_id."""
    return occ.groupBy("key").agg(F.countDistinct("doc_id").alias("refs"), F.max("doc_id").alias("keeper"))


def shard(shards: int):
    return F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int").alias("shard")


def filters(keys: DataFrame, shards: int, spare: int = 1) -> DataFrame:
    """(shard, filter) of a frame of distinct keys; a shard has its keys' share by hash, its filter room for `spare` times as many."""
    schema = pa.schema([("shard", pa.int32()), ("filter", pa.binary())])

    def build(table: pa.Table) -> pa.Table:
        own = _low(table["key"].combine_chunks())
        f = CuckooFilter(spare * len(own))
        f.insert(own)
        return pa.table({"shard": table["shard"][:1], "filter": pa.array([f.dump()], pa.binary())}, schema)

    return keys.select(shard(shards), "key").groupBy("shard").applyInArrow(build, "shard int, filter binary")


def probe(occ: DataFrame, made: DataFrame, shards: int, salts: int = SALTS) -> DataFrame:
    """The occurrences whose key their shard's filter may hold: no key that it holds is lost."""
    schema = pa.schema([("key", pa.binary()), ("doc_id", pa.int64())])
    asks = occ.select(shard(shards), F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int").alias("salt"), F.lit(1).alias("kind"), "key", "doc_id", F.lit(None).cast("binary").alias("filter"))
    held = made.select("shard", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(0).alias("kind"), F.lit(None).cast("binary").alias("key"), F.lit(None).cast("long").alias("doc_id"), "filter")
    dealt = asks.unionByName(held).repartition("shard", "salt").sortWithinPartitions("shard", "salt", "kind")

    def run(batches):
        at, f = None, None
        for b in batches:
            group = b.column(0).to_numpy().astype(np.int64) * salts + b.column(1).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)]
            for start, end in zip(cuts, cuts[1:], strict=False):
                if end == start:
                    continue
                if group[start] != at:
                    at, f = group[start], None
                if b.column(2)[start].as_py() == 0:
                    f, start = CuckooFilter.load(b.column(5)[start].as_py()), start + 1
                if f is not None and end > start:
                    keys = b.column(3).slice(start, end - start)
                    hit = pa.array(f.contains(_low(keys)))
                    yield batch(schema, keys.filter(hit), b.column(4).slice(start, end - start).filter(hit))

    return dealt.mapInArrow(run, "key binary, doc_id long")


class Ledger:
    """The state of incremental line dedup: tables of signed changes, cut into shards and merged when read.

    By shard of the key: `occurrences` (key, doc_id, change), `references` (key, change, keeper,
    sets, turn) and `filters`; by shard of the document: `documents` (doc_id, keys, alive, turn).
    An insertion appends +1 for each occurrence and its count for each key; a deletion appends the
    same with a minus. A key's count is the sum of its changes, its keeper the largest since the
    last row that sets one, and a document is as its last turn left it. So a batch writes as many
    rows as it has lines, whatever is held already. A shard whose changes outgrow what was merged
    before (and `few`) is merged; each row is therefore merged a bounded number of times on average.

    Filters have one entry for each key that some document holds, changed in place (some 2.4 bytes a
    key). They spare reading: an insertion looks up only keys that may be known, in their shards'
    references alone; a deletion reads occurrences only of keys that lose their keeper. A filter
    that gets too full is made anew from its shard's references. There are four times as many shards
    once they hold over LEDGER_KEYS keys on average. The driver holds the shards' paths and sizes.
    """

    SCHEMAS = {
        "occurrences": "key binary, doc_id long, change long",
        "references": "key binary, change long, keeper long, sets boolean, turn int",
        "filters": "filter binary",
        "documents": "doc_id long, keys array<binary>, alive boolean, turn int",
    }

    def __init__(self, spark, occ: DataFrame | None = None, shards: int = 32, few: int = FEW_CHANGES):
        self.spark, self.stash, self.turn, self.shards, self.few = spark, Stash(spark, "ledger"), 0, shards, few
        self.paths: dict[str, dict[int, list[str]]] = {name: {} for name in self.SCHEMAS}
        self.sizes: dict[str, dict[int, list[int]]] = {name: {} for name in self.SCHEMAS}  # merged rows, changes
        self.written = dict.fromkeys(self.SCHEMAS, 0)  # rows so far
        self.roots, self.temporary = 0, []
        if occ is not None:
            self._add(occ)

    # --- tables

    def read(self, name: str, shards: list[int] | None = None) -> DataFrame:
        """A table's rows with their shard, of all shards or of some."""
        some = self.paths[name] if shards is None else {k: self.paths[name].get(k, []) for k in shards}
        paths = [p for k in sorted(some) for p in some[k]]
        if not paths:
            return self.spark.createDataFrame([], f"{self.SCHEMAS[name]}, shard int")
        at = F.regexp_extract(F.input_file_name(), r"/shard=(\d+)/", 1).cast("int")
        return self.spark.read.schema(self.SCHEMAS[name]).parquet(*paths).withColumn("shard", at)

    def merged(self, name: str, rows: DataFrame) -> DataFrame:
        """Rows of a table (all of a key, occurrence or document, or none) as one row for what there is now."""
        if name == "occurrences":
            return rows.groupBy("key", "doc_id", "shard").agg(F.sum("change").alias("change")).where("change > 0")
        if name == "documents":
            last = rows.groupBy("doc_id", "shard").agg(F.max_by(F.struct("keys", "alive"), "turn").alias("x"), F.max("turn").alias("turn"))
            return last.select("doc_id", "x.keys", "x.alive", "turn", "shard").where("alive")
        since = F.max(F.when(F.col("sets"), F.col("turn"))).over(Window.partitionBy("key"))
        keeper = F.when(F.col("turn") >= F.coalesce("since", F.lit(0)), F.col("keeper"))
        one = rows.withColumn("since", since).groupBy("key").agg(F.sum("change").alias("change"), F.max(keeper).alias("keeper"), F.lit(True).alias("sets"), F.max("turn").alias("turn"), F.max("shard").alias("shard"))
        return one.where("change > 0")

    def _keep(self, rows: DataFrame, name: str) -> DataFrame:
        """A table of this turn alone."""
        self.temporary.append(f"{name}-{self.turn}")
        return self.stash.keep(rows, self.temporary[-1])

    def _begin(self) -> None:
        self.turn += 1

    def _end(self) -> None:
        for name in self.temporary:
            self.stash.drop(name)
        self.temporary.clear()

    def _by_shard(self, rows: DataFrame) -> dict[int, int]:
        """Rows of each shard; MOST_SHARDS at most."""
        return {r[0]: r[1] for r in rows.groupBy("shard").count().collect()}

    def _write(self, name: str, rows: DataFrame, replaced: list[int] | None = None) -> None:
        """Appends rows (with their shard) as changes; or as all that the replaced shards hold."""
        self.roots += 1
        root = f"{self.stash.root}/{name}-r{self.roots}"
        rows.hint("rebalance", "shard").write.partitionBy("shard").parquet(root)
        found = self._by_shard(self.spark.read.schema(f"{self.SCHEMAS[name]}, shard int").parquet(root).select("shard"))
        self.written[name] += sum(found.values())
        for k in replaced or ():
            self.paths[name].pop(k, None)
            self.sizes[name].pop(k, None)
        for k, n in found.items():
            self.paths[name].setdefault(k, []).append(f"{root}/shard={k}")
            size = self.sizes[name].setdefault(k, [0, 0])
            size[1 if replaced is None and size[0] else 0] += n  # what comes first needs no merging

    def _merge(self) -> None:
        """Merges the shards whose changes outgrew what was merged; makes more shards if they are large."""
        for name in ("occurrences", "references", "documents"):
            large = sorted(k for k, (base, new) in self.sizes[name].items() if new > max(base, self.few))
            if large:
                self._write(name, self.merged(name, self.read(name, large)), large)
        held = sum(base + new for base, new in self.sizes["references"].values())
        if held > self.shards * LEDGER_KEYS and self.shards < MOST_SHARDS:
            self._reshard(min(MOST_SHARDS, 4 * self.shards))

    def _reshard(self, shards: int) -> None:
        tables = {name: self.merged(name, self.read(name)) for name in ("occurrences", "references", "documents")}
        old, self.shards = {name: sorted(self.paths[name]) for name in self.SCHEMAS}, shards
        for name, rows in tables.items():
            at = self._home() if name == "documents" else shard(shards)
            self._write(name, rows.withColumn("shard", at), old[name])
        self._write("filters", filters(self.read("references").select("key"), shards, 2), old["filters"])

    def _home(self):
        return F.pmod(F.xxhash64("doc_id"), F.lit(self.shards)).cast("int").alias("shard")

    @property
    def occ(self) -> DataFrame:
        return self.merged("occurrences", self.read("occurrences")).select("key", "doc_id")

    @property
    def refs(self) -> DataFrame:
        """(key, refs, keeper): exact counts of documents, and the largest doc_id."""
        return self.merged("references", self.read("references")).select("key", F.col("change").alias("refs"), "keeper")

    # --- batches

    def insert(self, docs: DataFrame) -> None:
        """Adds documents; those already held are left as they are."""
        self._add(occurrences(docs))

    def _add(self, occ: DataFrame) -> None:
        self._begin()
        batch_ = self._keep(occ.dropDuplicates().select("key", "doc_id", self._home()), "batch")
        ids = batch_.select("doc_id").distinct()
        known = self.read("documents", sorted(self._by_shard(batch_))).select("doc_id", "alive", "turn").join(ids, "doc_id", "left_semi")
        held = known.groupBy("doc_id").agg(F.max_by("alive", "turn").alias("alive")).where("alive").select("doc_id")
        fresh = self._keep(batch_.join(held, "doc_id", "left_anti").select("key", "doc_id", shard(self.shards)), "fresh")
        new = self._keep(references(fresh).select("key", F.col("refs").alias("change"), "keeper", F.lit(False).alias("sets"), F.lit(self.turn).alias("turn"), shard(self.shards)), "new")
        touched = sorted(self._by_shard(new))
        if touched:
            # only keys that their shard's filter may hold meet the exact references
            maybe = self._keep(probe(new.select("key", F.col("keeper").alias("doc_id")), self.read("filters", touched), self.shards).select("key", shard(self.shards)), "maybe")
            rows = self.read("references", sorted(self._by_shard(maybe))).join(maybe.select("key"), "key", "left_semi")
            added = self._keep(new.join(self.merged("references", rows).select("key"), "key", "left_anti").select("key", "shard"), "added")
            self._write("references", new)
            self._write("occurrences", fresh.select("key", "doc_id", F.lit(1).cast("long").alias("change"), "shard"))
            self._write("documents", fresh.groupBy("doc_id").agg(F.collect_set("key").alias("keys")).select("doc_id", "keys", F.lit(True).alias("alive"), F.lit(self.turn).alias("turn"), self._home()))
            self._change_filters(added.withColumn("add", F.lit(True)))
            self._merge()
        self._end()

    def delete(self, ids: DataFrame) -> None:
        """Takes documents (doc_id) away; counts fall by exactly their occurrences. Ids that aren't held change nothing."""
        self._begin()
        gone = self._keep(ids.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct().withColumn("shard", self._home()), "gone")
        rows = self.read("documents", sorted(self._by_shard(gone))).join(gone.select("doc_id"), "doc_id", "left_semi")
        mine = self._keep(self.merged("documents", rows), "mine")
        lost = self._keep(mine.select("doc_id", F.explode("keys").alias("key")).select("key", "doc_id", shard(self.shards)), "lost")
        down = self._keep(lost.groupBy("key", "shard").agg(F.count("*").alias("n")), "down")
        touched = sorted(self._by_shard(down))
        if touched:
            now = self.merged("references", self.read("references", touched).join(down.select("key"), "key", "left_semi"))
            left = now.select("key", "keeper", F.col("change").alias("refs")).join(down, "key").withColumn("left", F.col("refs") - F.col("n"))
            # keys whose keeper goes get the largest of the documents that stay
            gone_keepers = lost.select("key", F.col("doc_id").alias("keeper"), F.lit(True).alias("sets"))
            left = self._keep(left.join(gone_keepers, ["key", "keeper"], "left").select("key", "shard", "n", "left", F.coalesce("sets", F.lit(False)).alias("sets")), "left")
            open_ = self._keep(left.where("sets AND left > 0").select("key", "shard"), "open")
            stay = self.read("occurrences", sorted(self._by_shard(open_))).join(open_.select("key"), "key", "left_semi")
            stay = self.merged("occurrences", stay).join(lost.select("key", "doc_id"), ["key", "doc_id"], "left_anti")
            heir = stay.groupBy("key").agg(F.max("doc_id").alias("keeper"))
            self._write("references", self._keep(left.join(heir, "key", "left").select("key", (-F.col("n")).alias("change"), "keeper", "sets", F.lit(self.turn).alias("turn"), "shard"), "change"))
            self._write("occurrences", lost.select("key", "doc_id", F.lit(-1).cast("long").alias("change"), "shard"))
            self._write("documents", mine.select("doc_id", F.lit(None).cast("array<binary>").alias("keys"), F.lit(False).alias("alive"), F.lit(self.turn).alias("turn"), "shard"))
            self._change_filters(left.where("left = 0").select("key", "shard", F.lit(False).alias("add")))
            self._merge()
        self._end()

    def _change_filters(self, changes: DataFrame) -> None:
        """Inserts or deletes keys (key, shard, add) in their shards' filters; a full one comes back null and is made anew."""
        touched = sorted(self._by_shard(changes))
        if not touched:
            return
        schema = pa.schema([("shard", pa.int32()), ("filter", pa.binary())])

        def change(left: pa.Table, right: pa.Table) -> pa.Table:
            if not right.num_rows:
                return pa.table({"shard": left["shard"], "filter": left["filter"]}, schema)
            keys, add = _low(right["key"].combine_chunks()), right["add"].to_numpy()
            f = CuckooFilter.load(left["filter"][0].as_py()) if left.num_rows else CuckooFilter(max(64, 2 * int(add.sum())))
            if add.any() and not f.room(int(add.sum())):
                made = None
            else:
                f.insert(keys[add])
                f.delete(keys[~add])
                made = f.dump()
            return pa.table({"shard": right["shard"][:1], "filter": pa.array([made], pa.binary())}, schema)

        held = self.read("filters", touched).select("shard", "filter")
        out = held.groupBy("shard").cogroup(changes.select("shard", "key", "add").groupBy("shard")).applyInArrow(change, "shard int, filter binary")
        out = self._keep(out, "changed")
        full = sorted(self._by_shard(out.where("filter IS NULL")))
        good = out.where("filter IS NOT NULL")
        if full:
            good = good.unionByName(filters(self.merged("references", self.read("references", full)).select("key"), self.shards, 2))
        self._write("filters", good, touched)

    def drops(self, min_docs: int = MIN_DOCS) -> DataFrame:
        return find_drops(self.stash, self.occ, self.refs.where(F.col("refs") >= min_docs))


def find_drops(stash: Stash, occ: DataFrame, heavy: DataFrame) -> DataFrame:
    """(doc_id, key) of lines to drop, given the references that have enough documents."""
    heavy = stash.keep(heavy, "heavy")
    shards = max(8, heavy.count() // SHARD_KEYS)
    passed = probe(occ, stash.keep(filters(heavy, shards), "heavy-filters"), shards)
    return passed.join(heavy, "key").where(F.col("doc_id") != F.col("keeper")).select("doc_id", "key")


OUT = "doc_id long, n_lines long, n_dropped long, kept_sha256 string"


def apply_drops(docs: DataFrame, drops: DataFrame, keep_columns: bool = False, min_chars: int = MIN_CHARS) -> DataFrame:
    """Documents without their dropped lines; a document's drops are bound by its own lines.

    keep_columns: the input's columns with the new text; else id, counts and the digest.
    """
    columns = docs.columns
    text = columns.index("text")
    source = docs if keep_columns else id_text(docs)
    drop_id, drop_keys = fresh(source, "drop_id"), fresh(source, "drop_keys")
    lists = drops.groupBy(F.col("doc_id").alias(drop_id)).agg(F.collect_set("key").alias(drop_keys))
    joined = source.join(lists, F.col("doc_id").cast("long") == F.col(drop_id), "left").select(*source.columns, drop_keys)
    schema = None if keep_columns else pa.schema([("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept_sha256", pa.string())])

    def cut(value: str, keys) -> tuple[int, int, str]:
        lines = value.split("\n")
        if not keys:
            return len(lines), 0, value
        gone = {bytes(k) for k in keys}
        kept = [x for x in lines if len(x) < min_chars or line_key(x, min_chars) not in gone]
        return len(lines), len(lines) - len(kept), "\n".join(kept)

    def digests(batches):
        for b in batches:
            done = 0
            for ids, texts in slices([b]):
                rows = [cut(x, k) for x, k in zip(texts, b.column(2).slice(done, len(texts)).to_pylist(), strict=True)]
                done += len(texts)
                yield batch(schema, ids, [r[0] for r in rows], [r[1] for r in rows], [hashlib.sha256(r[2].encode("utf-8", "replace")).hexdigest() for r in rows])

    def rewritten(batches):
        for b in row_slices(batches, text):
            out = [x if not k or x is None else cut(x, k)[2] for x, k in zip(b.column(text).to_pylist(), b.column(len(columns)).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()) if n == text else b.column(n) for n in range(len(columns))], names=columns)

    return joined.mapInArrow(rewritten, docs.schema) if keep_columns else joined.mapInArrow(digests, OUT)


def dedup(docs: DataFrame, keep_columns: bool = False, min_docs: int = MIN_DOCS) -> DataFrame:
    """One batch against an empty ledger: all documents' lines are counted, and repeats dropped."""
    stash = Stash(docs.sparkSession, "lines")
    occ = stash.keep(occurrences(docs), "occurrences")
    return apply_drops(docs, find_drops(stash, occ, references(occ).where(F.col("refs") >= min_docs)), keep_columns)
