"""What the operators share: batches of bounded size, written intermediate tables, word units.

Conventions that hold for every operator here:
- input frames are reduced to the id and text columns first; operators that return the input's
  columns name their own so that none clashes (fresh()); so further columns never matter;
- an empty table gives an empty result with the same columns;
- texts of any length: workers take them in slices of SLICE_BYTES, or one text at a time;
- a null text is an empty text;
- rows with a null id take no part in anything that compares documents;
- rows that repeat an id and its text are one document for counts, and every row gets its
  result; where an operator differs (op2's training and op5 count every row), it says so.
"""

from __future__ import annotations

import atexit
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.session import shared_dir

#: Text bytes that one step of a Python worker holds as Python objects.
SLICE_BYTES = 2 << 20

#: Spark's switch for deleting a query's shuffles when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_made: list[tuple[SparkSession, str]] = []


class Stash:
    """Written tables of one operator call; each survives the loss of executors."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        _made.append((spark, self.root))

    def keep(self, df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
        """Writes df and reads it back: lineage is cut, and no work is done twice. The shuffles
        of the write are deleted at its end, as nothing reads them again."""
        path = f"{self.root}/{name}"
        before = self.spark.conf.get(CLEANUP, "false")
        self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.option("compression", codec).parquet(path)
        finally:
            self.spark.conf.set(CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str = "") -> None:
        _delete(self.spark, f"{self.root}/{name}" if name else self.root)


def _delete(spark: SparkSession, path: str) -> None:
    jvm, sc = spark._jvm, spark.sparkContext
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)


@atexit.register
def _clean() -> None:
    for spark, path in _made:
        try:
            _delete(spark, path)
        except Exception:  # noqa: BLE001  the JVM may have ended before; the folder is scratch
            return


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) alone, whatever else the frame has."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))


def slices(batches, max_bytes: int = SLICE_BYTES):
    """Record batches (id, text) as (ids, texts) of at most max_bytes, or of one text."""
    for b in batches:
        if not b.num_rows:
            continue
        size = np.cumsum(pc.binary_length(b.column(1)).to_numpy(zero_copy_only=False))
        for start, end in _cuts(size, max_bytes):
            yield b.column(0).slice(start, end - start), b.column(1).slice(start, end - start).to_pylist()


def _cuts(size: np.ndarray, max_bytes: int):
    """Ranges of rows of at most max_bytes, or of one row, given the summed sizes."""
    start = 0
    while start < len(size):
        before = size[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(size, before + max_bytes, side="right")))
        yield start, end
        start = end


def row_slices(batches, text: int, max_bytes: int = SLICE_BYTES):
    """Record batches of any columns in parts whose column `text` holds at most max_bytes, or one row."""
    for b in batches:
        if b.num_rows:
            size = np.cumsum(np.nan_to_num(pc.binary_length(b.column(text)).to_numpy(zero_copy_only=False).astype(float)))
            for start, end in _cuts(size, max_bytes):
                yield b.slice(start, end - start)


def fresh(df: DataFrame, name: str) -> str:
    """The name, or one like it that no column of df has."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def hash64(values: np.ndarray) -> np.ndarray:
    """A finalising mix of uint64 values, without collisions among them."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_MUL = np.uint64(0x9E3779B97F4A7C15)
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers or more of an odd number and of its inverse, modulo 2 ** 64."""
    if not _powers or len(_powers[0]) < n:
        size = max(1 << 18, n + n // 4)
        back = np.uint64(pow(int(_MUL), -1, 1 << 64))
        _powers[:] = [np.cumprod(np.full(size, x, np.uint64)) for x in (_MUL, back)]
    return _powers[0], _powers[1]


#: The six ASCII blanks, and a number for each byte.
_BLANK = np.isin(np.arange(256), (9, 10, 11, 12, 13, 32))
_VALUE = hash64(np.arange(1, 257, dtype=np.uint64))
#: Words of more bytes are hashed one by one: sums of powers are weak for very long strings.
LONG_WORD = 256


#: Bytes that are hashed at once; eight-byte numbers of each are held, four times.
HASH_BLOCK = 1 << 19


def word_hashes(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes of all words with A-Z lower-cased, words of each text).

    All texts are hashed block by block, each block ending at a blank: prefix sums of byte values
    times powers give every word's polynomial, mixed with its length.
    """
    text = np.frombuffer(b"\n".join(raws).lower() + b"\n", np.uint8)  # bytes lower A-Z alone
    blank = _BLANK[text]
    hashes, firsts, at = [], [], 0
    while at < len(text):
        end = min(at + HASH_BLOCK, len(text))
        while not blank[end - 1]:  # the text ends with a blank
            more = np.flatnonzero(blank[end : end + HASH_BLOCK])
            end = end + int(more[0]) + 1 if len(more) else min(end + HASH_BLOCK, len(text))
        found, starts = _block_hashes(text[at:end], blank[at:end])
        hashes.append(found)
        firsts.append(starts + at)
        at = end
    borders = np.cumsum([0, *(len(x) + 1 for x in raws)])
    return np.concatenate(hashes), np.diff(np.searchsorted(np.concatenate(firsts), borders))


def _block_hashes(text: np.ndarray, blank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, starts) of the words of a block that ends with a blank."""
    edges = np.flatnonzero(np.diff(blank, prepend=True))
    starts, ends = edges[::2], edges[1::2]
    up, down = powers(len(text))
    total = np.zeros(len(text) + 1, np.uint64)
    np.cumsum(_VALUE[text] * down[: len(text)], out=total[1:])
    size = ends - starts
    hashes = hash64((total[ends] - total[starts]) * up[starts] + size.astype(np.uint64))
    for k in np.flatnonzero(size > LONG_WORD).tolist():
        hashes[k] = xxhash.xxh3_64_intdigest(text[starts[k] : ends[k]].tobytes())
    return hashes, starts


class Units:
    """Texts as units that any of the pre-tokenising patterns can never join.

    A split before a white-space character that follows another character is always a
    border of tokens. So a text of printable characters, single spaces and single line
    feeds falls into lines and words, and work is done once for each distinct word.
    Other texts go to the slow function whole.

    solve(list of strings) gives a value for each string. A cached word stands for the
    word with one space before it; `first` has those that begin a line.
    """

    def __init__(self, solve, room: int = 400_000):
        self.solve, self.room, self.first, self.rest = solve, room, {}, {}
        self.feed = None

    def split(self, text: str):
        """The lines' words, or None if the text needs the slow way."""
        if not text:
            return []
        lines = text.split("\n")
        if "  " in text:
            return None
        for x in lines:
            if not x or x[0] == " " or x[-1] == " " or not x.isprintable():
                return None
        return [x.split(" ") for x in lines]

    def learn(self, split: list) -> None:
        """Caches the values of all words of these texts."""
        if self.feed is None:
            self.feed = self.solve(["\n"])[0]
        heads, tails = set(), set()
        for lines in split:
            for words in lines or ():
                heads.add(words[0])
                tails.update(words[1:])
        for known, new, lead in ((self.first, heads, ""), (self.rest, tails, " ")):
            missing = new.difference(known)
            if missing:
                if len(known) + len(missing) > self.room:
                    known.clear()
                    missing = new
                missing = sorted(missing)
                known.update(zip(missing, self.solve([lead + w for w in missing]), strict=True))

    def values(self, lines: list) -> list:
        """The values of a split text's units in order."""
        out, get = [], self.rest.__getitem__
        for n, words in enumerate(lines):
            if n:
                out.append(self.feed)
            out.append(self.first[words[0]])
            out.extend(map(get, words[1:]))
        return out
