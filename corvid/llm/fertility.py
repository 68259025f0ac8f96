"""Quality rules: tokeniser fertility.

Two public vocabularies are laid over every word of a text: a piece vocabulary with byte
fallback and a byte-level one. They give characters per token (of each), the share of
byte-fallback tokens, and the entropy of the piece tokens. Rejection bands are taken for
each language from the corpus itself, from exact histograms over all documents that pass the
base rules: the band of a measure is its middle half, widened by `reach` times its width on
either side. Entropy grows with a text's length and short texts scatter more, so bands are
taken within length classes (a class for each doubling of tokens). A band needs `least`
documents; with fewer, the language's band over all lengths holds (not for entropy), then
the same of all languages, and without those none.

Base rules: fewer than 20 words, or over 30 % of the words in 8-word windows that occur twice
or more in the text.

Null or empty text: all counts 0, no measures, base_failed. A null lang is a group of its own.
Rows that repeat a doc_id are judged each, as are null ids.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Stash, batch, slices

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SYMBOLS = "#*$%&|<>"
BLANKS = b" \t\n\r\x0b\f"
REACH = 4.0
LEAST = 50
#: Bins of a measure's histogram for each unit.
GRAIN = 200
MEASURES = ("chars_per_piece", "chars_per_byte_token", "byte_share", "entropy")

_FIELDS = [("doc_id", pa.int64()), ("lang", pa.string())] + [(n, pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens")] + [(n, pa.float64()) for n in MEASURES]
SCHEMA = "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_tokens long, " + ", ".join(f"{n} double" for n in MEASURES)


class Lexicon:
    """Words seen by a worker with their token counts and piece ids, by position."""

    ROOM = 500_000

    def __init__(self, pieces_model: str, ranks_file: str, pattern: str):
        import base64

        import sentencepiece
        import tiktoken

        self.sp = sentencepiece.SentencePieceProcessor(model_file=pieces_model)
        with open(ranks_file, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.byte_level = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.size = self.sp.get_piece_size()
        self.is_byte = np.array([self.sp.is_byte(n) or self.sp.is_unknown(n) for n in range(self.size)])
        self.clear()

    def clear(self) -> None:
        self.at: dict[bytes, int] = {}
        self.n_byte_level = np.empty(0, np.int64)
        self.n_pieces, self.n_fallback = np.empty(0, np.int64), np.empty(0, np.int64)
        self.start, self.ids = np.zeros(1, np.int64), np.empty(0, np.int32)

    def learn(self, texts: list[list[bytes]]) -> None:
        new = set().union(*texts).difference(self.at)
        if len(self.at) + len(new) > self.ROOM and self.at:
            self.clear()
            new = set().union(*texts)
        if not new:
            return
        words = sorted(new)
        strings = [w.decode("utf-8", "replace") for w in words]
        ids = self.sp.encode(strings, num_threads=1)
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((x for some in ids for x in some), np.int32, int(size.sum()))
        ends = np.cumsum(size)
        fallback = np.concatenate([[0], np.cumsum(self.is_byte[flat])])
        lines = np.array([len(self.byte_level.encode_ordinary(" " + s)) for s in strings], np.int64)
        base = len(self.at)
        self.at.update(zip(words, range(base, base + len(words)), strict=True))
        self.n_byte_level = np.concatenate([self.n_byte_level, lines])
        self.n_pieces = np.concatenate([self.n_pieces, size])
        self.n_fallback = np.concatenate([self.n_fallback, fallback[ends] - fallback[ends - size]])
        self.start = np.concatenate([self.start, self.start[-1] + ends])
        self.ids = np.concatenate([self.ids, flat])


_lexicons: dict[tuple, Lexicon] = {}


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All positions of the ranges, one after the other."""
    return np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(int(sizes.sum()))


def repeated_words(words: np.ndarray, doc: np.ndarray, n_docs: int, window: int = WINDOW) -> np.ndarray:
    """For each document, its words in windows that occur twice or more in it."""
    n = len(words) - window + 1
    if n < 1:
        return np.zeros(n_docs, np.int64)
    whole = np.flatnonzero(doc[:n] == doc[window - 1 :])
    key = doc[whole].astype(np.uint64)
    for k in range(window):  # two multiplications and a shift for each word keep 64 bits mixed
        key = (key ^ (words[whole + k].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xD6E8FEB86659FD93)
        key ^= key >> np.uint64(32)
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(whole), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, whole[twice], 1)
    np.add.at(edge, whole[twice] + window, -1)
    return np.bincount(doc[np.cumsum(edge[:-1]) > 0], minlength=n_docs)


def measure(docs: DataFrame, pieces_model: str, ranks_file: str, pattern: str, lang_col: str = "lang", keep_columns: bool = False) -> DataFrame:
    """Counts and measures of every document; with keep_columns, its own columns beside them as the struct `row`."""
    schema = pa.schema(_FIELDS)

    def run(batches):
        key = pieces_model, ranks_file, pattern
        if key not in _lexicons:
            _lexicons[key] = Lexicon(*key)
        lex = _lexicons[key]
        for b in batches:
            done = 0
            for ids, texts in slices([b]):
                langs = b.column(2).slice(done, len(texts))
                done += len(texts)
                out = batch(schema, ids, langs, *_measure(lex, texts))
                if keep_columns:
                    out = pa.RecordBatch.from_arrays([*out.columns, b.column(3).slice(done - len(texts), len(texts))], names=[*schema.names, "row"])
                yield out

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"), docs[lang_col].cast("string").alias("lang"), *([F.struct(*[docs[c] for c in docs.columns]).alias("row")] if keep_columns else []))
    return rows.mapInArrow(run, T._parse_datatype_string(SCHEMA).add(rows.schema["row"]) if keep_columns else SCHEMA)


def _measure(lex: Lexicon, texts: list[str]) -> list:
    n = len(texts)
    raw = [x.encode("utf-8", "replace") for x in texts]
    split = [x.split() for x in raw]  # bytes split at the six ASCII blanks alone
    lex.learn(split)
    n_words = np.fromiter(map(len, split), np.int64, n)
    words = np.fromiter((lex.at[w] for x in split for w in x), np.int64, int(n_words.sum()))
    doc = np.repeat(np.arange(n), n_words)
    blanks = [sum(map(x.count, (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\f"))) for x in raw]
    word_chars = np.fromiter(map(len, texts), np.int64, n) - np.array(blanks, np.int64)
    symbols = [sum(map(x.count, SYMBOLS)) for x in texts]
    dup_lines = []
    for x in raw:
        lines = [y for y in x.split(b"\n") if y.strip(BLANKS)] if b"\n" in x else ()
        dup_lines.append(len(lines) - len(set(lines)))
    total = lambda per: np.bincount(doc, per[words], n).astype(np.int64)
    n_tokens, n_bytes, n_fallback = total(lex.n_pieces), total(lex.n_byte_level), total(lex.n_fallback)
    size = lex.n_pieces[words]
    tokens = lex.ids[_ranges(lex.start[words], size)]
    of = np.repeat(doc, size)
    pair = np.sort(of * lex.size + tokens)
    edges = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]])) if len(pair) else np.empty(0, np.int64)
    count = np.diff(np.concatenate([edges, [len(pair)]]))
    weight = np.bincount(pair[edges] // lex.size, count * np.log2(count), n) if len(pair) else np.zeros(n)
    some = np.maximum(n_tokens, 1)
    null = n_tokens == 0
    ratio = lambda x: pa.array(x, pa.float64(), mask=null)
    return [n_words, word_chars, np.array(symbols, np.int64), np.array(dup_lines, np.int64), repeated_words(words, doc, n), n_tokens,
            ratio(word_chars / some), ratio(word_chars / np.maximum(n_bytes, 1)), ratio(n_fallback / some), ratio(np.maximum(0, np.log2(some) - weight / some))]


def base_failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def bands(measured: DataFrame, reach: float = REACH, least: int = LEAST) -> DataFrame:
    """(lang, size_class, measure, low, high, docs) from exact histograms of all documents.

    Rows: languages x length classes x measures, and the same with `any` for all languages. Histograms have a bin for each 1 / GRAIN, so their size is bound
    by the measures' ranges, not by the documents.
    """
    size_class = F.floor(F.log2(F.col("n_tokens"))).cast("int")
    long = measured.where(~base_failed() & F.col("entropy").isNotNull()).select(
        "lang", F.posexplode(F.array(*[F.col(m) for m in MEASURES])).alias("m", "value"), size_class.alias("size")
    )
    long = long.select("lang", "m", F.col("size").alias("size_class"), F.round(F.col("value") * GRAIN).cast("long").alias("bin"))
    counts = long.groupBy("lang", "m", "size_class", "bin").agg(F.count("*").alias("n"))
    whole = counts.where(F.col("m") != MEASURES.index("entropy")).groupBy("lang", "m", "bin").agg(F.sum("n").alias("n"))
    counts = counts.unionByName(whole.withColumn("size_class", F.lit(-1)))
    every = counts.groupBy("m", "size_class", "bin").agg(F.sum("n").alias("n")).select(F.lit(True).alias("any"), F.lit(None).cast("string").alias("lang"), "m", "size_class", "bin", "n")
    counts = counts.select(F.lit(False).alias("any"), "lang", "m", "size_class", "bin", "n").unionByName(every)
    group = ["any", "lang", "m", "size_class"]
    ahead = Window.partitionBy(*group).orderBy("bin")
    cumulated = counts.withColumn("upto", F.sum("n").over(ahead)).withColumn("docs", F.sum("n").over(Window.partitionBy(*group)))
    at = lambda share: F.min(F.when(F.col("upto") >= share * F.col("docs"), F.col("bin")))
    quarter = cumulated.groupBy(*group).agg(F.max("docs").alias("docs"), at(0.25).alias("q1"), at(0.75).alias("q3")).where(F.col("docs") >= least)
    width = F.greatest(F.col("q3") - F.col("q1"), F.lit(GRAIN / 50))
    return quarter.select(*group, "docs", ((F.col("q1") - reach * width) / GRAIN).alias("low"), ((F.col("q3") + reach * width) / GRAIN).alias("high"))


def judge(measured: DataFrame, reach: float = REACH, least: int = LEAST) -> DataFrame:
    """Adds base_failed, kept and the measures outside their bands to a written table of measures.

    The bands have a few rows for each language and are joined as maps, one row for each
    language; a language's documents are never brought together.
    """
    found = bands(measured, reach, least).withColumn("band", F.struct("low", "high"))
    key = F.concat_ws(":", F.col("m").cast("string"), F.col("size_class").cast("string"))
    maps = found.groupBy("any", "lang").agg(F.map_from_entries(F.collect_list(F.struct(key, "band"))).alias("map"))
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<struct<low:double,high:double>>"))
    own = maps.where(~F.col("any")).select(F.col("lang").alias("of"), F.col("map").alias("own"))
    rest = maps.where("any").agg(F.first("map", ignorenulls=True).alias("rest"))  # one row, also for none
    joined = measured.join(F.broadcast(own), F.col("lang").eqNullSafe(F.col("of")), "left").join(F.broadcast(rest), F.lit(True), "left")
    outside = []
    for m, name in enumerate(MEASURES):
        size = F.concat(F.lit(f"{m}:"), F.floor(F.log2(F.col("n_tokens"))).cast("string"))
        band = F.coalesce(*[F.element_at(F.coalesce(of, empty), k) for of in ("own", "rest") for k in (size, F.lit(f"{m}:-1"))])
        outside.append(F.when((F.col(name) < band["low"]) | (F.col(name) > band["high"]), F.lit(name)))
    judged = joined.withColumn("outside", F.filter(F.array(*outside), lambda x: x.isNotNull())).withColumn("base_failed", base_failed())
    return judged.select(*measured.columns, "outside", "base_failed", (~F.col("base_failed") & (F.size("outside") == 0)).alias("kept"))


def rules(docs: DataFrame, pieces_model: str, ranks_file: str, pattern: str, reach: float = REACH, keep_columns: bool = False) -> DataFrame:
    """Measures, bands and verdicts of documents (doc_id, text, lang); with keep_columns, `row` as well."""
    stash = Stash(docs.sparkSession, "fertility")
    return judge(stash.keep(measure(docs, pieces_model, ranks_file, pattern, keep_columns=keep_columns), "measures"), reach)
