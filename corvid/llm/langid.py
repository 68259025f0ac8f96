"""Language identification by segmentation-marginalised unigrams.

A fixed public vocabulary (plus all single bytes, so that every word can be written) is the
piece inventory. A language's probability of a word is the sum over all segmentations of the
word into pieces of the product of the pieces' probabilities, by the forward algorithm over
bytes; a text is the product over its words. The piece probabilities of a language are the
expected piece counts in its words (forward-backward under equal piece probabilities, summed
over all training texts), smoothed by `ALPHA`. So training is one pass, and what reaches the
driver is bounded by languages x vocabulary.

A word is a run of bytes other than the six ASCII blanks, with a space before it, of any length;
all of the vocabulary's pieces that a word can hold take part. A longer word falls apart wherever
no piece of the vocabulary spans a place: its sum is the product of the parts' sums, so a text of
a script without spaces is work for each of its distinct parts. Words and parts of up to 64 bytes
go in padded matrices with bare probabilities; longer ones, and those whose probability leaves the
range of a double, go byte by byte, rescaled, in memory that doesn't grow with them. The score is
the posterior of the predicted language; equal posteriors go to the language that comes first in
order of its name.

Null text, or one without a letter: `und`, score 0. The same if nothing could be learned, and
so for an empty table's model. Rows with a null id are predicted and never learned from. Every
row counts in training, also one that repeats an id, and every row gets its prediction. A text
of any length is one task's, word by word. Columns other than doc_id, text and lang are not read.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch, id_text, slices

#: Widths of the padded matrices; words beyond the last are cut, and go byte by byte if that can't be.
WIDTHS = (8, 16, 24, 32, 64)
#: Probabilities below this are worked out again in logarithms.
TINY = 1e-280
ALPHA = 0.1
#: Distinct words that a training task holds before it turns them into piece counts, and text
#: bytes of documents of long words.
FLUSH, BULK = 200_000, 32 << 20
#: Starts of a long word that are looked up at once, and that are tried for cuts at once.
BLOCK, CUT_BLOCK = 4096, 1 << 16
#: Bytes between two rescalings of a long word's sums.
RESCALE = 8
#: Expected counts are summed as whole thousandths, so that their order doesn't matter.
GRAIN = 1000


class Pieces:
    """The inventory as a dense automaton: next node by byte, piece of a node."""

    def __init__(self, model_file: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        found = {bytes([b]) for b in range(256)}
        for n in range(sp.get_piece_size()):
            if not (sp.is_control(n) or sp.is_unknown(n) or sp.is_byte(n)):
                raw = sp.id_to_piece(n).replace("▁", " ").encode()
                if b" " not in raw[1:]:  # no word holds another space
                    found.add(raw)
        self.pieces = sorted(found)
        self.size = len(self.pieces)
        self.longest = max(map(len, self.pieces))
        node: dict[bytes, int] = {b"": 0}
        for p in self.pieces:
            for k in range(1, len(p) + 1):
                node.setdefault(p[:k], len(node))
        self.dead = dead = len(node)
        self.next = np.full((dead + 1, 256), dead, np.int32)
        self.piece = np.full(dead + 1, self.size, np.int32)  # self.size: no piece
        for prefix, n in node.items():
            if prefix:
                self.next[node[prefix[:-1]], prefix[-1]] = n
        for n, p in enumerate(self.pieces):
            self.piece[node[p]] = n

    def edges(self, words: list[bytes], width: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """(lengths, for each piece length less one the pieces by [start, word]) of words padded to the width."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        text = np.zeros((len(words), width), np.uint8)
        text[np.arange(width) < lengths[:, None]] = np.frombuffer(b"".join(words), np.uint8)
        text = np.ascontiguousarray(text.T)
        out, node = [], np.zeros((width, len(words)), np.int32)
        starts = np.arange(width)[:, None]
        for k in range(min(self.longest, width)):
            node = self.next[node[: width - k], text[k:]]
            out.append(np.where(starts[: width - k] + k < lengths, self.piece[node], self.size))
        return lengths, out

    def block(self, word: bytes, at: int) -> np.ndarray:
        """Pieces by [length - 1, start] of the BLOCK starts of a long word from `at` on."""
        count = min(BLOCK, len(word) - at)
        raw = np.frombuffer(word[at : at + count + self.longest], np.uint8)
        text = np.zeros(count + self.longest, np.uint8)
        text[: len(raw)] = raw
        out, node = np.full((self.longest, count), self.size, np.int32), np.zeros(count, np.int32)
        starts = np.arange(count)
        for k in range(self.longest):
            node = self.next[node, text[k : k + count]]
            out[k] = np.where(starts + k < len(raw), self.piece[node], self.size)
        return out

    def parts(self, word: bytes):
        """Lists of a word's parts, cut at every place that no piece spans."""
        begun, far = 0, 0  # the open part's start, the furthest end of a piece so far
        for first in range(0, len(word), CUT_BLOCK):
            count = min(CUT_BLOCK, len(word) - first)
            text = np.frombuffer(word[first : first + count + self.longest], np.uint8)
            ends = np.arange(1, count + 1)  # every byte is a piece
            at, node = np.arange(count), self.next[0, text[:count]]
            for k in range(1, self.longest):
                inside = at + k < len(text)
                at, node = at[inside], node[inside]
                node = self.next[node, text[at + k]]
                live = node != self.dead
                at, node = at[live], node[live]
                if not len(at):
                    break
                ends[at[self.piece[node] < self.size]] = at[self.piece[node] < self.size] + k + 1
            ends = np.maximum(np.maximum.accumulate(ends), far - first)
            far = first + int(ends[-1])
            cuts = (np.flatnonzero(ends == np.arange(1, count + 1)) + first + 1).tolist()
            if cuts:
                yield [word[a:b] for a, b in zip([begun, *cuts[:-1]], cuts, strict=True)]
                begun = cuts[-1]


_pieces: dict[str, Pieces] = {}


def inventory(model_file: str) -> Pieces:
    if model_file not in _pieces:
        _pieces[model_file] = Pieces(model_file)
    return _pieces[model_file]


def buckets(words: list[bytes]):
    """(width, positions) of words of like length; width 0 has those beyond all widths."""
    by: dict[int, list[int]] = {}
    for n, w in enumerate(words):
        by.setdefault(next((x for x in WIDTHS if len(w) <= x), 0), []).append(n)
    for width, at in by.items():
        step = (1 << 17) // width if width else len(at)
        for k in range(0, len(at), step):
            yield width, at[k : k + step]


def in_parts(pieces: Pieces, words: list[bytes]) -> dict[int, Counter]:
    """The parts, with their counts, of the words that are longer than all widths."""
    out = {}
    for n, word in enumerate(words):
        if len(word) > WIDTHS[-1]:
            out[n] = Counter()
            for some in pieces.parts(word):
                out[n].update(some)
    return out


def _sweep(step: np.ndarray, window: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums [start, language], log scales [start, language]) of one block: step has the pieces'
    probabilities by [start, length - 1, language], window the sums that reach the first places
    so far. Beyond the block's starts stand the next window and, last, its scale."""
    count, longest, langs = step.shape
    reach, scales = np.zeros((count + longest, langs)), np.empty((count + 1, langs))
    reach[:longest] = window
    for i in range(count):
        if i % RESCALE == 0:
            top = reach[i : i + longest].max(axis=0)
            reach[i : i + longest] /= top
            scale = scale + np.log(top)
        scales[i] = scale
        reach[i + 1 : i + 1 + longest] += reach[i] * step[i]
    scales[count] = scale
    return reach, scales


def _first(pieces: Pieces, langs: int) -> tuple[np.ndarray, np.ndarray]:
    window = np.zeros((pieces.longest, langs))
    window[0] = 1
    return window, np.zeros(langs)


def log_forward(pieces: Pieces, table: np.ndarray, word: bytes) -> np.ndarray:
    """[language] log probability of a word of any length, all segmentations summed; table: [piece + 1, language]."""
    window, scale = _first(pieces, table.shape[1])
    for at in range(0, len(word), BLOCK):
        step = np.ascontiguousarray(table[pieces.block(word, at)].transpose(1, 0, 2))
        reach, scales = _sweep(step, window, scale)
        window, scale = reach[len(step) :], scales[-1]
    return np.log(window[0]) + scale


def long_counts(pieces: Pieces, word: bytes) -> np.ndarray:
    """[piece] expected counts of a word of any length under equal probabilities.

    Only the forward sums at each block's start are kept; a block's are made again on the way back.
    """
    same = np.full((pieces.size + 1, 1), 1 / pieces.size)
    same[-1] = 0
    steps = lambda at: np.ascontiguousarray(same[pieces.block(word, at)].transpose(1, 0, 2))
    starts, held = range(0, len(word), BLOCK), []
    window, scale = _first(pieces, 1)
    for at in starts:
        held.append((window, scale))
        reach, scales = _sweep(steps(at), window, scale)
        window, scale = reach[len(scales) - 1 :].copy(), scales[-1]
    total = np.log(window[0, 0]) + scale[0]
    out, longest = np.zeros(pieces.size + 1), pieces.longest
    after, height = np.zeros(longest), 0.0  # sums from the places behind the block, and their log scale
    after[0] = 1
    for at in reversed(starts):
        edge, step = pieces.block(word, at), steps(at)
        count = len(step)
        reach, scales = _sweep(step, *held.pop())
        behind, heights = np.zeros(count + longest), np.full(count + longest, height)
        behind[count:] = after
        bare = step[:, :, 0]
        for i in range(count - 1, -1, -1):
            behind[i] = bare[i] @ behind[i + 1 : i + 1 + longest]
            heights[i] = height
            if i % RESCALE == 0:
                top = behind[i : i + longest].max()
                behind[i : i + longest] /= top
                height += np.log(top)
                heights[i : i + longest] = height
        with np.errstate(divide="ignore"):
            ahead = np.log(reach[:count, 0]) + scales[:count, 0] - total
            back = np.log(behind) + heights
        ends = np.arange(count)[:, None] + 1 + np.arange(longest)
        share = bare * np.exp(np.minimum(ahead[:, None] + back[ends], 700))
        out += np.bincount(edge.T.ravel(), share.ravel(), pieces.size + 1)
        after = behind[:longest]
    return out[:-1]


def expected_counts(pieces: Pieces, words: list[bytes], weights: np.ndarray) -> np.ndarray:
    """[language, piece] expected counts of words (weights: [language, word]) under equal probabilities."""
    cut = in_parts(pieces, words)
    if any(len(parts) > 1 for parts in cut.values()):
        total: dict[bytes, np.ndarray] = {}
        for n, word in enumerate(words):
            for part, times in (cut[n].items() if n in cut else ((word, 1),)):
                own = weights[:, n] * times
                total[part] = total[part] + own if part in total else own
        words, weights = list(total), np.stack(list(total.values()), axis=1)
    out = np.zeros((len(weights), pieces.size + 1))
    p = 1 / pieces.size
    for width, at in buckets(words):
        if not width:
            for n in at:
                out[:, :-1] += weights[:, n, None] * long_counts(pieces, words[n])
            continue
        lengths, edge = pieces.edges([words[n] for n in at], width)
        there = [(e < pieces.size) * p for e in edge]
        n = len(at)
        ahead, behind = np.zeros((width + 1, n)), np.zeros((width + 1, n))
        ahead[0] = 1
        behind[lengths, np.arange(n)] = 1
        for j in range(1, width + 1):
            for k in range(min(j, len(edge))):
                ahead[j] += ahead[j - 1 - k] * there[k][j - 1 - k]
        for i in range(width - 1, -1, -1):
            for k in range(min(width - i, len(edge))):
                behind[i] += behind[i + 1 + k] * there[k][i]
        total = behind[0].copy()
        for k, (e, t) in enumerate(zip(edge, there, strict=True)):
            share = ahead[: width - k] * behind[k + 1 :] * t / total
            for lang, weight in enumerate(weights):
                own = weight[at]
                if own.any():
                    out[lang] += np.bincount(e.ravel(), (share * own).ravel(), pieces.size + 1)
    return out[:, :-1]


def learn(docs: DataFrame, model_file: str, lang_col: str = "lang") -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, log prior, probabilities [piece + 1, language]) of all rows with a lang."""
    schema = pa.schema([("lang", pa.string()), ("piece", pa.int32()), ("n", pa.int64())])

    def run(batches):
        pieces = inventory(model_file)
        seen: dict[str, Counter] = {}
        texts_of = Counter()

        def flush():
            langs = sorted(seen)
            words = sorted(set().union(*seen.values()))
            weights = np.array([[seen[lang].get(w, 0) for w in words] for lang in langs], float).reshape(len(langs), len(words))
            counts = np.rint(expected_counts(pieces, [b" " + w for w in words], weights) * GRAIN).astype(np.int64)
            for lang, row in zip(langs, counts, strict=True):
                some = np.flatnonzero(row)
                yield batch(schema, [lang] * len(some), some.astype(np.int32), row[some])
            seen.clear()

        bulk = 0
        for b in batches:
            at = 0
            for _, texts in slices([b]):
                for text, lang in zip(texts, b.column(2).slice(at, len(texts)).to_pylist(), strict=True):
                    raw = text.encode("utf-8", "replace")
                    words = raw.split()
                    seen.setdefault(lang, Counter()).update(words)
                    texts_of[lang] += 1
                    if len(raw) > 40 * len(words):
                        bulk += len(raw)
                at += len(texts)
                if sum(map(len, seen.values())) > FLUSH or bulk > BULK:
                    yield from flush()
                    bulk = 0
        yield from flush()
        yield batch(schema, list(texts_of), [-1] * len(texts_of), list(texts_of.values()))

    rows = docs.where(docs[lang_col].isNotNull() & docs["doc_id"].isNotNull() & docs["text"].isNotNull()).select("doc_id", "text", docs[lang_col].cast("string").alias("lang"))
    counts = rows.mapInArrow(run, "lang string, piece int, n long").groupBy("lang", "piece").agg(F.sum("n").alias("n"))
    found = counts.toPandas()  # at most languages x (pieces + 1) rows
    langs = sorted(found["lang"].unique())
    size = inventory(model_file).size
    table = np.zeros((size + 1, len(langs)))
    prior = np.zeros(len(langs))
    for k, lang in enumerate(langs):
        own = found[found["lang"] == lang]
        table[own["piece"][own["piece"] >= 0], k] = own["n"][own["piece"] >= 0] / GRAIN
        prior[k] = own["n"][own["piece"] < 0].sum()
    table[:size] += ALPHA
    table[:size] /= table[:size].sum(axis=0)
    table[size] = 0
    return langs, np.log(np.maximum(prior, 1) / max(1, prior.sum())), table


def forward(pieces: Pieces, table: np.ndarray, words: list[bytes]) -> np.ndarray:
    """[word, language] log probability, all segmentations summed."""
    cut = {n: parts for n, parts in in_parts(pieces, words).items() if len(parts) > 1}
    if cut:
        known = {n for n in range(len(words)) if n not in cut}
        units = sorted(set().union(*cut.values(), (words[n] for n in known)))
        value, place = _forward(pieces, table, units), {w: n for n, w in enumerate(units)}
        out = np.empty((len(words), table.shape[1]))
        for n, word in enumerate(words):
            if n in cut:
                times = np.fromiter(cut[n].values(), float, len(cut[n]))
                out[n] = times @ value[np.fromiter(map(place.__getitem__, cut[n]), np.int64, len(cut[n]))]
            else:
                out[n] = value[place[word]]
        return out
    return _forward(pieces, table, words)


def _forward(pieces: Pieces, table: np.ndarray, words: list[bytes]) -> np.ndarray:
    """The same for words that no longer fall apart."""
    out = np.full((len(words), table.shape[1]), -np.inf)
    by_lang = np.ascontiguousarray(table.T)
    again: list[int] = []
    for width, at in buckets(words):
        if not width:
            again += at
            continue
        lengths, edge = pieces.edges([words[n] for n in at], width)
        pick = np.arange(len(at))
        low = np.zeros(len(at), bool)
        for lang, p in enumerate(by_lang):
            w = [p[e] for e in edge]
            ahead = np.zeros((width + 1, len(at)))
            ahead[0] = 1
            for j in range(1, width + 1):
                for k in range(min(j, len(w))):
                    ahead[j] += ahead[j - 1 - k] * w[k][j - 1 - k]
            total = ahead[lengths, pick]
            low |= total < TINY
            out[at, lang] = np.log(np.maximum(total, TINY))
        again += [at[n] for n in np.flatnonzero(low)]
    for n in again:
        out[n] = log_forward(pieces, table, words[n])
    return out


class Scorer:
    ROOM, BYTES = 500_000, 64 << 20  # distinct words that are held, and their bytes

    def __init__(self, model):
        self.langs, self.prior, self.table, model_file = model
        self.pieces = inventory(model_file)
        self.clear()

    def clear(self):
        self.at: dict[bytes, int] = {}
        self.bytes = 0
        self.value = np.empty((0, len(self.langs)))

    def texts(self, texts: list[str]) -> np.ndarray:
        """[text, language] log probability with the prior."""
        split = [x.encode("utf-8", "replace").split() for x in texts]
        new = set().union(*split).difference(self.at)
        if self.at and (len(self.at) + len(new) > self.ROOM or self.bytes > self.BYTES):
            self.clear()
            new = set().union(*split)
        if new:
            words = sorted(new)
            found = forward(self.pieces, self.table, [b" " + w for w in words])
            self.at.update(zip(words, range(len(self.at), len(self.at) + len(words)), strict=True))
            self.bytes += sum(map(len, words))
            self.value = np.concatenate([self.value, found])
        out = np.tile(self.prior, (len(texts), 1))
        for n, words in enumerate(split):
            if words:
                out[n] += self.value[np.fromiter(map(self.at.__getitem__, words), np.int64, len(words))].sum(axis=0)
        return out


_scorer: list = [None, None]


def predict(docs: DataFrame, model, model_file: str) -> DataFrame:
    """(doc_id, lang_pred, score) of every text. The model's size is languages x vocabulary."""
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])
    langs = model[0]
    key = hashlib.sha256(model[2].tobytes() + repr(langs).encode()).hexdigest()
    held = docs.sparkSession.sparkContext.broadcast((*model, model_file))

    def run(batches):
        if _scorer[0] != key:
            _scorer[:] = [key, Scorer(held.value)]
        scorer = _scorer[1]
        for ids, texts in slices(batches):
            lang, score = ["und"] * len(texts), [0.0] * len(texts)
            some = [n for n, x in enumerate(texts) if langs and any(map(str.isalpha, x))]
            if some:
                logs = scorer.texts([texts[n] for n in some])
                best = logs.argmax(axis=1)
                sure = 1 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
                for n, k, s in zip(some, best.tolist(), sure.tolist(), strict=True):
                    lang[n], score[n] = langs[k], s
            yield batch(schema, ids, lang, score)

    return id_text(docs).mapInArrow(run, "doc_id long, lang_pred string, score double")


def held_out(doc_id):
    """The fold that is never learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def identify(docs: DataFrame, model_file: str) -> DataFrame:
    """Learns from the folds 0, 1 and 3 and predicts every document."""
    model = learn(docs.where(~held_out(docs["doc_id"])), model_file)
    out = predict(docs, model, model_file)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
