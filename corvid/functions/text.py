"""Column -> Column text functions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = r"[\p{L}\p{N}_]{2,}"
#: Patterns of footer lines, each for a whole trimmed line in lower case: a sentence that mentions one of them stays.
FOOTERS = (
    r"(©|&copy;|\(c\)|copyright).*",
    r".{0,60}(all )?rights reserved\.?",
    r"(privacy|cookie) (policy|notice|settings)( [|·-].*)?\.?",
    r"terms (of|and) (use|service|conditions)( [|·-].*)?\.?",
    r"(we use|this site uses) cookies.{0,80}",
    r"(subscribe|sign up)( (to|for) (our )?(newsletter|updates))?[.!]?",
    r"(contact|about) us( [|·-].*)?[.!]?",
    r"powered by .{1,40}",
    r"follow us( on .{1,40})?[.!]?",
)


def normalize_whitespace(c: Column) -> Column:
    """Tabs to spaces, runs of spaces to one, lines trimmed; line feeds stay."""
    c = F.regexp_replace(F.regexp_replace(c, "\t", " "), " +", " ")
    return F.regexp_replace(c, "(?m)^ | $", "")


def remove_control_characters(c: Column) -> Column:
    return F.regexp_replace(c, r"[\p{C}&&[^\n\t\r]]", "")


@F.pandas_udf(T.StringType())
def nfkc(s: pd.Series) -> pd.Series:
    return s.str.normalize("NFKC")


def clean_text(c: Column, preserve_structure: bool = True, unicode: bool = True) -> Column:
    c = normalize_whitespace(remove_control_characters(nfkc(c) if unicode else c))
    c = F.regexp_replace(c, "[​-‏‪-‮﻿]", "")
    c = F.regexp_replace(c, "\n{3,}", "\n\n") if preserve_structure else F.regexp_replace(c, "\n+", " ")
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def remove_footer(c: Column, patterns=FOOTERS) -> Column:
    """Lines that a footer pattern matches whole go; blank lines stay."""
    rule = "^(" + "|".join(patterns) + ")$"
    return F.rtrim(F.array_join(F.filter(F.split(c, "\n"), lambda x: ~F.lower(F.trim(x)).rlike(rule)), "\n"))


KEEP = {"aggressive": r"\p{L}\s", "default": r"\p{L}0-9\s", "smart": r"\p{L}0-9\s|%.,\-"}


def normalize_for_retrieval(c: Column, mode: str = "default") -> Column:
    c = F.regexp_replace(F.lower(c), f"[^{KEEP[mode]}]", " ")
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def clean_title(c: Column) -> Column:
    return normalize_for_retrieval(F.regexp_replace(clean_text(c, False, False), r"[.!?]{2,}$", "."))


def strip_html(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]+>", ""), r"\s+", " "))


def page_text(c: Column) -> Column:
    """Visible text of a page: scripts and styles go, block ends become line feeds."""
    c = F.regexp_replace(c, r"(?is)<(script|style)[^>]*>.*?</(script|style)>", "")
    return F.regexp_replace(F.regexp_replace(c, r"(?i)</(p|div|li|ul|h[1-6]|title|nav|footer|header)>|<br[^>]*>", "\n"), "<[^>]+>", "")


def tokens(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(WORD), F.lit(0))


# The usual short list of English stop words.
STOP_WORDS = ("a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into", "is", "it", "no", "not", "of", "on", "or", "such", "that", "the", "their", "then", "there", "these", "they", "this", "to", "was", "will", "with")


def plural_stem(c: Column) -> Column:
    """Harman's S stemmer: ies to y, es to e, a last s dropped, with its exceptions; in expressions."""
    cut = lambda x, n: F.substring(x, F.lit(1), F.length(x) - n)
    return F.when(c.rlike("[^ea]ies$"), F.concat(cut(c, 3), F.lit("y"))).when(c.rlike("[^aeo]es$"), cut(c, 1)).when(c.rlike("[^us]s$"), cut(c, 1)).otherwise(c)


def analyzed(c: Column, stop=STOP_WORDS, stem=plural_stem) -> Column:
    """Tokens without stop words, each through `stem`, any function of a column."""
    kept = F.filter(tokens(c), lambda x: ~x.isin(*stop)) if stop else tokens(c)
    return F.transform(kept, stem) if stem else kept


# The entities and, in order, the separations of the mteval-v13a tokenizer: symbols; a
# period or comma that no digit precedes, or none follows; a dash behind a digit.
MTEVAL_ENTITIES = (("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"))
MTEVAL_RULES = ((r"([\x20-\x26\x28-\x2B\x2F\x3A-\x40\x5B-\x60\x7B-\x7E])", r" $1 "), (r"([^0-9])([.,])", r"$1 $2 "), (r"([.,])([^0-9])", r" $1 $2"), (r"([0-9])(-)", r"$1 $2 "))


def mteval_tokens(c: Column) -> Column:
    """Tokens as machine translation scores count them; case is kept, words over a line's end are joined."""
    for mark, value in (("<skipped>", ""), ("-\n", ""), ("\n", " "), *MTEVAL_ENTITIES):
        c = F.replace(c, F.lit(mark), F.lit(value))
    c = F.concat(F.lit(" "), c, F.lit(" "))
    for pattern, value in MTEVAL_RULES:
        c = F.regexp_replace(c, pattern, value)
    return F.filter(F.split(c, r"(?U)\s+"), lambda x: x != "")


def words(c: Column) -> Column:
    return F.filter(F.split(c, r"[ \n\t]+"), lambda x: x != "")


def quality_reason(text: Column, title: Column | None = None) -> Column:
    """Why a document is rejected, or null."""
    w = words(F.lower(text))
    empty = F.trim(F.coalesce(text, F.lit(""))) == ""
    if title is not None:
        empty = empty & (F.trim(F.coalesce(title, F.lit(""))) == "")
    return (
        F.when(empty, "empty")
        .when(F.length(F.trim(text)) < 10, "short")
        .when((F.size(w) > 100) & (F.size(F.array_distinct(w)) < 0.1 * F.size(w)), "repetition")
    )


_TITLE = r"^([^.!?\n]{1,99})[.!?\n]"


def first_sentence_title(text: Column) -> Column:
    first = F.regexp_extract(text, _TITLE, 1)
    return F.when(first != "", F.trim(first))


def without_title(text: Column) -> Column:
    """The text without the sentence that first_sentence_title() makes its title."""
    return F.when(F.regexp_extract(text, _TITLE, 1) != "", F.trim(F.regexp_replace(text, _TITLE, ""))).otherwise(text)


def merge_short_paragraphs(c: Column, least: int = 50) -> Column:
    """Appends a line to the current one while that is shorter than `least`; a blank line ends it."""
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))

    def step(acc, line):
        flush = F.when(acc["open"] != "", F.concat(acc["done"], F.array(acc["open"]))).otherwise(acc["done"])
        trimmed = F.trim(line)
        return (
            F.when(trimmed == "", F.struct(flush.alias("done"), F.lit("").alias("open")))
            .when(acc["open"] == "", F.struct(acc["done"].alias("done"), trimmed.alias("open")))
            .when(F.length(acc["open"]) < least, F.struct(acc["done"].alias("done"), F.concat(acc["open"], F.lit(" "), trimmed).alias("open")))
            .otherwise(F.struct(flush.alias("done"), trimmed.alias("open")))
        )

    end = lambda acc: F.array_join(F.when(acc["open"] != "", F.concat(acc["done"], F.array(acc["open"]))).otherwise(acc["done"]), "\n")
    return F.aggregate(F.split(c, "\n"), start, step, end)


ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&amp;": "&"}


def wiki_clean(c: Column) -> Column:
    """Entities, templates, references, files, links, headings and emphasis of wiki markup."""
    for name, value in ENTITIES.items():
        c = F.replace(c, F.lit(name), F.lit(value))
    for pattern, value in (
        (r"(?s)<!--.*?-->", ""), (r"(?is)<ref[^>/]*/>|<ref[^>]*>.*?</ref>", ""), (r"\{\{[^{}]*\}\}", ""), (r"\{\|[^{}]*\|\}", ""),
        (r"(?i)\[\[(file|image|category):[^\[\]]*\]\]", ""), (r"\[\[[^\[\]|]*\|([^\[\]]*)\]\]", "$1"), (r"\[\[([^\[\]]*)\]\]", "$1"),
        (r"\[https?://[^ \]]+ ([^\]]*)\]", "$1"), (r"'{2,}", ""), (r"(?m)^=+ *(.*?) *=+$", "$1"), (r"<[^>]+>", ""), (r"[ \t]+", " "),
    ):
        c = F.regexp_replace(c, pattern, value)
    return F.trim(c)


def is_wiki_stub(title: Column, text: Column) -> Column:
    return F.coalesce(title.rlike(r"(?i)\(disambiguation\)|^(list|index|outline) of "), F.lit(False)) | F.coalesce(text.rlike(r"(?i)^\s*#redirect"), F.lit(False))


PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def normalize_answer(c: Column) -> Column:
    """Lower case, no ASCII punctuation, no articles, single spaces; in this order."""
    parts = F.split(F.translate(F.lower(c), PUNCTUATION, ""), r"\s+")
    return F.array_join(F.filter(parts, lambda x: ~x.isin("", "a", "an", "the")), " ")


def between(c: Column, start: str, end: str) -> Column:
    """All shortest captures between two literals."""
    return F.regexp_extract_all(c, F.lit(rf"(?s)\Q{start}\E(.*?)\Q{end}\E"), F.lit(1))


def last_between(c: Column, start: str, end: str) -> Column:
    return F.try_element_at(between(c, start, end), F.lit(-1))


def script_language(c: Column) -> Column:
    """zh, ru or latin by the share of letters of each script."""
    n = F.greatest(F.regexp_count(c, F.lit(r"\p{L}")), F.lit(1))
    return F.when(F.regexp_count(c, F.lit(r"\p{IsHan}")) * 2 > n, "zh").when(F.regexp_count(c, F.lit(r"\p{IsCyrillic}")) * 2 > n, "ru").otherwise("latin")


def content_id(c: Column) -> Column:
    return F.sha2(c, 256)


def detect_table(c: Column) -> Column:
    lines = F.split(c, "\n")
    head = F.slice(lines, 1, 5)
    some = lambda mark: (F.size(lines) >= 2) & (F.size(F.filter(head, lambda x: F.contains(x, F.lit(mark)))) >= 2)
    return F.exists(lines, lambda x: x.rlike(r"\|.*\|")) | some("\t") | some("  ")


def table_rows(c: Column) -> Column:
    """Lines with cells re-joined by ' | '; separator rows go; other lines keep single spaces."""
    cells = lambda x: F.filter(F.transform(F.split(x, r"\|"), lambda y: F.trim(y)), lambda y: y != "")
    kept = F.filter(F.split(c, "\n"), lambda x: ~(F.contains(x, F.lit("|")) & x.rlike(r"^[\|\s\-:]+$")))
    return F.array_join(F.transform(kept, lambda x: F.when(F.contains(x, F.lit("|")), F.array_join(cells(x), " | ")).otherwise(F.trim(F.regexp_replace(x, r"[\t ]+", " ")))), "\n")


NUMERIC = (("rate", r"[0-9]+(?:[.,][0-9]+)?\s?(?:per|pro|par|por|/)\s?[a-z]+"), ("currency", r"[$€£]\s?[0-9]+(?:[.,][0-9]+)?"), ("percentage", r"[0-9]+(?:[.,][0-9]+)?\s?%"), ("date", r"[0-9]{1,2}[./][0-9]{1,2}[./][0-9]{2,4}"), ("large_number", r"[0-9]{4,}"))


def numerics(c: Column) -> Column:
    """array<struct<kind, value>> in order of the families."""

    def family(kind, pattern):
        return F.transform(F.regexp_extract_all(c, F.lit(f"({pattern})"), F.lit(1)), lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value")))

    return F.concat(*[family(kind, pattern) for kind, pattern in NUMERIC])


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("kind", "value", "context")])))
def numeric_contexts(s: pd.Series) -> pd.Series:
    """The numerics with up to 20 characters of text on either side; expressions can't tell positions."""
    import regex

    rules = [(kind, regex.compile(p)) for kind, p in NUMERIC]
    return pd.Series([[{"kind": k, "value": m[0], "context": t[max(0, m.start() - 20) : m.end() + 20]} for k, r in rules for m in r.finditer(t)] if t is not None else None for t in s])


def keep_table_cells(c: Column) -> Column:
    """Table lines of a chunk with their cells re-joined; all other lines as they are."""
    cells = lambda x: F.filter(F.transform(F.split(x, r"\|"), lambda y: F.trim(y)), lambda y: y != "")
    return F.array_join(F.transform(F.split(c, "\n"), lambda x: F.when(F.contains(x, F.lit("|")), F.array_join(cells(x), " | ")).otherwise(x)), "\n")


def keywords(c: Column, terms: tuple[str, ...], stop=()) -> Column:
    """The tokens that equal a dictionary term, hold one, or are part of one; each once, in order."""
    table = F.array(*map(F.lit, terms))
    near = lambda w: F.exists(table, lambda t: (w == t) | F.contains(w, t) | F.contains(t, w))
    some = lambda w: (F.length(w) >= 2) & (~w.isin(*stop) if stop else F.lit(True)) & near(w)
    return F.array_sort(F.array_distinct(F.filter(tokens(c), some)))


def number_variants(c: Column) -> Column:
    """Other writings of a text's numbers: decimal point and comma exchanged, whole numbers with a zero behind, groups of thousands."""
    numbers = F.array_distinct(F.regexp_extract_all(c, F.lit(r"[0-9]+(?:[.,][0-9]+)?"), F.lit(0)))

    def forms(x):
        whole = x.rlike("^[0-9]+$")
        swapped = F.translate(x, ".,", ",.")
        grouped = F.regexp_replace(x, r"(?<=[0-9])(?=(?:[0-9]{3})+$)", " ")
        return F.when(whole & (F.length(x) > 3), F.array(F.concat(x, F.lit(".0")), F.concat(x, F.lit(",0")), grouped)).when(whole, F.array(F.concat(x, F.lit(".0")), F.concat(x, F.lit(",0")))).otherwise(F.array(swapped, F.regexp_extract(x, "^[0-9]+", 0)))

    return F.flatten(F.transform(numbers, forms))


def expand_query(c: Column, synonyms: dict[str, tuple[str, ...]], critical: tuple[str, ...] = (), extra_words: int = 40, extra_chars: int = 200) -> Column:
    """A query with synonyms of its terms (three, or five of critical ones) and variants of its numbers behind it.

    At most so many further words are added, and none that would pass so many further characters.
    """
    own = tokens(c)
    added = [F.when(F.array_contains(own, term), F.array(*map(F.lit, words_[: 5 if term in critical else 3]))).otherwise(F.array().cast("array<string>")) for term, words_ in synonyms.items()]
    more = F.slice(F.array_distinct(F.concat(*added, number_variants(c))), 1, extra_words)
    start = F.struct(c.alias("text"), F.length(c).alias("size"))
    room = lambda a, w: F.length(a["text"]) + 1 + F.length(w) <= a["size"] + extra_chars
    return F.aggregate(more, start, lambda a, w: F.when(room(a, w), F.struct(F.concat(a["text"], F.lit(" "), w).alias("text"), a["size"].alias("size"))).otherwise(a), lambda a: a["text"])


def prepared_query(c: Column, synonyms: dict[str, tuple[str, ...]], important: tuple[str, ...], mode: str = "default") -> Column:
    """Expanded, up to two important keywords repeated in queries under 30 words, normalised; a blank one is a space, one that
    normalising empties stays as it was."""
    wide = expand_query(c, synonyms)
    again = F.slice(F.filter(F.array(*map(F.lit, important)).cast("array<string>"), lambda k: F.array_contains(tokens(c), k)), 1, 2)
    wide = F.when((F.size(words(wide)) < 30) & (F.size(again) > 0), F.concat_ws(" ", wide, F.array_join(again, " "))).otherwise(wide)
    norm = normalize_for_retrieval(wide, mode)
    return F.when(F.trim(c) == "", F.lit(" ")).when(norm == "", c).otherwise(norm)


def is_numeric_query(c: Column) -> Column:
    return c.rlike(r"[0-9]") | F.lower(c).rlike(r"\b(rate|percent|limit|price|cost|fee|amount|tariff)\b")


def expand_abbreviations(c: Column, table: dict[str, str]) -> Column:
    """Every abbreviation, taken literally, that stands alone, with what it stands for behind it."""
    for short, long in table.items():
        both = f"{short} {long}".replace("\\", "\\\\").replace("$", "\\$")
        c = F.regexp_replace(c, rf"(?<![\p{{L}}\p{{N}}_])\Q{short}\E(?![\p{{L}}\p{{N}}_])", both)
    return c


def sentences(c: Column) -> Column:
    """Sentences that end in . ! or ? before white space and an upper-case letter, or any ! or ?."""
    marked = F.regexp_replace(c, r"([!?])[ \n]+|([.])[ \n]+(?=\p{Lu})", "$1$2\u0001")
    return F.filter(F.split(marked, "\u0001"), lambda x: F.trim(x) != "")


def windows(array: Column, size: int, stride: int) -> Column:
    """Windows every `stride` items; the first that reaches the end is the last."""
    last = F.greatest(F.lit(0), F.ceil((F.size(array) - size) / stride).cast("int"))
    return F.when(F.size(array) > 0, F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(array, k * stride + 1, size))).otherwise(F.array().cast("array<array<string>>"))


_encoders: dict = {}


def token_windows(c: Column, vocabulary: str, size: int, overlap: int = 0) -> Column:
    """array<string>: a text's windows of `size` tokens of a vocabulary file, each but the first repeating `overlap` tokens.

    Cut at the tokens' places in the text, so a window is a piece of it; a character of several
    tokens goes to the window of its first token.
    """

    @F.pandas_udf("array<string>")
    def cut(s: pd.Series) -> pd.Series:
        if vocabulary not in _encoders:
            from tokenizers import Tokenizer

            _encoders[vocabulary] = Tokenizer.from_file(vocabulary)
        out = []
        for text in s:
            spots = _encoders[vocabulary].encode(text or "", add_special_tokens=False).offsets
            starts = [a for a, _ in spots] + [len(text or "")]
            last = max(0, -(-(len(spots) - size) // (size - overlap)))
            out.append([text[starts[k * (size - overlap)] : starts[min(k * (size - overlap) + size, len(spots))]] for k in range(last + 1)] if spots else [])
        return pd.Series(out)

    return cut(c)
