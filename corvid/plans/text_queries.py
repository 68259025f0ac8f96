"""Text, table and chunking queries with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvid.functions import text as tx
from corvid.session import table

from .registry import register

TOK = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')"
WORDS = r"list_filter(regexp_split_to_array(text, '[ \n\t]+'), lambda x: x <> '')"


def docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


def literals(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@register("io5_corpus", "SELECT doc_id AS id, source AS title, text, source || chr(10) || text AS contents FROM documents")
def io5(spark, d):
    return docs(spark, d).select(F.col("doc_id").alias("id"), F.col("source").alias("title"), "text", F.concat_ws("\n", "source", "text").alias("contents"))


@register("io6_head", "SELECT item_id AS id, text AS question FROM benchmark ORDER BY item_id LIMIT 10")
def io6(spark, d):
    return table(spark, d, "benchmark").orderBy("item_id").limit(10).select(F.col("item_id").alias("id"), F.col("text").alias("question"))


@register("tx1_whitespace", r"SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(replace(text || '  ' || chr(9) || 'x ', chr(9), ' '), ' +', ' ', 'g'), '(?m)^ ', '', 'g'), '(?m) $', '', 'g') AS out FROM documents")
def tx1(spark, d):
    return docs(spark, d).select("doc_id", tx.normalize_whitespace(F.concat("text", F.lit("  \tx "))).alias("out"))


@register("tx2_control", r"SELECT doc_id, text || 'ab' AS out FROM documents")
def tx2(spark, d):
    return docs(spark, d).select("doc_id", tx.remove_control_characters(F.concat("text", F.lit("\u0001a​\u007fb"))).alias("out"))


@register("tx3_nfkc")
def tx3(spark, d):
    return docs(spark, d).select("doc_id", tx.nfkc(F.concat("text", F.lit("ﬁ①"))).alias("out"))


@register("tx4_clean_flat", r"SELECT doc_id, trim(regexp_replace(regexp_replace(text, ' +', ' ', 'g'), '\n+', ' ', 'g')) AS out FROM documents")
def tx4(spark, d):
    return docs(spark, d).select("doc_id", tx.clean_text(F.col("text"), False).alias("out"))


_FOOT = "^(" + "|".join(tx.FOOTERS) + ")$"
_TX6 = r"""
WITH p AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', '', 'g'),
  '(?i)</(p|div|li|ul|h[1-6]|title|nav|footer|header)>|<br[^>]*>', chr(10), 'g'), '<[^>]+>', '', 'g') AS t FROM pages)
SELECT page_id, rtrim(array_to_string(list_filter(string_split(t, chr(10)), lambda x: NOT regexp_matches(lower(trim(x)), 'FOOT')), chr(10)), ' ') AS out FROM p
""".replace("FOOT", _FOOT)


@register("tx6_footer", _TX6)
def tx6(spark, d):
    return table(spark, d, "pages").select("page_id", tx.remove_footer(tx.page_text(F.col("html"))).alias("out"))


for _mode, _keep in tx.KEEP.items():

    def _tx7(spark, d, mode=_mode):
        return docs(spark, d).select("doc_id", tx.normalize_for_retrieval(F.col("text"), mode).alias("out"))

    register(f"tx7_{_mode}", rf"SELECT doc_id, trim(regexp_replace(regexp_replace(lower(text), '[^{_keep}]', ' ', 'g'), '\s+', ' ', 'g')) AS out FROM documents")(_tx7)


@register("tx5_title", r"SELECT page_id, trim(regexp_replace(regexp_replace(lower(regexp_replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '[.!?]{2,}$', '.')), '[^\p{L}0-9\s]', ' ', 'g'), '\s+', ' ', 'g')) AS out FROM pages")
def tx5(spark, d):
    return table(spark, d, "pages").select("page_id", tx.clean_title(F.regexp_extract("html", "<title>([^<]*)</title>", 1)).alias("out"))


_TX9 = """SELECT doc_id, array_to_string(list_filter(string_split(list_reduce(list_prepend('', string_split(text, chr(10))), lambda a, l: CASE WHEN trim(l) = '' THEN CASE WHEN string_split(a, chr(2))[-1] = '' THEN a ELSE a || chr(2) END
  WHEN string_split(a, chr(2))[-1] = '' THEN a || trim(l) WHEN length(string_split(a, chr(2))[-1]) < 50 THEN a || ' ' || trim(l) ELSE a || chr(2) || trim(l) END), chr(2)), lambda x: x <> ''), chr(10)) AS out FROM documents"""


@register("tx9_merge_paragraphs", _TX9)
def tx9(spark, d):
    return docs(spark, d).select("doc_id", tx.merge_short_paragraphs(F.col("text")).alias("out"))


@register("tx10_quality_gate", f"""
WITH w AS (SELECT doc_id, text, list_filter(regexp_split_to_array(lower(text), '[ \\n\\t]+'), lambda x: x <> '') AS w FROM documents)
SELECT coalesce(CASE WHEN trim(text) = '' THEN 'empty' WHEN length(trim(text)) < 10 THEN 'short' WHEN len(w) > 100 AND len(list_distinct(w)) < 0.1 * len(w) THEN 'repetition' END, 'ok') AS reason, count(*) AS n FROM w GROUP BY 1""")
def tx10(spark, d):
    return docs(spark, d).groupBy(F.coalesce(tx.quality_reason(F.col("text")), F.lit("ok")).alias("reason")).agg(F.count("*").alias("n"))


_TITLE = r"regexp_extract(text, '^([^.!?\n]{1,99})[.!?\n]', 1)"


@register("tx11_title_backfill", rf"SELECT doc_id, CASE WHEN {_TITLE} <> '' THEN trim({_TITLE}) END AS title, CASE WHEN {_TITLE} <> '' THEN trim(regexp_replace(text, '^([^.!?\n]{{1,99}})[.!?\n]', '')) ELSE text END AS body FROM documents")
def tx11(spark, d):
    """The first sentence becomes the title and leaves the text."""
    return docs(spark, d).select("doc_id", tx.first_sentence_title(F.col("text")).alias("title"), tx.without_title(F.col("text")).alias("body"))


@register("tx13_merge_pages", rf"SELECT source, title, sha256(string_agg(text, ' ' ORDER BY doc_id)) AS digest, count(*) AS n FROM (SELECT *, CASE WHEN {_TITLE} <> '' THEN trim({_TITLE}) ELSE 'untitled ' || doc_id END AS title FROM documents) GROUP BY source, title")
def tx13(spark, d):
    """Texts of one source and title as one page; a text without a title is a page of its own."""
    title = F.coalesce(tx.first_sentence_title(F.col("text")), F.concat(F.lit("untitled "), F.col("doc_id").cast("string")))
    ordered = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "text"))), lambda x: x["text"]), " ")
    return docs(spark, d).groupBy("source", title.alias("title")).agg(F.sha2(ordered, 256).alias("digest"), F.count("*").alias("n"))


@register("tx14_strip_html", r"SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '\s+', ' ', 'g')) AS out FROM pages")
def tx14(spark, d):
    return table(spark, d, "pages").select("page_id", tx.strip_html(F.col("html")).alias("out"))


NORM = r"array_to_string(list_filter(regexp_split_to_array(regexp_replace(lower({0}), '[[:punct:]]', '', 'g'), '\s+'), lambda x: x NOT IN ('', 'a', 'an', 'the')), ' ')"


@register("tx15_normalize_answer", f"SELECT item_id, {NORM.format('text')} AS out FROM benchmark")
def tx15(spark, d):
    return table(spark, d, "benchmark").select("item_id", tx.normalize_answer(F.col("text")).alias("out"))


@register("tx17_between", r"SELECT page_id, list_last(regexp_extract_all(html, '(?s)<li>(.*?)</li>', 1)) AS last, len(regexp_extract_all(html, '(?s)<li>(.*?)</li>', 1))::BIGINT AS n FROM pages")
def tx17(spark, d):
    return table(spark, d, "pages").select("page_id", tx.last_between(F.col("html"), "<li>", "</li>").alias("last"), F.size(tx.between(F.col("html"), "<li>", "</li>")).cast("long").alias("n"))


_LATIN = "abcdefghijklmnopqrstuvwxyz"
_CYRILLIC, _HAN = ("".join(chr(first + n) for n in range(26)) for first in (0x430, 0x4E00))


@register("tx18_language", rf"WITH t AS (SELECT lang, CASE doc_id % 3 WHEN 0 THEN text WHEN 1 THEN translate(text, '{_LATIN}', '{_CYRILLIC}') ELSE translate(text, '{_LATIN}', '{_HAN}') END AS t FROM documents), n AS (SELECT lang, len(regexp_extract_all(t, '\p{{L}}')) AS l, len(regexp_extract_all(t, '\p{{Han}}')) AS h, len(regexp_extract_all(t, '\p{{Cyrillic}}')) AS c FROM t) SELECT lang, CASE WHEN h * 2 > greatest(l, 1) THEN 'zh' WHEN c * 2 > greatest(l, 1) THEN 'ru' ELSE 'latin' END AS script, count(*) AS n FROM n GROUP BY ALL")
def tx18(spark, d):
    """Whole texts, a third with Cyrillic, a third with Han letters for a to z."""
    third, text = F.col("doc_id") % 3, F.col("text")
    t = F.when(third == 0, text).when(third == 1, F.translate(text, _LATIN, _CYRILLIC)).otherwise(F.translate(text, _LATIN, _HAN))
    return docs(spark, d).groupBy("lang", tx.script_language(t).alias("script")).agg(F.count("*").alias("n"))


@register("tx19_content_id", "SELECT sha256(text) AS id, min(doc_id) AS doc_id, count(*) AS n FROM documents GROUP BY 1")
def tx19(spark, d):
    return docs(spark, d).groupBy(tx.content_id(F.col("text")).alias("id")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))


_TABBED = "CASE doc_id % 4 WHEN 0 THEN text WHEN 1 THEN replace(text, ', ', chr(9)) WHEN 2 THEN replace(text, ', ', '  ') ELSE replace(text, '|', ' ') END"


@register("tb1_detect_table", rf"SELECT doc_id, len(list_filter(l, lambda x: regexp_matches(x, '\|.*\|'))) > 0 OR (len(l) >= 2 AND (len(list_filter(l[1:5], lambda x: contains(x, chr(9)))) >= 2 OR len(list_filter(l[1:5], lambda x: contains(x, '  '))) >= 2)) AS has_table FROM (SELECT doc_id, string_split({_TABBED}, chr(10)) AS l FROM documents)")
def tb1(spark, d):
    """Commas become tabs in a quarter of the texts, double spaces in another."""
    kind, c = F.col("doc_id") % 4, F.col("text")
    t = F.when(kind == 0, c).when(kind == 1, F.replace(c, F.lit(", "), F.lit("\t"))).when(kind == 2, F.replace(c, F.lit(", "), F.lit("  "))).otherwise(F.replace(c, F.lit("|"), F.lit(" ")))
    return docs(spark, d).select("doc_id", tx.detect_table(t).alias("has_table"))


@register("tb3_chunk_tables", r"SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)), lambda x: CASE WHEN contains(x, '|') THEN array_to_string(list_filter(list_transform(string_split(x, '|'), lambda y: trim(y)), lambda y: y <> ''), ' | ') ELSE x END), chr(10)) AS out FROM documents")
def tb3(spark, d):
    return docs(spark, d).select("doc_id", tx.keep_table_cells(F.col("text")).alias("out"))


@register("tb4_contexts")
def tb4c(spark, d):
    return docs(spark, d).select("doc_id", F.explode(tx.numeric_contexts("text")).alias("x")).select("doc_id", "x.kind", "x.value", "x.context")


@register("tb2_table_rows", r"""SELECT doc_id, array_to_string(list_transform(list_filter(string_split(text, chr(10)), lambda x: NOT (contains(x, '|') AND regexp_matches(x, '^[\|\s\-:]+$'))),
  lambda x: CASE WHEN contains(x, '|') THEN array_to_string(list_filter(list_transform(string_split(x, '|'), lambda y: trim(y)), lambda y: y <> ''), ' | ') ELSE trim(regexp_replace(x, '[\t ]+', ' ', 'g')) END), chr(10)) AS out FROM documents""")
def tb2(spark, d):
    return docs(spark, d).select("doc_id", tx.table_rows(F.col("text")).alias("out"))


_TB4 = " UNION ALL ".join(f"SELECT doc_id, '{k}' AS kind, unnest(regexp_extract_all(text, '{p}')) AS value FROM documents" for k, p in tx.NUMERIC)


@register("tb4_numerics", f"SELECT doc_id, kind, value, count(*) AS n FROM ({_TB4}) GROUP BY ALL")
def tb4(spark, d):
    one = docs(spark, d).select("doc_id", F.explode(tx.numerics(F.col("text"))).alias("x"))
    return one.groupBy("doc_id", F.col("x.kind").alias("kind"), F.col("x.value").alias("value")).agg(F.count("*").alias("n"))


_TERMS = ("license", "version", "email", "password", "token", "phone", "copyright", "software", "warranty", "liable", "notice", "permission")
_ABBREVIATIONS = {"de": "(of)", "la": "(the)", "en": "(in)", "el": "(the)", "que": "(that)", "und": "(and)", "der": "(the)", "le": "(the)", "et": "(and)"}
_SYNONYMS = {"the": ("this", "that", "these", "those"), "of": ("from", "off"), "and": ("plus", "also", "with", "both", "too", "as"), "de": ("von", "of"), "la": ("die",)}


@register("tb5_keywords", f"SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter({TOK}, lambda w: len(list_filter({list(_TERMS)}, lambda t: contains(w, t) OR contains(t, w))) > 0))), ',') AS keywords FROM documents")
def tb5(spark, d):
    """Tokens that hold a dictionary term or are part of one; the dictionary is a parameter."""
    return docs(spark, d).select("doc_id", F.array_join(tx.keywords(F.col("text"), _TERMS), ",").alias("keywords"))


_CASES = " ".join(f"WHEN '{k}' THEN '{k} {v}'" for k, v in _ABBREVIATIONS.items())


@register("tb6_abbreviations", rf"SELECT item_id, array_to_string(list_transform(regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_]+'), lambda x: CASE x {_CASES} ELSE x END), '') AS out FROM benchmark")
def tb6(spark, d):
    """Every abbreviation of the table, a parameter, with what it stands for behind it."""
    return table(spark, d, "benchmark").select("item_id", tx.expand_abbreviations(F.col("text"), _ABBREVIATIONS).alias("out"))


def _added(synonyms, critical=()):
    return "list_concat(" * (len(synonyms) - 1) + ", ".join(f"CASE WHEN list_contains({TOK}, '{k}') THEN {list(v[: 5 if k in critical else 3])} ELSE []::VARCHAR[] END{')' if n else ''}" for n, (k, v) in enumerate(synonyms.items()))


_ADDED, _TB8_ADDED = _added(_SYNONYMS, ("and",)), _added(_SYNONYMS)
_NUMBERED = "flatten(list_transform(nums, lambda x: CASE WHEN NOT contains(x, '.') AND NOT contains(x, ',') THEN CASE WHEN length(x) > 3 THEN [x || '.0', x || ',0', rtrim(reverse(regexp_replace(reverse(x), '([0-9]{3})', '\\1 ', 'g')))] ELSE [x || '.0', x || ',0'] END ELSE [translate(x, '.,', ',.'), regexp_extract(x, '^[0-9]+', 0)] END))"


@register("tb7_expand_query", rf"WITH q AS (SELECT item_id, text || ' 12 3,5 1234567' AS text, list_sort(list_distinct(regexp_extract_all(text || ' 12 3,5 1234567', '[0-9]+(?:[.,][0-9]+)?'))) AS nums FROM benchmark), a AS (SELECT item_id, text, list_concat({_ADDED}, {_NUMBERED}) AS more FROM q) SELECT item_id, list_sort(list_distinct(more)) AS added FROM a")
def tb7(spark, d):
    """What an expansion adds, in order of the words; the room for it is tested on fixtures."""
    text = F.concat("text", F.lit(" 12 3,5 1234567"))
    rows = table(spark, d, "benchmark").select("item_id", text.alias("text"), tx.expand_query(text, _SYNONYMS, ("and",), 1000, 100000).alias("wide"))
    more = F.substring(F.col("wide"), F.length("text") + 2, F.length("wide"))
    return rows.select("item_id", F.array_sort(F.array_distinct(F.split(F.regexp_replace(more, "1 234 567", "1_234_567"), " "))).alias("w")).select("item_id", F.array_sort(F.transform("w", lambda x: F.replace(x, F.lit("_"), F.lit(" ")))).alias("added"))


_ONCE = "list_filter({0}, lambda x, i: list_position({0}, x) = i)"


@register("tb8_prepare_query", rf"""WITH n AS (SELECT item_id, text, regexp_extract_all(text, '[0-9]+(?:[.,][0-9]+)?') AS l FROM asked), q AS (SELECT item_id, text, {_ONCE.format("l")} AS nums FROM n),
a AS (SELECT item_id, text, list_concat({_TB8_ADDED}, {_NUMBERED}) AS l FROM q), b AS (SELECT item_id, text, {_ONCE.format("l")}[1:40] AS l FROM a),
w AS (SELECT item_id, text, list_filter(['the', 'of', 'de'], lambda k: list_contains({TOK}, k))[1:2] AS k, list_reduce(list_prepend(text, l), lambda u, x: CASE WHEN length(u) + 1 + length(x) <= length(text) + 200 THEN u || ' ' || x ELSE u END) AS wide FROM b),
z AS (SELECT item_id, text, CASE WHEN len({WORDS.replace("text", "wide")}) < 30 AND len(k) > 0 THEN wide || ' ' || array_to_string(k, ' ') ELSE wide END AS wide FROM w)
SELECT item_id, coalesce(nullif(trim(regexp_replace(regexp_replace(lower(wide), '[^\p{{L}}0-9\s]', ' ', 'g'), '\s+', ' ', 'g')), ''), text) AS query FROM z""".replace("FROM asked", "FROM (SELECT item_id, text || ' ' || item_id || ',5 ' || (item_id * 1009) AS text FROM benchmark)"))
def tb8(spark, d):
    """Queries, each asking for two numbers more, with synonyms and the numbers' other writings; important terms are repeated in short ones."""
    asked = F.concat("text", F.lit(" "), "item_id", F.lit(",5 "), F.col("item_id") * 1009)
    return table(spark, d, "benchmark").select("item_id", tx.prepared_query(asked, _SYNONYMS, ("the", "of", "de")).alias("query"))


@register("tb9_numeric_query", r"SELECT doc_id, regexp_matches(text, '[0-9]') OR regexp_matches(lower(text), '\b(rate|percent|limit|price|cost|fee|amount|tariff)\b') AS numeric FROM documents")
def tb9(spark, d):
    return docs(spark, d).select("doc_id", tx.is_numeric_query(F.col("text")).alias("numeric"))


@register("ch2_word_chunks", f"""
WITH w AS (SELECT doc_id, {WORDS} AS w FROM documents)
SELECT doc_id, k AS chunk, array_to_string(w[k * 100 + 1 : k * 100 + 100], ' ') AS text FROM (SELECT doc_id, w, unnest(generate_series(0, ((len(w) - 1) // 100)::BIGINT)) AS k FROM w WHERE len(w) > 0)""")
def ch2(spark, d):
    return chunks(docs(spark, d), 100, 0)


def chunks(frame, size, overlap):
    """Word chunks with overlap as (doc_id, chunk, text); each but the first repeats `overlap` words."""
    w = frame.select("doc_id", tx.words(F.col("text")).alias("w")).where(F.size("w") > 0)
    made = tx.windows(F.col("w"), size, size - overlap)
    return w.select("doc_id", F.posexplode(made).alias("chunk", "part")).select("doc_id", F.col("chunk").cast("long").alias("chunk"), F.array_join("part", " ").alias("text"))


@register("ch1_token_chunks_overlap", f"""
WITH w AS (SELECT doc_id, {WORDS} AS w FROM documents)
SELECT doc_id, k AS chunk, array_to_string(w[k * 40 + 1 : k * 40 + 50], ' ') AS text
FROM (SELECT doc_id, w, unnest(generate_series(0, greatest(0, ceil((len(w) - 50) / 40.0))::BIGINT)) AS k FROM w WHERE len(w) > 0)""")
def ch1(spark, d):
    return chunks(docs(spark, d), 50, 10)


SENT = r"list_filter(string_split(regexp_replace(text, '([.!?])[ \n]+', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x) <> '')"


def plain_sentences(c):
    return F.filter(F.split(F.regexp_replace(c, r"([.!?])[ \n]+", "$1\u0001"), "\u0001"), lambda x: F.trim(x) != "")


@register("ch5_sentence_windows", f"""
WITH s AS (SELECT doc_id, {SENT} AS s FROM documents)
SELECT doc_id, k AS segment, array_to_string(s[k * 2 + 1 : k * 2 + 3], ' ') AS text
FROM (SELECT doc_id, s, unnest(generate_series(0, greatest(0, ceil((len(s) - 3) / 2.0))::BIGINT)) AS k FROM s WHERE len(s) > 0)""")
def ch5(spark, d):
    s = docs(spark, d).select("doc_id", plain_sentences(F.col("text")).alias("s")).where(F.size("s") > 0)
    return s.select("doc_id", F.posexplode(tx.windows(F.col("s"), 3, 2)).alias("segment", "part")).select("doc_id", F.col("segment").cast("long").alias("segment"), F.array_join("part", " ").alias("text"))


_CH3 = f"""WITH s AS (SELECT doc_id, {SENT} AS s FROM documents),
f AS (SELECT doc_id, string_split(list_reduce(s, lambda a, x: CASE WHEN len(list_filter(regexp_split_to_array(string_split(a, chr(2))[-1], '[ \n\t]+'), lambda y: y <> '')) + len(list_filter(regexp_split_to_array(x, '[ \n\t]+'), lambda y: y <> '')) <= 60 THEN a || ' ' || x ELSE a || chr(2) || x END), chr(2)) AS c FROM s WHERE len(s) > 0)
SELECT doc_id, (generate_subscripts(c, 1) - 1)::BIGINT AS chunk, unnest(c) AS text FROM f"""


@register("ch3_sentence_chunks", _CH3)
def ch3(spark, d):
    """Whole sentences packed up to 60 words: a fold over the sentence array."""
    s = docs(spark, d).select("doc_id", plain_sentences(F.col("text")).alias("s"))
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))
    size = lambda x: F.size(tx.words(x))
    step = lambda a, x: F.when(a["open"] == "", F.struct(a["done"].alias("done"), x.alias("open"))).when(size(a["open"]) + size(x) <= 60, F.struct(a["done"].alias("done"), F.concat(a["open"], F.lit(" "), x).alias("open"))).otherwise(F.struct(F.concat(a["done"], F.array(a["open"])).alias("done"), x.alias("open")))
    parts = F.aggregate("s", start, step, lambda a: F.when(a["open"] != "", F.concat(a["done"], F.array(a["open"]))).otherwise(a["done"]))
    return s.select("doc_id", F.posexplode(parts).alias("chunk", "text")).withColumn("chunk", F.col("chunk").cast("long"))


@register("ch6_wrapped_segments", f"""
WITH w AS (SELECT doc_id, {WORDS} AS w FROM documents)
SELECT doc_id, k AS segment, array_to_string(list_concat(w, w[1 : 100])[k * 100 + 1 : k * 100 + 100], ' ') AS text
FROM (SELECT doc_id, w, unnest(generate_series(0, ((len(w) - 1) // 100)::BIGINT)) AS k FROM w WHERE len(w) > 0)""")
def ch6(spark, d):
    """100-word segments; the last is filled from the document's start."""
    w = docs(spark, d).select("doc_id", tx.words(F.col("text")).alias("w")).where(F.size("w") > 0)
    ring, n = F.concat("w", F.slice("w", 1, 100)), F.ceil(F.size("w") / 100).cast("int")
    return w.select("doc_id", F.posexplode(F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.array_join(F.slice(ring, k * 100 + 1, 100), " "))).alias("segment", "text")).withColumn("segment", F.col("segment").cast("long"))


_LINES = "SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents"
_LEVEL = r"CASE WHEN regexp_matches(line, '^#{1,3} ') THEN length(regexp_extract(line, '^(#+)', 1)) WHEN length(line) BETWEEN 4 AND 99 AND line = upper(line) AND line <> lower(line) THEN 2 WHEN length(line) < 80 AND line LIKE '%:' THEN 3 END"


def heading_level(line):
    return (
        F.when(line.rlike("^#{1,3} "), F.length(F.regexp_extract(line, "^(#+)", 1)))
        .when(F.length(line).between(4, 99) & (line == F.upper(line)) & (line != F.lower(line)), F.lit(2))
        .when((F.length(line) < 80) & line.endswith(":"), F.lit(3))
    )


def lines_of(spark, d):
    marked = F.concat(F.lit("# Top\n"), "text", F.lit("\nNOTES ON IT\nend:\ntail"))
    return docs(spark, d).select("doc_id", F.posexplode(F.split(marked, "\n")).alias("pos", "line"))


_MARKED = _LINES.replace("string_split(text, chr(10))", "string_split('# Top' || chr(10) || text || chr(10) || 'NOTES ON IT' || chr(10) || 'end:' || chr(10) || 'tail', chr(10))")


@register("ch7_headings", f"SELECT doc_id, pos::BIGINT AS pos, ({_LEVEL})::BIGINT AS level FROM ({_MARKED}) WHERE ({_LEVEL}) IS NOT NULL")
def ch7(spark, d):
    return lines_of(spark, d).select("doc_id", F.col("pos").cast("long").alias("pos"), heading_level(F.col("line")).cast("long").alias("level")).where("level IS NOT NULL")


@register("ch8_segments", f"""
WITH l AS (SELECT *, ({_LEVEL}) IS NOT NULL AS head, regexp_matches(line, '\\|.*\\|') AS tab FROM ({_MARKED})),
b AS (SELECT *, CASE WHEN head OR (tab <> coalesce(lag(tab) OVER (PARTITION BY doc_id ORDER BY pos), false)) THEN 1 ELSE 0 END AS cut FROM l),
s AS (SELECT *, sum(cut) OVER (PARTITION BY doc_id ORDER BY pos) AS segment FROM b)
SELECT doc_id, segment::BIGINT AS segment, string_agg(line, chr(10) ORDER BY pos) AS text, bool_or(tab) AS has_table FROM s GROUP BY doc_id, segment""")
def ch8(spark, d):
    """New segment at a heading and where a table starts or ends: a running sum of boundaries."""
    from pyspark.sql import Window

    w = Window.partitionBy("doc_id").orderBy("pos")
    l = lines_of(spark, d).withColumn("head", heading_level(F.col("line")).isNotNull()).withColumn("tab", F.col("line").rlike(r"\|.*\|"))
    b = l.withColumn("cut", (F.col("head") | (F.col("tab") != F.coalesce(F.lag("tab").over(w), F.lit(False)))).cast("long"))
    s = b.withColumn("segment", F.sum("cut").over(w))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), "\n")
    return s.groupBy("doc_id", "segment").agg(joined.alias("text"), F.bool_or("tab").alias("has_table"))


@register("ch10_title_split", "SELECT doc_id, split_part(text, chr(10), 1) AS title, CASE WHEN contains(text, chr(10)) THEN substr(text, strpos(text, chr(10)) + 1) END AS body FROM documents")
def ch10(spark, d):
    two = F.split("text", "\n", 2)
    return docs(spark, d).select("doc_id", two[0].alias("title"), F.try_element_at(two, F.lit(2)).alias("body"))


@register("ds2_split_merge", "SELECT item_id, CASE WHEN length(text) > 200 THEN 'long' ELSE 'short' END AS part FROM benchmark")
def ds2(spark, d):
    b = table(spark, d, "benchmark")
    long = F.length("text") > 200
    return b.where(long).select("item_id", F.lit("long").alias("part")).unionByName(b.where(~long).select("item_id", F.lit("short").alias("part")))


@register("pr5_history", "SELECT conv_id, turn, string_agg(role || ': ' || text, chr(10)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS history FROM conversations")
def pr5(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    return table(spark, d, "conversations").select("conv_id", "turn", F.array_join(F.collect_list(F.concat("role", F.lit(": "), "text")).over(w), "\n").alias("history"))


@register("pr3_truncate", f"SELECT doc_id, CASE WHEN len(w) <= 60 THEN array_to_string(w, ' ') ELSE array_to_string(list_concat(w[1:30], w[len(w) - 29:len(w)]), ' ') END AS out FROM (SELECT doc_id, {WORDS} AS w FROM documents)")
def pr3(spark, d):
    w = tx.words(F.col("text"))
    return docs(spark, d).select("doc_id", w.alias("w")).select("doc_id", F.when(F.size("w") <= 60, F.array_join("w", " ")).otherwise(F.array_join(F.concat(F.slice("w", 1, 30), F.slice("w", -30, 30)), " ")).alias("out"))


def triples(frame):
    """Explodes <head; relation; tail> blocks; malformed ones are skipped."""
    p = "^(.*);([^;]*);([^;]*)$"
    x = frame.withColumn("x", F.explode(F.regexp_extract_all("text", F.lit("<([^>]*)>"), F.lit(1)))).where(F.col("x").rlike(p))
    return x.select(*frame.columns, *[F.trim(F.regexp_extract("x", p, n)).alias(c) for n, c in enumerate(("head", "relation", "tail"), 1)])
