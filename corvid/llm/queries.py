"""The operators' queries, each over the whole of its table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from corvid.session import table

from . import bytebpe, fertility, filteraudit, hierbayes, jaccard, langid, linededup, ngramlm, packing, rolling, sentencepieces, suffixdedup, tiff

PIECES = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN


def op1_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER, PATTERN)


def op2_langid(spark, sf_dir):
    return langid.identify(table(spark, sf_dir, "documents"), PIECES)


def op3_fertility(spark, sf_dir):
    judged = fertility.rules(table(spark, sf_dir, "documents"), PIECES, RANKS, PATTERN)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_tokens", *fertility.MEASURES)


def op4_line_dedup(spark, sf_dir):
    return linededup.dedup(table(spark, sf_dir, "documents"))


def op5_lm_scoring(spark, sf_dir):
    return ngramlm.score(table(spark, sf_dir, "documents"))


def op6_jaccard(spark, sf_dir):
    return jaccard.join(table(spark, sf_dir, "documents"))


def op7_quality(spark, sf_dir):
    """Host: the source; path: the source's documents of one language. kept: good quality and not toxic."""
    docs = table(spark, sf_dir, "documents")
    found = hierbayes.classify(docs, table(spark, sf_dir, "labels"), docs["source"], F.concat_ws("/", docs["source"], docs["lang"]), ["quality", "toxic"])
    return found.select("doc_id", "quality", "toxic", "quality_doc", "quality_host", "quality_path", "toxic_doc", "toxic_host", "toxic_path", (F.col("toxic") >= 0.5).alias("is_toxic"), ((F.col("quality") >= 0.5) & (F.col("toxic") < 0.5)).alias("kept"))


def op8_suffix_dedup(spark, sf_dir):
    return suffixdedup.dedup(table(spark, sf_dir, "documents"))


def op9_byte_bpe(spark, sf_dir):
    return bytebpe.digests(table(spark, sf_dir, "documents"), RANKS, PATTERN)


def op10_tiff(spark, sf_dir):
    return tiff.round_trip(table(spark, sf_dir, "documents"))


def op11_sentencepiece(spark, sf_dir):
    return sentencepieces.digests(table(spark, sf_dir, "documents"), PIECES)


def op12_filter_audit(spark, sf_dir):
    return filteraudit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_rolling(spark, sf_dir):
    return rolling.rolling(table(spark, sf_dir, "documents"))


def queries():
    own = (op1_packing, op2_langid, op3_fertility, op4_line_dedup, op5_lm_scoring, op6_jaccard, op7_quality, op8_suffix_dedup, op9_byte_bpe, op10_tiff)
    return {f.__name__: f for f in (*own, op11_sentencepiece, op12_filter_audit, op13_rolling)}


#: A document's eligible keys, and those of five documents or more.
_OP4 = r"""
WITH lines AS (
  SELECT doc_id, line, pos,
         lower(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')) AS any_case,
         translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents)),
heavy AS (
  SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
SELECT l.doc_id, count(*) AS n_lines, count(*) FILTER (WHERE h.key IS NOT NULL AND h.keeper <> l.doc_id) AS n_dropped,
       sha256(coalesce(string_agg(CASE WHEN h.key IS NOT NULL AND h.keeper <> l.doc_id THEN NULL ELSE line END, chr(10) ORDER BY pos), '')) AS kept_sha256
FROM lines l LEFT JOIN heavy h ON l.key = h.key
GROUP BY l.doc_id
"""


#: A mask of failed filters for each document, counted by part, and all orders of the five letters.
_OP12 = r"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS x, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
known AS (SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS bad FROM labels GROUP BY doc_id),
failed AS (
  SELECT doc_id, part,
         CASE WHEN len(w) < 100 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(x, '[^A-Z]+', '', 'g')) > 10 * length(x) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(x, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY x) THEN 16 ELSE 0 END AS mask
  FROM texts),
counted AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS g, count(*) FILTER (WHERE bad) AS t
  FROM failed LEFT JOIN known USING (doc_id) GROUP BY part, mask),
letters(l, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
steps AS (
  SELECT filter_order, CAST(s AS INTEGER) AS step, bits[s] AS bit, coalesce(list_sum(bits[1:s - 1]), 0) AS before FROM orders, range(1, 6) r(s))
SELECT part, filter_order, step,
       CAST(coalesce(sum(n) FILTER (WHERE mask & before = 0 AND mask & bit = 0), 0) AS BIGINT) AS kept,
       CAST(coalesce(sum(n) FILTER (WHERE mask & before = 0 AND mask & bit <> 0), 0) AS BIGINT) AS removed,
       CAST(coalesce(sum(n) FILTER (WHERE mask & before <> 0 AND mask & bit <> 0), 0) AS BIGINT) AS redundant,
       CAST(coalesce(sum(n) FILTER (WHERE mask = bit), 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(sum(g) FILTER (WHERE mask & before = 0 AND mask & bit <> 0), 0) AS BIGINT) AS good_lost,
       CAST(coalesce(sum(t) FILTER (WHERE mask & before = 0 AND mask & bit <> 0), 0) AS BIGINT) AS toxic_lost,
       CAST(coalesce(sum(n * (120 // greatest(bit_count(mask), 1))) FILTER (WHERE mask & bit <> 0), 0) AS BIGINT) AS shapley
FROM counted, steps
GROUP BY part, filter_order, step
"""

#: CRC-32 by eight shifts for each digit; windows by a range join of a source's distinct times.
_OP13 = r"""
WITH hashed AS (
  SELECT doc_id, source, lang, length(text) AS size,
         xor(list_reduce([4294967295::BIGINT] || list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda i: ord(CAST(doc_id AS VARCHAR)[i])::BIGINT),
             lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, (y & 1) * 3988292384))), 4294967295) AS h
  FROM documents),
e AS (SELECT doc_id, source, lang, size, CAST(60 * floor((doc_id + h % 4000) / 6.0) AS BIGINT) AS event_s FROM hashed),
asked AS (SELECT DISTINCT source, event_s, window_s FROM e, (VALUES (CAST(3600 AS BIGINT)), (21600)) w(window_s) WHERE event_s IS NOT NULL),
found AS (
  SELECT a.source, a.event_s, a.window_s, count(x.event_s) AS n_events, CAST(coalesce(sum(x.size), 0) AS BIGINT) AS sum_chars,
         count(DISTINCT x.lang) AS n_langs, list_sort(list(x.size) FILTER (WHERE x.size IS NOT NULL)) AS sizes
  FROM asked a LEFT JOIN e x ON x.source IS NOT DISTINCT FROM a.source AND x.event_s >= a.event_s - a.window_s AND x.event_s < a.event_s
  GROUP BY a.source, a.event_s, a.window_s)
SELECT e.doc_id, CAST(w.window_s AS BIGINT) AS window_s, e.event_s, coalesce(n_events, 0) AS n_events, coalesce(sum_chars, 0) AS sum_chars,
       coalesce(n_langs, 0) AS n_langs, sizes[(len(sizes) + 1) // 2] AS median_chars, sizes[(75 * len(sizes) + 99) // 100] AS high_chars
FROM e CROSS JOIN (VALUES (3600), (21600)) w(window_s)
LEFT JOIN found f ON f.source IS NOT DISTINCT FROM e.source AND f.event_s = e.event_s AND f.window_s = w.window_s
"""


def oracle_sql():
    return {"op4_line_dedup": _OP4, "op12_filter_audit": _OP12, "op13_rolling": _OP13}
