"""The corpus pipeline: five stages, each over all that its predecessor kept.

Stages take (spark, docs, sf_dir); all but the last return the columns of documents. n_chars,
where there is such a column, follows the text. run() writes each stage's result to the shared
folder and reads it again for the next.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from corvid.llm import fertility, jaccard, linededup, packing, queries, suffixdedup
from corvid.llm.common import Stash
from corvid.session import table

#: The tokenisers' rules, the cells of count vectors and the suffixes have no SQL.
ORACLE_SQL = None


def _sized(docs):
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def quality_rules(spark, docs, sf_dir):
    """Documents that the base rules or the fertility bands reject go; each row is judged itself, also those of null ids."""
    return fertility.rules(docs, queries.PIECES, queries.RANKS, queries.PATTERN, keep_columns=True).where("kept").select("row.*")


def line_dedup(spark, docs, sf_dir):
    """Lines of five documents or more stay in the largest doc_id alone."""
    return _sized(linededup.dedup(docs, keep_columns=True))


def near_duplicates(spark, docs, sf_dir):
    """Of each group of near copies the smallest doc_id stays."""
    return jaccard.one_of_each(docs)


def repeated_passages(spark, docs, sf_dir):
    """Bytes of 100-byte strings that start earlier too go; a document with nothing left goes."""
    return _sized(suffixdedup.dedup(docs, keep_columns=True)).where((F.length("text") > 0) | F.col("text").isNull())


def pack(spark, docs, sf_dir):
    """The remaining documents as sequences of 1024 tokens."""
    return packing.pack(docs, queries.TOKENIZER, queries.PATTERN)


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("ngram_jaccard", near_duplicates), ("suffix_dedup", repeated_passages), ("packing", pack)]


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    stash = Stash(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES[:-1]):
        docs = stash.keep(stage(spark, docs, sf_dir), name)
        if k:
            stash.drop(STAGES[k - 1][0])
    return STAGES[-1][1](spark, docs, sf_dir)
