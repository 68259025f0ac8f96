"""Queries on indexes that are written once and searched many times, and on analysed terms."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvid.functions import stemming as sm
from corvid.functions import text as tx
from corvid.operators import blockmax as bm
from corvid.operators import quantise as qz
from corvid.operators import retrieval as rt
from corvid.session import scratch, spread, table

from .registry import register
from .retrieval_queries import SQL_SPARSE, benchmark, vectors


def documents(spark, d):
    return spread(table(spark, d, "documents").select("doc_id", "text"))


@register("sp3_written_index", f"WITH {SQL_SPARSE} SELECT * FROM sparse")
def sp3_written(spark, d):
    """Every question against an index on disk, by block maxima; the results are those of a full scoring."""
    return bm.bm25_search(bm.bm25(documents(spark, d), scratch(spark, "bm25")), benchmark(spark, d), 20)


@register("sp2_written_terms", f"WITH {SQL_SPARSE} SELECT term, count(*) AS df, round(max(weight), 6) AS most FROM idx GROUP BY term")
def sp2_written(spark, d):
    """The dictionary of the written index: each term's number of documents and largest weight."""
    index = bm.bm25(documents(spark, d), scratch(spark, "bm25"))
    return index.terms().select("term", "df", F.round("most", 6).alias("most"))


def sparse_weights(spark, d):
    """(term, doc_id, weight) of sp6's stand-in encoder, not written yet; and (term, idf), written."""
    path = scratch(spark, "sparse")
    rows = bm.count_terms(documents(spark, d), f"{path}/counts")
    tf = rows.select("doc_id", F.explode(F.arrays_zip("terms", "tfs")).alias("x")).select("doc_id", F.col("x.terms").alias("term"), F.col("x.tfs").alias("tf"))
    n_docs = rows.select("doc_id").distinct().count()
    if n_docs < rows.count():  # rows that repeat an id are one document
        tf = tf.groupBy("doc_id", "term").agg(F.sum("tf").alias("tf"))
    tf.groupBy("term").agg(F.log(1 + F.lit(n_docs) / F.count("*")).alias("idf")).write.parquet(f"{path}/idf")
    idf = spark.read.parquet(f"{path}/idf")
    return tf.join(idf, "term").select("term", "doc_id", (F.log1p("tf") * F.col("idf")).alias("weight")), idf


def cut_questions(spark, d, idf, cut=10):
    """(q_id, term, weight) of each question's heaviest terms, as sp7_query_cut has them."""
    asked = benchmark(spark, d).select("q_id", F.explode(tx.tokens(F.col("text"))).alias("term")).groupBy("q_id", "term").agg(F.count("*").alias("n"))
    return bm.query_cut(asked.join(idf, "term").select("q_id", "term", F.round(F.log1p("n") * F.col("idf"), 9).alias("weight")), cut)


@register("sp7_seismic")
def sp7_seismic(spark, d):
    """Approximate: like documents share blocks, summaries are cut; tests hold recall against sp7_query_cut."""
    weights, idf = sparse_weights(spark, d)
    return bm.search(bm.seismic(weights, scratch(spark, "seismic")), cut_questions(spark, d, idf), 10, factor=0.8)


@register("dn7_ivfpq_search")
def dn7_ivfpq(spark, d):
    """Every 20th vector against all, by byte codes of a quarter of the cells; tests hold recall against the exact search."""
    v, q = vectors(spark, d)
    return qz.search(qz.build(v.select("item", "v"), scratch(spark, "ivfpq")), q, 10)


def tokens_of(rows, id_col):
    return rows.select(id_col, F.explode(tx.tokens(F.col("text"))).alias("term"))


@register("sp1_snowball")
def sp1_snowball(spark, d):
    """Terms without stop words, stemmed, both by the language of their document."""
    docs = spread(table(spark, d, "documents").select("doc_id", "text", "lang"))
    terms = docs.select("doc_id", "lang", F.explode(tx.tokens(F.col("text"))).alias("term")).groupBy("doc_id", "lang", "term").agg(F.count("*").alias("n"))
    return sm.analyse(terms, F.col("lang")).groupBy("doc_id", "term").agg(F.sum("n").alias("n"))


@register("sp3_stemmed_search")
def sp3_stemmed(spark, d):
    """BM25 over English stems without stop words, from a written index; the questions are analysed alike."""
    docs = documents(spark, d).withColumn("text", F.coalesce("text", F.lit("")))  # each counts
    index = bm.bm25(docs, scratch(spark, "stems"), term_of=sm.stem_or_none("en"))
    asked = sm.analyse(tokens_of(benchmark(spark, d), "q_id"), F.lit("en")).dropDuplicates().withColumn("weight", F.lit(1.0))
    return bm.search(index, asked, 10)
