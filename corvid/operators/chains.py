"""Reasoning chains: a beam over the triples of each question's retrieved documents, scored by vectors.

A question's candidates are the triples of its own hits, joined by its id: no question meets another
one's triples. Every table has rows of bounded size (one path, one triple, one pair of them), and a
hop's best candidates are kept before they are gathered, so a question with very long documents has
more rows and no larger ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvid.functions import text as tx

from .retrieval import dot, few_of
from .routing import DIM, hashed_dim

#: Ends a path, as a chosen triple does not.
END = -1

#: A triple's number is its document's rank times this, plus its place in the document.
PLACES = 1 << 40


def said_triples(text: Column) -> Column:
    """Stand-in for a model that extracts triples: `<first; second; the other terms>` of each sentence with three terms."""
    terms = F.filter(F.transform(F.split(text, r"[.!?\n]+"), tx.tokens), lambda t: F.size(t) >= 3)
    return F.array_join(F.transform(terms, lambda t: F.concat(F.lit("<"), t[0], F.lit("; "), t[1], F.lit("; "), F.array_join(F.slice(t, F.lit(3), F.size(t)), " "), F.lit(">"))), " ")


def term_counts(text: Column, dim: int = DIM) -> Column:
    """Stand-in for an encoder whose vectors add up: the text's terms by hashed dimension. Not of unit length."""
    dims = F.transform(tx.tokens(text), lambda t: hashed_dim(t, dim))
    count = lambda v, d: F.transform(v, lambda x, k: F.when(k == d, x + 1).otherwise(x))
    return F.aggregate(dims, F.array_repeat(F.lit(0.0), dim), count)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def triples_of_hits(hits: DataFrame, texts: DataFrame, extract: Callable[[Column], Column] = said_triples, encode: Callable[[Column], Column] = term_counts) -> DataFrame:
    """(q_id, triple, doc_id, said, v, length) of hits (q_id, doc_id, rank): every triple of the whole texts.

    A document that several questions found is extracted and encoded once, then joined back. The
    sentences of a long one are dealt to all tasks before they are encoded.
    A document that was extracted to nothing has no rows; malformed triples are skipped.
    """
    found = texts.join(few_of(hits)(hits.select("doc_id").dropDuplicates()), "doc_id")
    blocks = found.select("doc_id", F.posexplode(F.regexp_extract_all(extract(F.col("text")), F.lit("<([^>]*)>"), F.lit(1))).alias("n", "x"))
    parts = [F.trim(F.regexp_extract("x", "^(.*);([^;]*);([^;]*)$", k)) for k in (1, 2, 3)]
    made = blocks.where(F.col("x").rlike("^(.*);([^;]*);([^;]*)$")).select("doc_id", "n", F.concat_ws(" ", *parts).alias("said"))
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = made.repartition(tasks, "doc_id", "n").withColumn("v", encode(F.col("said")))
    return hits.select("q_id", "doc_id", "rank").join(own, "doc_id").select("q_id", (F.col("rank").cast("long") * PLACES + F.col("n")).alias("triple"), "doc_id", "said", "v", norm(F.col("v")).alias("length"))


def near_or_done(score: Column, length: Column) -> Column:
    """Stand-in for the model that chooses: the logit of a candidate by its similarity, of ending by the path's length.

    score is null where the choice is to end.
    """
    return F.coalesce(F.round(8 * score, 6), length.cast("double"))


def hop(beam: DataFrame, triples: DataFrame, width: int = 5, branches: int = 5, most: int = 20, least: float = 1e-4, logit: Callable[[Column, Column], Column] = near_or_done) -> DataFrame:
    """One hop of a beam (q_id, path array<long>, v, length, prob, done).

    A path that isn't done is offered the `width` triples nearest to question and path (cosine,
    without those it has; equal ones by number) and the choice to end. Of the choices' softmax it
    takes the `branches` most probable of at least `least`; a question keeps its `most` most
    probable paths (equal ones by path). Done paths compete as they are. A path without any further
    triple can only end; questions without triples end with an empty path.
    """
    key = ["q_id", "path"]
    live = beam.where(~F.col("done")).select("q_id", "path", F.col("v").alias("pv"), F.col("length").alias("own"), "prob")
    cosine = F.round(dot(F.col("pv"), F.col("v")) / F.greatest(F.col("own") * F.col("length"), F.lit(1e-12)), 6)
    pairs = live.join(triples.select("q_id", "triple", "v", "length"), "q_id").where(~F.array_contains("path", F.col("triple")))
    scored = pairs.select(*key, "prob", "triple", cosine.alias("score"))
    near = scored.withColumn("r", F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("score"), "triple"))).where(F.col("r") <= width).drop("r")
    ending = live.select(*key, "prob", F.lit(END).cast("long").alias("triple"), F.lit(None).cast("double").alias("score"))
    by = Window.partitionBy(*key)
    choices = near.unionByName(ending).withColumn("logit", logit(F.col("score"), F.size("path")))
    weight = F.exp(F.col("logit") - F.max("logit").over(by))
    choices = choices.withColumn("choice", F.round(weight / F.sum(weight).over(by), 9))
    chosen = choices.withColumn("r", F.row_number().over(by.orderBy(F.desc("choice"), "triple"))).where((F.col("r") <= branches) & (F.col("choice") >= least))
    grown = chosen.select("q_id", F.concat("path", F.array("triple")).alias("path"), F.round(F.col("prob") * F.col("choice"), 9).alias("prob"), (F.col("triple") == END).alias("done"))
    ended = beam.where("done").select("q_id", "path", "prob", "done")
    order = Window.partitionBy("q_id").orderBy(F.desc("prob"), "path")
    kept = grown.unionByName(ended).withColumn("r", F.row_number().over(order)).where(F.col("r") <= most).drop("r")
    # vectors follow the kept paths alone: the old path's and the last triple's
    old = F.when(F.col("done"), F.lit(None)).otherwise(F.slice("path", 1, F.size("path") - 1))
    last = F.when(~F.col("done"), F.element_at("path", -1))
    kept = kept.withColumn("old", old).withColumn("triple", last)
    kept = kept.join(live.select("q_id", F.col("path").alias("old"), "pv"), ["q_id", "old"], "left").join(triples.select("q_id", "triple", "v"), ["q_id", "triple"], "left")
    grown = kept.select("q_id", "path", F.zip_with("pv", "v", lambda x, y: x + y).alias("v"), "prob", "done")
    return grown.withColumn("length", norm(F.col("v")))


def chains(questions: DataFrame, triples: DataFrame, settle: Callable[[DataFrame], DataFrame], hops: int = 4, encode: Callable[[Column], Column] = term_counts, **options) -> DataFrame:
    """(q_id, chain, path, prob): each question's paths after at most `hops` hops, from the most probable (1) on.

    questions: q_id, text; a null text is an empty one. Paths name triples; an ended one's last is END.
    """
    start = F.array().cast("array<long>")
    beam = questions.dropDuplicates(["q_id"]).select("q_id", start.alias("path"), encode(F.coalesce("text", F.lit(""))).alias("v"), F.lit(1.0).alias("prob"), F.lit(False).alias("done"))
    beam = settle(beam.withColumn("length", norm(F.col("v"))))
    for _ in range(hops):
        beam = settle(hop(beam, triples, **options))
    order = Window.partitionBy("q_id").orderBy(F.desc("prob"), "path")
    return beam.select("q_id", F.row_number().over(order).alias("chain"), "path", "prob")


def chain_triples(found: DataFrame, triples: DataFrame) -> DataFrame:
    """(q_id, chain, pos, triple, doc_id, text) of every triple in a chain."""
    rows = found.select("q_id", "chain", F.posexplode("path").alias("pos", "triple"))
    return rows.join(triples.select("q_id", "triple", "doc_id", F.col("said").alias("text")), ["q_id", "triple"])


def chain_documents(rows: DataFrame, texts: DataFrame, most: int = 5) -> DataFrame:
    """(q_id, context): the documents of the first `most` chains by their number of triples there, then by first
    use; texts has doc_id, title, text. A question's context has `hops * most` documents at most."""
    first = rows.where(F.col("chain") <= most).groupBy("q_id", "doc_id").agg(F.count("*").alias("n"), F.min(F.struct("chain", "pos")).alias("at"))
    line = F.struct((-F.col("n")).alias("n"), "at", "doc_id", F.col("title"), F.col("text"))
    own = first.join(texts.select("doc_id", F.coalesce("title", F.lit("")).alias("title"), F.coalesce("text", F.lit("")).alias("text")), "doc_id")
    put = lambda x, n: F.concat(F.lit("Doc "), (n + 1).cast("string"), F.lit("(Title: "), x["title"], F.lit(") "), x["text"], F.lit("\n"))
    return own.groupBy("q_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(line)), put), "").alias("context"))
