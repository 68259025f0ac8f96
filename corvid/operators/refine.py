"""Context refinement: extractive sentences, compression targets and windows, structured prompts, recovery; triples and chains."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvid.functions import text as tx


def refined_sentences(c: Column) -> Column:
    """Sentences of a text without its title line, each of over five characters; a full stop after a letter's abbreviation is no end."""
    body = F.element_at(F.split(F.concat(c, F.lit("\n")), "\n", 2), 2)
    return F.filter(F.transform(F.split(F.btrim(body, F.lit(" \n\t")), r"(?<![A-Za-z]\.)(?<=[.!?])\s+"), lambda x: F.btrim(x, F.lit(" \n\t"))), lambda x: F.length(x) > 5)


def compression_target(instruction: int, question: Column, contexts: Column, rate: float) -> Column:
    """Tokens that the contexts may keep for the whole prompt to have `rate` of its tokens."""
    return (F.lit(float(instruction)) + question + contexts) * rate - instruction - question


PRICE = 0.06  # a thousand tokens


def compression_statistics(before: Column, after: Column) -> list[Column]:
    return [F.round(before / after, 6).alias("ratio"), F.round(after / before, 6).alias("rate"), F.round((before - after) * PRICE / 1000, 6).alias("saving")]


def window_ratios(contexts: DataFrame, target: float, spread: float, window: int = 200) -> DataFrame:
    """(q_id, doc_id, window, tokens, ratio): each context's ratio, falling linearly by rank around the
    common one, over the windows that its tokens lie in. contexts: q_id, doc_id, rank, size."""
    by = Window.partitionBy("q_id")
    before = F.coalesce(F.sum("size").over(by.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    c = contexts.withColumn("_n", F.count("*").over(by)).withColumn("_all", F.sum("size").over(by)).withColumn("_a", before)
    share = F.when(F.col("_n") > 1, 1 - 2 * (F.col("rank") - 1) / (F.col("_n") - 1)).otherwise(F.lit(0.0))
    ratio = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(target) / (F.col("_all") + 1) + spread * share))
    laid = c.where("size > 0").withColumn("ratio", F.round(ratio, 6)).withColumn("_b", F.col("_a") + F.col("size"))
    laid = laid.withColumn("window", F.explode(F.sequence(F.floor(F.col("_a") / window), F.floor((F.col("_b") - 1) / window))))
    tokens = F.least("_b", (F.col("window") + 1) * window) - F.greatest("_a", F.col("window") * window)
    return laid.select("q_id", "doc_id", F.col("window").cast("long").alias("window"), tokens.cast("long").alias("tokens"), "ratio")


def keep_contexts(contexts: DataFrame, key: str, rate: float) -> DataFrame:
    """Contexts (key, prob, forced) at or over the percentile 1 - rate of their key, and forced ones."""
    cut = contexts.groupBy(key).agg(F.percentile("prob", F.lit(1 - rate)).alias("_t"))
    return contexts.join(cut, key).where((F.col("prob") >= F.col("_t") - 1e-12) | F.col("forced")).drop("_t")


def boundary_chunks(tokens: Column, size: int, marks: tuple[str, ...] = (".", "\n")) -> Column:
    """Start of each chunk of at most `size` tokens: a chunk ends behind the last boundary token inside it, if there is one."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("start"), F.lit(0).alias("last"), F.array(F.lit(0)).alias("cuts"))

    def step(a, token):
        n = a["n"] + 1
        last = F.when(token.isin(*marks), n).otherwise(a["last"])
        cut = F.when(last > a["start"], last).otherwise(n)
        full = n - a["start"] == size
        return F.struct(n.alias("n"), F.when(full, cut).otherwise(a["start"]).alias("start"), last.alias("last"), F.when(full, F.concat(a["cuts"], F.array(cut))).otherwise(a["cuts"]).alias("cuts"))

    cuts = F.aggregate(tokens, start, step, lambda a: F.filter(a["cuts"], lambda x: x < a["n"]))
    return F.when(F.size(tokens) > 0, cuts).otherwise(F.array().cast("array<int>"))


def prompt_segments(c: Column, tag: str = "part") -> Column:
    """array<struct<rate, compress, text>> of the segments of a structured prompt in a tag; a segment without a rate has null."""
    rule = F.lit(rf"(?s)<{tag}\b([^>]*)>(.*?)</{tag}>")
    heads = F.regexp_extract_all(c, rule, F.lit(1))
    bodies = F.regexp_extract_all(c, rule, F.lit(2))

    def one(x):
        rate = F.regexp_extract(x["h"], r"rate\s*=\s*([0-9.]+)", 1)
        return F.struct(F.when(rate != "", rate.cast("double")).alias("rate"), (~x["h"].rlike(r"(?i)compress\s*=\s*false")).alias("compress"), x["b"].alias("text"))

    return F.transform(F.arrays_zip(heads.alias("h"), bodies.alias("b")), one)


def json_segments(c: Column, rates: dict[str, float], default: float | None = None) -> Column:
    """The same of a JSON object's values, each key with its rate; a rate of 1 is left as it is."""
    pairs = F.map_entries(F.from_json(c, "map<string,string>"))
    rate = lambda k: F.coalesce(*[F.when(k == name, F.lit(x)) for name, x in rates.items()], F.lit(default).cast("double"))
    return F.transform(pairs, lambda p: F.struct(p["key"].alias("key"), rate(p["key"]).alias("rate"), (F.coalesce(rate(p["key"]), F.lit(0.0)) != 1.0).alias("compress"), p["value"].alias("text")))


def squeeze(text: Column, rate: Column) -> Column:
    """Stand-in for a compressor: the longest words of a text, in order, `rate` of them (the first of equals)."""
    w = tx.words(text)
    order = F.array_sort(F.transform(w, lambda x, n: F.struct((-F.length(x)).alias("l"), n.alias("n"))))
    chosen = F.array_sort(F.transform(F.slice(order, 1, F.greatest(F.ceil(F.size(w) * rate).cast("int"), F.lit(0))), lambda x: x["n"]))
    return F.array_join(F.transform(chosen, lambda n: F.element_at(w, n + 1)), " ")


@F.pandas_udf(T.StringType())
def recover(response: pd.Series, original: pd.Series, kept: pd.Series) -> pd.Series:
    """A response in the words of the text before compression: each longest run of its words that the
    kept words (their positions) have becomes the original's span from the run's first to its last word."""

    def one(answer, text, places):
        words, whole = (answer or "").split(), (text or "").split()
        places = sorted(int(p) for p in (places if places is not None else ()) if 0 <= int(p) < len(whole))
        short = [whole[p] for p in places]
        at: dict[str, list[int]] = {}
        for n, w in enumerate(short):
            at.setdefault(w, []).append(n)
        out, n = [], 0
        while n < len(words):
            length, where = 0, 0
            for k in at.get(words[n], ()):
                m = 0
                while n + m < len(words) and k + m < len(short) and words[n + m] == short[k + m]:
                    m += 1
                if m > length:
                    length, where = m, k
            out += whole[places[where] : places[where + length - 1] + 1] if length else [words[n]]
            n += max(1, length)
        return " ".join(out)

    return pd.Series([one(*x) for x in zip(response, original, kept, strict=True)])


# --- triples ------------------------------------------------------------------------------


#: Triples of at most so many terms are found by each set of their terms.
FEW_TERMS = 6


def term_bags(triples: DataFrame, settle) -> DataFrame:
    """(triple, more, bag) of triples (triple, terms): their terms, and the different ones, those of many triples last.

    The rows of one triple are taken together; a term of several of them stands in the bag as often.
    """
    held = settle(triples.where("triple IS NOT NULL"))
    rows = held.withColumn("term", F.explode(F.array_distinct("terms"))).where("term IS NOT NULL")
    counts = rows.groupBy("term").agg(F.count("*").alias("n"))
    # no more than 1,000 terms; the order only decides how many sets a term has to be compared with
    frequent = counts.crossJoin(F.broadcast(counts.agg(F.sum("n").alias("total")))).where("1000 * n >= total").drop("total")
    ranked = rows.join(F.broadcast(frequent), "term", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    bag = F.transform(F.array_sort(F.collect_list(F.struct("n", "term"))), lambda x: x["term"])
    return ranked.groupBy("triple").agg(F.min("terms").alias("more"), bag.alias("bag"))


def offers(bags: DataFrame, most: int) -> DataFrame:
    """(term, shared, triples): for each set of terms that triples have in common the `most` first of them, under its rarest term.

    A triple among the k best of a path that shares just this set with it comes behind fewer than k unused triples
    of the set, as each of them shares as many terms at least; so with `most` of k and the path's length none is missed.
    Triples of more than FEW_TERMS stand under each term, as one set that a path need not have whole.
    """
    sets = F.aggregate("bag", F.array(F.array().cast("array<string>")), lambda got, x: F.concat(got, F.transform(got, lambda s: F.concat(s, F.array(x)))))
    sets = F.when(F.size("bag") > FEW_TERMS, F.array("bag")).otherwise(F.array_distinct(F.filter(sets, lambda s: F.size(s) > 0)))
    rows = bags.select("triple", F.explode(sets).alias("shared"))
    first = rows.withColumn("r", F.row_number().over(Window.partitionBy("shared").orderBy("triple"))).where(F.col("r") <= most)
    terms = F.when(F.size("shared") > FEW_TERMS, F.array_distinct("shared")).otherwise(F.slice("shared", 1, 1))
    return first.groupBy("shared").agg(F.collect_list("triple").alias("triples")).select(F.explode(terms).alias("term"), "shared", "triples")


def hop(beam: DataFrame, bags: DataFrame, offered: DataFrame, width: int = 5, most: int = 20, least: float = 1e-4) -> DataFrame:
    """One hop of a beam (q_id, path array<long>, terms array<string>, prob): each path is offered the
    `width` unused triples (of term_bags and their offers) that share most terms with the question and the path, by
    softmax of the shared terms; a question keeps its `most` most probable paths.

    A question meets sets of shared terms and a path their first triples, so what is shuffled grows with the
    different sets, not with the triples that have a frequent term.
    """
    key = ["q_id", "path"]
    held = lambda terms: (F.size("shared") > FEW_TERMS) | F.forall("shared", lambda x: F.array_contains(terms, x))
    paths = beam.groupBy(*key).agg(F.first("terms").alias("terms"), F.first("prob").alias("prob"), F.flatten(F.collect_list(F.array_distinct("terms"))).alias("has"))
    asked = paths.groupBy("q_id").agg(F.array_distinct(F.flatten(F.collect_list("has"))).alias("asks"))
    asked = asked.withColumn("term", F.explode("asks"))
    near = asked.join(offered, "term").where(held("asks")).select(F.col("q_id").alias("_q"), "shared", "triples").dropDuplicates(["_q", "shared"])
    n = F.aggregate("shared", F.lit(0), lambda got, x: got + F.size(F.filter("has", lambda y: y == x)))
    met = paths.join(near, F.col("q_id").eqNullSafe(F.col("_q"))).where(held("has")).select(*key, "triples", n.alias("n")).where("n > 0")
    met = met.withColumn("triple", F.explode("triples")).where(~F.array_contains("path", F.col("triple"))).groupBy(*key, "triple").agg(F.max("n").alias("n"))
    by = Window.partitionBy(*key)
    best = met.withColumn("r", F.row_number().over(by.orderBy(F.desc("n"), "triple"))).where(F.col("r") <= width)
    known = paths.select(F.col("q_id").alias("_q"), F.col("path").alias("_path"), "terms", "prob")
    best = best.join(known, F.col("q_id").eqNullSafe(F.col("_q")) & (F.col("path") == F.col("_path"))).drop("_q", "_path")
    weight = F.exp(F.col("n") - F.max("n").over(by))
    chosen = best.withColumn("prob", F.round(F.col("prob") * weight / F.sum(weight).over(by), 9)).where(F.col("prob") >= least)
    chosen = chosen.join(bags.select("triple", "more"), "triple")
    grown = chosen.select("q_id", F.concat("path", F.array("triple")).alias("path"), F.concat("terms", "more").alias("terms"), "prob")
    order = Window.partitionBy("q_id").orderBy(F.desc("prob"), "path")
    return grown.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most).drop("place")


def chains(questions: DataFrame, triples: DataFrame, hops: int, settle, width: int = 5, **options) -> DataFrame:
    """(q_id, path, prob) after at most `hops` hops; a path without a further triple stays as it is."""
    beam = questions.select("q_id", F.array().cast("array<long>").alias("path"), tx.tokens(F.col("text")).alias("terms"), F.lit(1.0).alias("prob"))
    bags = settle(term_bags(triples, settle))
    offered = settle(offers(bags, width + hops - 1))
    for _ in range(hops):
        grown = settle(hop(beam, bags, offered, width, **options))
        ended = beam.join(grown.select("q_id").dropDuplicates(), "q_id", "left_anti")
        beam = settle(grown.unionByName(ended))
    return beam.select("q_id", "path", "prob")


def chain_context(chain_triples: DataFrame, most: int = 5) -> DataFrame:
    """(q_id, context): triples (q_id, chain, pos, text) of the first chains, each once in order, numbered."""
    first = chain_triples.where(F.col("chain") <= most).groupBy("q_id", "text").agg(F.min(F.struct("chain", "pos")).alias("at"))
    line = F.array_sort(F.collect_list(F.struct("at", "text")))
    return first.groupBy("q_id").agg(F.array_join(F.transform(line, lambda x, n: F.concat((n + 1).cast("string"), F.lit(". "), x["text"])), "\n").alias("context"))


def exemplars(vectors: DataFrame, queries: DataFrame, k: int = 3) -> DataFrame:
    """The k demonstrations (item, v) nearest to each query by dot product."""
    from .retrieval import dense_search

    return dense_search(vectors, queries, k)
