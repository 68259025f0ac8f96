"""Retrieval metrics as aggregates, answer metrics as columns."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvid.functions import text as tx


def retrieval_metrics(hits: DataFrame, qrels: DataFrame, k: int, queries: DataFrame) -> DataFrame:
    """One row: means over all queries, and the numbers of queries with and without truth.

    Hits are distinct (q_id, doc_id, rank); recall, MRR and NDCG can't exceed 1.
    """
    good = hits.where(F.col("rank") <= k).join(qrels, ["q_id", "doc_id"]).groupBy("q_id").agg(F.count("*").alias("found"), F.min("rank").alias("first"), F.sum(1 / F.log2(F.col("rank") + 1.0)).alias("dcg"))
    truth = qrels.groupBy("q_id").agg(F.count("*").alias("relevant"))
    ideal = F.aggregate(F.sequence(F.lit(1), F.least(F.col("relevant"), F.lit(k)).cast("int")), F.lit(0.0), lambda s, n: s + 1 / F.log2(n + 1.0))
    per = queries.select("q_id").join(truth, "q_id", "left").join(good, "q_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return per.agg(
        F.round(F.avg(zero((F.col("found") > 0).cast("double"))), 6).alias("hit"),
        F.round(F.avg(zero(F.col("found") / F.col("relevant"))), 6).alias("recall"),
        F.round(F.avg(zero(1 / F.col("first"))), 6).alias("mrr"),
        F.round(F.avg(zero(F.col("dcg") / F.when(F.col("relevant").isNotNull(), ideal))), 6).alias("ndcg"),
        F.count("*").alias("num_queries"),
        F.count("relevant").alias("num_queries_with_gt"),
    )


def token_scores(pairs: DataFrame) -> DataFrame:
    """(id, f1, precision, recall) of (id, pred, gold), the best over golds for each component.

    Yes, no and noanswer only match themselves. Tokens are counted by row and joined, so long
    predictions cost their length.
    """
    norm = pairs.select("id", F.xxhash64("gold").alias("gid"), tx.normalize_answer(F.col("pred")).alias("p"), tx.normalize_answer(F.col("gold")).alias("g")).dropDuplicates(["id", "gid"])
    words = lambda c: F.filter(F.split(c, " "), lambda x: x != "")
    closed = F.array(*map(F.lit, ("yes", "no", "noanswer")))
    blocked = (F.array_contains(closed, F.col("p")) | F.array_contains(closed, F.col("g"))) & (F.col("p") != F.col("g"))
    sized = norm.select("id", "gid", words("p").alias("pw"), words("g").alias("gw"), blocked.alias("blocked"))
    sides = sized.select("id", "gid", F.explode(F.concat(F.transform("pw", lambda w: F.struct(w.alias("w"), F.lit(1).alias("a"), F.lit(0).alias("b"))), F.transform("gw", lambda w: F.struct(w.alias("w"), F.lit(0).alias("a"), F.lit(1).alias("b"))))).alias("x"))
    counts = sides.groupBy("id", "gid", "x.w").agg(F.sum("x.a").alias("a"), F.sum("x.b").alias("b"))
    shared = counts.groupBy("id", "gid").agg(F.sum(F.least("a", "b")).alias("c"))
    both = sized.select("id", "gid", "blocked", F.size("pw").alias("np"), F.size("gw").alias("ng")).join(shared, ["id", "gid"], "left")
    both = both.withColumn("c", F.when(F.col("blocked"), 0).otherwise(F.coalesce("c", F.lit(0))))
    p, r = F.col("c") / F.greatest(F.col("np"), F.lit(1)), F.col("c") / F.greatest(F.col("ng"), F.lit(1))
    f1 = F.when(F.col("c") > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))
    return both.groupBy("id").agg(F.round(F.max(f1), 6).alias("f1"), F.round(F.max(p), 6).alias("precision"), F.round(F.max(r), 6).alias("recall"))


def exact_match(pred: Column, gold: Column, pattern: bool = False) -> Column:
    """Equal after normalising; with `pattern`, the gold answer is a regular expression for the whole prediction."""
    if pattern:
        return F.coalesce(F.regexp_like(pred, F.concat(F.lit("(?i)^(?:"), gold, F.lit(")$"))), F.lit(False)).cast("int")
    return (tx.normalize_answer(pred) == tx.normalize_answer(gold)).cast("int")


def sub_match(pred: Column, gold: Column) -> Column:
    return F.contains(tx.normalize_answer(pred), tx.normalize_answer(gold)).cast("int")


def gram_counts(frame: DataFrame, keys: list[str], text: str, n: int, name: str, tokens=tx.tokens) -> DataFrame:
    """(keys, g, name): counts of n-grams of tokens, made within the row."""
    t = frame.select(*keys, tokens(F.col(text)).alias("t"))
    runs = F.transform(F.filter(F.sequence(F.lit(1), F.greatest(F.size("t") - n + 1, F.lit(1))), lambda k: k <= F.size("t") - n + 1), lambda k: F.array_join(F.slice("t", k, n), " "))
    return t.select(*keys, F.explode(runs if n > 1 else F.col("t")).alias("g")).groupBy(*keys, "g").agg(F.count("*").alias(name))


def characters(c: Column) -> Column:
    """Every character but blanks as a token: the segmentation of scripts without spaces."""
    return F.filter(F.split(F.regexp_replace(F.lower(c), r"\s+", ""), ""), lambda x: x != "")


def rouge_n(pairs: DataFrame, n: int, tokens=tx.tokens) -> DataFrame:
    """(id, score): F of clipped n-gram counts, the best over golds. pairs: id, gold_id, pred, gold."""
    keys = ["id", "gold_id"]
    both = gram_counts(pairs, keys, "pred", n, "a", tokens).join(gram_counts(pairs, keys, "gold", n, "b", tokens), [*keys, "g"], "full")
    sums = both.groupBy(*keys).agg(F.sum(F.least(F.coalesce("a", F.lit(0)), F.coalesce("b", F.lit(0)))).alias("c"), F.sum("a").alias("a"), F.sum("b").alias("b"))
    f = F.coalesce(2.0 * F.col("c") / (F.coalesce("a", F.lit(0)) + F.coalesce("b", F.lit(0))), F.lit(0.0))
    return sums.groupBy("id").agg(F.round(F.max(f), 6).alias("score"))


@F.pandas_udf(T.DoubleType())
def _lcs_f(a: pd.Series, b: pd.Series) -> pd.Series:
    """F of the longest common subsequence: a bit for each token of one side, a few integer operations for each of the other."""

    def one(x, y):
        if x is None or y is None or not len(x) or not len(y):
            return 0.0
        at: dict[str, int] = {}
        for n, w in enumerate(x):
            at[w] = at.get(w, 0) | 1 << n
        full = (1 << len(x)) - 1
        open_ = full
        for w in y:
            hit = open_ & at.get(w, 0)
            open_ = ((open_ + hit) | (open_ - hit)) & full
        return round(2 * (len(x) - open_.bit_count()) / (len(x) + len(y)), 6)

    return pd.Series([one(x, y) for x, y in zip(a, b, strict=True)], dtype=float)


def rouge_l(pred: Column, gold: Column) -> Column:
    return _lcs_f(tx.tokens(pred), tx.tokens(gold))


def bleu_counts(pairs: DataFrame, order: int = 4, tokens=tx.mteval_tokens) -> DataFrame:
    """(id, n, hit, total, c, r) of (id, gold_id, pred, gold): n-grams of each prediction clipped by the
    most that any gold has, its length, and the shortest gold's."""
    out = None
    preds = pairs.select("id", "pred").dropDuplicates(["id"])
    for n in range(1, order + 1):
        gold = gram_counts(pairs, ["id", "gold_id"], "gold", n, "b", tokens).groupBy("id", "g").agg(F.max("b").alias("b"))
        both = gram_counts(preds, ["id"], "pred", n, "a", tokens).join(gold, ["id", "g"], "left")
        own = both.groupBy("id").agg(F.sum(F.least("a", F.coalesce("b", F.lit(0)))).alias("hit"), F.sum("a").alias("total"))
        own = preds.select("id").join(own, "id", "left").select("id", F.lit(n).alias("n"), F.coalesce("hit", F.lit(0)).alias("hit"), F.coalesce("total", F.lit(0)).alias("total"))
        out = own if out is None else out.unionByName(own)
    lengths = pairs.groupBy("id").agg(F.max(F.size(tokens(F.col("pred")))).alias("c"), F.min(F.size(tokens(F.col("gold")))).alias("r"))
    return out.join(lengths, "id")


def bleu_score(rows: DataFrame, keys: list[str], smooth: bool = False) -> DataFrame:
    """(keys, bleu) of summed bleu_counts(); smoothing adds one to both counts of every order."""
    plus = 1 if smooth else 0
    sums = rows.groupBy(*keys, "n").agg((F.sum("hit") + plus).alias("hit"), (F.sum("total") + plus).alias("total"), F.sum("c").alias("c"), F.sum("r").alias("r"))
    one = sums.groupBy(*keys).agg(F.min("hit").alias("least"), F.avg(F.log(F.col("hit") / F.col("total"))).alias("mean"), F.max("c").alias("c"), F.max("r").alias("r"))
    brevity = F.when(F.col("c") >= F.col("r"), 1.0).when(F.col("c") == 0, 0.0).otherwise(F.exp(1 - F.col("r") / F.col("c")))
    return one.select(*keys, F.round(F.when(F.col("least") > 0, brevity * F.exp("mean")).otherwise(0.0), 6).alias("bleu"))


def choice_answers(choices: Column, answers: Column) -> Column:
    """Gold texts of a question with choices: its answers are places (from 0) among them."""
    return F.transform(F.filter(answers, lambda n: (n >= 0) & (n < F.size(choices))), lambda n: F.element_at(choices, n + 1))


def graded_answer(kind: Column, pred: Column, gold: Column) -> Column:
    """One choice: equal or not. Several: 1 if equal, a half if what was given is part of it, else 0."""
    return F.when(pred == gold, 1.0).when((kind == "multiple choice") & (pred != "") & F.contains(gold, pred), 0.5).otherwise(0.0)


#: Item metrics by name: columns of (pred, gold).
METRICS = {
    "em": exact_match,
    "sub_em": sub_match,
    "input_tokens": lambda pred, gold: F.size(tx.words(pred)),
    "rouge_l": rouge_l,
}


def evaluate(pairs: DataFrame, names: list[str]) -> tuple[DataFrame, DataFrame]:
    """(item scores, their means) of the named metrics; an unknown name is an error before anything runs."""
    unknown = [n for n in names if n not in METRICS]
    if unknown:
        raise ValueError(f"unknown metrics {unknown}; there are {sorted(METRICS)}")
    items = pairs.select("id", *[METRICS[n](F.col("pred"), F.col("gold")).cast("double").alias(n) for n in names])
    return items, items.agg(*[F.round(F.avg(n), 6).alias(n) for n in names], F.count("*").alias("n"))


def failure_records(hits: DataFrame, qrels: DataFrame, questions: DataFrame, texts: DataFrame, k: int = 5) -> DataFrame:
    """(q_id, found, numeric, numbers_found, suggestions) of questions with truth whose first k hits miss it.

    found: the truth is among deeper hits; numbers_found: the question's numbers that its hits' texts hold.
    """
    truth = qrels.select("q_id").dropDuplicates()
    good = hits.join(qrels, ["q_id", "doc_id"], "left_semi")
    failed = questions.join(truth, "q_id", "left_semi").join(good.where(F.col("rank") <= k), "q_id", "left_anti")
    deeper = good.groupBy("q_id").agg(F.min("rank").alias("deeper"))
    numbers = F.array_distinct(F.regexp_extract_all("text", F.lit("[0-9]+"), F.lit(0)))
    asked = failed.withColumn("numbers", numbers)
    each = asked.select("q_id", F.explode("numbers").alias("number"))
    seen = hits.where(F.col("rank") <= 10).join(each, "q_id").join(texts.select("doc_id", F.col("text").alias("doc")), "doc_id").groupBy("q_id", "number").agg(F.max(F.contains("doc", F.col("number")).cast("int")).alias("hit"))
    present = seen.groupBy("q_id").agg(F.sum("hit").alias("numbers_found"))
    rows = asked.join(deeper, "q_id", "left").join(present, "q_id", "left")
    numeric = F.size("numbers") > 0
    tips = F.filter(
        F.array(
            F.when(F.col("deeper").isNotNull(), F.concat(F.lit("rerank: truth at rank "), F.col("deeper").cast("string"))),
            F.when(F.col("deeper").isNull(), F.lit("retrieval: truth is not among the candidates")),
            F.when(numeric & (F.coalesce("numbers_found", F.lit(0)) < F.size("numbers")), F.lit("numbers: not all are in the first hits")),
            F.when(F.size(tx.words(F.col("text"))) < 20, F.lit("query: short, expand it")),
        ),
        lambda x: x.isNotNull(),
    )
    return rows.select("q_id", F.col("deeper").isNotNull().alias("found"), numeric.alias("numeric"), F.coalesce("numbers_found", F.lit(0)).alias("numbers_found"), tips.alias("suggestions"))


def failure_summary(records: DataFrame, k: int = 5) -> DataFrame:
    """(kind, n): numbers of failures, of those found deeper and numeric ones, and the k most frequent suggestions
    (their part before a colon, or 50 characters)."""
    totals = records.agg(F.count("*").alias("failures"), F.count_if("found").alias("found"), F.count_if("numeric").alias("numeric"))
    flat = totals.select(F.explode(F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).alias("n")) for c in ("failures", "found", "numeric")])).alias("x")).select("x.kind", "x.n")
    key = F.when(F.contains("s", F.lit(":")), F.substring_index("s", ":", 1)).otherwise(F.substring("s", 1, 50))
    tips = records.select(F.explode("suggestions").alias("s")).groupBy(F.concat(F.lit("suggestion "), key).alias("kind")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "kind").limit(k)
    return flat.unionByName(tips)
