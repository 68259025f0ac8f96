"""Prompts, the generator seam, answer parsers, agent loops and dataset plumbing over keyed tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, fields, replace

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvid.functions import text as tx

from .retrieval import few_of
from .routing import BUDGET, by_budget, token_sizes

# --- prompts ------------------------------------------------------------------------------


def assemble(system: str, user: str, previous: Column | None = None, **columns: Column) -> Column:
    """A prompt of a system and a user template, `{name}` replaced by columns, what was generated before behind them."""
    parts = [p for p in (fill(system, **columns), fill(user, **columns)) if p is not None]
    return F.concat_ws("\n\n", *parts, *([] if previous is None else [F.when(previous != "", previous)]))


def messages(system: str, user: str, **columns: Column) -> Column:
    """The same as chat messages: array<struct<role, content>>."""
    made = [("system", fill(system, **columns)), ("user", fill(user, **columns))]
    return F.array(*[F.struct(F.lit(r).alias("role"), c.alias("content")) for r, c in made if c is not None])


def fill(template: str, **columns: Column) -> Column | None:
    """A template as an expression; null for an empty one."""
    if not template:
        return None
    import re

    pieces = re.split(r"\{(\w+)\}", template)
    return F.concat(*[columns[p] if n % 2 else F.lit(p) for n, p in enumerate(pieces) if n % 2 or p])


#: Instructions by kind of question, `{question}` and `{choices}` filled in.
KINDS = {
    "single choice": "Choose one of A to D.\n{question}\n{choices}\nAnswer:",
    "multiple choice": "Choose all that are right.\n{question}\n{choices}\nAnswers:",
    "open": "{question}\nAnswer:",
}


def prompt_of_kind(kind: Column, question: Column, choices: Column) -> Column:
    made = F.lit(None).cast("string")
    for name, template in KINDS.items():
        made = F.when(kind == name, fill(template, question=question, choices=choices)).otherwise(made)
    return made


def message_budgets(turns: DataFrame, budget: int, keys: tuple[str, ...] = ("conv_id",)) -> DataFrame:
    """Turns (keys, turn, text) cut to the words that are left of a conversation's budget before them."""
    w = turns.withColumn("_w", tx.words(F.col("text")))
    before = F.coalesce(F.sum(F.size("_w")).over(Window.partitionBy(*keys).orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.greatest(F.lit(0), F.lit(budget) - before).cast("int")
    return w.withColumn("_left", left).where("_left > 0").withColumn("text", F.array_join(F.slice("_w", 1, F.col("_left")), " ")).drop("_w", "_left")


def fit_exemplars(sizes: Column, budget: int) -> Column:
    """Positions (from 0) of the longest run of exemplars within the budget: from the first that fits by itself."""
    head = F.array_position(F.transform(sizes, lambda x: x <= budget), True).cast("int") - 1
    start = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(True).alias("open"), F.array().cast("array<int>").alias("kept"))

    def step(a, x):
        total = a["sum"] + x["size"]
        fits = a["open"] & (total <= budget)
        return F.struct(total.cast("long").alias("sum"), fits.alias("open"), F.when(fits, F.concat(a["kept"], F.array(x["n"]))).otherwise(a["kept"]).alias("kept"))

    placed = F.transform(sizes, lambda x, n: F.struct(x.alias("size"), n.alias("n")))
    run = F.aggregate(F.filter(placed, lambda x: x["n"] >= head), start, step, lambda a: a["kept"])
    return F.when(head >= 0, run).otherwise(F.array().cast("array<int>"))


# --- generator ----------------------------------------------------------------------------


def cut_at_stop(c: Column, stops: tuple[str, ...], most_words: int | None = None) -> Column:
    """A generation up to its first stop string, and of so many words at most."""
    import re

    out = F.regexp_replace(c, "(?s)(" + "|".join(map(re.escape, stops)) + ").*$", "") if stops else c
    return out if most_words is None else F.array_join(F.slice(F.split(out, " "), 1, most_words), " ")


class Generator:
    """The generator seam: generate() answers a batch of prompts; a model is loaded once for each worker.

    It gets batches of prompts of like length, `budget` tokens each, smaller ones once memory runs out.
    """

    budget = BUDGET

    def generate(self, prompts: list[str], stop: tuple[str, ...] = (), max_words: int | None = None) -> list[str]:
        raise NotImplementedError

    def apply(self, rows: DataFrame, prompt: str, out: str = "pred", stop: tuple[str, ...] = (), max_words: int | None = None) -> DataFrame:
        own = self

        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for prompts in batches:
                held = prompts.fillna("").tolist()
                yield pd.Series(by_budget(lambda part: own.generate(part, stop, max_words), held, token_sizes(held), own.budget), dtype=object)

        run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
        return rows.withColumn(out, F.pandas_udf(run, "string")(prompt))


class FirstSentence(Generator):
    """The offline stand-in: the first sentence behind the last line break but one of the prompt's context."""

    def __init__(self, behind: str = ""):
        self.behind = behind

    def generate(self, prompts, stop=(), max_words=None):
        import re

        out = []
        for p in prompts:
            text = p.split(self.behind, 1)[-1] if self.behind else p
            text = re.match(r"[^.!?\n]*", text)[0]
            for s in stop:
                text = text.split(s, 1)[0]
            out.append(" ".join(text.split(" ")[:max_words]) if max_words is not None else text)
        return out


def fused_token(logits: DataFrame) -> DataFrame:
    """(q_id, token, score) of the best token by summed weighted logits; weights (doc scores) are shares of their sum.

    logits: q_id, doc_id, score, token, logit.
    """
    total = logits.select("q_id", "doc_id", "score").dropDuplicates().groupBy("q_id").agg(F.sum("score").alias("total"))
    fused = logits.join(total, "q_id").groupBy("q_id", "token").agg(F.round(F.sum(F.col("score") / F.col("total") * F.col("logit")), 6).alias("score"))
    w = Window.partitionBy("q_id").orderBy(F.desc("score"), "token")
    return fused.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


# --- parsers ------------------------------------------------------------------------------

PARSERS: dict[str, Callable[[Column], Column]] = {
    "basic": lambda t: F.substring_index(t, "\n", 1),
    "selfask": lambda t: F.regexp_extract(t, r"So the final answer is: ([^\n]*)", 1),
    "ircot": lambda t: F.trim(F.substring_index(t, "So the answer is:", -1)),
    "single choice": lambda t: F.coalesce(F.try_element_at(F.regexp_extract_all(t, F.lit(r"\b([A-D])\b"), F.lit(1)), F.lit(-1)), F.lit("")),
    "multiple choice": lambda t: F.array_join(F.array_sort(F.array_distinct(F.regexp_extract_all(t, F.lit(r"\b([A-D])\b"), F.lit(1)))), ""),
    "boxed": lambda t: F.coalesce(F.try_element_at(F.regexp_extract_all(t, F.lit(r"\\boxed\{([^{}]*)\}"), F.lit(1)), F.lit(-1)), F.lit("")),
    "tagged": lambda t: F.coalesce(tx.last_between(t, "<answer>", "</answer>"), F.lit("")),
}


def sure_candidates(t: Column) -> Column:
    """array<struct<label, answer>> of `(a) answer (b) answer`."""
    labels = F.regexp_extract_all(t, F.lit(r"\((\w+)\)\s*([^()]+)"), F.lit(1))
    answers = F.regexp_extract_all(t, F.lit(r"\((\w+)\)\s*([^()]+)"), F.lit(2))
    return F.transform(F.arrays_zip(labels.alias("l"), answers.alias("a")), lambda x: F.struct(x["l"].alias("label"), F.trim(x["a"]).alias("answer")))


def action_blocks(t: Column) -> list[Column]:
    """(thought, function, query) of a step: labelled blocks, the action a JSON object in backticks."""
    thought = F.trim(F.regexp_extract(t, r"(?s)Thought:(.*?)(?:\nAction:|$)", 1))
    body = F.regexp_extract(t, r"(?s)Action:\s*```(?:json)?\s*(.*?)\s*```", 1)
    act = F.from_json(body, "function string, parameters struct<query:string, answer:string>")
    return [thought.alias("thought"), act["function"].alias("function"), F.coalesce(act["parameters"]["query"], act["parameters"]["answer"]).alias("query")]


def numbered_documents(found: DataFrame, title: str = "title", text: str = "text") -> DataFrame:
    """(q_id, docs): `(i)Title: ... Text: ...` of hits by rank, a number that leads a title dropped."""
    line = F.concat(F.lit("("), F.col("rank").cast("string"), F.lit(")Title: "), F.regexp_replace(F.col(title), r"^\d+\s+", ""), F.lit(" Text: "), F.col(text), F.lit("\n"))
    return found.groupBy("q_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", line.alias("line")))), lambda x: x["line"]), "").alias("docs"))


def adaptive_route(question: Column, short: int = 15, long: int = 30) -> Column:
    """Stand-in for the classifier of question kinds: A none, B one, C several retrievals, by words."""
    n = F.size(tx.words(question))
    return F.when(n <= short, "A").when(n <= long, "B").otherwise("C")


# --- agent loops --------------------------------------------------------------------------


@dataclass
class Policy:
    """What makes one agent differ from another: its rounds, its queries in a step, what it does with an answer.

    grow: the next query from (text, query, answer). finish: whether a state is done, from the
    columns (answer, last, round); reasons are kept. subqueries: array<string> of one step's searches.
    """

    rounds: int
    grow: Callable[[Column, Column, Column], Column] = lambda text, query, answer: F.concat_ws(" ", text, answer)
    finish: Callable[[Column, Column], Column] = lambda answer, last: F.when(answer == "", "empty").when(answer == last, "repeat")
    subqueries: Callable[[Column], Column] = lambda query: F.array(query)
    parser: str = "basic"


def run_agent(questions: DataFrame, search: Callable[[DataFrame], DataFrame], texts: DataFrame, policy: Policy, settle: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(q_id, answer, trail, reason) of bounded retrieve-and-answer rounds with a finish reason for each question.

    A round searches the open questions' queries only. search(q_id, text) gives (q_id, doc_id,
    rank); answers are the first sentence of the best document of each subquery, joined. State is
    a written table of one row for each question.
    """
    few = few_of(questions)
    state = questions.select("q_id", "text", F.col("text").alias("query"), F.lit("").alias("answer"), F.array().cast("array<string>").alias("trail"), F.lit(None).cast("string").alias("reason"))
    for turn in range(1, policy.rounds + 1):
        going = state.where("reason IS NULL")
        steps = going.select("q_id", F.posexplode(policy.subqueries(F.col("query"))).alias("part", "text")).withColumn("step", F.concat_ws(":", "q_id", "part"))
        found = search(steps.select(F.col("step").alias("q_id"), "text")).where("rank = 1").select(F.col("q_id").alias("step"), "doc_id")
        said = F.regexp_extract("doc", r"^([^.!?\n]*)", 1)
        docs = texts.select("doc_id", F.col("text").alias("doc"))
        answers = few(steps.join(found, "step")).join(docs, "doc_id").groupBy("q_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", said.alias("a")))), lambda x: x["a"]), " ").alias("new"))
        next_ = going.join(answers, "q_id", "left").withColumn("new", PARSERS[policy.parser](F.coalesce("new", F.lit(""))))
        why = policy.finish(F.col("new"), F.col("answer"))
        done = F.coalesce(why, F.lit("rounds") if turn == policy.rounds else F.lit(None).cast("string"))
        moved = next_.select("q_id", "text", policy.grow(F.col("text"), F.col("query"), F.col("new")).alias("query"), F.when(F.col("new") == "", F.col("answer")).otherwise(F.col("new")).alias("answer"), F.concat("trail", F.array("new")).alias("trail"), done.alias("reason"))
        state = settle(moved.unionByName(state.where("reason IS NOT NULL")))
        if state.where("reason IS NULL").isEmpty():
            break
    return state.select("q_id", "answer", "trail", "reason")


#: The agents by name.
POLICIES = {
    "iterative": Policy(3, finish=lambda answer, last: F.lit(None).cast("string")),
    "confident": Policy(5, finish=lambda answer, last: F.when(F.forall(F.split(answer, " "), lambda w: F.length(w) > 1), "confident"), grow=lambda text, query, answer: F.concat_ws(" ", text, F.array_join(F.filter(F.split(answer, " "), lambda w: F.length(w) > 3), " "))),
    "self-ask": Policy(5, grow=lambda text, query, answer: F.concat_ws(" ", text, F.lit("Intermediate answer:"), answer)),
    "reasoning": Policy(5, parser="basic", finish=lambda answer, last: F.when(answer == "", "no answer").when(answer == last, "answer found")),
    "boxed": Policy(10, finish=lambda answer, last: F.when(answer == last, "boxed")),
    "tagged": Policy(4, grow=lambda text, query, answer: F.concat_ws(" ", query, answer)),
    "several queries": Policy(2, subqueries=lambda query: F.slice(F.split(query, r"(?<=[,;.]) "), 1, 3)),
    "thought and action": Policy(15, finish=lambda answer, last: F.when(answer == last, "repeat").when(answer == "", "finish")),
    "chain of sub-queries": Policy(4, finish=lambda answer, last: F.lit(None).cast("string"), grow=lambda text, query, answer: answer),
}


def query_tree(questions: DataFrame, search: Callable[[DataFrame], DataFrame], texts: DataFrame, levels: int, settle: Callable[[DataFrame], DataFrame], width: int = 3) -> DataFrame:
    """(q_id, path, answer, prob): the best leaf of a tree of queries.

    Each level offers every frontier node four actions: answer as it is, rewrite (by the answer),
    decompose (the first half of the query) and disambiguate (the second half). A node's
    probability is the mean over its path of the share of its query's terms that the best document
    holds, in place of mean token probabilities; a question keeps `width` nodes of each level.
    """
    frontier = questions.select("q_id", F.col("text").alias("query"), F.lit("").alias("path"), F.lit("").alias("answer"), F.lit(0.0).alias("sum"))
    leaves, few = None, few_of(questions)
    for level in range(1, levels + 1):
        node = frontier.withColumn("node", F.concat_ws("|", "q_id", "path"))
        best = search(node.select(F.col("node").alias("q_id"), F.col("query").alias("text"))).where("rank = 1").select(F.col("q_id").alias("node"), "doc_id")
        held = texts.select("doc_id", F.col("text").alias("doc"))
        terms = F.array_distinct(tx.tokens(F.col("query")))
        share = F.size(F.array_intersect(terms, tx.tokens(F.col("doc")))) / F.greatest(F.size(terms), F.lit(1))
        seen = settle(few(node.join(best, "node")).join(held, "doc_id").select("q_id", "query", "path", F.regexp_extract("doc", r"^([^.!?\n]*)", 1).alias("answer"), (F.col("sum") + share).alias("sum")))
        own = seen.select("q_id", F.concat("path", F.lit("A")).alias("path"), "answer", F.round(F.col("sum") / level, 6).alias("prob"))
        leaves = own if leaves is None else leaves.unionByName(own)
        w = tx.words(F.col("query"))
        half = F.ceil(F.size(w) / 2).cast("int")
        actions = F.array(*[F.struct(F.lit(a).alias("a"), q.alias("q")) for a, q in (("R", F.concat_ws(" ", "query", "answer")), ("D", F.array_join(F.slice(w, F.lit(1), half), " ")), ("B", F.array_join(F.slice(w, half + 1, F.greatest(F.size(w), F.lit(1))), " ")))])
        grown = seen.where("query <> ''").withColumn("x", F.explode(actions)).select("q_id", F.col("x.q").alias("query"), F.concat("path", F.col("x.a")).alias("path"), "answer", "sum")
        order = Window.partitionBy("q_id").orderBy(F.desc("sum"), "path")
        frontier = settle(grown.where("query <> ''").withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= width).drop("_r"))
    order = Window.partitionBy("q_id").orderBy(F.desc("prob"), "path")
    return leaves.withColumn("_r", F.row_number().over(order)).where("_r = 1").drop("_r")


# --- datasets and configuration -----------------------------------------------------------


def update_column(rows: DataFrame, values: DataFrame, name: str, key: str = "id") -> DataFrame:
    """rows with a column of other rows' values, joined by key; those without one keep null."""
    return rows.drop(name).join(values.select(key, name), key, "left")


def batches_of(rows: DataFrame, size: int, key: str = "id", groups: int = 64) -> DataFrame:
    """rows with `batch`: at most `size` rows of one batch, numbered within groups of hashed keys."""
    group = F.pmod(F.xxhash64(key), F.lit(groups))
    place = F.row_number().over(Window.partitionBy("_g").orderBy(key)) - 1
    return rows.withColumn("_g", group).withColumn("batch", F.concat_ws("-", "_g", F.floor(place / size).cast("long"))).drop("_g")


def fitting_batch_size(n: int, base: int = 4, most: int = 64) -> int:
    """From base upwards the first divisor of n, most at most."""
    return next((k for k in range(base, most + 1) if n and n % k == 0), most)


@dataclass
class Config:
    """Parameters in layers: defaults, then a file's values, then a call's. Unknown names are errors."""

    k_retrieve: int = 180
    over_fetch: float = 1.2
    k_rerank: int = 55
    k_final: int = 5
    weights: dict[str, float] = field(default_factory=lambda: {"dense": 0.6, "bm25": 0.4})
    metrics: tuple[str, ...] = ("hit", "recall", "mrr", "ndcg")

    def over(self, *layers: dict) -> Config:
        out = self
        for layer in layers:
            unknown = set(layer) - {f.name for f in fields(self)}
            if unknown:
                raise ValueError(f"unknown parameters: {sorted(unknown)}")
            out = replace(out, **layer)
        return out


def made_by(registry: dict[str, Callable], name: str, **arguments):
    """What a registry's entry makes; a name that it lacks is an error with the names that it has."""
    if name not in registry:
        raise KeyError(f"{name} is none of {sorted(registry)}")
    return registry[name](**arguments)
