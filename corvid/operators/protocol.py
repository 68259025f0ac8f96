"""Agents that follow a markup: what the model writes is parsed, and the first tag decides the next state.

A protocol is a table of the tags that a model writes, for a search and for an answer, and
of those that its results are given back in. In each turn the writer continues the transcripts
of all open questions; what stands behind the first tag is cut off, as a stop word would, and

    a search for something new   its results go behind the transcript, and the question stays open
    a search asked before        ends with `repeat`
    a search for nothing         ends with `empty query`
    an answer                    ends with `answer`
    no tag                       ends with `no tag`
    the last turn                ends with `rounds`, the last result as the answer

State is a written table of one row for each question, so a lost executor costs a turn.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvid.functions import text as tx

from .retrieval import few_of


@dataclass(frozen=True)
class Protocol:
    """Tags as (before, behind) pairs and the number of turns."""

    search: tuple[str, str]
    answer: tuple[str, str]
    result: tuple[str, str]
    rounds: int

    def pattern(self, tags: tuple[str, str]) -> str:
        """A regular expression whose group is what stands between the tags."""
        before, behind = ("".join("\\" + c if c in r"\.[]{}()*+?^$|" else c for c in t) for t in tags)
        return f"(?s){before}(.*?){behind}"


# The markup that the models of these agents write.
PROTOCOLS = {
    "reasoning": Protocol(("<|begin_of_query|>", "<|end_of_query|>"), ("<answer>", "</answer>"), ("<|begin_of_documents|>", "<|end_of_documents|>"), 5),
    "boxed": Protocol(("<|begin_search_query|>", "<|end_search_query|>"), (r"\boxed{", "}"), ("<|begin_search_result|>", "<|end_search_result|>"), 10),
    "tagged": Protocol(("<search>", "</search>"), ("<answer>", "</answer>"), ("<information>", "</information>"), 4),
    "actions": Protocol(('"function": "search", "parameters": {"query": "', '"}'), ('"function": "finish", "parameters": {"answer": "', '"}'), ("Observation: ", "\n"), 15),
    "sub-queries": Protocol(("Intermediate query: ", "\n"), ("Final answer: ", "\n"), ("Intermediate answer: ", "\n"), 4),
}


def parse(rows: DataFrame, protocol: Protocol) -> DataFrame:
    """rows with `said` -> rows with cut, query and found: the text up to the end of its first tag, and
    what stands in that tag; null where it is another."""
    for name, tags in (("q", protocol.search), ("a", protocol.answer)):
        p = protocol.pattern(tags)
        rows = rows.withColumn(f"_{name}", F.regexp_substr("said", F.lit(p)))
        rows = rows.withColumn(f"_{name}_at", F.when(F.col(f"_{name}").isNotNull(), F.instr("said", F.col(f"_{name}"))))
    first = F.when(F.col("_q_at").isNotNull() & (F.col("_a_at").isNull() | (F.col("_q_at") < F.col("_a_at"))), "q").when(F.col("_a_at").isNotNull(), "a")
    rows = rows.withColumn("_first", first)
    inner = lambda name, tags: F.when(F.col("_first") == name, F.trim(F.regexp_extract(f"_{name}", protocol.pattern(tags), 1)))
    end = lambda name: F.substring("said", F.lit(1), F.col(f"_{name}_at") + F.length(f"_{name}") - 1)
    cut = F.when(F.col("_first") == "q", end("q")).when(F.col("_first") == "a", end("a")).otherwise(F.col("said"))
    return rows.select("*", cut.alias("cut"), inner("q", protocol.search).alias("query"), inner("a", protocol.answer).alias("found")).drop("_q", "_a", "_q_at", "_a_at", "_first")


Writer = Callable[[DataFrame, int], DataFrame]


def run_protocol(questions: DataFrame, search: Callable[[DataFrame], DataFrame], texts: DataFrame, protocol: Protocol, write: Writer, settle: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(q_id, transcript, asked, answer, reason) for questions (q_id, text).

    write(open rows, turn) gives them with `said`; rows have text, transcript and last, the last result.
    search(q_id, text) gives (q_id, doc_id, rank); a result is the first sentence of the best document.
    """
    none, few = F.lit(None).cast("string"), few_of(questions)
    state = questions.select("q_id", "text", F.lit("").alias("transcript"), F.array().cast("array<string>").alias("asked"), F.lit("").alias("last"), none.alias("answer"), none.alias("reason"))
    columns = state.columns
    for turn in range(1, protocol.rounds + 1):
        said = settle(write(state.where("reason IS NULL"), turn).withColumn("said", F.coalesce("said", F.lit(""))))
        read = parse(said, protocol)
        why = (
            F.when(F.col("found").isNotNull(), "answer")
            .when(F.col("query").isNull(), "no tag")
            .when(F.col("query") == "", "empty query")
            .when(F.array_contains("asked", F.col("query")), "repeat")
        )
        read = settle(read.withColumn("why", why))
        going = read.where("why IS NULL")
        hits = search(going.select("q_id", F.col("query").alias("text"))).where("rank = 1").select("q_id", "doc_id")
        held = few(hits).join(texts.select("doc_id", "text"), "doc_id").select("q_id", F.regexp_extract("text", r"^([^.!?\n]*)", 1).alias("result"))
        moved = going.join(held, "q_id", "left").withColumn("result", F.coalesce("result", F.lit("")))
        over = F.lit("rounds") if turn == protocol.rounds else none
        shown = F.concat("transcript", "cut", F.lit(protocol.result[0]), "result", F.lit(protocol.result[1]))
        moved = moved.select("q_id", "text", shown.alias("transcript"), F.concat("asked", F.array("query")).alias("asked"), F.col("result").alias("last"), (F.col("result") if turn == protocol.rounds else none).alias("answer"), over.alias("reason"))
        ended = read.where("why IS NOT NULL").select("q_id", "text", F.concat("transcript", "cut").alias("transcript"), "asked", "last", F.coalesce("found", F.lit("")).alias("answer"), F.col("why").alias("reason"))
        state = settle(state.where("reason IS NOT NULL").unionByName(ended).unionByName(moved).select(*columns))
        if state.where("reason IS NULL").isEmpty():
            break
    return state.select("q_id", "transcript", "asked", "answer", "reason")


def scripted(protocol: Protocol) -> Writer:
    """A stand-in for a model that writes the protocol's markup; what it does depends on the length of the question.

    Of five kinds one searches twice and answers, one searches once and answers, one asks the
    same again, one writes no tag, and one goes on asking for less and less of the question. Each
    writes on behind its tag, as models do.
    """

    def write(rows: DataFrame, turn: int) -> DataFrame:
        kind, text, last = F.length("text") % 5, F.col("text"), F.col("last")
        w = tx.words(text)
        query = F.when((kind == 2) | (F.lit(turn) == 1), text).when(kind == 0, F.concat_ws(" ", text, last)).otherwise(F.array_join(F.slice(w, turn, F.greatest(F.size(w), F.lit(1))), " "))
        plain = lambda c: F.translate(c, '"{}\n', "'() ")  # noqa: E731  inside the tags' own characters
        tagged = lambda tags, c: F.concat(F.lit("I think about it. " + tags[0]), plain(c), F.lit(tags[1] + " and so on " + protocol.answer[0] + "no" + protocol.answer[1]))
        asks = ((kind == 0) & (F.lit(turn) <= 2)) | ((kind == 1) & (F.lit(turn) <= 1)) | kind.isin(2, 4)
        return rows.withColumn("said", F.when(kind == 3, "There is nothing to add.").when(asks, tagged(protocol.search, query)).otherwise(tagged(protocol.answer, last)))

    return write


def with_model(generator, template: Callable[[Column, Column], Column] = lambda text, transcript: F.concat(text, F.lit("\n"), transcript)) -> Writer:
    """A writer behind the generator seam: the prompt is made of question and transcript."""
    return lambda rows, turn: generator.apply(rows.withColumn("_prompt", template(F.col("text"), F.col("transcript"))), "_prompt", "said").drop("_prompt")
