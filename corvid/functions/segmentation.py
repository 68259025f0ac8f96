"""Words of scripts without spaces: the most probable path over the dictionary graph of a line.

A line's graph has an edge for each dictionary word at each place, and one for each single
character, at a floor if the dictionary lacks it. The best path is found from the line's end
backwards (Viterbi); of equal paths the one with the longest first word counts.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of a dictionary that is sent to all tasks, the most frequent ones.
MOST_WORDS = 200_000


@dataclass
class Dictionary:
    """Words with their log probabilities; floor is that of a character that is no word."""

    logs: dict[str, float]
    longest: int
    floor: float

    @classmethod
    def of(cls, counts: dict[str, int]) -> Dictionary:
        total = sum(counts.values()) + 1
        return cls({w: math.log(n / total) for w, n in counts.items() if w and n > 0}, max(map(len, counts), default=1), math.log(0.5 / total))

    def words(self, line: str) -> list[str]:
        """The words of one line."""
        get, floor, n = self.logs.get, self.floor, len(line)
        best, size = [0.0] * (n + 1), [1] * (n + 1)
        for i in range(n - 1, -1, -1):
            top, long = get(line[i], floor) + best[i + 1], 1
            for j in range(i + 2, min(n, i + self.longest) + 1):
                p = get(line[i:j])
                if p is not None and p + best[j] >= top:
                    top, long = p + best[j], j - i
            best[i], size[i] = top, long
        out, i = [], 0
        while i < n:
            out.append(line[i : i + size[i]])
            i += size[i]
        return out


#: Runs that are segmented; blanks and punctuation stand between them.
RUN = r"\w+"


def dictionary(words: DataFrame, most: int = MOST_WORDS) -> Dictionary:
    """The `most` most frequent of words (word, n), ties by the word."""
    rows = words.where("n > 0").orderBy(F.desc("n"), "word").limit(most).collect()  # at most `most`
    return Dictionary.of({r.word: r.n for r in rows})


def segmenter(spark, own: Dictionary):
    """A function of a text column -> its words; the dictionary is sent once."""
    sent = spark.sparkContext.broadcast(own)  # MOST_WORDS words at most

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known, find = sent.value, re.compile(RUN).findall
        for b in batches:
            yield b.map(lambda x: [w for line in find(x or "") for w in known.words(line)])

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    made = F.pandas_udf(run, "array<string>")

    def words(c: Column) -> Column:
        return made(F.lower(c))

    return words
