"""Pages of a wiki dump: pages that are no articles go, residues of markup are removed.

Rules are data and run in their order as JVM expressions; only HTML's named characters need Python.
"""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space as Unicode has it, in Java's and RE2's syntax.
BLANKS = r"[\t-\r\x1c-\x20\x{85}\p{Z}]+"

# What is removed from a page's text, in this order.
NOT_ARTICLES = r"^(List|Index|Outline) of ."
CITATION = r"(?s)\{\{cite .*?\}\}"
MARKS = (
    ("TABLETOREPLACE", " "), ("'''", " "), ("[[", " "), ("]]", " "), ("{{", " "), ("}}", " "), ("<br>", " "), ("&quot;", '"'), ("&amp;", "&"), ("& amp;", "&"), ("nbsp;", " "), ("formatnum:", ""),
)
BLOCKS = ("math", "chem", "score")
STYLED = ("item[0-9]?_?", "col[0-9]?_?", "row[0-9]?_?", "", "body", "frame_?", "data_?", "label_?", "header", "list_?", "title_?", "ul_?", "li_?", "border-")
QUOTED = ("style", "rowspan", "colspan", "scope", "align", "valign", "lang", "bgcolor")
SIZES = ("height", "width", "rowspan", "colspan")
ALIGNED = ("align", "valign", "scope")
FILE = r"File:[A-Za-z0-9 ]+\.[a-z]{3,4}(\|[0-9]+px)?"
LAST_MARKS = (
    ("Country flag|", "country:"), ("flag|", "country:"), ("flagicon|", "country:"), ("flagcountry|", "country:"), ("Flagu|", "country:"), ("display=inline", ""), ("display=it", ""), ("abbr=on", ""), ("disp=table", ""),
)

#: (pattern, replacement) between the two lists of marks.
PATTERNS = (
    *((rf"(?s)<{b}.*?</{b}>", "") for b in BLOCKS),
    *((rf"\| ?{s}style= ?.*? ", " ") for s in STYLED),
    *((rf'\|? ?{q}=".*?"', "") for q in QUOTED),
    (r"\|? ?bg=#[a-z]+", ""),
    (r'\|? ?width=".*?"', ""),
    *((rf"\|? ?{s}=[0-9]+", "") for s in SIZES),
    (r"[\n\t]", " "),
    (r"<.*?/>", ""),
    *((rf"\|? ?{a}=[a-z]+", "") for a in ALIGNED),
    (r"&lt;ref&gt;.*?&lt;/ref&gt;", " "),
    (r"&lt;.*?&gt;", " "),
    (FILE, ""),
    (r"Source: \[.*?\]", ""),
)


@F.pandas_udf(T.StringType())
def unescape(s: pd.Series) -> pd.Series:
    """HTML's character references, once, with or without their semicolon; null stays null."""
    marked = s.str.contains("&", regex=False).fillna(False).astype(bool)
    return s.where(~marked, s[marked].map(html.unescape))


def strip(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, "^" + BLANKS, ""), BLANKS + r"\z", "")


def is_article(title: Column, text: Column) -> Column:
    """Whether an unescaped title and a stripped text are neither disambiguation, list, index, outline nor redirect."""
    no = F.lower(title).contains("(disambiguation)") | F.lower(title).contains("(disambiguation page)") | title.rlike("(?d)" + NOT_ARTICLES)
    return ~(F.coalesce(no, F.lit(False)) | F.coalesce(text.startswith("REDIRECT") | text.startswith("redirect"), F.lit(False)))


def without_markup(text: Column) -> Column:
    """An unescaped, stripped text without the residues; `.` of the patterns is all but the line feed."""
    tail = ". References."
    c = F.when(text.endswith(tail), strip(F.substr(text, F.lit(1), F.length(text) - len(tail) + 1))).otherwise(text)
    c = F.regexp_replace(c, CITATION, " ")
    for mark, value in MARKS:
        c = F.replace(c, F.lit(mark), F.lit(value))
    for pattern, value in PATTERNS:
        c = F.regexp_replace(c, "(?d)" + pattern, value)
    for mark, value in LAST_MARKS:
        c = F.replace(c, F.lit(mark), F.lit(value))
    return c


def articles(pages, title: str = "title", text: str = "text"):
    """pages with cleaned title and text, without those that are no articles; a null title or text stays null."""
    held = pages.withColumns({title: unescape(F.col(title)), text: unescape(F.col(text))}).withColumn(text, strip(F.col(text)))
    kept = held.where(is_article(F.col(title), F.col(text)))
    return kept.withColumns({title: F.translate(title, "\n\t", "  "), text: without_markup(F.col(text))})
