"""Clean-up of wiki pages: markup is put around whole documents, its kind by the document's id."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvid.functions import wiki
from corvid.session import table

from .registry import register

#: Pages' titles by id, and what stands before and behind their texts.
_TITLES = {0: "List of {}", 1: "{} (Disambiguation)", 2: "Index of {}", 3: "{}&nbsp;&amp;\tothers"}
_BEFORE = {
    0: "REDIRECT ",
    1: "  '''Name''' &amp; [[link]] &eacute;&#233; {{cite web\n|url=x}} {{formatnum:12}}<br>",
    2: "{| style=\"a\" rowspan=2 bg=#abc | item1_style= b | colstyle= c | style= d width=\"9\"\n|- align=left valign=\"top\" scope=row height=12 ",
    3: "<math>x\n<y</math> <chem>H2O</chem><score>c d</score> &amp;lt;ref&amp;gt;note&amp;lt;/ref&amp;gt; &amp;lt;b&amp;gt; <ref name=a/> ",
    4: "File:Some map 2.png|220px Source: [here] Country flag|AA flag|BB flagicon|CC Flagu|DD abbr=on display=inline ",
}
_AFTER = {0: ". References.", 1: " &quot;end&quot;", 2: " lang=\"en\" | border-style= solid x"}


def _sql(c: str, table_of: dict[int, str], n: int) -> str:
    return f"CASE {c} % {n} " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in ((k, v.replace("'", "''")) for k, v in table_of.items())) + " ELSE '' END"


def _column(c: str, table_of: dict[int, str], n: int):
    return F.coalesce(*[F.when(F.col(c) % n == k, F.lit(v)) for k, v in table_of.items()], F.lit(""))


def _nested(start: str) -> str:
    """The rules as SQL: the same lists, applied from the inside out."""
    q = lambda x: "'" + x.replace("'", "''") + "'"
    out = f"regexp_replace({start}, {q(wiki.CITATION)}, ' ', 'g')"
    for mark, value in wiki.MARKS:
        out = f"replace({out}, {q(mark)}, {q(value)})"
    for pattern, value in wiki.PATTERNS:
        out = f"regexp_replace({out}, {q(pattern)}, {q(value)}, 'g')"
    for mark, value in wiki.LAST_MARKS:
        out = f"replace({out}, {q(mark)}, {q(value)})"
    return out


def _unescaped(c: str) -> str:
    for name, value in (("&nbsp;", " "), ("&quot;", '"'), ("&eacute;", "é"), ("&#233;", "é"), ("&amp;", "&")):
        c = f"replace({c}, '{name}', '{value}')"
    return c



def _stripped(c: str) -> str:
    return rf"regexp_replace(regexp_replace({c}, '^{wiki.BLANKS}', ''), '{wiki.BLANKS}\z', '')"


_PAGE_TITLE = "CASE doc_id % 13 " + " ".join(f"WHEN {k} THEN replace('{v}', '{{}}', source)" for k, v in _TITLES.items()) + " ELSE source END"


@register("tx12_articles", f"""WITH p AS (SELECT doc_id, {_PAGE_TITLE} AS title, {_sql('doc_id', _BEFORE, 7)} || coalesce(text, '') || {_sql('doc_id', _AFTER, 5)} AS text FROM documents),
u AS (SELECT doc_id, {_unescaped('title')} AS title, {_stripped(_unescaped('text'))} AS text FROM p),
k AS (SELECT doc_id, title, CASE WHEN ends_with(text, '. References.') THEN {_stripped('left(text, length(text) - 12)')} ELSE text END AS text FROM u
  WHERE NOT coalesce(contains(lower(title), '(disambiguation)') OR regexp_matches(title, '{wiki.NOT_ARTICLES}'), false) AND NOT starts_with(text, 'REDIRECT') AND NOT starts_with(text, 'redirect'))
SELECT doc_id, translate(title, chr(10) || chr(9), '  ') AS title, {_nested('text')} AS text FROM k""")
def tx12_articles(spark, d):
    """The articles among pages made of every whole document, with all rules at work."""
    title = F.coalesce(*[F.when(F.col("doc_id") % 13 == k, F.replace(F.lit(v), F.lit("{}"), F.col("source"))) for k, v in _TITLES.items()], F.col("source"))
    text = F.concat(_column("doc_id", _BEFORE, 7), F.coalesce("text", F.lit("")), _column("doc_id", _AFTER, 5))
    pages = table(spark, d, "documents").select("doc_id", title.alias("title"), text.alias("text"))
    return wiki.articles(pages)
