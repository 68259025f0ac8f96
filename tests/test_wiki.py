"""Each rule of the wiki clean-up on small markup, pages that are no articles, odd rows."""

import html

import pytest

from corvid.functions import wiki

CASES = [
    ("'''Ann''' met [[Bob]]", " Ann  met  Bob "),
    ("a {{cite web\n|url=b}} c", "a   c"),
    ("{{formatnum:12}}<br>TABLETOREPLACE", " 12   "),
    ("a &amp;nbsp; b & amp; c", "a &  b & c"),
    ("a<math>x\n<y</math>b<chem>H</chem>c<score>d</score>e", "abce"),
    ("x | item1_style= b | colstyle= c | style= d | border-style= e f", "x     f"),
    ('x| style="a" rowspan="2" y', "x y"),
    ('x| style="a b" y', 'x b" y'),
    ("x rowspan=2| colspan=3 bg=#abc height=12 width=9 y", "x y"),
    ("a\nb\tc", "a b c"),
    ("a<ref name=b/>c", "ac"),
    ("a align=left| valign=top scope=row b", "a| v b"),
    ("a &amp;lt;ref&amp;gt;note&amp;lt;/ref&amp;gt; b", "a   b"),
    ("a &amp;lt;b&amp;gt; b", "a   b"),
    ("File:Some map 2.png|220px x", " x"),
    ("Source: [here] x", " x"),
    ("flag|AA flagicon|BB flagcountry|CC Flagu|DD", "country:AA country:BB country:CC country:DD"),
    ("a display=inline abbr=on disp=table b", "a    b"),
    ("An end. References.", "An end."),
    ("", ""),
    ("  a 　", "a"),
]


def test_rules(spark):
    rows = [(k, "T", x) for k, (x, _) in enumerate(CASES)]
    got = {r.id: r.text for r in wiki.articles(spark.createDataFrame(rows, "id long, title string, text string")).collect()}
    for k, (source, want) in enumerate(CASES):
        assert got[k] == want, (source, got[k])


def test_what_is_no_article(spark):
    rows = [(1, "List of things", "x"), (2, "A list of things", "x"), (3, "Ann (Disambiguation)", "x"), (4, "Index of ", "x"), (5, "Outline of y", "x"), (6, "A", " REDIRECT b"), (7, "A", "Redirect b"), (8, "A", "redirect b"), (9, None, "x"), (10, "A\nB\tC", None), (11, "List&nbsp;of x", "y"), (12, "List &#111;f x", "y")]
    got = {r.id: (r.title, r.text) for r in wiki.articles(spark.createDataFrame(rows, "id long, title string, text string")).collect()}
    assert got == {2: ("A list of things", "x"), 4: ("Index of ", "x"), 7: ("A", "Redirect b"), 9: (None, "x"), 10: ("A B C", None), 11: ("List of x", "y")}


@pytest.mark.parametrize("text", ["&eacute;&copy &#233;&#xe9; &notit; &amp;lt; & &;", "plain", "", "&" * 1000])
def test_character_references(spark, text):
    rows = spark.createDataFrame([(text,), (None,)], "s string").select(wiki.unescape("s").alias("s")).collect()
    assert [r.s for r in rows] == [html.unescape(text), None]


def test_very_long_text(spark):
    text = "word [[link]] <ref a/> " * 200_000
    rows = spark.createDataFrame([(1, "T", text)], "id long, title string, text string")
    assert wiki.articles(rows).first().text == ("word  link   " * 200_000)[:-1]


def test_empty_table(spark):
    assert wiki.articles(spark.createDataFrame([], "title string, text string, other int")).collect() == []
