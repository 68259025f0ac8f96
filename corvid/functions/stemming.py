"""Snowball stemmers and stop lists by language, run once for each distinct term.

A stemmer is a sequence of steps over a word and its regions: R1 stands behind the first
non-vowel that follows a vowel, R2 is the same within R1, and RV is the Spanish region, which
begins earlier. A step looks for the longest suffix of its table and does what stands beside it if
the suffix lies in the region asked. The tables are parameters of a step, not code.

stem_terms() applies one to a frame's distinct terms and joins the stems back, so the work in
Python grows with the vocabulary and not with the texts.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The usual short stop lists.
STOP_LISTS = {
    "en": "a about above after again against all am an and any are as at be because been before being below between both but by can did do does doing down during each few for from further had has have having he her here hers him his how i if in into is it its itself just me more most my no nor not now of off on once only or other our out over own same she should so some such than that the their them then there these they this those through to too under until up very was we were what when where which while who whom why will with you your".split(),
    "de": "aber alle als also am an auch auf aus bei bin bis bist da damit dann das dass dein dem den der des dich die dies diese dir doch dort du durch ein eine einem einen einer eines er es für hat hatte hier ich ihr ihre im in ist ja kann kein keine man mein mich mir mit nach nicht noch nun nur ob oder ohne sehr sein sich sie sind so über um und uns unter vom von vor war was wenn wie wir wird zu zum zur".split(),
    "es": "a al algo como con contra cual cuando de del desde donde durante e el ella ellos en entre era es esa ese eso esta este esto fue ha hay la las le les lo los más me mi mucho muy nada ni no nos o os otra otro para pero poco por porque que quien se sea ser si sin sobre son su sus también te tiene todo tu tus un una uno unos y ya yo".split(),
    "fr": "à au aux avec ce ces cette dans de des du elle elles en est et eu eux il ils je la le les leur leurs lui ma mais me même mes moi mon ne nos notre nous on ont ou où par pas pour qu que qui sa sans se ses si son sont sur ta te tes toi ton tu un une vos votre vous y".split(),
}


def region(word: str, vowels: str, start: int = 0) -> int:
    """Where R1 of word[start:] begins: behind the first non-vowel that follows a vowel."""
    found = re.compile(f"[{vowels}][^{vowels}]").search(word, start)
    return found.end() if found else len(word)


def longest(word: str, table: dict[str, object], start: int = 0) -> str | None:
    """The longest suffix of word[start:] that the table has."""
    for at in range(max(start, len(word) - max(map(len, table))), len(word)):
        if word[at:] in table:
            return word[at:]
    return None


def table(spec: str) -> dict[str, str]:
    """"ational:ate izer:ize" as suffix -> replacement; no colon: the suffix goes."""
    return dict((x.split(":") + [""])[:2] for x in spec.split())


# --- English ---------------------------------------------------------------------------------

_EN = "aeiouy"
_EN_DOUBLE = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
# The exceptional forms and suffix tables of the English stemmer.
_EN_FORMS = table("skis:ski skies:sky dying:die lying:lie tying:tie idly:idl gently:gentl ugly:ugli early:earli only:onli singly:singl sky:sky news:news howe:howe atlas:atlas cosmos:cosmos bias:bias andes:andes")
_EN_AFTER = set("inning outing canning herring earring proceed exceed succeed".split())
_EN_PREFIXES = ("gener", "commun", "arsen")
_EN_1B = table("eed:ee eedly:ee ed edly ing ingly")
_EN_2 = table("ational:ate tional:tion enci:ence anci:ance abli:able entli:ent izer:ize ization:ize ation:ate ator:ate alism:al aliti:al alli:al fulness:ful ousli:ous ousness:ous iveness:ive iviti:ive biliti:ble bli:ble ogi:og fulli:ful lessli:less li")
_EN_3 = table("ational:ate tional:tion alize:al icate:ic iciti:ic ical:ic ful ness ative")
_EN_4 = table("al ance ence er ic able ible ant ement ment ent ism ate iti ous ive ize ion")


def _en_short(word: str) -> bool:
    """Whether the word ends in a short syllable."""
    return bool(re.search(r"[^aeiouy][aeiouy][^aeiouywxY]$|^[aeiouy][^aeiouy]$", word))


def english(word: str) -> str:
    """Porter's second stemmer."""
    if len(word) <= 2:
        return word
    if word in _EN_FORMS:
        return _EN_FORMS[word]
    word = re.sub(r"(?<=[aeiouy])y", "Y", re.sub(r"^y", "Y", word.removeprefix("'")))
    head = next((p for p in _EN_PREFIXES if word.startswith(p)), None)
    r1 = len(head) if head else region(word, _EN)
    r2 = region(word, _EN, r1)
    word = re.sub(r"'s'$|'s$|'$", "", word)
    # 1a: plurals
    if word.endswith("sses"):
        word = word[:-2]
    elif word.endswith(("ied", "ies")):
        word = word[:-2] if len(word) > 4 else word[:-1]
    elif word.endswith("s") and not word.endswith(("us", "ss")) and re.search("[aeiouy]", word[:-2]):
        word = word[:-1]
    if word in _EN_AFTER:
        return word
    # 1b: past and present participles
    if end := longest(word, _EN_1B):
        if end in ("eed", "eedly"):
            if len(word) - len(end) >= r1:
                word = word[: -len(end)] + "ee"
        elif re.search("[aeiouy]", word[: -len(end)]):
            word = word[: -len(end)]
            if word.endswith(("at", "bl", "iz")):
                word += "e"
            elif word.endswith(_EN_DOUBLE):
                word = word[:-1]
            elif r1 >= len(word) and _en_short(word):
                word += "e"
    # 1c: a last y behind a consonant that does not begin the word
    if len(word) > 2 and word[-1] in "yY" and word[-2] not in _EN:
        word = word[:-1] + "i"
    # 2 and 3: longer suffixes to shorter ones, in R1
    if (end := longest(word, _EN_2)) and len(word) - len(end) >= r1:
        stem = word[: -len(end)]
        if end == "li":
            word = stem if stem[-1:] in tuple("cdeghkmnrt") else word
        elif end != "ogi" or stem.endswith("l"):
            word = stem + _EN_2[end]
    if (end := longest(word, _EN_3)) and len(word) - len(end) >= r1 and (end != "ative" or len(word) - len(end) >= r2):
        word = word[: -len(end)] + _EN_3[end]
    # 4: suffixes that go, in R2
    if (end := longest(word, _EN_4)) and len(word) - len(end) >= r2 and (end != "ion" or word[:-3].endswith(("s", "t"))):
        word = word[: -len(end)]
    # 5: a last e or a second l
    last = len(word) - 1
    if word.endswith("e") and (last >= r2 or last >= r1 and not _en_short(word[:-1])) or word.endswith("ll") and last >= r2:
        word = word[:-1]
    return word.replace("Y", "y")


# --- German ----------------------------------------------------------------------------------

_DE = "aeiouyäöü"


def german(word: str) -> str:
    word = re.sub(rf"(?<=[{_DE}])u(?=[{_DE}])", "U", word.replace("ß", "ss"))
    word = re.sub(rf"(?<=[{_DE}])y(?=[{_DE}])", "Y", word)
    first = region(word, _DE)
    r1, r2 = max(3, first) if first < len(word) else first, region(word, _DE, first)
    # 1: endings of nouns
    if (end := longest(word, table("em ern er e en es s"))) and len(word) - len(end) >= r1:
        stem = word[: -len(end)]
        if end != "s" or stem[-1:] in tuple("bdfghklmnrt"):
            word = stem[:-1] if end in ("e", "en", "es") and stem.endswith("niss") else stem
    # 2: endings of adjectives and verbs
    if (end := longest(word, table("en er est st"))) and len(word) - len(end) >= r1:
        stem = word[: -len(end)]
        if end != "st" or len(stem) >= 4 and stem[-1] in "bdfghklmnt":
            word = stem
    # 3: derived words
    if (end := longest(word, table("end ung ig ik isch lich heit keit"))) and len(word) - len(end) >= r2:
        stem = word[: -len(end)]
        if end in ("end", "ung"):
            word = stem
            if word.endswith("ig") and not word.endswith("eig") and len(word) - 2 >= r2:
                word = word[:-2]
        elif end in ("ig", "ik", "isch"):
            word = word if stem.endswith("e") else stem
        elif end in ("lich", "heit"):
            word = stem[:-2] if stem.endswith(("er", "en")) and len(stem) - 2 >= r1 else stem
        else:
            word = stem
            if more := longest(word, table("lich ig")):
                word = word[: -len(more)] if len(word) - len(more) >= r2 else word
    return word.lower().translate(str.maketrans("äöü", "aou"))


# --- Spanish ---------------------------------------------------------------------------------

_ES = "aeiouáéíóúü"
# The suffix tables of the Spanish stemmer.
_ES_PRONOUNS = table("me se sela selo selas selos la le lo las les los nos")
_ES_1 = {
    "delete": table("anza anzas ico ica icos icas ismo ismos able ables ible ibles ista istas oso osa osos osas amiento amientos imiento imientos"),
    "ic": table("adora ador ación adoras adores aciones ante antes ancia ancias"),
    "log": table("logía logías"),
    "u": table("ución uciones"),
    "ente": table("encia encias"),
}
_ES_Y = table("ya ye yan yen yeron yendo yo yó yas yes yais yamos")
_ES_GU = table("en es éis emos")
_ES_VERB = table("arían arías arán arás aríais aría aréis aríamos aremos ará aré erían erías erán erás eríais ería eréis eríamos eremos erá eré irían irías irán irás iríais iría iréis iríamos iremos irá iré aba ada ida ía ara iera ad ed id ase iese aste iste an aban ían aran ieran asen iesen aron ieron ado ido ando iendo ió ar er ir as abas adas idas ías aras ieras ases ieses ís áis abais íais arais ierais aseis ieseis asteis isteis ados idos amos ábamos íamos imos áramos iéramos iésemos ásemos")


def _rv_spanish(word: str) -> int:
    if len(word) < 3:
        return len(word)
    if word[1] not in _ES:
        found = re.compile(f"[{_ES}]").search(word, 2)
    elif word[0] in _ES:
        found = re.compile(f"[^{_ES}]").search(word, 2)
    else:
        return 3
    return found.end() if found else len(word)


def spanish(word: str) -> str:
    rv, r1 = _rv_spanish(word), region(word, _ES)
    r2 = region(word, _ES, r1)
    ends = lambda w, s, at: w.endswith(s) and len(w) - len(s) >= at
    bare = str.maketrans("áéíóú", "aeiou")
    # 0: attached pronouns behind a gerund or an infinitive
    if end := longest(word, _ES_PRONOUNS, rv):
        stem = word[: -len(end)]
        if any(ends(stem, s, rv) for s in ("iéndo", "ándo", "ár", "ér", "ír")):
            word = stem.translate(bare)
        elif any(ends(stem, s, rv) for s in ("iendo", "ando", "ar", "er", "ir")) or ends(stem, "yendo", rv) and stem.endswith("uyendo"):
            word = stem
    start = word
    # 1: standard suffixes
    every = {s: kind for kind, t in _ES_1.items() for s in t} | {"amente": "amente", "mente": "mente", "idad": "idad", "idades": "idad", "iva": "iva", "ivo": "iva", "ivas": "iva", "ivos": "iva"}
    if end := longest(word, every):
        kind, stem = every[end], word[: -len(end)]
        if len(stem) >= (r1 if kind == "amente" else r2):
            word = stem + {"log": "log", "u": "u", "ente": "ente"}.get(kind, "")
            more = {"ic": ("ic",), "amente": ("os", "ic", "ad"), "mente": ("ante", "able", "ible"), "idad": ("abil", "ic", "iv"), "iva": ("at",)}.get(kind, ())
            if kind == "amente" and ends(word, "iv", r2):
                word = word[:-2]
                more = ("at",)
            word = next((word[: -len(s)] for s in more if ends(word, s, r2)), word)
    if word == start:
        # 2: verb endings, those with y first
        if (end := longest(word, _ES_Y, rv)) and word[: -len(end)].endswith("u"):
            word = word[: -len(end)]
        elif end := longest(word, {**_ES_VERB, **_ES_GU}, rv):
            stem = word[: -len(end)]
            word = stem[:-1] if end in _ES_GU and stem.endswith("gu") else stem
    # 3: a last vowel
    if end := longest(word, table("os a o á í ó e é"), rv):
        word = word[: -len(end)]
        if end in ("e", "é") and word.endswith("gu") and len(word) - 1 >= rv:
            word = word[:-1]
    return word.translate(bare)


STEMMERS: dict[str, Callable[[str], str]] = {"en": english, "de": german, "es": spanish}


def stems(terms: Column, language: str) -> Column:
    """Stems of lower-case terms in a language with a stemmer, batch by batch."""
    one = STEMMERS[language]

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield b.map(one, na_action="ignore")

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "string")(terms)


def stem_or_none(language: str, stop: dict[str, list[str]] | None = None) -> Callable[[str], str | None]:
    """What analyse() makes of one term of a language: None of a stop word."""
    halted, one = frozenset((STOP_LISTS if stop is None else stop).get(language, ())), STEMMERS.get(language, str)
    return lambda term: None if term in halted else one(term)


def stem_terms(rows: DataFrame, language: str, term: str = "term", out: str = "stem") -> DataFrame:
    """rows with the stem of their term; each distinct term is stemmed once. A language without
    a stemmer leaves terms as they are."""
    if language not in STEMMERS:
        return rows.withColumn(out, F.col(term))
    known = rows.select(term).where(F.col(term).isNotNull()).distinct().withColumn(out, stems(F.col(term), language))
    return rows.join(known, term, "left")


def analyse(rows: DataFrame, language: Column, languages: tuple[str, ...] = ("en", "de", "es"), stop: dict[str, list[str]] | None = None) -> DataFrame:
    """rows (..., term) without the stop words of their row's language, and with its stem in place
    of the term; rows of other languages keep their terms. stop: lists by language, STOP_LISTS unless given."""
    lists = STOP_LISTS if stop is None else stop
    named = rows.withColumn("_lang", language)
    halted = [(x, w) for x, words in lists.items() for w in words]
    if halted:
        named = named.join(F.broadcast(rows.sparkSession.createDataFrame(halted, "_lang string, term string")), ["_lang", "term"], "left_anti")  # the lists alone
    distinct = named.select("_lang", "term").where(F.col("_lang").isin(*languages)).distinct()
    made = None
    for x in languages:
        part = distinct.where(F.col("_lang") == x).withColumn("stem", stems(F.col("term"), x) if x in STEMMERS else F.col("term"))
        made = part if made is None else made.unionByName(part)
    return named.join(made, ["_lang", "term"], "left").withColumn("term", F.coalesce("stem", "term")).drop("stem", "_lang")
