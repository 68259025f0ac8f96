"""Stemmers against words of the published sample vocabularies; terms are stemmed once and joined back."""

import pytest
from pyspark.sql import functions as F

from corvid.functions import stemming as sm

# Word and stem.
EN = "consign:consign consigned:consign consigning:consign consignment:consign consist:consist consisted:consist consistency:consist consistent:consist consistently:consist consisting:consist consists:consist consolation:consol consolations:consol consolatory:consolatori console:consol consoled:consol consoles:consol consolidate:consolid consolidated:consolid consolidating:consolid consoling:consol consolingly:consol consols:consol consonant:conson consort:consort consorted:consort consorting:consort conspicuous:conspicu conspicuously:conspicu conspiracy:conspiraci conspirator:conspir conspirators:conspir conspire:conspir conspired:conspir conspiring:conspir constable:constabl constables:constabl constance:constanc constancy:constanc constant:constant knack:knack knackeries:knackeri knacks:knack knag:knag knave:knave knaves:knave knavish:knavish kneaded:knead kneading:knead knee:knee kneel:kneel kneeled:kneel kneeling:kneel kneels:kneel knees:knee knell:knell knelt:knelt knew:knew knick:knick knif:knif knife:knife knight:knight knightly:knight knights:knight knit:knit knits:knit knitted:knit knitting:knit knives:knive knob:knob knobs:knob knock:knock knocked:knock knocker:knocker knockers:knocker knocking:knock knocks:knock knopp:knopp knot:knot knots:knot generate:generat generally:general generic:generic communities:communiti skies:sky dying:die news:news luxuriate:luxuri hopping:hop hoped:hope agreed:agre ties:tie cries:cri by:by say:say cry:cri exceed:exceed relational:relat sensational:sensat hopefulness:hope"
DE = "aufeinander:aufeinand aufeinanderfolge:aufeinanderfolg aufeinanderfolgen:aufeinanderfolg aufeinanderfolgend:aufeinanderfolg aufeinanderfolgende:aufeinanderfolg aufeinanderfolgt:aufeinanderfolgt aufeinanderfolgten:aufeinanderfolgt aufeinanderschlügen:aufeinanderschlug aufenthalt:aufenthalt aufenthalten:aufenthalt aufenthaltes:aufenthalt auferlegen:auferleg auferlegt:auferlegt auferlegten:auferlegt auferstand:auferstand auferstanden:auferstand auferstehen:aufersteh aufersteht:aufersteht auferstehung:aufersteh auferstünde:auferstund auffahrt:auffahrt auffällig:auffall kategorie:kategori kategorien:kategori kategorisch:kategor kategorische:kategor kategorischen:kategor kategorischer:kategor kater:kat katerliede:katerlied katern:kat katers:kat kathedrale:kathedral katholik:kathol katholische:kathol katholischer:kathol kattun:kattun katze:katz kätzchen:katzch katzen:katz"
ES = "chicharrones:chicharron chicharrón:chicharron chico:chic chicos:chic chicas:chic chicago:chicag chicana:chican chicano:chican torear:tor toreo:tore torero:torer tormenta:torment tormentas:torment tornado:torn tornados:torn torneo:torne torneos:torne torniquetes:torniquet torpe:torp torpedos:torped torrentes:torrent tortura:tortur torturado:tortur torturó:tortur torturas:tortur chile:chil chilena:chilen chilenas:chilen chileno:chilen che:che cheque:chequ"


@pytest.mark.parametrize(("stem", "words"), [(sm.english, EN), (sm.german, DE), (sm.spanish, ES)])
def test_published_words(stem, words):
    wrong = [(w, s, stem(w)) for w, s in (x.split(":") for x in words.split()) if stem(w) != s]
    assert not wrong


def test_any_string_is_stemmed():
    for stem in sm.STEMMERS.values():
        for w in ("", "a", "s", "yy", "'s", "123", "ß", "日本", "x" * 10_000, "ies", "ing", "ed"):
            assert isinstance(stem(w), str)


def test_terms_are_stemmed_once_and_joined_back(spark):
    rows = spark.createDataFrame([(1, "knives"), (1, "knives"), (2, "kneeling"), (3, None)], "doc_id long, term string")
    assert sorted((r.doc_id, r.stem) for r in sm.stem_terms(rows, "en").where("term is not null").collect()) == [(1, "knive"), (1, "knive"), (2, "kneel")]
    assert sm.stem_terms(rows, "en").count() == 4
    assert {r.stem for r in sm.stem_terms(rows, "xx").collect()} == {"knives", "kneeling", None}


def test_analysis_by_language(spark):
    rows = spark.createDataFrame([(1, "en", "the"), (1, "en", "knights"), (2, "de", "katzen"), (2, "de", "the"), (3, "xx", "katzen"), (4, None, "katzen")], "doc_id long, lang string, term string")
    got = sorted((r.doc_id, r.term) for r in sm.analyse(rows, F.col("lang")).collect())
    assert got == [(1, "knight"), (2, "katz"), (2, "the"), (3, "katzen"), (4, "katzen")]
    assert sm.analyse(rows, F.col("lang"), stop={}).count() == 6
