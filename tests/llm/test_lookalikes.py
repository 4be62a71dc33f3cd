import pytest

from phrasemill.llm.characters import plain, skeleton, suspects
from phrasemill.llm.lookalikes import canonical_texts, look_classes, same_looking

BASE = "The porous cathode of a coated cell reaches 12 m² in the café."
SAME = {
    "full-width": BASE.replace("cell", "ｃｅｌｌ").replace("12", "１２"),
    "accents": BASE.replace("é", "é"),
    "invisible": BASE.replace("porous", "po​rous﻿").replace("cell", "ce­ll").replace("m", "m͏︎"),
    "gaps": BASE.replace(" ", " ", 3).replace(" of ", " of "),
    "look-alikes": BASE.replace("o", "о").replace("a", "а").replace("c", "с"),
    "greek": BASE.replace("o", "ο"),
    "all letters": BASE.replace(" a ", " а "),
}
OTHER = {
    "case": BASE.lower(), "accent gone": BASE.replace("é", "e"), "digit not raised": BASE.replace("²", "2"), "word": BASE.replace("cell", "cells"), "number": BASE.replace("12", "13"),
    "double gap": BASE.replace(" of ", "  of "), "blank": " ​ ", "null": None, "empty": "",
}


@pytest.mark.parametrize("kind", SAME)
def test_same_look_has_one_skeleton(kind):
    assert SAME[kind] != BASE and skeleton(SAME[kind]) == BASE


@pytest.mark.parametrize("kind", [k for k in OTHER if OTHER[k]])
def test_visible_differences_stay(kind):
    assert skeleton(OTHER[kind]) != BASE


def test_suspects():
    assert suspects("The саthode is here") == {"саthode": ["cathode"]}
    assert suspects("Электрод и саthod") == {"саthod": ["cathod"]}
    assert suspects("Совет и сор") == {} and suspects("10 Ω and 5 μm, café") == {}
    assert suspects(plain("Катод оf дома и электрода")) == {"оf": ["of"]}
    assert suspects("the word сор here")["сор"] == ["cop"]
    assert suspects("daеndevateを用いた")["daеndevate"] == ["daendevate"]


def run(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "doc_id BIGINT, text STRING, canonical STRING").repartition(3)


def test_pairs(spark):
    rows = [(1, BASE), (2, BASE)] + [(10 + i, t) for i, t in enumerate(SAME.values())] + [(50 + i, t) for i, t in enumerate(OTHER.values())] + [(70, " \t"), (None, SAME["greek"])]
    alike = [1, 2, *range(10, 10 + len(SAME))]
    want = {(a, b) for a in alike for b in alike if a < b and (a, b) != (1, 2)}
    assert {tuple(r) for r in same_looking(run(spark, rows)).collect()} == want
    assert same_looking(run(spark, rows).limit(0)).collect() == []


def canonical(spark, rows):
    return {r.doc_id: r.canonical for r in canonical_texts(run(spark, rows), "doc_id", "text").collect()}


def test_repair_needs_a_known_word(spark):
    rows = [(1, "rare wоrdling"), (2, "some Wordling text"), (3, "unknοwnish"), (4, "unknоwnish"), (5, None), (6, "")]
    got = canonical(spark, rows)
    assert got[1] == "rare wordling" and got[2] == "some Wordling text"  # known, in any case
    assert got[3] == got[4] == "unknownish"  # not known, but with it repaired two texts are the same
    assert got[5] is None and got[6] == "" and len(got) == 6
    assert canonical(spark, [(3, "unknοwnish"), (4, "more")])[3] == "unknοwnish"


def test_quoted_foreign_words_stay(spark):
    quoted = "The Russian word сор means litter, а is a letter"
    rows = [(1, quoted), (2, quoted), (3, "a cop and a cell"), (4, "the only сор")]
    assert canonical(spark, rows) == dict(rows)
    # Only a text that is the same otherwise shows that a whole word is a disguise.
    assert canonical(spark, [*rows, (5, "the only cop")])[4] == "the only cop"


def test_characters_beyond_the_basic_plane():
    assert plain("𝐜𝑒𝓁𝔩 𝟏𝟐") == "cell 12" and plain("ce\U000e0101ll\U000e0063") == "cell"
    assert skeleton("Ꭺnode ⲟf ցold") == "Anode of gold"


def test_classes(spark):
    rows = [(1, "a cell"), (2, "a cell"), (3, "a\u00a0cell"), (4, "a ｃell"), (5, "other"), (6, "other"), (7, None), (8, " "), (9, "Cell")]
    got = {tuple(r) for r in look_classes(run(spark, rows)).collect()}
    assert got == {(1, 1, 1, 4, 3, 2), (2, 1, 1, 4, 3, 2), (3, 1, 3, 4, 3, 3), (4, 1, 4, 4, 3, 3)}


def test_pairs_of_a_large_class(spark):
    rows = [(i, "a cell" if i % 3 else "a\u00a0cell") for i in range(60)]
    got = {tuple(r) for r in same_looking(run(spark, rows), part=7).collect()}
    assert got == {(i, j) for i in range(60) for j in range(i + 1, 60) if (i % 3 == 0) != (j % 3 == 0)}


def test_very_long_text(spark):
    long = "cell " * 60_000
    assert [tuple(r) for r in same_looking(run(spark, [(1, long + "cathode"), (2, long + "саthode")])).collect()] == [(1, 2)]
