"""Structure of acts on a statute text, pending changes, covers."""

import pytest
from pyspark.sql import functions as F

from kodeks.operators import structure

STATUTE = [
    ["USTAWA", "z dnia 5 maja 2010 r.", "DZIAŁ I", "Młyny", "Rozdział 1", "Przepisy ogólne", "Art. 1. 1. Starosta prowadzi rejestr, o którym mowa w art.", "7. Ustawy nie narusza to.", "2. Rejestr obejmuje:", "1) młyny;"],
    ["2) śluzy.", "Art. 2. (uchylony)", "Art. 3. W ustawie wprowadza się następujące", "zmiany: skreśla się słowa.", "Art. 4. [Opłata wynosi 5 zł.] <Opłata wynosi 9 zł.> Wpłaca się ją", "w kasie.", "Art. 5. Zakres:", "1) wody;", "1. Inne.", "Rozdział 2", "Przepisy przejściowe i końcowe", "Art. 6. Ustawa wchodzi w życie z dniem ogłoszenia."],
    ["Rozdział 10", "Kary", "Art. 4a. Kto niszczy młyn, podlega karze."],
]
PAGE = "page_id long, eli string, invoke_id string, page struct<page_number:int, paragraph_lines:array<struct<text:string>>>, title string"


def pages(spark, acts):
    rows = [(1000 * a + n, eli, "i", (n, [(t,) for t in lines]), "clash") for a, (eli, act) in enumerate(acts) for n, lines in enumerate(act, 1)]
    return spark.createDataFrame(rows + rows[:1], PAGE)


@pytest.mark.parametrize("block", [1, 256])
def test_statute(spark, block):
    df = pages(spark, [("A", STATUTE), (None, [["1. Bez artykułu.", "Art. 1. Treść"], None or []])])
    units, errors = structure.act_units(df, block)
    got = {(r.eli, r.part, r.chapter, r.article, r.section, r.point): (r.body, r.current) for r in units.collect()}
    act = ("A", "I", "1")
    assert {k[3:]: v[0] for k, v in got.items() if k[:3] == act} == {
        ("1", None, None): None, ("1", "1", None): "Starosta prowadzi rejestr, o którym mowa w art.\n7. Ustawy nie narusza to.", ("1", "2", None): "Rejestr obejmuje:", ("1", "2", "1"): "młyny;", ("1", "2", "2"): "śluzy.",
        ("4", None, None): "[Opłata wynosi 5 zł.] <Opłata wynosi 9 zł.> Wpłaca się ją\nw kasie.", ("5", None, None): "Zakres:", ("5", None, "1"): "wody;", ("5", "1", None): "Inne.",
    }
    assert got[(*act, "4", None, None)][1] == "Opłata wynosi 5 zł.  Wpłaca się ją\nw kasie."
    assert got[("A", "I", "10", "4a", None, None)][0] == "Kto niszczy młyn, podlega karze." and not any(k[2] == "2" for k in got if k[0] == "A")
    assert {k[3:] for k in got if k[0] is None} == {("1", None, None)}
    assert {tuple(r) for r in errors.collect()} == {("A", "i", "article", "5", "both_levels"), ("A", "i", "article", "4a", "not_ascending")}


def test_no_pages(spark):
    units, errors = structure.act_units(pages(spark, [("A", [])][:0] or [("A", [[]])]))
    assert units.count() == 0 and errors.count() == 0


def test_segments_and_paint(spark):
    text = "Art. 5. [stary tekst] <nowy tekst> wspólny"
    df = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, "a [b <c] d>"), (5, "[Art. 1. x] [y]")], "k long, t string")
    got = {}
    for r in structure.segments(df, ["k"], "t").orderBy("seg_no").collect():
        got.setdefault(r.k, []).append((r.start, r.end, r.status.split("_")[0], r.segment))
    assert got[1] == [(0, 7, "NOT", "Art. 5. "), (8, 20, "BEFORE", "stary tekst"), (21, 21, "NOT", " "), (22, 33, "UPCOMING", "nowy tekst"), (34, 41, "NOT", " wspólny")]
    assert set(got) == {1, 4, 5} and all(s == "NOT" for *_, s, _ in got[4]) and [x[2] for x in got[5]] == ["BEFORE", "NOT", "BEFORE"]
    assert [r.status[:3] for r in structure.segments(df.where("k = 5"), ["k"], "t", "article").orderBy("seg_no").collect()] == ["BEF", "NOT", "NOT"]
    chars = structure.painted(df.where("k = 1"), ["k"], "t").orderBy("char_no").collect()
    assert "".join(c.letter for c in chars if c.status != "UPCOMING_CHANGE") == "Art. 5. stary tekst  wspólny" and all(text[c.char_no] == c.letter for c in chars)


def test_cover(spark):
    rows = [("ok", 0, 4), ("ok", 5, 9), ("gap", 0, 3), ("gap", 5, 9), ("overlap", 0, 5), ("overlap", 5, 9), ("bounds", 1, 9)]
    df = spark.createDataFrame(rows, "k string, s int, e int")
    got = {r.k: r.error for r in structure.cover_errors(df, ["k"], F.col("s"), F.col("e"), F.lit(0), F.lit(9)).collect()}
    assert got == {k: k for k in ("gap", "overlap", "bounds")}
