"""Golden cases of the general operators."""

import random

import pytest
from pyspark.sql import functions as F

from kodeks.functions import text as T
from kodeks.functions.normal import act_key, any_date, label
from kodeks.operators import intervals as I
from kodeks.operators import match
from kodeks.operators import relational as R
from kodeks.operators import split
from kodeks.operators.tasks import run_rows


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize(("text", "want"), [("1-3", ["1", "3"]), ("9 – 9b", ["9", "9b"]), ("22", ["22"]), (None, []), ("", []), ("a1", None)])
def test_id_range(spark, text, want):
    assert one(spark, T.id_range, text) == want


@pytest.mark.parametrize(("text", "want"), [("(uchylony)", False), (" ( uchylona ) \n", False), ("²⁾(utracił moc)", False), ("(uchylony) tekst", True), ("(Uchylony)", True), ("", True), (None, True)])
def test_in_force(spark, text, want):
    assert one(spark, T.in_force, text) is want


@pytest.mark.parametrize(("ids", "want"), [(["1", "2", "3", "4", "4b", "4a", "5"], True), (["1", "2", "4", "3", "4a"], False), (["1", "a", "2"], False), (["1", "2", "x"], True), ([], True)])
def test_ascending(spark, ids, want):
    assert one(spark, T.ascending, ids, "array<string>") is want


def test_normal_forms(spark):
    assert one(spark, act_key, " du / 2010 / 0015") == "DU/2010/15"
    assert [one(spark, any_date, x) for x in ("2010-4-1", "1.04.2010", "1 kwietnia 2010 r.", "2010/04/01", "2010-04-01T10:00:00", "2010-02-30", "jutro", None, "")] == ["2010-04-01"] * 5 + [None] * 4
    assert [one(spark, label, x) for x in ("  Akty  Zmieniające", "-", "b.d.", None, "12")] == ["akty zmieniające", None, None, None, None]


def test_change_detection_is_null_safe_and_settles(spark):
    new = spark.createDataFrame([(1, "a", None), (2, "b", "x"), (3, None, None), (4, "n", "n")], "k int, s string, t string")
    state = spark.createDataFrame([(1, "a", None), (2, "c", "x"), (3, "z", None)], "k int, s string, t string")
    got = {r.k: (r.missing, r.s_changed, r.t_changed) for r in R.detect_changes(new, state, "k", ["s", "t"]).collect()}
    assert got == {2: (False, True, False), 3: (False, True, False), 4: (True, None, None)}
    after = R.upsert(state, new, ["k"])
    assert R.detect_changes(new, after, "k", ["s", "t"]).count() == 0


def test_outer_indicator_matches_nulls(spark):
    a, b = spark.createDataFrame([(None,), ("x",)], "k string"), spark.createDataFrame([(None,), ("y",)], "k string")
    assert {(r.k, r.side) for r in R.outer_indicator(a, b, ["k"]).collect()} == {(None, "both"), ("x", "left_only"), ("y", "right_only")}


def test_align_and_violations(spark):
    from kodeks.schemas import ACT_PATHS

    df = spark.createDataFrame([("e", 5, "zzz")], "ELI string, title int, missing string")
    assert R.align(df, ACT_PATHS).first().asDict() == {"eli": "e", "title": "5", "s3_pdf_path": None, "missing": None}
    assert [r.violation for r in R.violations(df, "ELI", {"a": F.col("title") > 9, "b": F.lit(None).cast("boolean"), "c": F.lit(True)}).collect()] == ["a", "b"]


def test_islands_equal_a_fold(spark):
    rnd = random.Random(5)
    rows = [(g, i, float(s), float(s + rnd.randint(0, 12))) for g in range(20) for i, s in enumerate(sorted(rnd.randint(0, 80) for _ in range(12)))]
    got = {(r.g, r.i): r.island_id for r in I.islands(spark.createDataFrame(rows, "g int, i int, a double, b double"), ["g"], "a", "b", ["i"], 0.4).collect()}
    for g in range(20):
        far, number = None, 0
        for _, i, a, b in sorted((r for r in rows if r[0] == g), key=lambda r: (r[2], r[3], r[1])):
            number += far is None or not a + 0.4 <= far
            far = b if far is None else max(far, b)
            assert got[(g, i)] == number


def test_sliding_count_excludes_the_edge(spark):
    df = spark.sql("SELECT 1 AS g, timestamp_seconds(x) AS ts FROM VALUES (0), (180), (181) AS t(x)")
    assert [r.n_window for r in I.sliding_count(df, ["g"], "ts", 180).orderBy("ts").collect()] == [1, 1, 2]


def test_overlap_equals_all_pairs(spark):
    rnd = random.Random(6)
    rows = lambda n: [(rnd.randint(0, 2), i, float(a := rnd.randint(0, 100)), float(a + rnd.randint(0, 60))) for i in range(n)]
    a, b = rows(40), rows(40)
    schema = "g int, i int, lo double, hi double"
    got = sorted((r.i, r.i_b) for r in I.overlap(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), ["g"], 10.0).collect())
    assert got == sorted((x[1], y[1]) for x in a for y in b if x[0] == y[0] and x[3] > y[2] and y[3] > x[2])


def test_gaps_offsets_sessions(spark):
    df = spark.createDataFrame([(1, 1, 0, 5), (1, 2, 3, 4), (1, 3, 9, 10)], "g int, i int, a int, b int")
    assert [(r.gap_start, r.gap_end) for r in I.gaps(df, ["g"], "a", "b", ["i"]).collect()] == [(5, 9)]
    t = spark.createDataFrame([(1, i, x) for i, x in enumerate(["Art. 5. Tekst"[:13], "dalej", "koniec"])], "g int, i int, x string")
    assert [r.start_at for r in I.running_offsets(t, ["g"], ["i"], F.length("x") + 2).orderBy("i").collect()] == [0, 15, 22]


def test_nearest_is_exact(spark):
    import numpy as np

    rnd = np.random.default_rng(1)
    v = rnd.normal(size=(60, 8))
    rows = [(i, [float(x) for x in v[i]]) for i in range(60)] + [(60, [0.0] * 8), (61, None), (62, [])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    got = {r.id: (r.neighbour, r.score) for r in match.nearest(df, df.where("id % 5 = 0"), "id", "v", block=4).collect()}
    n = v / np.linalg.norm(v, axis=1)[:, None]
    s = np.round(n @ n.T, 6)
    np.fill_diagonal(s, -2)
    assert got == {i: (int(s[i].argmax()), float(s[i].max())) for i in range(0, 60, 5)}


STATUTE = """preambuła
USTAWA
z dnia 1 stycznia
DZIAŁ I
Przepisy ogólne
Rozdział 1
Zakres
Art. 1. 1. Ustawa określa:
1) pierwsze;
2) drugie, o którym mowa w
art. 7 ust. 2.
2. Drugi ustęp.
Art. 2. (uchylony)
Art. 2a. [stary tekst] <nowy tekst> wspólny
Rozdział 10
Przepisy końcowe
Art. 3. Koniec."""


def test_splitters(spark):
    df = spark.createDataFrame([(1, STATUTE), (2, "bez nagłówka"), (3, ""), (4, None)], "k int, t string")
    cut = df.select("k", split.body_cut(F.col("t")).alias("b")).collect()
    assert cut[0].b.startswith("USTAWA") and [r.b for r in cut[1:]] == [None] * 3
    for level, ids in (("article", [None, "1", "2", "2a", "3"]), ("chapter", [None, "1", "10"]), ("part", [None, "I"])):
        rows = split.split_units(df, ["k"], "t", level).where("k = 1").orderBy("unit_no").collect()
        assert [r.unit_id for r in rows] == ids
        assert "".join(r.unit_text for r in rows) == STATUTE and all(STATUTE[r.start_at :].startswith(r.unit_text) for r in rows)
    assert split.split_units(df, ["k"], "t", "article").where("k = 2").first().unit_id is None
    points = [r.unit_id for r in split.split_units(df, ["k"], "t", "point").where("k = 1").orderBy("unit_no").collect()]
    assert points == [None, "1", "2"]
    sections = [r.unit_id for r in split.split_units(df, ["k"], "t", "section").where("k = 1").orderBy("unit_no").collect()]
    assert sections == [None, "1", "2"]


def test_retry_and_dead_letters(spark):
    def work(row, attempt):
        if row["k"] == 1 or (row["k"] == 2 and attempt < 2):
            raise ValueError("no")
        return "ok"

    got = {r.k: (r.status, r.attempts) for r in run_rows(spark.range(4).withColumnRenamed("id", "k"), "k", work, 3, 0).collect()}
    assert got == {0: ("success", 1), 1: ("failed", 3), 2: ("success", 2), 3: ("success", 1)}


def test_characters_of_every_line(spark, data):
    import __spark_entry__ as entry

    pages = spark.read.parquet(f"{data}/act_pages.parquet").select("page_id", "page.paragraph_lines").collect()
    want = {(p.page_id, n, k): line.start_x + k * (line.end_x - line.start_x) / len(line.text) for p in pages for n, line in enumerate(p.paragraph_lines or []) if line and line.text for k in range(len(line.text))}
    rows = entry.queries()["char_interp_lines"](spark, data).collect()
    got = {(r.page_id, r.line_no, r.char_no): r.x for r in rows}
    assert len(rows) == len(got) and got == pytest.approx(want) and any(n > 0 for _, n, _ in got)


def test_bodies_of_all_units(spark):
    df = spark.createDataFrame([(1, STATUTE), (2, "1) ciąg dalszy;\n2. Ustęp."), (3, ""), (4, None)], "k int, t string")
    rows = split.unit_bodies(df, ["k"], "t").orderBy("k", "article_no", "section_no", "point_no").collect()
    assert [(r.k, r.article, r.section, r.point, r.body and r.body.strip()) for r in rows] == [
        (1, "1", None, None, None), (1, "1", "1", None, "Ustawa określa:"), (1, "1", "1", "1", "pierwsze;"), (1, "1", "1", "2", "drugie, o którym mowa w\nart. 7 ust. 2."), (1, "1", "2", None, "Drugi ustęp."),
        (1, "2", None, None, "(uchylony)"), (1, "2a", None, None, "[stary tekst] <nowy tekst> wspólny\nRozdział 10\nPrzepisy końcowe"), (1, "3", None, None, "Koniec."),
        (2, None, None, "1", "ciąg dalszy;"), (2, None, "2", None, "Ustęp."),
    ]


def test_units_by_start_and_end_id(spark):
    units = spark.createDataFrame([(1, i, u) for i, u in enumerate(["1", "2", "2a", "3", "2"])], "k int, place int, unit_id string")
    wanted = spark.createDataFrame([(1, x) for x in (["2", "3"], ["2"], ["9", "3"], ["3", "1"], ["7"], ["1", "2", "3"], [], None)], "k int, ids array<string>")
    got = {}
    for r in split.select_units(units, ["k"], "place", wanted).collect():
        got.setdefault(tuple(r.ids or ()), set()).add((r.place, r.unit_id, r.error))
    error = lambda e: {(None, None, e)}
    assert got == {("2", "3"): {(1, "2", None), (2, "2a", None), (3, "3", None)}, ("2",): {(1, "2", None)}, ("9", "3"): error("start_not_found"), ("3", "1"): error("end_not_found"), ("7",): error("not_found"), ("1", "2", "3"): error("bad_arity"), (): error("bad_arity")}


def test_unit_queries_run(spark, data):
    import __spark_entry__ as entry

    q = entry.queries()
    assert {r.level for r in q["unit_bodies"](spark, data).select("level").distinct().collect()} >= {"article"}
    q["unit_select"](spark, data).collect()  # the references name no act that has pages here


def test_phrase_in_long_and_repeated_documents(spark, tmp_path):
    import time

    import duckdb

    import __spark_entry__ as entry

    texts = ["o których mowa", "O KTÓRYCH Mowa.", "o  których mowa", "a  o których mowa", " o których mowa ", "z o których o których mowa\u00a0", "to których mowa o których mowa o których mowa", "o\nktórych mowa", "x\to których mowa", "o których mowa\n", "o ktorych mowa", "o których mowawia o których mowa", "\u0130 Σ o których mowa", "o których", " ", "", None]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(90, "a b c d o których mowa"), (90, "a o których mowa"), (90, "brak"), (None, "a o których mowa"), (None, "o których mowa")]
    rows += [(91, "o których " * 15_000 + "mowa"), (92, "słowo " * 30_000)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.sql(entry.oracle_sql()["phrase_find"]).fetchall()
    began = time.time()
    got = [tuple(r) for r in entry.queries()["phrase_find"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and (91, 29_998) in got
    assert time.time() - began < 20  # a split for every word takes minutes
