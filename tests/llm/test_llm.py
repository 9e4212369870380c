"""Edge cases and brute-force checks of the operators for training text."""

import random
import re
import unicodedata

import numpy as np
import pytest

from kodeks.llm import boilerplate, canon, language, leakage, markup, packing, pairs, readability, scan, skeleton

LONG = "Właściciel urządzenia składa wniosek w terminie 14 dni. " * 4000


# 1 broken pairs
QS = "create_date timestamp, nro long, title string, question_content string, answer_content string, key_ string, defect string"
QUESTION = "Czy najemca może przebudować młyn wodny, jeżeli zgłosi to 20 mieszkańców?"


def qdf(spark, rows):
    return spark.createDataFrame([(None, n, None, q, a, "clash", "clash") for n, q, a in rows], QS)


def test_pair_defects(spark):
    corpus = [(100 + i, QUESTION, f"Od {i} maja starosta prowadzi rejestr mostów, gdyż stary wzór stracił aktualność. Organ prowadzi spis na podstawie protokołu oględzin.") for i in range(8)]
    rows = [
        (1, QUESTION, None), (2, QUESTION, "<p>&nbsp;</p>"), (3, QUESTION, "n/d"), (4, QUESTION, QUESTION.upper()), (5, QUESTION, "<b>Pytanie brzmiało:</b> " + QUESTION), (6, QUESTION, "Przykro mi, ale nie mogę udzielić odpowiedzi na to pytanie. Proszę zwrócić się do prawnika."),
        (7, QUESTION, "Szanowni Państwo, The owner must register the water mill within 14 days of the notice."), (8, QUESTION, "Kdo užívá vodní mlýn, je povinen zaplatit poplatek. Bez povolení není možné jej označit."), (9, QUESTION, "Organ prowadzi spis na pod"), (10, QUESTION, "Od 3 maja starosta prowadzi rejestr mostów, gdyż"), (11, QUESTION, "Tak."),
        (12, QUESTION, "Od 3 maja starosta prowadzi rejestr mostów, gdyż stary wzór stracił aktualność"), (13, QUESTION, QUESTION + " Tak, po złożeniu wniosku do starosty w ciągu 14 dni."), (14, QUESTION, "Niestety, przepisy nie pozwalają na skrócenie terminu, dlatego należy odczekać 3 dni."), (15, None, "Zob. art. 3 ust. 1."), (15, None, "Zob. art. 3 ust. 1."), (None, "x", None), (16, QUESTION, LONG),
        (17, QUESTION, "Klauzula „ohne Gewähr”, czyli bez gwarancji, obowiązuje właściciela młyna."),
    ]
    got = {r.nro: r.defect for r in pairs.defects(qdf(spark, corpus + rows)).collect()}
    assert got == {1: "empty", 2: "empty", 3: "empty", 4: "copy", 5: "copy", 6: "refusal", 7: "other_language", 8: "other_language", 9: "truncated", 10: "truncated"}
    assert pairs.defects(qdf(spark, [])).count() == 0


def test_long_copies_are_judged_like_short_ones():
    rnd = random.Random(3)
    for _ in range(200):
        a, b = ([rnd.choice("abcd") for _ in range(rnd.randrange(30))] for _ in "12")
        row = [0] * (len(b) + 1)
        for x in a:
            last = row
            row = [0]
            for j, y in enumerate(b):
                row.append(last[j] + 1 if x == y else max(last[j + 1], row[j]))
        assert pairs.common_length(a, b) == row[-1]
    letters = lambda: "".join(rnd.choice("abcdefghijkl") for _ in range(9))
    for n in (90, 1100, 20_000):
        q = [letters() for _ in range(n)]
        assert pairs.says_no_more(" ".join(q), " ".join(letters() if i % 10 == 5 else w for i, w in enumerate(q)))
        blocks = [q[i : i + 20] for i in range(0, n, 20)]
        assert not pairs.says_no_more(" ".join(q), " ".join(w for b in blocks[::-1] for w in b))


def test_language_of_prompt_and_response():
    m = language.LanguageModel()
    cs = "Kdo užívá vodní mlýn, je povinen zaplatit poplatek."
    assert pairs.is_foreign(m, QUESTION, cs) and not pairs.is_foreign(m, QUESTION, "Tak, wystarczy zgłoszenie.") and not pairs.is_foreign(m, "", "Tak.")
    differs = lambda q, a: pairs.language_differs(m.posterior(q), m.posterior(a))
    assert differs(QUESTION, cs) > 0.99 and differs(QUESTION, "Młyn wodny wymaga zgłoszenia do starosty.") < 0.01
    # a pair that agrees needs more evidence
    texts = [x[:n] for x in ("Ano, stačí předložit", "Yes, it is enough", "Nein, das genügt", "Oui, monsieur") for n in range(2, len(x))]
    short = next(t for t in texts if 4 <= (s := m.scores(t)).max() - s[0] < 8 and m.posterior(t)[m.language(t)] > 0.8)
    assert pairs.is_foreign(m, QUESTION, short) and not pairs.is_foreign(m, short, short)


def test_formula_after_a_sentence_and_words_that_never_follow(spark):
    text = "Od {} maja starosta prowadzi rejestr mostów, gdyż stary wzór stracił aktualność. Wójt wydaje akt."
    rows = [(100 + i, QUESTION, text.format(i)) for i in range(12)]
    rows += [(1, QUESTION, "Od 3 maja starosta prowadzi rejestr mostów, gdyż stary wzór stracił aktualność. $W = 3$"), (2, QUESTION, "Od 3 maja starosta akt")]
    for most in (2_000_000, 0):  # asked n-grams sent to the tasks, or all counted
        assert {r.nro: r.defect for r in pairs.defects(qdf(spark, rows), most_asked=most).collect()} == {2: "truncated"}


def test_ellipsis_closes_no_answer(spark):
    text = "Od {} maja starosta prowadzi rejestr mostów, gdyż stary wzór stracił aktualność. Organ prowadzi spis na podstawie protokołu oględzin."
    rows = [(100 + i, QUESTION, text.format(i)) for i in range(8)]
    sound = ["Od 3 maja starosta prowadzi rejestr mostów, gdyż stary wzór stracił aktualność…", "Od 3 maja starosta prowadzi rejestr mostów, gdyż stary wzór stracił aktualność. (…)", "Organ prowadzi spis na podstawie protokołu oględzin:"]
    cut = ["Od 3 maja starosta prowadzi rejestr zaw…", "Od 3 maja starosta prowadzi rejestr mostów, gdyż (…", "Od 3 maja starosta prowadzi rejestr ...", "Od 3 maja starosta prowadzi rejestr mostów, gdyż [...]", "Organ prowadzi spis na podstawie art. …", "Od 3 maja starosta prowadzi rejestr mostów, gdyż stary:"]
    rows += [(i, QUESTION, t) for i, t in enumerate(sound)] + [(10 + i, QUESTION, t) for i, t in enumerate(cut)]
    got = {r.nro: r.defect for r in pairs.defects(qdf(spark, rows)).collect()}
    assert got == {10 + i: "truncated" for i in range(len(cut))}


def test_language_model_on_held_out_sentences():
    m = language.LanguageModel()
    for lang, text in {"pl": "Rada sołecka ogłasza wykaz stawów rybnych.", "en": "The fish pond must be insured before winter.", "de": "Der Fischteich wird von der Gemeinde verpachtet.", "cs": "Obec musí rybník pojistit před zimou, jinak zaplatí pokutu.", "uk": "Громада повинна застрахувати ставок до зими."}.items():
        assert m.language(text) == lang
    assert m.language("12 !") is None and abs(sum(m.posterior("tekst").values()) - 1) < 1e-9


# 2 markup
@pytest.mark.parametrize(
    ("text", "kinds"),
    [
        ("<h2>T</h2><ul><li>a</ul><pre><code>&lt;b&gt; **x**</code></pre><math><mi>x</mi></math>", {("html", "heading"), ("html", "list"), ("html", "code"), ("html", "formula")}),
        ("&lt;p&gt;tekst&lt;/p&gt;", {("html", "other")}), ("a&nbsp;b<!-- c -->", {("html", "other")}),
        ("## T\n\n- a\n- b\n\n```\n<p>x</p>\n```\n\n**b** $x = \\frac{1}{2}$", {("markdown", "heading"), ("markdown", "list"), ("markdown", "code"), ("markdown", "other"), ("latex", "formula")}),
        ("Tytuł\n-----\ntekst `kod`", {("markdown", "heading"), ("markdown", "other")}), ("== T ==\n# a\n# b\n[[x|y]] {{z}} ''w''", {("wiki", "heading"), ("wiki", "list"), ("wiki", "other")}),
        ("== T ==\n* a\n* b", {("wiki", "heading"), ("wiki", "list")}), ("**t**\n* a\n* b", {("markdown", "other"), ("markdown", "list")}),
        ("\\section{T}\\begin{itemize}\\item a\\end{itemize}\\begin{verbatim}\\emph{x}\\end{verbatim}\\[x^2\\] \\emph{e}", {("latex", "heading"), ("latex", "list"), ("latex", "code"), ("latex", "formula"), ("latex", "other")}),
        ("1. a\n2. b\n1) c\n– d", set()), ("Kwota < 52 zł i powierzchnia > 52 m", set()), ("Za 43 $ i 50 $ kaucji", set()), ("36 * 3 i gwiazdka *", set()), ("[dotychczasowa treść] <nowa treść przepisu>", set()), ("plik_a_b.pdf #18/2019", set()), (None, set()), ("", set()),
    ],
)
def test_markup_kinds(text, kinds):
    assert markup.parse(text).kinds == kinds


def test_clean_text_keeps_structure(spark):
    got = markup.parse("<h2>Tytuł</h2><p>Tekst <b>ważny</b>.</p><ol><li>raz<li>dwa</ol><pre>x &lt; 1</pre><math><mi>a</mi><mo>=</mo><mn>1</mn></math>").text
    assert [x for x in got.split("\n") if x] == ["# Tytuł", "Tekst ważny.", "- raz", "- dwa", "```", "x < 1", "```", "$a = 1$"]
    df = qdf(spark, [(1, "<p>" + LONG, "**a**"), (1, "<p>" + LONG, "**a**"), (2, None, None), (None, "<p>", "<p>")])
    assert sorted(map(tuple, markup.markup_kinds(df).collect())) == [(1, "answer", "markdown", "other"), (1, "question", "html", "other")]
    assert markup.clean_texts(df).count() == 2 and markup.markup_kinds(df.limit(0)).count() == 0


@pytest.mark.parametrize("n", [10, 20_000])
@pytest.mark.parametrize(("opener", "closer", "kind"), [("$$", "$$", ("latex", "formula")), ("\\[", "\\]", ("latex", "formula")), ("\\(", "\\)", ("latex", "formula")), ("**", "**", ("markdown", "other")), ("__", "__", ("markdown", "other")), ("~~", "~~", ("markdown", "other")), ("'''", "'''", ("wiki", "other"))])
def test_spans_of_any_length(opener, closer, kind, n):
    inside = "xy " * n + "z"
    assert markup.parse(f"a {opener}{inside}{closer} b").kinds == {kind}
    assert markup.parse(f"a {opener}{inside} b").kinds == set()


def test_spans_equal_the_patterns():
    rnd = random.Random(2)
    forms = [("*", (2,), False, r"\*\*(?=\S)((?:[^\n]|\n(?!\n))+?)(?<=\S)\*\*"), ("_", (2,), True, r"(?<!\w)__(?=\S)((?:[^\n]|\n(?!\n))+?)(?<=\S)__(?!\w)"), ("'", (5, 3, 2), False, r"(?<!')('')(?=\S)((?:[^\n]|\n(?!\n))+?)(?<=\S)\1(?!')")]
    for mark, sizes, whole, pattern in forms:
        for _ in range(2000):
            # runs of several sizes close one another by the pattern, which is no mark-up
            pieces = [mark * sizes[-1], "a", " ", "\n", "b c"]
            t = "".join(x if x[0] != mark or not i or p[i - 1][0] != mark else "q" for p in [[rnd.choice(pieces) for _ in range(rnd.randrange(12))]] for i, x in enumerate(p))
            want = re.sub(pattern, lambda m: f"<{m[m.lastindex]}>", t, flags=re.DOTALL)
            assert markup.emphasised(t, mark, sizes, lambda x: f"<{x}>", whole) == want, t
    assert markup.between("$$a$$ $$$$ b$$ $$", "$$", "$$", lambda x: f"<{x}>") == "<a> <$$ b> $$"


def test_unescaping_ends():
    t = "<p>x</p>"
    for _ in range(6):
        t = t.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
    assert markup.parse(t).kinds == {("html", "other")} or markup.parse(t).kinds == set()


def test_unique_runs_equal_brute_force(spark):
    rnd = random.Random(4)
    least = 5
    texts = {}
    shared = ["w1 w2 w3 w4 w5 w6 w7", "x , y . z !", "p q r s"]
    for i in range(60):
        texts[i] = " ".join(rnd.choice([*shared, f"u{rnd.randrange(400)} v{rnd.randrange(400)}"]) for _ in range(rnd.randrange(1, 9)))
    rows = [(h, i + 1000 * k, t, "clash", 1) for k, h in enumerate("AB") for i, t in texts.items()] + [("A", 5000, None, "", 1), ("A", 5001, "", "", 1), (None, 1, "a", "", 1), ("C", 6000, " ".join(map(str, range(9))), "", 1)]
    df = spark.createDataFrame(rows, "host string, page long, body string, text string, at int")
    got = {}
    for r in boilerplate.unique_runs(df, "host", "page", "body", least).orderBy("run").collect():
        got.setdefault((r.host, r.page), []).append(r.text)
    want = {}
    for h, p, t, *_ in rows:
        words = boilerplate._TOKEN.findall(t or "")
        if h is None or not words:
            continue
        others = {tuple(w[k : k + least]) for h2, p2, t2, *_ in rows if h2 == h and p2 != p for w in [boilerplate._TOKEN.findall(t2 or "")] for k in range(len(w) - least + 1)}
        gone = {k + j for k in range(len(words) - least + 1) if tuple(words[k : k + least]) in others for j in range(least)}
        if runs := "".join("\0" if k in gone else f" {w}" for k, w in enumerate(words)).split("\0"):
            if kept := [x.strip() for x in runs if x.strip()]:
                want[(h, p)] = kept
    assert {k: [" ".join(boilerplate._TOKEN.findall(x)) for x in v] for k, v in got.items()} == want
    assert boilerplate.unique_runs(df.limit(0), "host", "page", "body", least).count() == 0


# 3 canonical list
def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_automaton_equals_brute_force():
    rnd = random.Random(3)
    words = sorted({"".join(rnd.choice("abcd") for _ in range(rnd.randint(2, 10))) for _ in range(200)})
    trie = canon.Trie()
    for w in words:
        trie.add(w, w)
    for _ in range(150):
        q = "".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 10)))
        want = {w: d for w in words if (d := levenshtein(q, w)) <= canon.most_errors(min(len(q), len(w)))}
        assert dict(trie.search(q)) == want


CATALOGUE = [("DU/2010/1", "Ustawa z dnia 5 maja 2010 r. o ochronie młynów wodnych", "u.o.m.w.10"), ("DU/2020/2", "Ustawa z dnia 7 maja 2020 r. o ochronie młynów wodnych", "u.o.m.w.20"), ("DU/2011/3", "Ustawa z dnia 9 lutego 2011 r. o opłatach za użytkowanie wiat przystankowych", "u.o.z.u.w.p.")]


@pytest.mark.parametrize(
    ("tytul", "skrot", "eli"),
    [
        ("ustawa z 2010 r. o ochornie mlynow wodynch, dalej: ustawa", None, "DU/2010/1"), ("Ustawa z dnia 7.05.2020r. o ochronie młynówwodnych", None, "DU/2020/2"), ("Ustawa o ochronie młynów wodnych", None, ""), ("Ustawa o ochronie młynów wodnych", "U. O. M. W. 20", "DU/2020/2"),
        ("Ustawa o wiat przystankowych (opłatach za użytkowanie)", None, "DU/2011/3"), ("o opł. za użytk. wiat przyst.", None, "DU/2011/3"), ("o op\\u0142atach za u\\u017cytkowanie wiat", None, ""), ("ww. ustawa", " uozuwp", "DU/2011/3"), (None, "u.o.m.w.10", "DU/2010/1"), ("", None, ""), (None, None, ""),
        ("Ustawa z 1999 r. o ochronie młynów wodnych", None, ""), ("Ustawa o kontroli teatrów lalkowych", "u.o.m.w.10", ""), ("Uchwała sołecka nr 5", None, ""), ("Ustаwa ο ochronie mły​nów wodnych z 2010 r.", None, "DU/2010/1"),
    ],
)
def test_titles(tytul, skrot, eli):
    assert canon.Matcher(canon.Catalogue.of([*CATALOGUE, (None, "x", None), ("DU/9/9", None, None)])).match(tytul, skrot) == eli


def test_entries_of_any_form_and_alias_paths():
    rows = [("A", "Rozporządzenie Ministra Młynów z dnia 5 maja 2010 r. w sprawie młynów wodnych", None), ("B", "Konstytucja Rzeczypospolitej Polskiej z dnia 2 kwietnia 1997 r.", None), ("C", "Kodeks cywilny", None), ("D", CATALOGUE[2][1], None), ("E", "Ustawa z dnia 9 lutego 2011 r. o opłatach za użytkowanie", None)]
    m = canon.Matcher(canon.Catalogue.of(rows))
    for eli, tytul, _ in rows[:4]:
        assert m.match(tytul, None) == eli and (eli, 0) in m.candidates(tytul)
    assert m.match("kodex cywilmy, art. 5", None) == "C" and dict(m.candidates("kodeks cywilmy")) == {"C": 1}
    words = "opłatach za użytkowanie wiat przystankowych".split()
    for i in range(len(words)):  # every rotation is a path; both entries that lie within it come out
        assert m.candidates(" ".join(words[i:] + words[:i]))[0] == ("D", 0)
    assert dict(m.candidates("o opłatach za użytkowanie wiat przystankowych")) == {"D": 0, "E": 0}


def test_trie_grows_with_the_letters():
    def nodes(at):
        return 1 + sum(nodes(x) for k, x in at.items() if k is not None)

    title = " ".join(f"wyraz{chr(97 + i)}" for i in range(20))
    c = canon.Catalogue.of([("A", f"Ustawa z dnia 5 maja 2010 r. o {title}", None)])
    assert nodes(c.phrases) == 21 and sum(map(len, c.inside.values())) == 19


def test_map_titles(spark):
    cat = spark.createDataFrame(CATALOGUE, "eli string, tytul string, skrot string")
    rows = [(1, "ustawa z 2010 r. o ochronie młynów wodnych", None), (1, "ustawa z 2010 r. o ochronie młynów wodnych", None), (2, None, None), (3, LONG, None), (None, "x", None)]
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "ref_id long, tytul string, skrot string, eli string, key_ string")
    assert sorted(map(tuple, canon.map_titles(df, "ref_id", cat).collect())) == [(1, "DU/2010/1"), (2, ""), (3, "")]
    assert sorted(map(tuple, canon.title_candidates(df, "ref_id", cat).collect())) == [(1, "DU/2010/1", 0), (1, "DU/2020/2", 0)]
    assert canon.map_titles(df.limit(0), "ref_id", cat).count() == 0 and [r.eli for r in canon.map_titles(df, "ref_id", cat.limit(0)).collect()] == [""] * 3


# 5 skeleton
def cells(spark, acts):
    rows, at = [], 0
    for eli, texts in acts:
        for i, t in enumerate(texts):
            rows.append((at, eli, t, i, "clash", 1))
            at += 1
    return spark.createDataFrame(rows, "char_id long, eli string, text string, index_in_legal_act int, e_ string, b_ int")


def test_consistent_form():
    for bad, good in {"ｕｓｔａｗａ": "ustawa", "ustаwa": "ustawa", "zażółć": "zażółć", "a b​": "a b", "ο ustawie": "o ustawie", "graﬁka": "grafika", "Νastępca": "Następca"}.items():
        assert skeleton.consistent(bad) == good and skeleton.skeleton(bad) == skeleton.skeleton(good)
    for same in ("Нова Криниця", "„Αθηνά”", "α + β", "40 Ω", "x³ ½ – „a”", "zażółć gęślą jaźń", ""):
        assert skeleton.consistent(same) == same


def test_every_case_is_a_candidate():
    rnd = random.Random(6)
    letters = [*skeleton.PROTOTYPE, *skeleton.LOOSE_PROTOTYPE, *"abcżółęN \xa0\u200bｕﬁ²½αЖ\u0301\u0307"]
    for _ in range(3000):
        t = "".join(rnd.choice(letters) for _ in range(rnd.randrange(1, 9)))
        assert skeleton.consistent(t) == t or skeleton.prototype(t) != t


@pytest.mark.parametrize("block", [3, 4096])
def test_cells(spark, block):
    texts = list("ustаwa ") + ["z", "̇", "e", " ", "„", *"Нова", " ", *"Заря", "”", " ", "z", "\xa0", "ο", " ", "a", "​", "b", "ｃ", "α", " ", "α"]
    df = cells(spark, [("A", texts), ("B", ["x", None, "", "y"]), (None, ["а"])])
    want = {i for i, t in enumerate(texts) if t in ("\xa0", "​", "ｃ", "̇")} | {3, texts.index("̇") - 1, texts.index("ο"), len(texts) - 3}
    got = {r.char_id for r in skeleton.cell_cases(df, block).collect()}
    assert got == want
    assert {r.char_id for r in skeleton.cell_cases(df.unionByName(df), block).collect()} == want and skeleton.cell_cases(df.limit(0)).count() == 0


def test_text_cases_and_groups(spark):
    rows = [(1, "ustаwa"), (2, "ustawa"), (3, "ustawa"), (4, "ust\\u0430wa\xa0"), (5, None), (6, ""), (7, "Нова")]
    df = spark.createDataFrame(rows, "ref_id long, tytul string")
    assert [r.ref_id for r in skeleton.text_cases(df, "ref_id", "tytul").collect()] == [1]
    groups = {r.skeleton: (r.consistent_form, r.forms, r.rows) for r in skeleton.skeleton_groups(df, "tytul").collect()}
    assert groups["ustawa"] == ("ustawa", 2, 3)


# 6 scans
LINE = "struct<line_type string, start_x double, end_x double, start_y double, end_y double, page_number int, index_in_act int, text string, merged boolean, table_number int>".replace("struct<", "struct<").replace(" string", ":string").replace(" double", ":double").replace(" int", ":int").replace(" boolean", ":boolean")


def pages(spark, rows):
    line = lambda t: None if t is Ellipsis else ("text", 0.0, 1.0, 0.0, 1.0, 1, 0, t, False, None)
    area = lambda ts: None if ts is None else [line(t) for t in ts]
    data = [(i, e, "inv", (n, area(p), area(f), area(m)), None, "clash") for i, e, n, p, f, m in rows]
    return spark.createDataFrame(data, f"page_id long, eli string, invoke_id string, page struct<page_number:int, paragraph_lines:array<{LINE}>, footer_lines:array<{LINE}>, margin_lines:array<{LINE}>>, expires_at timestamp, area string")


def test_scan_noise(spark):
    body = ["Starosta prowadzi rejestr młynów wodnych", "oraz kontroluje wodno-lądowy charakter prac"] * 6
    rows = []
    for a in range(3):
        for n in (1, 2, 3):
            rows.append((a * 10 + n, f"A{a}", n, [f"Dziennik Aktów – {n} – Poz. {500 + a}", *body], [f"{3 * n + a}) Zmianę ogłoszono w ten sposób", f"– {n} –"], None))
    extra = ["Dz1ennik Aktów – 4 – Poz. 500", "Starosta kontro-", "luje rejestr m!ynów wodno-", "lądowy charaktcr prac", ..., None, "Starosta prowadzi reje-"]
    rows.append((99, "A0", 4, extra, None, []))
    rows.append((100, "A0", 5, ["str młynów wodnych"], ["[5]"], None))
    df = pages(spark, rows)
    got = {(r.page_id, r.area, r.line_no, r.noise) for r in scan.find_noise(df)[1].collect() if r.page_id >= 99}
    assert got == {(99, "paragraph", 0, "running_header"), (99, "paragraph", 1, "hyphenation"), (99, "paragraph", 2, "misread"), (99, "paragraph", 3, "misread"), (99, "paragraph", 6, "hyphenation"), (100, "footer", 0, "page_number")}
    noise = scan.find_noise(df.unionByName(df))[1].collect()
    assert len(noise) == len(set(noise)) and sum(r.noise == "running_header" for r in noise) == 10 and not any(r.line_no == 0 and r.area == "footer" and r.page_id < 99 for r in noise)
    texts = {(r.page_id, r.area): (r.text, r.open_end) for r in scan.repaired(df).collect()}
    assert texts[(99, "paragraph")][0].startswith("Starosta kontroluje rejestr m!ynów wodno-lądowy charakter prac") and texts[(99, "paragraph")][1]
    assert scan.find_noise(df.limit(0))[1].count() == 0


def test_repaired_text_is_whole(spark):
    body = ["starosta prowadzi rejestr młynów wodnych, dokument rejestr młynów dokument"] * 12
    rows = [(n, "A", 2 * n, body, None, None) for n in range(1, 4)]
    rows += [(20, "B", 1, ["Rejcstr młynów. REJCSTR, (rejcstr)  nie-rejcstrów; dok-", "umcnt wodnych doku-"], None, []), (21, "B", 2, ["mcnt starosta pro-"], None, None), (22, "B", 3, ["wadzi rejestr. Koniec"], None, None), (23, "B", 5, ["młynów"], None, None)]
    df = pages(spark, rows)
    got = {(r.page_id, r.area): (r.text, r.open_end, r.page_number, r.last_page) for r in scan.repaired(df).collect() if r.page_id >= 20}
    assert got == {
        (20, "paragraph"): ("Rejestr młynów. REJESTR, (rejestr)  nie-rejcstrów; dokument wodnych dokument starosta prowadzi rejestr. Koniec", True, 1, 3),
        (23, "paragraph"): ("młynów", False, 5, 5),
    }


def test_chains_cross_blocks(spark):
    data = [(n, "A", "i", n, "paragraph", f"{n};", n not in (3, 9)) for n in range(1, 13)] + [(90, "A", "i", 5, "paragraph", "x", True)]
    df = spark.createDataFrame(data, "page_id long, eli string, invoke_id string, page_number int, area string, text string, open_end boolean")
    got = {(r.page_id, r.text, r.last_page) for r in scan._chained(df, block=2).collect()}
    assert got == {(1, "1;2;3;", 3), (4, "4;5;6;7;8;9;", 9), (10, "10;11;12;", 12), (90, "x", 5)}


def test_anagram_hash(spark):
    words = ["młyn", "nmył", "dokumen†ację", "", "vv"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    assert [r.h for r in df.select(scan.anagram_hash(df.w).alias("h")).collect()] == [scan.anagram_value(w) for w in words]


# 8 packing
def test_first_fit_equals_brute_force():
    rnd = random.Random(8)
    for _ in range(40):
        sizes = [rnd.randint(0, 14) for _ in range(rnd.randint(0, 60))]
        got = packing.pack(sizes, 10)
        free = []
        for i, k, n, b in sorted((x for x in got if not (x[2] == 10 and sizes[x[0]] > 10 and x[1] == 0)), key=lambda x: -x[2]):
            fit = next((j for j, f in enumerate(free) if f >= n), len(free))
            if fit == len(free):
                free.append(10)
            free[fit] -= n
            assert fit == b
        assert sorted((i, sum(x[2] for x in got if x[0] == i)) for i in {x[0] for x in got}) == list(enumerate(sizes))
        for b in {x[3] for x in got}:
            assert sum(x[2] for x in got if x[3] == b) <= 10
    with pytest.raises(ValueError):
        packing.pack([1], 0)


def test_pack_documents(spark):
    docs = spark.createDataFrame([(i, t, 1, 1) for i, t in enumerate(["a b c", None, "", LONG, "x", "x", "<|endoftext|>"])], "doc_id long, text string, tokens int, bin_id int")
    sizes = spark.createDataFrame([(1, 50), (2, 1000), (3, 0), (None, 9), (4, None)], "pack_id int, capacity_tokens int")
    got = packing.pack_documents(docs, sizes, group_size=3).collect()
    counts = {r.doc_id: r.tokens for r in packing.token_counts(docs, "doc_id", "text").collect()}
    assert set(counts) == {0, 3, 4, 5, 6} and {r.pack_id for r in got} == {1, 2}
    for p, cap in ((1, 50), (2, 1000)):
        own = [r for r in got if r.pack_id == p]
        assert {d: sum(r.tokens for r in own if r.doc_id == d) for d in counts} == counts
        bins = {}
        for r in own:
            bins[(r.group_id, r.bin_id)] = bins.get((r.group_id, r.bin_id), 0) + r.tokens
            assert r.piece == 0 or counts[r.doc_id] > cap
        assert max(bins.values()) <= cap
    assert packing.pack_documents(docs.limit(0), sizes).count() == 0 and packing.pack_documents(docs, sizes.limit(0)).count() == 0


# 9 leakage
def test_block_index_finds_all_within_the_radius():
    rnd = np.random.default_rng(9)
    base = rnd.integers(0, 1 << 63, 300, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in rnd.choice(64, rnd.integers(0, 6), replace=False)) for _ in range(300)], dtype=np.uint64)
    queries = base ^ flips
    q, h = leakage.BlockIndex(base).within(queries)
    want = {(i, j) for i in range(300) for j in range(300) if bin(int(queries[i] ^ base[j])).count("1") <= leakage.RADIUS}
    assert {(int(a), int(b)) for a, b in zip(q, h, strict=True)} == want


def test_short_items_are_held_whole(spark):
    items = spark.createDataFrame([(1, "młyn wodny stoi nad cichą rzeką Wartą"), (2, "kto zamknie śluzę"), (3, "!"), (4, "jeden"), (2, "inny krótki tekst pytania")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "Wiadomo: MŁYN wodny stoi, nad cicha rzeką Wartą. Reszta."), (2, "młyn wodny stoi nad"), (3, "Kto zamknie śluzę"), (4, "x inny krótki tekst pytania y"), (5, "jeden"), (6, "zamknie śluzę kto")], "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in leakage.leaks(docs, "doc_id", "text", items).collect()}
    assert got == {(1, 1), (3, 2), (4, 2), (5, 4)}


def test_stretches_far_apart_and_the_bound():
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(6))
    item = [word() for _ in range(60)]
    doc = item[:30] + [word() for _ in range(3000)] + item
    finder = leakage.LeakFinder([(1, " ".join(item))], 0.4, 0.72, 0.12)
    assert finder.find([" ".join(doc)]) == [(0, 1, 0, 59, 1.0)]
    # the bound never refuses what the final test takes
    for _ in range(200):
        part = np.array([rnd.choice([*range(60), -1, -1]) if rnd.random() < 0.3 else i for i in range(rnd.randrange(20, 60))], np.int32)
        x = finder.coded[0]
        own = np.where(part < 0, -1, x[part])
        first, last = leakage.best_stretches([(x, own)])[0]
        stretch = x[first : last + 1]
        takes = last - first + 1 >= 0.4 * len(x) and leakage.shingle_similarity(stretch, own, finder.weight[stretch]) >= 0.72
        assert finder._can_reach(0, own) or not takes


def local(item, doc):
    best, table = (0, 0, -1), {}
    for i in range(len(item) + 1):
        for j in range(len(doc) + 1):
            if i == 0 or j == 0:
                table[i, j] = 0
                continue
            table[i, j] = max(0, table[i - 1, j - 1] + (1 if item[i - 1] == doc[j - 1] else -1), table[i - 1, j] - 1, table[i, j - 1] - 1)
            best = max(best, (table[i, j],))
    return best[0]


def test_alignment_scores_like_the_full_table():
    rnd = random.Random(10)
    for _ in range(60):
        a, b = [rnd.randint(0, 3) for _ in range(rnd.randint(0, 14))], [rnd.randint(0, 3) for _ in range(rnd.randint(0, 20))]
        first, last = leakage.best_stretches([(np.array(a, np.int32), np.array(b, np.int32))])[0]
        want = local(a, b)
        if want:
            assert local(a[first : last + 1], b) == want
        else:
            assert last == -1


def test_leaks(spark):
    rnd = random.Random(11)
    pool = [f"słowo{i}" for i in range(3000)]
    items = [(i, " ".join(rnd.sample(pool, 80))) for i in range(5)]
    w = items[0][1].split()
    light = " ".join(x if k % 15 else x + " dodane" for k, x in enumerate(w)).upper()
    noise = lambda n: " ".join(rnd.choices(pool, k=n))
    docs = [(1, noise(50) + " " + items[0][1] + " " + noise(30)), (2, noise(20) + "\n" + light + ".\n" + noise(20)), (3, " ".join(w[20:55])), (4, noise(40) + " " + " ".join(w[:20])), (5, noise(9000) + " " + " ".join(items[3][1].split()[10:60])), (6, None), (7, ""), (8, "krótki"), (9, items[1][1] + " " + items[2][1]), (10, LONG)]
    df = spark.createDataFrame([(*d, "clash", 1) for d in docs], "doc_id long, text string, key_ string, item_id int")
    it = spark.createDataFrame([*items, (None, "x"), (77, None), (78, "za krótki"), items[0]], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id) for r in leakage.leaks(df, "doc_id", "text", it).collect())
    assert got == [(1, 0), (2, 0), (3, 0), (5, 3), (9, 1), (9, 2)]
    assert leakage.leaks(df.limit(0), "doc_id", "text", it).count() == 0 and leakage.leaks(df, "doc_id", "text", it.limit(0)).count() == 0
    accents = unicodedata.normalize("NFD", "Zażółć gęślą jaźń")
    assert leakage.words(accents) == leakage.words("zazolc, gesla JAZN")


# 10 reading level
STYLES = {1: "Ala ma {}. Tu jest {}. Weź {}.", 2: "Pamiętaj, że {} musi mieć twój podpis, jeśli chcesz go użyć.", 3: "Urząd gminy przypomina, że {} należy zgłosić do końca maja, gdyż poprzedni wykaz stracił aktualność.", 4: "W przypadkach, o których mowa w art. 3 ust. 2, organ określa {} w drodze decyzji administracyjnej, po zasięgnięciu opinii rady gminy, w terminie 30 dni.", 5: "Nie ulega wątpliwości, że {} implikuje prekluzyjny charakter rozstrzygnięcia, wobec czego a contrario nie sposób podzielić poglądu, jakoby relatywizował wzruszalność domniemania in abstracto."}
THINGS = "młyn staw most prom wyciąg pomost spis rejestr sad wykaz".split()


def styled(level, n, rnd):
    return " ".join(STYLES[level].format(*(rnd.choice(THINGS) for _ in range(3))) for _ in range(n))


def test_levels_of_held_out_documents(spark):
    rnd = random.Random(12)
    train = [(i, styled(1 + i % 5, 3, rnd)) for i in range(150)]
    test = [(1000 + i, styled(1 + i % 5, 6, rnd) + " " + styled(1 + (i + 2) % 5, 1, rnd)) for i in range(50)]
    odd = [(2000, None), (2001, " "), (2002, "The owner must register the building within fourteen days of the notice."), (2003, "123 !"), (2004, LONG)]
    df = spark.createDataFrame([(*d, "clash", 9) for d in train + test + odd], "doc_id long, text string, key_ string, level int")
    ratings = [(i, 1, 1 + i % 5) for i, _ in train] + [(0, 2, 1), (1, 2, None), (5, 3, 9), (None, 1, 2), (999999, 1, 3)]
    rd = spark.createDataFrame(ratings, "doc_id long, rater_id int, level int")
    got = {r.doc_id: r.level for r in readability.reading_levels(df, rd).collect()}
    assert sum(got[d] == 1 + i % 5 for i, (d, _) in enumerate(test)) >= 48
    assert 2004 in got and not {2000, 2001, 2002, 2003} & set(got) and len(got) == 201
    assert readability.reading_levels(df.limit(0), rd).count() == 0 and readability.reading_levels(df, rd.limit(0)).count() == 0


def test_sentences_keep_abbreviations():
    assert readability.sentences("Zob. art. 3 ust. 2. Tak.\nNie!") == ["Zob. art. 3 ust. 2.", "Tak.", "Nie!"]
