"""Queries of text functions, nested values and statute splitters."""

from __future__ import annotations

from pyspark.sql import functions as F

from kodeks.functions import text as T
from kodeks.operators import match, split, structure
from kodeks.operators.nested import reference_tables
from kodeks.plans.core_problems import BODIES
from kodeks.plans.registry import Registry
from kodeks.session import table

query = Registry()
# Relations that change an act.
CHANGING = ["Akty zmieniające", "Akty uchylające", "Uchylenia wynikające z", "Inf. o tekście jednolitym"]
_PAGE_TEXT = "(SELECT page_id, string_agg(l.text, chr(10) ORDER BY i) AS t FROM (SELECT DISTINCT page_id, unnest(page.paragraph_lines) AS l, generate_subscripts(page.paragraph_lines, 1) AS i FROM act_pages) WHERE l.text IS NOT NULL GROUP BY page_id)"


def _page_text(spark, sf):
    p = table(spark, sf, "act_pages").select("page_id", F.filter(F.transform("page.paragraph_lines", lambda x: x["text"]), lambda t: t.isNotNull()).alias("l")).where("size(l) > 0")
    return p.select("page_id", F.array_join("l", "\n").alias("t")).distinct()


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(spark, sf):
    return table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("SELECT ref_id, nro, p.artykul AS artykul, p.ustep AS ustep, p.punkt AS punkt FROM (SELECT ref_id, nro, unnest(przepisy) AS p FROM llm_references)")
def explode_refs(spark, sf):
    return table(spark, sf, "llm_references").select("ref_id", "nro", F.explode("przepisy").alias("p")).select("ref_id", "nro", "p.artykul", "p.ustep", "p.punkt")


@query("SELECT ref_id, len(przepisy) AS n_units, list_filter(przepisy, lambda x: x.ustep IS NOT NULL)[1].artykul AS first_with_section FROM llm_references WHERE przepisy IS NOT NULL")
def array_first_match(spark, sf):
    r = table(spark, sf, "llm_references").where("przepisy IS NOT NULL")
    return r.select("ref_id", F.size("przepisy").cast("long").alias("n_units"), F.get(F.filter("przepisy", lambda x: x["ustep"].isNotNull()), 0)["artykul"].alias("first_with_section"))


@query("SELECT ref_id, concat_ws('/', p.artykul, p.ustep, p.punkt) AS unit_path FROM (SELECT ref_id, unnest(przepisy) AS p FROM llm_references)")
def flatten_units(spark, sf):
    return table(spark, sf, "llm_references").select("ref_id", F.explode(F.transform("przepisy", lambda x: F.concat_ws("/", x["artykul"], x["ustep"], x["punkt"]))).alias("unit_path"))


_CHANGING = "relation IN ('" + "', '".join(CHANGING) + "')"
_DATE = "coalesce(CASE WHEN NOT contains(lower(relation), 'inf.') THEN json_extract_string(r, '$.date') END, json_extract_string(r, '$.act.promulgation'), CASE WHEN json_extract_string(r, '$.act.type') = 'Obwieszczenie' THEN json_extract_string(r, '$.act.announcementDate') END)"


def _dated(spark, sf):
    refs, _ = reference_tables(table(spark, sf, "act_references"))
    refs = refs.where(F.col("relation").isin(CHANGING))
    own = F.when(~F.lower("relation").contains("inf."), F.col("date"))
    return refs.withColumn("ref_date", F.coalesce(own, "promulgation", F.when(F.col("act_type") == "Obwieszczenie", F.col("announcement_date"))))


@query(BODIES + f"SELECT DISTINCT record_id, relation, ref_pos, {_DATE} AS ref_date FROM refs WHERE {_CHANGING}")
def ref_dates(spark, sf):
    """Date of every reference that changes an act: its own, save for consolidated texts, else the act's promulgation,
    else its announcement where the act is one. Null where none is known."""
    return _dated(spark, sf).select("record_id", "relation", "ref_pos", "ref_date").distinct()


@query(BODIES + f"""SELECT DISTINCT record_id, relation, ref_pos, act_eli, ref_date, CASE WHEN act_eli IS NULL THEN 'no_eli' WHEN json_extract_string(r, '$.act.type') IS NULL THEN 'no_type' WHEN json_extract_string(r, '$.act.title') IS NULL THEN 'no_title' WHEN ref_date IS NULL THEN 'no_date' END AS error
 FROM (SELECT *, json_extract_string(r, '$.act.ELI') AS act_eli, {_DATE} AS ref_date FROM refs WHERE {_CHANGING})""")
def ref_extract(spark, sf):
    """References that change an act, with the first thing they lack as their error."""
    lacks = F.when(F.col("act_eli").isNull(), "no_eli").when(F.col("act_type").isNull(), "no_type").when(F.col("act_title").isNull(), "no_title").when(F.col("ref_date").isNull(), "no_date")
    return _dated(spark, sf).select("record_id", "relation", "ref_pos", "act_eli", "ref_date", lacks.alias("error")).distinct()


@query("SELECT char_id, translate(text, '{a}', '{b}') AS up, translate(text, '{c}', '{d}') AS down FROM act_chars".format(a=T.TO_RAISE.replace("'", "''"), b=T.RAISED_ALL, c=T.TO_LOWER.replace("'", "''"), d=T.LOWERED_ALL))
def script_map(spark, sf):
    return table(spark, sf, "act_chars").select("char_id", T.raised(F.col("text")).alias("up"), T.lowered(F.col("text")).alias("down"))


@query("SELECT DISTINCT ref_id, coalesce(regexp_matches(trim(regexp_replace(tytul, '[\\s\\x{00a0}\\x{2000}-\\x{200a}\\x{202f}\\x{3000}]+', ' ', 'g')), '(?is)^Ustawa\\s+z\\s+dnia\\s+([0-9]{1,2}\\s+(" + T.MONTH_NAMES + ")|[0-9]{2}[.][0-9]{2})\\s+[0-9]{4}\\s+r[.]\\s+.*$'), FALSE) AS full_title FROM llm_references")
def title_valid(spark, sf):
    return table(spark, sf, "llm_references").select("ref_id", T.is_full_title(F.col("tytul")).alias("full_title")).distinct()


@query("SELECT eli, to_base64(encode(title)) AS encoded, translate(title, '-–—', '−−−') AS one_dash, NOT regexp_matches(title, '[(]cid:[0-9]+[)]') AS decodable FROM acts WHERE title IS NOT NULL")
def encoded_titles(spark, sf):
    t = F.col("title")
    return table(spark, sf, "acts").where("title IS NOT NULL").select("eli", T.encoded(t).alias("encoded"), T.usual_signs(t).alias("one_dash"), T.is_decodable(t).alias("decodable"))


@query("SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS squeezed FROM documents")
def ws_collapse(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.squeeze(F.col("text")).alias("squeezed"))


@query("SELECT eli, contains(strip_accents(lower(title)), 'zasadach udostepniania') AS folded_hit FROM acts")
def fold_contains(spark, sf):
    return table(spark, sf, "acts").select("eli", F.contains(T.fold(F.col("title")), F.lit("zasadach udostepniania")).alias("folded_hit"))


@query("SELECT char_id, translate(text, '⁰¹²³⁴⁵⁶⁷⁸⁹', '0123456789') AS digit FROM act_chars WHERE regexp_matches(text, '[⁰¹²³⁴⁵⁶⁷⁸⁹]')")
def superscript_map(spark, sf):
    return table(spark, sf, "act_chars").where(F.col("text").rlike(f"[{T.RAISED}]")).select("char_id", T.plain_digits(F.col("text")).alias("digit"))


@query("""SELECT ref_id, a, CASE WHEN u IS NULL THEN string_split(a, '-') WHEN NOT contains(a, '-') THEN [a, u] END AS ids FROM (SELECT ref_id, p.artykul AS a, p.ustep AS u FROM (SELECT ref_id, unnest(przepisy) AS p FROM llm_references)) WHERE a IS NOT NULL""")
def id_range_parse(spark, sf):
    p = table(spark, sf, "llm_references").select("ref_id", F.explode("przepisy").alias("p")).where("p.artykul IS NOT NULL")
    return p.select("ref_id", F.col("p.artykul").alias("a"), T.id_range(F.concat_ws(" – ", "p.artykul", "p.ustep")).alias("ids"))


@query("SELECT nro, CAST(unnest(regexp_extract_all(answer_content, '#/document/([0-9]+)', 1)) AS BIGINT) AS document_id FROM (SELECT DISTINCT nro, answer_content FROM questions)")
def href_refs(spark, sf):
    q = table(spark, sf, "questions").select("nro", "answer_content").distinct()
    return q.select("nro", F.explode(F.regexp_extract_all("answer_content", F.lit(r"#/document/(\d+)"), F.lit(1)).cast("array<bigint>")).alias("document_id"))


@query("SELECT doc_id, strpos(text, 'ust.') AS first_at, substr(text, 5, 10) AS part FROM documents WHERE text IS NOT NULL")
def substr_range(spark, sf):
    return table(spark, sf, "documents").where("text IS NOT NULL").select("doc_id", F.locate("ust.", "text").cast("long").alias("first_at"), F.substring("text", 5, 10).alias("part"))


@query("SELECT doc_id, (length(text) - length(replace(text, 'ust.', ''))) // 4 AS n_hits FROM documents WHERE text IS NOT NULL")
def substr_count(spark, sf):
    return table(spark, sf, "documents").where("text IS NOT NULL").select("doc_id", F.regexp_count("text", F.lit(r"ust\.")).cast("long").alias("n_hits"))


@query("""SELECT doc_id, min(i) AS word_at FROM (SELECT doc_id, w, generate_subscripts(w, 1) - 1 AS i FROM (SELECT doc_id, string_split(lower(text), ' ') AS w FROM documents)) WHERE w[i + 1] = 'o' AND w[i + 2] = 'których' AND w[i + 3] = 'mowa' GROUP BY doc_id""")
def phrase_find(spark, sf):
    """First word position of a phrase in a document's texts: the blanks before it. One search of the text as a string; a
    list of its words would be split again at every place, as Spark puts its expression into lambdas and filters."""
    phrase = " o których mowa "
    text = F.concat(F.lit(" "), F.lower("text"), F.lit(" "))
    d = table(spark, sf, "documents").where(F.contains(text, F.lit(phrase)))
    return d.select("doc_id", F.regexp_count(F.substring_index(text, phrase, 1), F.lit(" ")).cast("long").alias("word_at")).groupBy("doc_id").agg(F.min("word_at").alias("word_at"))


_CHARS = "(SELECT nro, c, count(*) AS n FROM (SELECT nro, unnest(string_split({f}, '')) AS c FROM (SELECT DISTINCT nro, title, question_content FROM questions)) WHERE c <> '' GROUP BY nro, c)"


@query(f"SELECT a.nro, a.c AS letter, a.n - coalesce(b.n, 0) AS lacking FROM {_CHARS.format(f='title')} a LEFT JOIN {_CHARS.format(f='question_content')} b USING (nro, c) WHERE a.n > coalesce(b.n, 0)")
def multiset_diff(spark, sf):
    q = table(spark, sf, "questions").select("nro", "title", "question_content").distinct()
    n = lambda f, m: q.select("nro", F.explode(F.split(f, "")).alias("letter")).where("letter <> ''").groupBy("nro", "letter").agg(F.count("*").alias(m))
    j = n("title", "a").join(n("question_content", "b"), ["nro", "letter"], "left")
    return j.select("nro", "letter", (F.col("a") - F.coalesce("b", F.lit(0))).alias("lacking")).where("lacking > 0")


@query("SELECT eli, regexp_extract(u, '^s3://([^/]+)/(.*)$', 1) AS bucket, regexp_extract(u, '^s3://([^/]+)/(.*)$', 2) AS object_key FROM (SELECT eli, 's3://' || lower(publisher) || '/' || address || '/' || filename_of_pdf AS u FROM acts) WHERE u IS NOT NULL")
def uri_parts(spark, sf):
    u = table(spark, sf, "acts").select("eli", F.concat(F.lit("s3://"), F.lower("publisher"), F.lit("/"), "address", F.lit("/"), "filename_of_pdf").alias("u")).where("u IS NOT NULL")
    p = "^s3://([^/]+)/(.*)$"
    return u.select("eli", F.regexp_extract("u", p, 1).alias("bucket"), F.regexp_extract("u", p, 2).alias("object_key"))


@query("SELECT doc_id, CASE WHEN regexp_matches(text, '^(W przypadkach|Na zasadach|W trybie)') THEN 'reference' WHEN regexp_matches(text, '^(Kto|Od [0-9]+)') THEN 'duty' ELSE 'other' END AS opening FROM documents")
def regex_classify(spark, sf):
    t = F.col("text")
    return table(spark, sf, "documents").select("doc_id", F.when(t.rlike("^(W przypadkach|Na zasadach|W trybie)"), "reference").when(t.rlike("^(Kto|Od [0-9]+)"), "duty").otherwise("other").alias("opening"))


@query("SELECT eli, status FROM acts WHERE NOT coalesce(regexp_replace('(' || lower(trim(status)) || ')', '\\s+', '', 'g') = '(uchylony)', FALSE)")
def drop_repealed(spark, sf):
    s = F.concat(F.lit("("), F.lower(F.trim("status")), F.lit(")"))
    return table(spark, sf, "acts").where(T.in_force(s)).select("eli", "status")


@query("""WITH u AS (SELECT ref_id, p.artykul AS unit_id, i FROM (SELECT ref_id, unnest(przepisy) AS p, generate_subscripts(przepisy, 1) - 1 AS i FROM (SELECT DISTINCT ref_id, przepisy FROM llm_references)) WHERE p.artykul IS NOT NULL),
w AS (SELECT ref_id, CASE ref_id % 4 WHEN 0 THEN [list[1]] WHEN 1 THEN [list[1], list[len(list)]] WHEN 2 THEN ['999'] ELSE [list[len(list)], '999'] END AS ids FROM (SELECT ref_id, list(unit_id ORDER BY i) AS list FROM u GROUP BY ref_id)),
s AS (SELECT ref_id, ids, (SELECT min(i) FROM u WHERE u.ref_id = w.ref_id AND unit_id = ids[1]) AS a FROM w),
e AS (SELECT *, (SELECT min(i) FROM u WHERE u.ref_id = s.ref_id AND i >= a AND unit_id = ids[len(ids)]) AS b FROM s)
SELECT e.ref_id, array_to_string(ids, '..') AS asked, u.unit_id, NULL AS error FROM e JOIN u ON u.ref_id = e.ref_id AND u.i BETWEEN a AND b
UNION ALL SELECT ref_id, array_to_string(ids, '..'), NULL, CASE WHEN a IS NULL THEN CASE len(ids) WHEN 1 THEN 'not_found' ELSE 'start_not_found' END ELSE 'end_not_found' END FROM e WHERE a IS NULL OR b IS NULL""")
def unit_range(spark, sf):
    """Units from a start id to an end id by position, single ids, and the errors of ids that aren't there: over the
    articles that a reference lists."""
    r = table(spark, sf, "llm_references").select("ref_id", "przepisy").distinct().select("ref_id", F.posexplode("przepisy").alias("i", "p")).where("p.artykul IS NOT NULL")
    units = r.select("ref_id", "i", F.col("p.artykul").alias("unit_id"))
    ids = F.transform(F.array_sort(F.collect_list(F.struct("i", "unit_id"))), lambda x: x["unit_id"])
    first, last, none = F.element_at("l_", 1), F.element_at("l_", -1), F.lit("999")
    m = F.col("ref_id") % 4
    wanted = units.groupBy("ref_id").agg(ids.alias("l_")).select("ref_id", F.when(m == 0, F.array(first)).when(m == 1, F.array(first, last)).when(m == 2, F.array(none)).otherwise(F.array(last, none)).alias("ids"))
    return split.select_units(units, ["ref_id"], "i", wanted).select("ref_id", F.array_join("ids", "..").alias("asked"), "unit_id", "error")


@query("""SELECT r.ref_id, c.eli, r.unit_no, r.p.artykul AS artykul, r.p.ustep AS ustep, r.p.punkt AS punkt FROM
 (SELECT ref_id, t, unnest(przepisy) AS p, generate_subscripts(przepisy, 1) - 1 AS unit_no FROM (SELECT DISTINCT ref_id, rtrim(trim(lower(tytul)), '.') || '.' AS t, przepisy FROM llm_references)) r
 JOIN (SELECT rtrim(trim(lower(tytul)), '.') || '.' AS t, min(eli) AS eli FROM act_catalog GROUP BY 1) c USING (t)""")
def ref_resolve(spark, sf):
    """References resolved to an act by title, then to the articles they name, in order."""
    r = table(spark, sf, "llm_references").select("ref_id", "tytul", "przepisy").distinct()
    acts = match.exact_titles(r, table(spark, sf, "act_catalog"), "ref_id")
    units = r.select("ref_id", F.posexplode("przepisy").alias("unit_no", "p")).select("ref_id", F.col("unit_no").cast("long").alias("unit_no"), "p.*")
    return units.join(acts.where("eli IS NOT NULL").distinct(), "ref_id").select("ref_id", "eli", "unit_no", "artykul", "ustep", "punkt")


@query("SELECT DISTINCT nro, trim(regexp_replace(replace(regexp_replace(answer_content, '<[^<>]*>', ' ', 'g'), chr(160), ' '), '\\s+', ' ', 'g')) AS answer_text FROM questions WHERE answer_content IS NOT NULL")
def html_text(spark, sf):
    return table(spark, sf, "questions").where("answer_content IS NOT NULL").select("nro", F.trim(F.regexp_replace(F.regexp_replace("answer_content", "<[^<>]*>", " "), r"[\s\u00a0]+", " ")).alias("answer_text")).distinct()


@query(f"SELECT page_id, substr(t, strpos(t, 'Art. ')) AS body FROM {_PAGE_TEXT} WHERE contains(t, 'Art. ')")
def body_cut(spark, sf):
    return _page_text(spark, sf).select("page_id", split.body_cut(F.col("t"), r"Art\. ").alias("body")).where("body IS NOT NULL")


@query(f"SELECT page_id, u - 1 AS unit_no, p[u] AS unit_text FROM (SELECT page_id, p, unnest(generate_series(1, len(p))) AS u FROM (SELECT page_id, list_filter(string_split(regexp_replace(t, '\\b(Art[.]\\s[0-9]+[a-z]*[.]\\s)', chr(1) || '\\1', 'g'), chr(1)), lambda x: x <> '') AS p FROM {_PAGE_TEXT}))")
def split_lookahead(spark, sf):
    return split.split_units(_page_text(spark, sf), ["page_id"], "t", "article").select("page_id", F.col("unit_no").cast("long").alias("unit_no"), "unit_text")


@query()
def split_articles(spark, sf):
    return split.split_units(_page_text(spark, sf), ["page_id"], "t", "article")


@query()
def split_sections(spark, sf):
    return split.split_units(_page_text(spark, sf), ["page_id"], "t", "section")


@query()
def split_points(spark, sf):
    return split.split_units(_page_text(spark, sf), ["page_id"], "t", "point")


_SEGMENTS = f"""(SELECT page_id, i - 1 AS seg_no, CAST(coalesce(list_sum(list_transform(p[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS a, length(p[i]) AS n, p[i] AS raw,
 CASE WHEN regexp_full_match(p[i], '\\[[^\\[\\]<>]*\\]') THEN 'BEFORE_UPCOMING_CHANGE' WHEN regexp_full_match(p[i], '<[^\\[\\]<>]*>') THEN 'UPCOMING_CHANGE' ELSE 'NOT_MATCH_CHANGE' END AS status
 FROM (SELECT page_id, p, unnest(generate_series(1, len(p))) AS i FROM (SELECT page_id, regexp_extract_all(t, '\\[[^\\[\\]<>]*\\]|<[^\\[\\]<>]*>|[^\\[<]+|[\\[<]') AS p FROM {_PAGE_TEXT})))"""


@query(f"SELECT page_id, seg_no, a AS start_at, a + n - 1 AS end_at, status, CASE WHEN status = 'NOT_MATCH_CHANGE' THEN raw ELSE substr(raw, 2, n - 2) END AS segment FROM {_SEGMENTS}")
def change_segments(spark, sf):
    s = structure.segments(_page_text(spark, sf), ["page_id"], "t")
    return s.select("page_id", *[F.col(c).cast("long").alias(n) for c, n in (("seg_no", "seg_no"), ("start", "start_at"), ("end", "end_at"))], "status", "segment")


@query(f"SELECT page_id, string_agg(CASE WHEN status = 'NOT_MATCH_CHANGE' THEN raw ELSE substr(raw, 2, n - 2) END, '' ORDER BY seg_no) AS in_force FROM {_SEGMENTS} WHERE status <> 'UPCOMING_CHANGE' GROUP BY page_id")
def current_text(spark, sf):
    """Characters that are in force now, put together from the painted text of a page."""
    chars = structure.painted(_page_text(spark, sf), ["page_id"], "t").where("status <> 'UPCOMING_CHANGE'")
    return chars.groupBy("page_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("char_no", "letter"))), lambda x: x["letter"]), "").alias("in_force"))


_ACT_LINES = r"""ls AS (SELECT eli, invoke_id, pn, page_id, i, k, ps[k] AS line FROM (SELECT *, unnest(generate_series(1, len(ps))) AS k FROM (SELECT eli, invoke_id, pn, page_id, i,
 string_split(regexp_replace(regexp_replace(regexp_replace(trim(l.text), '([.!?;,]) (Art[.] [0-9]+[a-z]*[.] )', '\1' || chr(10) || '\2', 'g'), '(^|\n)(Art[.] [0-9]+[a-z]*[.]) ([0-9]+[a-z]*[.)] )', '\1\2' || chr(10) || '\3', 'g'), '(^|\n)([0-9]+[a-z]*[.]) ([0-9]+[a-z]*[)] )', '\1\2' || chr(10) || '\3', 'g'), chr(10)) AS ps
 FROM (SELECT DISTINCT eli, invoke_id, page.page_number AS pn, page_id, unnest(page.paragraph_lines) AS l, generate_subscripts(page.paragraph_lines, 1) AS i FROM act_pages) WHERE length(trim(l.text)) > 0))),
num AS (SELECT *, row_number() OVER (PARTITION BY eli, invoke_id ORDER BY pn, page_id, i, k) AS r FROM ls),
g AS (SELECT *, lag(line) OVER (PARTITION BY eli, invoke_id ORDER BY r) AS prev FROM num),
h AS (SELECT eli, invoke_id, r, line, CASE WHEN regexp_matches(line, '^[\[<]?\s*Art[.]?\s*[0-9]+[a-zA-ZĄĆĘŁŃÓŚŹŻąćęłńóśźż]*[.]') THEN r END AS a,
 CASE WHEN regexp_matches(line, '^[\[<]?\s*[0-9]{1,2}[a-zA-ZĄĆĘŁŃÓŚŹŻąćęłńóśźż]{0,4}[.]\s*[A-ZĄĆĘŁŃÓŚŹŻ(\[<]') AND NOT coalesce(regexp_matches(prev, '([-–]|\s(art[.]|ust[.]|poz[.]|str[.]|pkt|lub|albo|i))\s*$'), FALSE) THEN r END AS s,
 CASE WHEN regexp_matches(line, '^[\[<]?\s*[0-9]+[a-zA-ZĄĆĘŁŃÓŚŹŻąćęłńóśźż]*[)]\s*') AND NOT coalesce(regexp_matches(prev, '([-–]|\s(s[.]|i)|(str[.]|pkt|ust[.]|art[.]|poz[.]))\s*$'), FALSE) THEN r END AS p FROM g),
c AS (SELECT eli, invoke_id, r, line, max(a) OVER w AS a, max(s) OVER w AS s, max(p) OVER w AS p FROM h WINDOW w AS (PARTITION BY eli, invoke_id ORDER BY r ROWS UNBOUNDED PRECEDING)),
v AS (SELECT eli, invoke_id, r, line, a, CASE WHEN s > a THEN s END AS s, CASE WHEN p > a AND (s IS NULL OR p > s) THEN p END AS p FROM c WHERE a IS NOT NULL),
am AS (SELECT eli, invoke_id, a FROM v GROUP BY ALL HAVING contains(string_agg(line, ' ' ORDER BY r), 'wprowadza się następujące zmiany')),
u AS (SELECT eli, invoke_id, a, s, p, arg_min(line, r) AS head, regexp_replace(string_agg(line, chr(10) ORDER BY r), '^[\[<]?\s*(Art[.]?\s*)?[0-9]+\p{L}*[.)]\s*', '') AS body FROM v WHERE NOT EXISTS (SELECT 1 FROM am WHERE am.eli = v.eli AND am.invoke_id = v.invoke_id AND am.a = v.a) GROUP BY eli, invoke_id, a, s, p)"""


def _unit_sql(level: str) -> str:
    own = {"article": "s IS NULL AND p IS NULL", "section": "s IS NOT NULL AND p IS NULL", "point": "p IS NOT NULL"}[level]
    return f"WITH {_ACT_LINES} SELECT eli, invoke_id, regexp_extract(head, '([0-9]+[a-zA-ZĄĆĘŁŃÓŚŹŻąćęłńóśźż]*)', 1) AS unit_id, nullif(trim(body), '') AS body FROM u WHERE {own}"


def _units(spark, sf, level):
    units = structure.act_units(table(spark, sf, "act_pages"))[0]
    return units.where(F.col("level") == level).select("eli", "invoke_id", "unit_id", "body")


@query(_unit_sql("article"))
def act_articles(spark, sf):
    """Articles of acts over their pages, up to the first section or point. The tables hold no titles, parts, chapters or
    repealed units, so the SQL leaves their rules out; tests cover these."""
    return _units(spark, sf, "article")


@query(_unit_sql("section"))
def act_sections(spark, sf):
    return _units(spark, sf, "section")


@query(_unit_sql("point"))
def act_points(spark, sf):
    return _units(spark, sf, "point")


@query()
def act_unit_errors(spark, sf):
    """Articles with sections and points of their own, and units whose numbers fall."""
    return structure.act_units(table(spark, sf, "act_pages"))[1]


@query(f"SELECT page_id, regexp_extract(t, '^Art[.] ([0-9]+[a-z]*)[.]', 1) AS unit_id, regexp_replace(t, '^Art[.] [0-9]+[a-z]*[.]\\s*', '') AS body FROM {_PAGE_TEXT} WHERE regexp_matches(t, '^Art[.] [0-9]+[a-z]*[.]')")
def id_and_body(spark, sf):
    p = _page_text(spark, sf).where(F.col("t").rlike(r"^Art\. \d+[a-z]*\."))
    return p.select("page_id", F.regexp_extract("t", r"^Art\. (\d+[a-z]*)\.", 1).alias("unit_id"), F.regexp_replace("t", r"^Art\. \d+[a-z]*\.\s*", "").alias("body"))


@query()
def unit_bodies(spark, sf):
    """Identifier and body of every article, section and point; id_and_body has the article a page begins with only."""
    return split.unit_bodies(_page_text(spark, sf), ["page_id"], "t")


@query()
def unit_select(spark, sf):
    """Articles that a resolved reference names, by start and end id or a single id; unit_range goes by fixed places."""
    r = table(spark, sf, "llm_references").select("ref_id", "tytul", "przepisy").distinct()
    acts = match.exact_titles(r, table(spark, sf, "act_catalog"), "ref_id").where("eli IS NOT NULL").select("ref_id", "eli").distinct()
    pages = table(spark, sf, "act_pages").select("page_id", "eli", "invoke_id", F.col("page.page_number").alias("page_number")).dropDuplicates(["page_id"])
    units = split.split_units(_page_text(spark, sf), ["page_id"], "t", "article").where("unit_id IS NOT NULL").join(pages, "page_id").select("eli", "invoke_id", F.struct("page_number", "page_id", "unit_no").alias("place"), "unit_id")
    ids = r.select("ref_id", F.explode("przepisy").alias("p")).select("ref_id", T.id_range(F.col("p.artykul")).alias("ids"))
    wanted = ids.join(acts, "ref_id").join(pages.select("eli", "invoke_id").distinct(), "eli")
    got = split.select_units(units, ["eli", "invoke_id"], "place", wanted)
    return got.select("eli", "invoke_id", "ids", "place.page_id", "place.unit_no", "unit_id", "error")


QUERIES, SQL = query.queries, query.sql
