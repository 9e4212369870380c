"""Queries of the relational operators: scans, sinks, joins, aggregation, incremental state."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from kodeks.functions.normal import act_key, any_date
from kodeks.functions.text import squeeze, title_key
from kodeks.operators import match
from kodeks.operators import relational as R
from kodeks.plans.registry import Registry
from kodeks.schemas import ACT_CORE, ACT_PATHS
from kodeks.session import table

query = Registry()

_VERSIONS = """
WITH s AS (SELECT eli, lower(trim(status)) AS status, title, promulgation, filename_of_pdf, changedate,
  row_number() OVER (PARTITION BY eli ORDER BY changedate NULLS FIRST, lower(trim(status)) NULLS FIRST, title NULLS FIRST, promulgation NULLS FIRST, filename_of_pdf NULLS FIRST) AS a,
  row_number() OVER (PARTITION BY eli ORDER BY changedate DESC NULLS LAST, lower(trim(status)) DESC NULLS LAST, title DESC NULLS LAST, promulgation DESC NULLS LAST, filename_of_pdf DESC NULLS LAST) AS d FROM acts)"""


def _act_versions(spark: SparkSession, sf: str):
    """First and last version of every act."""
    cols = ["changedate", "status", "title", "promulgation", "filename_of_pdf"]
    acts = table(spark, sf, "acts").withColumn("status", F.lower(F.trim("status"))).select("eli", *cols)
    v = F.struct(*cols)
    # structs compare field by field with nulls first, so first and last need no window
    g = acts.groupBy("eli").agg(F.min(v).alias("old"), F.max(v).alias("new"))
    return g.select("eli", "old.*"), g.select("eli", "new.*")


@query("SELECT eli, status, announcementdate, CAST(volume AS BIGINT) AS volume, title, type, texthtml, CAST(document_year AS BIGINT) AS document_year FROM acts")
def scan_cast(spark, sf):
    return R.align(table(spark, sf, "acts"), ACT_CORE)


@query("SELECT eli, title, CAST(NULL AS VARCHAR) AS s3_pdf_path, CAST(NULL AS BOOLEAN) AS missing FROM acts")
def schema_align(spark, sf):
    return R.align(table(spark, sf, "acts"), ACT_PATHS)


@query("SELECT change_row_id, upper(replace(trim(eli), ' ', '')) AS eli, snapshot_date FROM act_changes")
def state_scan(spark, sf):
    return table(spark, sf, "act_changes").select("change_row_id", F.upper(F.replace(F.trim("eli"), F.lit(" "), F.lit(""))).alias("eli"), "snapshot_date")


@query("SELECT page_id, eli, len(page.paragraph_lines) AS n_lines FROM act_pages WHERE page.page_number = 1")
def nested_filter(spark, sf):
    p = table(spark, sf, "act_pages").where("page.page_number = 1")
    n = F.size("page.paragraph_lines")
    return p.select("page_id", "eli", F.when(n >= 0, n).cast("long").alias("n_lines"))


@query("SELECT eli, title FROM acts WHERE type = 'Ustawa' AND NOT coalesce(contains(title, 'zmianie'), FALSE) AND NOT coalesce(contains(title, 'budżetow'), FALSE)")
def null_safe_filter(spark, sf):
    without = lambda w: ~F.coalesce(F.contains(F.col("title"), F.lit(w)), F.lit(False))
    return table(spark, sf, "acts").where((F.col("type") == "Ustawa") & without("zmianie") & without("budżetow")).select("eli", "title")


@query("SELECT change_row_id, CAST(try_cast(date_of_change_annotation AS DATE) AS VARCHAR) AS changed FROM act_changes WHERE regexp_matches(date_of_change_annotation, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') AND try_cast(date_of_change_annotation AS DATE) < DATE '2010-01-01'")
def date_cutoff(spark, sf):
    d = F.when(F.col("date_of_change_annotation").rlike(r"^\d{4}-\d{2}-\d{2}$"), any_date(F.col("date_of_change_annotation")))
    return table(spark, sf, "act_changes").select("change_row_id", d.alias("changed")).where(F.col("changed") < "2010-01-01")


_PAGE_LINES = "SELECT DISTINCT page_id, eli, invoke_id, page.page_number AS page_number, '{a}' AS area, unnest(page.{a}_lines) AS l, generate_subscripts(page.{a}_lines, 1) - 1 AS line_no FROM act_pages"


@query("""SELECT p.page_id, p.n_paragraph, f.n_footer FROM
 (SELECT DISTINCT page_id, len(page.paragraph_lines) AS n_paragraph FROM act_pages WHERE len(page.paragraph_lines) > 0) p
 LEFT JOIN (SELECT DISTINCT page_id, len(page.footer_lines) AS n_footer FROM act_pages WHERE len(page.footer_lines) > 0) f USING (page_id)""")
def optional_match(spark, sf):
    p = table(spark, sf, "act_pages")
    side = lambda a: p.where(F.size(f"page.{a}_lines") > 0).select("page_id", F.size(f"page.{a}_lines").cast("long").alias(f"n_{a}")).distinct()
    return side("paragraph").join(side("footer"), "page_id", "left")


@query("SELECT n_nationkey, n_name, CASE n_nationkey WHEN 1 THEN 'first' WHEN 7 THEN 'second' ELSE CAST(n_regionkey AS VARCHAR) END AS place FROM nation")
def const_override(spark, sf):
    const = spark.createDataFrame([(1, "first"), (7, "second")], "n_nationkey int, override string")
    return table(spark, sf, "nation").join(F.broadcast(const), "n_nationkey", "left").select("n_nationkey", "n_name", F.coalesce("override", F.col("n_regionkey").cast("string")).alias("place"))


@query(_VERSIONS + """, n AS (SELECT * FROM s WHERE d = 1), o AS (SELECT s.* FROM s SEMI JOIN act_catalog USING (eli) WHERE a = 1)
SELECT n.eli, o.eli IS NULL AS missing, CASE WHEN o.eli IS NOT NULL THEN n.status IS DISTINCT FROM o.status END AS status_changed, CASE WHEN o.eli IS NOT NULL THEN n.title IS DISTINCT FROM o.title END AS title_changed,
 CASE WHEN o.eli IS NOT NULL THEN n.promulgation IS DISTINCT FROM o.promulgation END AS promulgation_changed, CASE WHEN o.eli IS NOT NULL THEN n.filename_of_pdf IS DISTINCT FROM o.filename_of_pdf END AS filename_of_pdf_changed
FROM n LEFT JOIN o USING (eli) WHERE o.eli IS NULL OR n.status IS DISTINCT FROM o.status OR n.title IS DISTINCT FROM o.title OR n.promulgation IS DISTINCT FROM o.promulgation OR n.filename_of_pdf IS DISTINCT FROM o.filename_of_pdf""")
def change_detect(spark, sf):
    old, new = _act_versions(spark, sf)
    state = old.join(table(spark, sf, "act_catalog").select("eli"), "eli", "left_semi")
    return R.detect_changes(new, state, "eli", ["status", "title", "promulgation", "filename_of_pdf"])


@query("SELECT a.eli, a.title, c.skrot FROM acts a LEFT JOIN act_catalog c USING (eli)")
def left_enrich(spark, sf):
    return table(spark, sf, "acts").select("eli", "title").join(table(spark, sf, "act_catalog").select("eli", "skrot"), "eli", "left")


@query("SELECT coalesce(a.eli, b.eli) AS eli, CASE WHEN a.f AND b.f THEN 'both' WHEN a.f THEN 'left_only' ELSE 'right_only' END AS side FROM (SELECT DISTINCT eli, TRUE AS f FROM act_references) a FULL JOIN (SELECT DISTINCT eli, TRUE AS f FROM documents) b ON a.eli IS NOT DISTINCT FROM b.eli")
def outer_indicator(spark, sf):
    return R.outer_indicator(table(spark, sf, "act_references"), table(spark, sf, "documents"), ["eli"])


_LINKS = "SELECT DISTINCT regexp_replace(upper(replace(trim(eli), ' ', '')), '/0+([0-9])', '/\\1', 'g') AS eli, regexp_replace(upper(replace(trim(eli_annotation), ' ', '')), '/0+([0-9])', '/\\1', 'g') AS eli_annotation FROM act_changes WHERE snapshot_date = (SELECT {f}(snapshot_date) FROM act_changes)"


@query(f"SELECT * FROM ({_LINKS.format(f='max')}) l ANTI JOIN ({_LINKS.format(f='min')}) f USING (eli, eli_annotation)")
def anti_two_key(spark, sf):
    c = table(spark, sf, "act_changes").select(act_key(F.col("eli")).alias("eli"), act_key(F.col("eli_annotation")).alias("eli_annotation"), "snapshot_date")
    edge = c.agg(F.min("snapshot_date").alias("a"), F.max("snapshot_date").alias("b"))
    at = lambda k: c.join(F.broadcast(edge.select(F.col(k).alias("snapshot_date"))), "snapshot_date").select("eli", "eli_annotation").distinct()
    return R.new_keys(at("b"), at("a"), ["eli", "eli_annotation"])


@query("SELECT a.eli, a.title, c.eli IS NOT NULL AS has_references FROM acts a LEFT JOIN (SELECT DISTINCT eli FROM act_references) c USING (eli)")
def flag_left_join(spark, sf):
    return R.mark(table(spark, sf, "acts").select("eli", "title"), table(spark, sf, "act_references"), ["eli"], "has_references")


@query("SELECT DISTINCT nro, title FROM questions q WHERE NOT EXISTS (SELECT 1 FROM llm_references r WHERE r.nro = q.nro)")
def anti_new_questions(spark, sf):
    return R.new_keys(table(spark, sf, "questions").select("nro", "title").distinct(), table(spark, sf, "llm_references"), ["nro"])


@query("SELECT eli FROM acts WHERE eli IS NOT NULL EXCEPT SELECT eli FROM documents")
def set_diff(spark, sf):
    return table(spark, sf, "acts").select("eli").where("eli IS NOT NULL").subtract(table(spark, sf, "documents").select("eli"))


@query("SELECT source, count(*) AS n_rows, count(DISTINCT eli) AS n_acts FROM (SELECT 'references' AS source, eli FROM act_references UNION ALL SELECT 'pages', eli FROM act_pages UNION ALL SELECT 'documents', eli FROM documents) GROUP BY source")
def union_refs(spark, sf):
    parts = [table(spark, sf, t).select(F.lit(n).alias("source"), "eli") for n, t in (("references", "act_references"), ("pages", "act_pages"), ("documents", "documents"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("source").agg(F.count("*").alias("n_rows"), F.count_distinct("eli").alias("n_acts"))


@query(_VERSIONS + "SELECT eli, status, changedate FROM s WHERE d = 1")
def upsert_merge(spark, sf):
    old, new = _act_versions(spark, sf)
    return R.upsert(old, new, ["eli"]).select("eli", "status", "changedate")


@query("SELECT CASE WHEN length(trim(text)) > 0 THEN 'success' ELSE 'failed' END AS status, count(*) AS n_rows FROM documents GROUP BY 1")
def route_status(spark, sf):
    good, bad = R.route(table(spark, sf, "documents"), F.length(F.trim("text")) > 0)
    return good.select(F.lit("success").alias("status")).unionByName(bad.select(F.lit("failed").alias("status"))).groupBy("status").agg(F.count("*").alias("n_rows"))


@query("SELECT record_id, CASE WHEN call_result IS NOT NULL AND json_valid(call_result) THEN 'success' ELSE 'failed' END AS status, CAST(CASE WHEN call_result IS NOT NULL AND json_valid(call_result) THEN 1 ELSE 2 END AS INTEGER) AS attempts FROM act_references")
def retry_route(spark, sf):
    from kodeks.operators.tasks import run_rows

    def work(row: dict, attempt: int) -> str:
        import json

        return type(json.loads(row["call_result"])).__name__

    return run_rows(table(spark, sf, "act_references").select("record_id", "call_result"), "record_id", work, retries=2, delay=0.0).select("record_id", "status", "attempts")


@query(_VERSIONS + """, n AS (SELECT * FROM s WHERE d = 1), o AS (SELECT s.eli FROM s SEMI JOIN act_catalog USING (eli) WHERE a = 1)
SELECT n.eli, o.eli IS NULL AS missing, n.eli IN (SELECT eli FROM act_references WHERE eli IS NOT NULL) AS has_new_refs FROM n LEFT JOIN o USING (eli) WHERE o.eli IS NULL OR n.eli IN (SELECT eli FROM act_references WHERE eli IS NOT NULL)""")
def acts_to_process(spark, sf):
    """Acts that the state lacks or that have references of their own."""
    old, new = _act_versions(spark, sf)
    state = old.join(table(spark, sf, "act_catalog").select("eli"), "eli", "left_semi")
    known = R.mark(new, state, ["eli"], "known")
    marked = R.mark(known, table(spark, sf, "act_references").where("eli IS NOT NULL"), ["eli"], "has_new_refs")
    return marked.select("eli", (~F.col("known")).alias("missing"), "has_new_refs").where("missing OR has_new_refs")


@query("SELECT eli, status, title, title IS NULL AS lacks FROM acts")
def suffix_columns(spark, sf):
    """Columns renamed by their suffix, others dropped by theirs."""
    a = table(spark, sf, "acts").select(F.col("eli").alias("eli_api"), F.col("status").alias("status_api"), F.col("title").alias("title_api"), F.col("title").isNull().alias("lacks"), F.lit(True).alias("x_changed"))
    return R.strip_suffix(R.drop_suffix(a, "_changed"), "_api")


@query("SELECT eli, CASE WHEN textpdf THEN 'pdf' ELSE 'html' END AS kind, filename_of_pdf FROM acts WHERE (textpdf AND filename_of_pdf IS NOT NULL) OR texthtml IS NOT NULL AND NOT (textpdf AND filename_of_pdf IS NOT NULL) AND FALSE")
def tagged_round_trip(spark, sf):
    """Objects with a type tag, written and read again."""
    a = table(spark, sf, "acts").where("textpdf AND filename_of_pdf IS NOT NULL").withColumn("kind", F.lit("pdf"))
    objects = R.tagged(a, "eli", {"pdf": ["kind", "filename_of_pdf"]})
    return R.untagged(objects, "eli", "kind string, filename_of_pdf string").select("eli", "kind", "filename_of_pdf")


@query("SELECT eli, 'SET ' || array_to_string(list_transform(l, lambda x: x[1] || ' = :' || x[1]), ', ') AS expression FROM (SELECT eli, list_filter([['status', status], ['title', title], ['changedate', changedate]], lambda x: x[2] IS NOT NULL) AS l FROM acts) WHERE len(l) > 0")
def update_expression(spark, sf):
    return R.assignments(table(spark, sf, "acts"), "eli", ["status", "title", "changedate"]).select("eli", "expression")


@query("SELECT eli, count(*) AS n_rows FROM acts GROUP BY eli HAVING count(*) > 1")
def unique_violation(spark, sf):
    return R.duplicate_keys(table(spark, sf, "acts"), ["eli"])


@query("""SELECT eli, 'title' AS violation FROM acts WHERE title IS NULL UNION ALL SELECT eli, 'changedate' FROM acts WHERE changedate IS NULL OR NOT regexp_matches(changedate, '^[0-9]{4}-')
 UNION ALL SELECT eli, 'status' FROM acts WHERE status IS NULL OR status <> lower(trim(status)) UNION ALL SELECT eli, 'pos' FROM acts WHERE pos IS NULL OR pos < 1""")
def schema_violations(spark, sf):
    return R.violations(table(spark, sf, "acts"), "eli", {"title": F.col("title").isNotNull(), "changedate": F.col("changedate").rlike("^[0-9]{4}-"), "status": F.col("status") == F.lower(F.trim("status")), "pos": F.col("pos") >= 1})


@query("SELECT page_id, eli FROM act_pages WHERE expires_at > TIMESTAMP '2024-06-01 00:00:00'")
def ttl_filter(spark, sf):
    return table(spark, sf, "act_pages").where(F.col("expires_at") > F.lit("2024-06-01 00:00:00").cast("timestamp")).select("page_id", "eli")


@query("SELECT nro, count(*) AS n_references, arg_min(id, ref_id) FILTER (WHERE id IS NOT NULL) AS first_id FROM llm_references GROUP BY nro")
def act_group(spark, sf):
    return table(spark, sf, "llm_references").groupBy("nro").agg(F.count("*").alias("n_references"), F.min_by("id", F.when(F.col("id").isNotNull(), F.col("ref_id"))).alias("first_id"))


@query("SELECT nro, title FROM (SELECT *, row_number() OVER (PARTITION BY nro ORDER BY create_date NULLS FIRST, title NULLS FIRST) AS r FROM questions) WHERE r = 1")
def dedup_first(spark, sf):
    return R.first_per_key(table(spark, sf, "questions").select("nro", "create_date", "title"), ["nro"], [F.col("create_date").asc_nulls_first()]).select("nro", "title")


@query("SELECT user_id, event_type AS most_common FROM (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, min(ts)) AS r FROM events GROUP BY user_id, event_type) WHERE r = 1")
def mode_value(spark, sf):
    n = table(spark, sf, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"), F.min("ts").alias("first"))
    return n.groupBy("user_id").agg(F.max_by("event_type", F.struct("n", -F.unix_micros(F.col("first").cast("timestamp")))).alias("most_common"))


@query("""SELECT eli, line AS repeated_line, n AS n_pages FROM (SELECT eli, line, n, row_number() OVER (PARTITION BY eli ORDER BY n DESC, line) AS r FROM
 (SELECT eli, line, count(*) AS n FROM (SELECT DISTINCT page_id, eli, page.footer_lines[len(page.footer_lines)].text AS line FROM act_pages) WHERE line IS NOT NULL GROUP BY eli, line HAVING count(*) > 1)) WHERE r = 1""")
def repeated_line(spark, sf):
    last = table(spark, sf, "act_pages").select("page_id", "eli", F.try_element_at("page.footer_lines", F.lit(-1))["text"].alias("line")).distinct().where("line IS NOT NULL")
    n = last.groupBy("eli", "line").agg(F.count("*").alias("n_pages")).where("n_pages > 1")
    return n.groupBy("eli").agg(F.min_by("line", F.struct(-F.col("n_pages"), "line")).alias("repeated_line"), F.max("n_pages").alias("n_pages"))


@query("SELECT nro, string_agg(skrot, ' | ' ORDER BY ref_id, skrot) AS skroty FROM (SELECT DISTINCT nro, ref_id, skrot FROM llm_references) WHERE skrot IS NOT NULL GROUP BY nro")
def collect_ordered(spark, sf):
    r = table(spark, sf, "llm_references").where("skrot IS NOT NULL").select("nro", "ref_id", "skrot").distinct()
    return r.groupBy("nro").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ref_id", "skrot"))), lambda x: x["skrot"]), " | ").alias("skroty"))


@query("SELECT o_custkey, count(*) AS n_orders, sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS total FROM orders GROUP BY o_custkey")
def cost_rollup(spark, sf):
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n_orders"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"))


@query("""SELECT r.ref_id, min(c.eli) AS eli FROM (SELECT DISTINCT ref_id, CASE WHEN ends_with(trim(lower(tytul)), '.') THEN trim(lower(tytul)) ELSE trim(lower(tytul)) || '.' END AS t FROM llm_references) r
 LEFT JOIN (SELECT eli, CASE WHEN ends_with(trim(lower(tytul)), '.') THEN trim(lower(tytul)) ELSE trim(lower(tytul)) || '.' END AS t FROM act_catalog) c USING (t) GROUP BY r.ref_id""")
def title_exact_join(spark, sf):
    return match.exact_titles(table(spark, sf, "llm_references").select("ref_id", "tytul").distinct(), table(spark, sf, "act_catalog"), "ref_id")


_LETTERS = "abcdefghijklmnoprstuwyz"
_COUNTS = "[" + ", ".join(f"CAST(length(x) - length(replace(x, '{c}', '')) AS DOUBLE)" for c in _LETTERS) + "]"


@query(f"""WITH a AS (SELECT DISTINCT tytul, CASE WHEN ends_with(trim(lower(tytul)), '.') THEN trim(lower(tytul)) ELSE trim(lower(tytul)) || '.' END AS x FROM llm_references WHERE tytul IS NOT NULL),
k AS (SELECT eli, CASE WHEN ends_with(trim(lower(tytul)), '.') THEN trim(lower(tytul)) ELSE trim(lower(tytul)) || '.' END AS x FROM act_catalog),
av AS (SELECT tytul, x, {_COUNTS} AS v FROM a), kv AS (SELECT eli, x, {_COUNTS} AS v FROM k),
e AS (SELECT av.tytul, av.v, min(kv.eli) AS eli FROM av LEFT JOIN kv USING (x) GROUP BY av.tytul, av.v),
n AS (SELECT tytul, s, eli, row_number() OVER (PARTITION BY tytul ORDER BY s DESC, eli) AS r FROM (SELECT e.tytul, kv.eli, round(list_cosine_similarity(e.v, kv.v), 6) AS s FROM e, kv WHERE e.eli IS NULL AND list_sum(e.v) > 0))
SELECT e.tytul, coalesce(e.eli, n.eli) AS eli, CASE WHEN e.eli IS NOT NULL THEN 'title' WHEN n.eli IS NOT NULL THEN 'nearest' ELSE 'unresolved' END AS how FROM e LEFT JOIN n ON n.tytul = e.tytul AND n.r = 1 AND n.s >= 0.87""")
def title_cascade(spark, sf):
    """Exact title, else the nearest by a vector of letter counts, which stands for the embedding, else unresolved."""
    t = title_key(F.col("tytul"))
    vector = F.array(*[(F.length(t) - F.length(F.replace(t, F.lit(c), F.lit("")))).cast("double") for c in _LETTERS]).alias("v_")
    asked = table(spark, sf, "llm_references").where("tytul IS NOT NULL").select("tytul").distinct().select("tytul", vector)
    known = table(spark, sf, "act_catalog").select("eli", "tytul", vector)
    return match.title_cascade(asked, known, "tytul", "tytul", "v_")


@query("""SELECT q AS vec_id, arg_max(v, (s, -v)) AS neighbour, max(s) AS score FROM (SELECT a.vec_id AS q, b.vec_id AS v, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS s
 FROM embeddings a, embeddings b WHERE a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id) GROUP BY q""")
def cosine_top1(spark, sf):
    e = table(spark, sf, "embeddings")
    return match.nearest(e, e.where("vec_id % 20 = 0"), "vec_id", "embedding")


@query("SELECT DISTINCT eli, squeezed FROM (SELECT eli, trim(regexp_replace(status, '\\s+', ' ', 'g')) AS squeezed FROM acts)")
def distinct_rows(spark, sf):
    return table(spark, sf, "acts").select("eli", squeeze(F.col("status")).alias("squeezed")).distinct()


QUERIES, SQL = query.queries, query.sql
