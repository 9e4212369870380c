"""Queries of ordered rows, intervals and windows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from kodeks.functions.text import ascending, nonblank_lines
from kodeks.operators import intervals as I
from kodeks.operators import structure
from kodeks.plans.registry import Registry
from kodeks.session import table

query = Registry()

_LINES = "(SELECT DISTINCT page_id, eli, invoke_id, page_number, line_no, l.line_type AS line_type, l.start_x AS start_x, l.start_y AS start_y, l.end_y AS end_y, l.text AS text FROM (SELECT page_id, eli, invoke_id, page.page_number AS page_number, unnest(page.{a}_lines) AS l, generate_subscripts(page.{a}_lines, 1) - 1 AS line_no FROM act_pages) WHERE l IS NOT NULL)"
_P, _M = _LINES.format(a="paragraph"), _LINES.format(a="margin")


def _lines(spark, sf, area="paragraph"):
    p = table(spark, sf, "act_pages")
    x = p.select("page_id", "eli", "invoke_id", F.col("page.page_number").alias("page_number"), F.posexplode(f"page.{area}_lines").alias("line_no", "l")).where("l IS NOT NULL")
    return x.select("page_id", "eli", "invoke_id", "page_number", F.col("line_no").cast("long").alias("line_no"), *[F.col(f"l.{c}").alias(c) for c in ("line_type", "start_x", "start_y", "end_y", "text")]).distinct()


_DOC_LINES = "(SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents WHERE text IS NOT NULL)"


def _doc_lines(spark, sf):
    return table(spark, sf, "documents").where("text IS NOT NULL").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line")).withColumn("line_no", F.col("line_no").cast("long"))


@query(f"SELECT doc_id, line_no, CAST(coalesce(sum(length(line) + 2) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_at FROM {_DOC_LINES}")
def line_offsets(spark, sf):
    return I.running_offsets(_doc_lines(spark, sf), ["doc_id"], ["line_no"], F.length("line") + 2).select("doc_id", "line_no", "start_at")


@query(f"SELECT page_id, line_no, CAST(count(*) FILTER (WHERE line_type = 'table') OVER (PARTITION BY page_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS BIGINT) AS table_no FROM {_P}")
def running_flag_count(spark, sf):
    w = Window.partitionBy("page_id").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    return _lines(spark, sf).select("page_id", "line_no", F.sum(F.when(F.col("line_type") == "table", 1).otherwise(0)).over(w).alias("table_no"))


@query(f"""SELECT page_id, CAST(g AS INTEGER) AS island_id, min(start_y) AS top, max(end_y) AS bottom, count(*) AS n_lines FROM (SELECT *, sum(b) OVER (PARTITION BY page_id ORDER BY start_y, end_y, line_no ROWS UNBOUNDED PRECEDING) AS g FROM
 (SELECT *, CASE WHEN start_y + 0.4 <= max(end_y) OVER (PARTITION BY page_id ORDER BY start_y, end_y, line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS b FROM {_P} WHERE start_y IS NOT NULL)) GROUP BY page_id, g""")
def island_merge(spark, sf):
    x = I.islands(_lines(spark, sf).where("start_y IS NOT NULL"), ["page_id"], "start_y", "end_y", ["line_no"], 0.4)
    return x.groupBy("page_id", "island_id").agg(F.min("start_y").alias("top"), F.max("end_y").alias("bottom"), F.count("*").alias("n_lines"))


_PAGES = "(SELECT DISTINCT page_id, eli, invoke_id, page.page_number AS page_number FROM act_pages)"


@query(f"""SELECT page_id, CAST(sum(b) OVER (PARTITION BY eli, invoke_id ORDER BY page_number, page_id ROWS UNBOUNDED PRECEDING) AS INTEGER) AS session_no FROM
 (SELECT *, CASE WHEN page_number <= lag(page_number) OVER w + 1 THEN 0 ELSE 1 END AS b FROM {_PAGES} WINDOW w AS (PARTITION BY eli, invoke_id ORDER BY page_number, page_id))""")
def sessionize_pages(spark, sf):
    p = table(spark, sf, "act_pages").select("page_id", "eli", "invoke_id", F.col("page.page_number").alias("page_number")).distinct()
    p = p.withColumn("o_", F.struct("page_number", "page_id"))
    before = F.lag("page_number").over(Window.partitionBy("eli", "invoke_id").orderBy("o_"))
    return I.sessions(p.withColumn("before_", before), ["eli", "invoke_id"], "o_", ~F.coalesce(F.col("page_number") <= F.col("before_") + 1, F.lit(False))).select("page_id", "session_no")


@query("SELECT event_id, count(*) OVER (PARTITION BY event_type ORDER BY epoch_us(ts) RANGE BETWEEN 179999999 PRECEDING AND CURRENT ROW) AS n_window FROM events")
def sliding_180s(spark, sf):
    e = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return I.sliding_count(e, ["event_type"], "ts", 180).select("event_id", "n_window")


@query(f"SELECT page_id, page_number, coalesce(lead(page_number) OVER (PARTITION BY eli, invoke_id ORDER BY page_number, page_id) - 1, page_number) AS last_page FROM {_PAGES}")
def lead_ranges(spark, sf):
    p = table(spark, sf, "act_pages").select("page_id", "eli", "invoke_id", F.col("page.page_number").alias("page_number")).distinct()
    return p.select("page_id", "page_number", F.coalesce(F.lead("page_number").over(Window.partitionBy("eli", "invoke_id").orderBy("page_number", "page_id")) - 1, F.col("page_number")).alias("last_page"))


@query(f"SELECT page_id FROM (SELECT page_id, max(CASE WHEN t > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY eli, invoke_id ORDER BY page_number, page_id ROWS UNBOUNDED PRECEDING) AS f FROM (SELECT page_id, eli, invoke_id, page_number, count(*) FILTER (WHERE line_type = 'table') AS t FROM {_P} GROUP BY ALL)) WHERE f = 1")
def from_first_match(spark, sf):
    t = _lines(spark, sf).groupBy("page_id", "eli", "invoke_id", "page_number").agg(F.count_if(F.col("line_type") == "table").alias("t"))
    w = Window.partitionBy("eli", "invoke_id").orderBy("page_number", "page_id").rowsBetween(Window.unboundedPreceding, 0)
    return t.withColumn("f", F.max(F.when(F.col("t") > 0, 1).otherwise(0)).over(w)).where("f = 1").select("page_id")


@query("SELECT event_id, user_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 5")
def topk_recent(spark, sf):
    return table(spark, sf, "events").orderBy(F.desc("ts"), F.desc("event_id")).limit(5).select("event_id", "user_id")


@query("SELECT user_id, arg_max(event_id, (ts, event_id)) AS last_event FROM events GROUP BY user_id")
def latest_by(spark, sf):
    return table(spark, sf, "events").groupBy("user_id").agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("last_event"))


@query(f"""SELECT page_id, gap_start, start_y AS gap_end FROM (SELECT *, max(end_y) OVER (PARTITION BY page_id ORDER BY start_y, end_y, line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS gap_start FROM {_P} WHERE start_y IS NOT NULL) WHERE gap_start < start_y""")
def gap_fill(spark, sf):
    return I.gaps(_lines(spark, sf).where("start_y IS NOT NULL"), ["page_id"], "start_y", "end_y", ["line_no"])


_PIECES = "(SELECT DISTINCT page_id, l.index_in_act AS s, l.index_in_act + length(l.text) + 1 AS e FROM (SELECT page_id, unnest(page.paragraph_lines) AS l FROM act_pages) WHERE l.text IS NOT NULL)"


@query(f"""SELECT page_id, CASE WHEN o THEN 'overlap' WHEN g THEN 'gap' WHEN b THEN 'bounds' ELSE 'ok' END AS error FROM (SELECT page_id, bool_or(coalesce(s <= far, FALSE)) AS o, bool_or(coalesce(s > far + 1, FALSE)) AS g, min(s) <> min(s0) OR max(e) <> max(e0) AS b FROM
 (SELECT *, max(e) OVER (PARTITION BY page_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far, min(s) OVER (PARTITION BY page_id) AS s0, s + (e - s) // 2 * 0 + max(e) OVER (PARTITION BY page_id) - s AS e0 FROM {_PIECES}) GROUP BY page_id)""")
def cover_check(spark, sf):
    """Pages whose lines, with their two closing characters, don't cover the page's stretch of the act one after another."""
    p = table(spark, sf, "act_pages").select("page_id", F.explode("page.paragraph_lines").alias("l")).where("l.text IS NOT NULL")
    pieces = p.select("page_id", F.col("l.index_in_act").alias("s"), (F.col("l.index_in_act") + F.length("l.text") + 1).alias("e")).distinct()
    page = Window.partitionBy("page_id")
    pieces = pieces.withColumns({"f": F.min("s").over(page), "z": F.max("e").over(page)})
    errors = structure.cover_errors(pieces, ["page_id"], F.col("s"), F.col("e"), F.col("f"), F.col("z"))
    return pieces.select("page_id").distinct().join(errors, "page_id", "left").select("page_id", F.coalesce("error", F.lit("ok")).alias("error"))


@query("SELECT DISTINCT ref_id, list_transform(przepisy, lambda x: CAST(regexp_extract(x.artykul, '^([0-9]+)', 1) AS BIGINT)) = list_sort(list_transform(przepisy, lambda x: CAST(regexp_extract(x.artykul, '^([0-9]+)', 1) AS BIGINT))) AS ascends FROM llm_references WHERE przepisy IS NOT NULL AND len(list_filter(przepisy, lambda x: x.artykul IS NULL)) = 0")
def is_ascending(spark, sf):
    r = table(spark, sf, "llm_references").where("przepisy IS NOT NULL AND NOT exists(przepisy, x -> x.artykul IS NULL)")
    return r.select("ref_id", ascending(F.transform("przepisy", lambda x: x["artykul"])).alias("ascends")).distinct()


def _boxes(spark, sf):
    side = lambda a: _lines(spark, sf, a).where("start_y IS NOT NULL AND end_y IS NOT NULL").select("page_id", "line_no", F.col("start_y").alias("lo"), F.col("end_y").alias("hi"))
    return side("paragraph"), side("margin")


@query(f"SELECT a.page_id, a.line_no AS line_no, b.line_no AS line_no_b FROM {_P} a JOIN {_M} b ON a.page_id = b.page_id AND a.end_y > b.start_y AND b.end_y > a.start_y")
def interval_overlap(spark, sf):
    a, b = _boxes(spark, sf)
    return I.overlap(a, b, ["page_id"], 25.0).select("page_id", "line_no", "line_no_b")


@query(f"SELECT a.page_id, a.line_no AS line_no, b.line_no AS line_no_b FROM {_P} a JOIN {_M} b ON a.page_id = b.page_id AND a.end_y > b.start_y AND b.end_y > a.start_y AND b.start_y >= a.start_y - 5 AND b.end_y <= a.end_y + 5")
def interval_contains(spark, sf):
    a, b = _boxes(spark, sf)
    return I.overlap(a, b, ["page_id"], 25.0).where("lo_b >= lo - 5 AND hi_b <= hi + 5").select("page_id", "line_no", "line_no_b")


@query(f"SELECT page_id, count(*) FILTER (WHERE abs(start_x - m) <= 5) AS aligned, count(*) AS n_lines FROM (SELECT *, min(start_x) OVER (PARTITION BY page_id) AS m FROM {_P}) GROUP BY page_id")
def tolerance_match(spark, sf):
    x = _lines(spark, sf).withColumn("m", F.min("start_x").over(Window.partitionBy("page_id")))
    return x.groupBy("page_id").agg(F.count_if(F.abs(F.col("start_x") - F.col("m")) <= 5).alias("aligned"), F.count("*").alias("n_lines"))


@query("""SELECT DISTINCT page_id, CASE WHEN coalesce(len(page.paragraph_lines), 0) = 0 THEN 'no_text' WHEN coalesce(len(page.footer_lines), 0) > 0 AND coalesce(len(page.margin_lines), 0) > 0 THEN 'footer_and_margin'
 WHEN coalesce(len(page.footer_lines), 0) > 0 THEN 'footer' WHEN coalesce(len(page.margin_lines), 0) > 0 THEN 'margin' ELSE 'plain' END AS layout FROM act_pages""")
def classify_case(spark, sf):
    n = lambda a: F.size(F.coalesce(f"page.{a}_lines", F.expr(f"filter(page.{a}_lines, x -> false)"))) > 0
    layout = F.when(~n("paragraph"), "no_text").when(n("footer") & n("margin"), "footer_and_margin").when(n("footer"), "footer").when(n("margin"), "margin").otherwise("plain")
    return table(spark, sf, "act_pages").select("page_id", layout.alias("layout")).distinct()


@query("SELECT CAST(m AS DATE) AS month_start, last_day(CAST(m AS DATE)) AS month_end FROM (SELECT unnest(generate_series(date_trunc('month', min(CAST(snapshot_date AS DATE))), date_trunc('month', max(CAST(snapshot_date AS DATE))), INTERVAL 1 MONTH)) AS m FROM act_changes)")
def month_ranges(spark, sf):
    e = table(spark, sf, "act_changes").agg(F.trunc(F.to_date(F.min("snapshot_date")), "month").alias("a"), F.trunc(F.to_date(F.max("snapshot_date")), "month").alias("b"))
    return e.select(F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("month_start")).select("month_start", F.last_day("month_start").alias("month_end"))


@query(f"SELECT page_id, line_no, k - 1 AS char_no, start_x + (k - 1) * 5.5 AS x FROM (SELECT page_id, line_no, start_x, unnest(generate_series(1, length(text))) AS k FROM {_P} WHERE length(text) > 0 AND line_no = 0)")
def char_interp(spark, sf):
    x = _lines(spark, sf).where("length(text) > 0 AND line_no = 0")
    return x.select("page_id", "line_no", "start_x", F.explode(F.sequence(F.lit(0), F.length("text") - 1)).alias("k")).select("page_id", "line_no", F.col("k").cast("long").alias("char_no"), (F.col("start_x") + F.col("k") * F.lit(5.5)).alias("x"))


@query(f"SELECT page_id, line_no, k - 1 AS char_no, start_x + (k - 1) * w AS x FROM (SELECT page_id, line_no, start_x, (end_x - start_x) / length(text) AS w, unnest(generate_series(1, length(text))) AS k FROM (SELECT DISTINCT page_id, line_no, l.start_x AS start_x, l.end_x AS end_x, l.text AS text FROM (SELECT page_id, unnest(page.paragraph_lines) AS l, generate_subscripts(page.paragraph_lines, 1) - 1 AS line_no FROM act_pages) WHERE length(l.text) > 0))")
def char_interp_lines(spark, sf):
    """Characters of every paragraph line, spread evenly from its start to its end. char_interp has the first line of
    each page only, at a fixed width, as its SQL does."""
    x = table(spark, sf, "act_pages").select("page_id", F.posexplode("page.paragraph_lines").alias("line_no", "l")).select("page_id", F.col("line_no").cast("long").alias("line_no"), "l.start_x", "l.end_x", "l.text").where("length(text) > 0").distinct()
    x = x.select("page_id", "line_no", "start_x", ((F.col("end_x") - F.col("start_x")) / F.length("text")).alias("w"), F.explode(F.sequence(F.lit(0), F.length("text") - 1)).alias("k"))
    return x.select("page_id", "line_no", F.col("k").cast("long").alias("char_no"), (F.col("start_x") + F.col("k") * F.col("w")).alias("x"))


@query(f"SELECT page_id, string_agg(text, chr(10) ORDER BY line_no) AS page_text FROM {_P} WHERE text IS NOT NULL GROUP BY page_id")
def page_concat(spark, sf):
    p = table(spark, sf, "act_pages").select("page_id", F.filter(F.transform("page.paragraph_lines", lambda x: x["text"]), lambda t: t.isNotNull()).alias("t")).where("size(t) > 0")
    return p.select("page_id", F.array_join("t", "\n").alias("page_text")).distinct()


@query("SELECT doc_id, len(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '')) AS n_lines FROM documents WHERE text IS NOT NULL")
def nonblank_line_count(spark, sf):
    return table(spark, sf, "documents").where("text IS NOT NULL").select("doc_id", F.size(nonblank_lines(F.col("text"))).cast("long").alias("n_lines"))


QUERIES, SQL = query.queries, query.sql
