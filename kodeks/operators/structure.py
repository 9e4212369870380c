"""Structure of acts: titles, parts, chapters, articles, sections and points read from ordered lines.

Every head stands at the start of a line, so a line needs nothing but the last head of every level before it. These are
carried along in blocks of pages, and an act of any length spreads over many tasks; only the lines of one unit meet.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kodeks.functions.text import fold, in_force
from kodeks.session import cut

LEVELS = ["title", "part", "chapter", "article", "section", "point"]
# Heads of the levels at the start of a line; the group is the identifier.
HEADS = {
    "title": r"^T\s*Y\s*T\s*U\s*Ł\s+([IVXLCDM]+)",
    "part": r"^DZIAŁ\s+([IVXLCDM]+|[A-ZĄĆĘŁŃÓŚŹŻ]+)",
    "chapter": r"^R\s*o\s*z\s*d\s*z\s*i\s*a\s*[łl]\s+([0-9a-zA-Z]+)",
    "article": r"^[\[<]?\s*Art\.?\s*([0-9]+[a-zA-ZĄĆĘŁŃÓŚŹŻąćęłńóśźż]*)\.",
    "section": r"^[\[<]?\s*([0-9]{1,2}[a-zA-ZĄĆĘŁŃÓŚŹŻąćęłńóśźż]{0,4})\.\s*[A-ZĄĆĘŁŃÓŚŹŻ(\[<]",
    "point": r"^[\[<]?\s*([0-9]+[a-zA-ZĄĆĘŁŃÓŚŹŻąćęłńóśźż]*)\)\s*",
}
# What a line must not end with if the next one is to begin a section or a point.
GUARDS = {"section": r"(?:[-–]|\s(?:art\.|ust\.|poz\.|str\.|pkt|lub|albo|i))\s*$", "point": r"(?:[-–]|\s(?:s\.|i)|(?:str\.|pkt|ust\.|art\.|poz\.))\s*$"}
# Names of titles and chapters that hold no lasting rules.
PASSING = ["przepisy zmieniajace", "zmiany w przepisach", "przejsciowe", "koncowe", "dostosowujace"]
# Fixed value: wording of an article that amends others.
AMENDS = "wprowadza się następujące zmiany"


def carry(df: DataFrame, by: list[str], block: str, order: str, columns: list[str], before: list[str] | None = None) -> DataFrame:
    """``df`` with each of ``columns`` replaced by its greatest value up to the row, and those of ``before`` up to the row
    before. What lies before a block comes from one row per block, so no window holds more than a block."""
    strict = before or []
    up = Window.partitionBy(*by, block).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*by, block).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    rest = [c for c in df.columns if c not in columns and c not in strict]
    inner = df.select(*rest, *[F.max(c).over(up).alias(c) for c in columns], *[F.max(c).over(earlier).alias(c) for c in strict])
    sums = df.groupBy(*by, block).agg(*[F.max(c).alias(f"{c}_b") for c in [*columns, *strict]])
    past = Window.partitionBy(*by).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*[F.col(c).alias(f"{c}_k") for c in [*by, block]], *[F.max(f"{c}_b").over(past).alias(f"{c}_b") for c in [*columns, *strict]])
    on = reduce(lambda a, b: a & b, [inner[c].eqNullSafe(sums[f"{c}_k"]) for c in [*by, block]])
    return inner.join(sums, on).select(*rest, *[F.coalesce(c, f"{c}_b").alias(c) for c in [*columns, *strict]])


def act_lines(pages: DataFrame) -> DataFrame:
    """(eli, invoke_id, place, block_, line): the paragraph lines of acts. A head that follows a sentence or another head
    on its line begins one of its own; a page that stands twice is taken once."""
    once = pages.where("page_id IS NOT NULL").select("page_id", "eli", "invoke_id", F.col("page.page_number").alias("page_number"), F.transform("page.paragraph_lines", lambda x: x["text"]).alias("texts")).distinct()
    rows = once.select("page_id", "eli", "invoke_id", "page_number", F.posexplode("texts").alias("line_no", "text")).where("length(trim(text)) > 0")
    text = F.regexp_replace(F.trim("text"), r"([.!?;,]) (Art\. [0-9]+[a-z]*\. )", "$1\n$2")
    text = F.regexp_replace(text, r"(^|\n)(Art\. [0-9]+[a-z]*\.) ([0-9]+[a-z]*[.)] )", "$1$2\n$3")
    text = F.regexp_replace(text, r"(^|\n)([0-9]+[a-z]*\.) ([0-9]+[a-z]*\) )", "$1$2\n$3")
    rows = rows.select("page_id", "eli", "invoke_id", "page_number", "line_no", F.posexplode(F.split(text, "\n")).alias("part_no", "line"))
    return rows.select("eli", "invoke_id", F.struct("page_number", "page_id", "line_no", "part_no").alias("place"), "line")


def _structured(lines: DataFrame, block: int) -> DataFrame:
    """Lines with the head (place, id) of every level that they lie under, null where there is none."""
    by = ["eli", "invoke_id"]
    hit = {k: F.col("line").rlike(p) for k, p in HEADS.items()}
    guard = {k: ~F.coalesce(F.col("last_")["line"].rlike(g), F.lit(False)) for k, g in GUARDS.items()}
    df = lines.withColumns({"block_": F.floor(F.col("place.page_number") / block), "last_": F.struct("place", "line")})
    df = carry(df, by, "block_", "place", [], ["last_"])
    head = {k: F.when(hit[k] & guard.get(k, F.lit(True)), F.struct("place", F.regexp_extract("line", p, 1).alias("id"))) for k, p in HEADS.items()}
    df = carry(df.select(*by, "block_", "place", "line", *[h.alias(k) for k, h in head.items()]), by, "block_", "place", LEVELS)
    # a head counts only under the last heads of the levels above it: it stands behind all of these
    behind = lambda i: reduce(lambda a, b: a & b, [F.col(x).isNull() | (F.col(LEVELS[i])["place"] > F.col(x)["place"]) for x in LEVELS[:i]], F.lit(True))
    return df.select(*by, "place", "line", *[F.when(behind(i), F.col(k)).alias(k) for i, k in enumerate(LEVELS)])


def act_units(pages: DataFrame, block: int = 256) -> tuple[DataFrame, DataFrame]:
    """(units, errors) of acts.

    units: eli, invoke_id, title, part, chapter, article, section, point, level, unit_id, place, body, current; one row
    per article, section and point in force. The body runs from behind the identifier to the first child; ``current``
    is its wording now in force. A level that an act lacks has no id. Titles and chapters of passing rules, articles that
    amend others and repealed units are left out with all below them. errors: eli, invoke_id, level, unit_id, error:
    ``both_levels`` for an article with sections and points of its own, ``not_ascending`` for a unit whose number is below
    that of the one before it under the same parent. Null eli and invoke_id make an act of their own.
    """
    by = ["eli", "invoke_id"]
    rows = cut(_structured(cut(act_lines(pages)), block))
    at = {k: F.col(k)["place"] for k in LEVELS}
    names = rows.where(at["article"].isNull())
    gone = []
    for k in ("title", "chapter"):
        own = names.where(at[k].isNotNull()).groupBy(*by, at[k].alias("head")).agg(F.array_sort(F.collect_list(F.struct("place", "line"))).alias("ls"))
        name = fold(F.array_join(F.transform("ls", lambda x: x["line"]), " "))
        gone.append((k, own.where(reduce(lambda a, b: a | b, [F.contains(name, F.lit(p)) for p in PASSING])).select(*[F.col(c).alias(f"{c}_g") for c in by], "head")))
    body = rows.where(at["article"].isNotNull())
    for k, heads in gone:
        on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"{c}_g")) for c in by]) & (at[k] == F.col("head"))
        body = body.join(heads, on, "left_anti")
    whole = body.groupBy(*by, at["article"].alias("head")).agg(F.array_sort(F.collect_list(F.struct("place", "line"))).alias("ls"))
    amending = whole.where(F.contains(F.array_join(F.transform("ls", lambda x: x["line"]), " "), F.lit(AMENDS))).select(*[F.col(c).alias(f"{c}_g") for c in by], "head")
    body = body.join(amending, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"{c}_g")) for c in by]) & (at["article"] == F.col("head")), "left_anti")
    keys = ["article", "section", "point"]
    units = body.groupBy(*by, *LEVELS).agg(F.array_sort(F.collect_list(F.struct("place", "line"))).alias("ls"))
    level = F.when(at["point"].isNotNull(), "point").when(at["section"].isNotNull(), "section").otherwise("article")
    unit = F.coalesce("point", "section", "article")
    text = F.array_join(F.transform("ls", lambda x: x["line"]), "\n")
    # what stands before a section's or point's own head lies under the unit above, so every text begins with its head
    rest = F.trim(F.regexp_replace(text, r"^[\[<]?\s*(?:Art\.?\s*)?[0-9]+\p{L}*[.)]\s*", ""))
    units = units.select(*by, *[F.col(k)["id"].alias(k) for k in LEVELS], level.alias("level"), unit["id"].alias("unit_id"), unit["place"].alias("place"), at["article"].alias("article_at"), at["section"].alias("section_at"), F.nullif(rest, F.lit("")).alias("body"))
    units = units.withColumn("current", F.trim(F.regexp_replace(F.regexp_replace("body", r"<[^<>\[\]]*>", ""), r"[\[\]]", "")))
    repealed = units.where(~in_force(F.col("body")) & (F.col("level") != "point"))
    drop = repealed.select(*[F.col(c).alias(f"{c}_g") for c in by], F.col("place").alias("head"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"{c}_g")) for c in by])
    units = units.where(in_force(F.col("body"))).join(drop, same & ((F.col("head") == F.col("article_at")) | (F.col("head") == F.col("section_at"))), "left_anti")
    both = units.where("level <> 'article'").groupBy(*by, "article_at").agg(F.max("article").alias("unit_id"), F.bool_or(F.col("level") == "section").alias("s"), F.bool_or((F.col("level") == "point") & F.col("section_at").isNull()).alias("p")).where("s AND p")
    errors = both.select(*by, F.lit("article").alias("level"), "unit_id", F.lit("both_levels").alias("error"))
    lead = F.regexp_extract("unit_id", r"^([0-9]+)", 1).try_cast("int")
    for k, parent in (("article", []), ("section", ["article_at"]), ("point", ["article_at", "section_at"])):
        own = units.where(F.col("level") == k).select(*by, *parent, "place", "unit_id", lead.alias("n_"), F.floor(F.col("place.page_number") / block).alias("block_"))
        own = carry(own.withColumn("last_", F.struct("place", "n_")), [*by, *parent], "block_", "place", [], ["last_"])
        errors = errors.unionByName(own.where("n_ < last_.n_").select(*by, F.lit(k).alias("level"), "unit_id", F.lit("not_ascending").alias("error")))
    return units.select(*by, *LEVELS, "level", "unit_id", "place", "body", "current"), errors


def segments(df: DataFrame, keys: list[str], text: str, level: str | None = None) -> DataFrame:
    """Stretches of a text by the state of its wording: [..] holds until a change, <..> after it, the rest in any case.
    keys, seg_no, start, end (inclusive, with the brackets), status, segment (without them). The stretches cover the text
    exactly. With a level only brackets around a whole unit of it count. Null and empty texts have none."""
    pieces = F.regexp_extract_all(text, F.lit(r"(\[[^\[\]<>]*\]|<[^\[\]<>]*>|[^\[<]+|[\[<])"), F.lit(1))
    rows = df.where(F.length(text) > 0).select(*keys, pieces.alias("all_")).select(*keys, "all_", F.posexplode("all_").alias("seg_no", "raw_"))
    start = F.aggregate(F.slice("all_", F.lit(1), F.col("seg_no")), F.lit(0), lambda a, x: a + F.length(x))
    closed = (F.length("raw_") > 1) & (F.lit(True) if level is None else F.col("raw_").rlike(r"^[\[<]\s*" + HEADS[level].removeprefix(r"^[\[<]?\s*")))
    status = F.when(closed & F.endswith("raw_", F.lit("]")) & F.startswith("raw_", F.lit("[")), "BEFORE_UPCOMING_CHANGE").when(closed & F.endswith("raw_", F.lit(">")) & F.startswith("raw_", F.lit("<")), "UPCOMING_CHANGE").otherwise("NOT_MATCH_CHANGE")
    got = rows.select(*keys, "seg_no", start.alias("start"), (start + F.length("raw_") - 1).alias("end"), status.alias("status"), "raw_")
    return got.select(*keys, "seg_no", "start", "end", "status", F.when(F.col("status") == "NOT_MATCH_CHANGE", F.col("raw_")).otherwise(F.substring("raw_", F.lit(2), F.length("raw_") - 2)).alias("segment"))


def painted(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """keys, char_no, letter, status: every character of a text with the state of its wording, brackets aside."""
    s = segments(df, keys, text)
    inner = F.col("start") + (F.col("status") != "NOT_MATCH_CHANGE").cast("int")
    return s.where("length(segment) > 0").select(*keys, "status", inner.alias("from_"), F.posexplode(F.filter(F.split("segment", ""), lambda c: c != "")).alias("k_", "letter")).select(*keys, (F.col("from_") + F.col("k_")).alias("char_no"), "letter", "status")


def cover_errors(pieces: DataFrame, by: list[str], start: Column, end: Column, first: Column, last: Column) -> DataFrame:
    """by, error: parents that their pieces (inclusive bounds) don't cover exactly: ``overlap`` where a piece begins before
    the one before it has ended, else ``gap`` where it begins later, else ``bounds`` where they begin or end elsewhere."""
    rows = pieces.select(*by, start.alias("s_"), end.alias("e_"), first.alias("f_"), last.alias("l_"))
    w = Window.partitionBy(*by).orderBy("s_", "e_")
    far = F.max("e_").over(w.rowsBetween(Window.unboundedPreceding, -1))
    got = rows.withColumn("far_", far).groupBy(*by).agg(F.bool_or(F.col("s_") <= F.col("far_")).alias("o"), F.bool_or(F.col("s_") > F.col("far_") + 1).alias("g"), ((F.min("s_") != F.min("f_")) | (F.max("e_") != F.max("l_"))).alias("b"))
    error = F.when(F.col("o"), "overlap").when(F.col("g"), "gap").when(F.col("b"), "bounds")
    return got.select(*by, error.alias("error")).where("error IS NOT NULL")
