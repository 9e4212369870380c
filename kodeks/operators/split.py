"""Splitters of statute text: units by their heading pattern, status of pending wording."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Where a unit of each level begins, and its identifier.
HEADS = {
    "title": (r"(?m)(?=^T\s*Y\s*T\s*U\s*Ł\s+[IVXLCDM]+)", r"^T\s*Y\s*T\s*U\s*Ł\s+([IVXLCDM]+)"),
    "part": (r"(?=DZIAŁ\s+(?:[IVXLCDM]+|[A-ZĄĆĘŁŃÓŚŹŻ]+))", r"^DZIAŁ\s+([IVXLCDM]+|[A-ZĄĆĘŁŃÓŚŹŻ]+)"),
    "chapter": (r"(?<!„)(?=R\s*o\s*z\s*d\s*z\s*i\s*a\s*[łl]\s+[0-9a-zA-Z]+)", r"^R\s*o\s*z\s*d\s*z\s*i\s*a\s*[łl]\s+([0-9a-zA-Z]+)"),
    "article": (r"(?=\bArt\.\s\d+[a-z]*\.\s)", r"^Art\.\s(\d+[a-z]*)\.\s"),
    "section": (r"(?m)(?<![-–]\s?)(?<!\s(?:art|ust|poz|str)\.\s)(?<!\s(?:pkt|lub|albo|i)\s)(?:^|(?<=Art\.\s\d{1,4}[a-z]{0,3}\.\s))(?=\d+[a-z]*\.\s[\p{Lu}\[<])", r"^(\d+[a-z]*)\.\s"),
    "point": (r"(?m)(?=^\d+[a-z]*\)\s)", r"^(\d+[a-z]*)\)\s"),
    "letter": (r"(?m)(?=^[a-z]{1,2}\)\s)", r"^([a-z]{1,2})\)\s"),
}


def body_cut(text: Column, head: str = r"U\s*S\s*T\s*A\s*W\s*A|KONSTYTUCJA") -> Column:
    """The text from the first heading on; null where there is none."""
    return F.nullif(F.regexp_extract(text, rf"(?s)((?:{head}).*)", 1), F.lit(""))


def split_units(df: DataFrame, keys: list[str], text: str, level: str) -> DataFrame:
    """One row per piece of ``text`` cut before every heading of a level: keys, unit_no, unit_id, start_at, unit_text.
    Pieces follow one another without gap; what stands before the first heading has no unit_id, and a text without
    headings is one hidden unit. Null and empty texts have no pieces."""
    head, ident = HEADS[level]
    pieces = F.filter(F.split(text, head), lambda x: x != "")
    parts = df.where(F.length(text) > 0).select(*keys, F.posexplode(pieces).alias("unit_no", "unit_text"), pieces.alias("all_"))
    start = F.aggregate(F.slice("all_", F.lit(1), F.col("unit_no")), F.lit(0), lambda a, x: a + F.length(x))
    return parts.select(*keys, "unit_no", F.nullif(F.regexp_extract("unit_text", ident, 1), F.lit("")).alias("unit_id"), start.alias("start_at"), "unit_text")


def unit_bodies(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """One row per article, section and point: keys, article_no, section_no, point_no, article, section, point, level,
    unit_id, body. The body runs from behind the identifier up to the first child, null where a child follows at once.
    What stands before the first article or section is no unit, but its sections and points are."""
    def rest(level: str):
        found = F.col("unit_id").isNotNull()
        return F.when(found, F.regexp_replace("unit_text", HEADS[level][1] + r"\s*", "")).otherwise(F.col("unit_text"))

    def body(*children: str):
        heads = "|".join(HEADS[c][0] for c in children)
        starts = "|".join(f"(?:{HEADS[c][1]})" for c in children)
        first = F.get(F.split("rest_", heads, 2), 0)
        return F.when(~F.coalesce(first.rlike(starts), F.lit(False)) & (first != ""), first)

    none, number = F.lit(None).cast("string"), F.lit(None).cast("int")
    out = ["article_no", "section_no", "point_no", "article", "section", "point", "level", "unit_id", "body"]
    arts = split_units(df, keys, text, "article").withColumn("rest_", rest("article")).select(*keys, F.col("unit_no").alias("article_no"), F.col("unit_id").alias("article"), "rest_")
    at = [*keys, "article_no", "article"]
    secs = split_units(arts, at, "rest_", "section").withColumn("rest_", rest("section")).select(*at, F.col("unit_no").alias("section_no"), F.col("unit_id").alias("section"), "rest_")
    at = [*at, "section_no", "section"]
    points = split_units(secs, at, "rest_", "point").withColumn("rest_", rest("point")).select(*at, F.col("unit_no").alias("point_no"), F.col("unit_id").alias("point"), "rest_")
    a = arts.where("article IS NOT NULL").withColumns({"section_no": number, "point_no": number, "section": none, "point": none, "level": F.lit("article"), "unit_id": F.col("article"), "body": body("section", "point")})
    s = secs.where("section IS NOT NULL").withColumns({"point_no": number, "point": none, "level": F.lit("section"), "unit_id": F.col("section"), "body": body("point")})
    p = points.where("point IS NOT NULL").withColumns({"level": F.lit("point"), "unit_id": F.col("point"), "body": F.nullif("rest_", F.lit(""))})
    return a.select(*keys, *out).unionByName(s.select(*keys, *out)).unionByName(p.select(*keys, *out))


def select_units(units: DataFrame, keys: list[str], order: str, wanted: DataFrame) -> DataFrame:
    """Units named by ``ids`` of ``wanted`` (keys, ids): one id gives the first unit that has it, two give all from the
    first with the start id to the next with the end id, by position. keys, ids, order, unit_id, error; a start or an
    end that isn't there, or another number of ids, gives one row with an error and no unit."""
    wanted = wanted.select(*keys, "ids").distinct()
    hits = wanted.where("size(ids) IN (1, 2)").join(units.select(*keys, order, "unit_id"), keys)
    start = hits.where("unit_id = ids[0]").groupBy(*keys, "ids").agg(F.min(order).alias("start_"))
    end = hits.join(start, [*keys, "ids"]).where((F.col(order) >= F.col("start_")) & (F.col("unit_id") == F.element_at("ids", -1))).groupBy(*keys, "ids").agg(F.min(order).alias("end_"))
    asked = wanted.join(start, [*keys, "ids"], "left").join(end, [*keys, "ids"], "left")
    n = F.coalesce(F.size("ids"), F.lit(0))
    asked = asked.withColumn("error", F.when(~n.isin(1, 2), "bad_arity").when(F.col("start_").isNull(), F.when(n == 1, "not_found").otherwise("start_not_found")).when(F.col("end_").isNull(), "end_not_found"))
    found = asked.where("error IS NULL").join(units.select(*keys, order, "unit_id"), keys).where(F.col(order).between(F.col("start_"), F.col("end_"))).select(*keys, "ids", order, "unit_id", "error")
    return found.unionByName(asked.where("error IS NOT NULL").select(*keys, "ids", "error"), allowMissingColumns=True)
