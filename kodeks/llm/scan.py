"""Noise in text from scanned pages (problem 6).

Edge lines that repeat are running headers, lines that hold nothing but their page's number are page numbers. Broken
words are told from hyphenated compounds by the words that the corpus holds elsewhere. Misread words are rare words
whose anagram hash differs from that of a frequent word by the difference of a known confusion of characters; the join
on that sum finds them in SQL, and the corrections are ranked by frequency.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kodeks.session import cut

# What scanners read, and what stood there.
CONFUSIONS = "! i|@ a|0 o|0 ó|c e|2 z|vv w|cl d|lc k|m ni|m rn|m in|† t|rn m|ii u|b h|h b|1 l|1 i|l i|i l|t ł|l ł|9 g|6 ó|6 b|q ą|q ę|g ę|z ż|z ź|ż z|5 ś|5 s|8 b|o ó|a ą|e ę|e c|s ś|n ń|c ć|3 e|4 a|$ s|€ e|ł t|u ii|ni m|nn m|li h|lz k|j i|i j|r n|f t|y v|v y|w vv|d cl|k lc|| l"
AREAS = {"paragraph": "paragraph_lines", "footer": "footer_lines", "margin": "margin_lines"}
BREAKS = "-‐‑­¬⁃"
_KEYS = ["page_id", "area", "line_no"]


def _pairs() -> list[tuple[str, str]]:
    return [(p[0], p[1]) for x in CONFUSIONS.split("|") if len(p := x.split(" ")) == 2 and p[0]]


def anagram_value(text: str) -> int:
    return sum((ord(c) % 997) ** 5 for c in text)


def anagram_hash(c: Column) -> Column:
    """Sum of the fifth powers of the code points (modulo a prime): equal for all anagrams, and differences add up."""
    point = lambda x: F.ascii(x).cast("long") % 997
    return F.aggregate(F.split(c, ""), F.lit(0).cast("long"), lambda a, x: a + point(x) * point(x) * point(x) * point(x) * point(x))


def lines(pages: DataFrame) -> DataFrame:
    """One row per line with text: page_id, eli, invoke_id, page_number, area, line_no (its place in the array), of_lines,
    text. Null areas, null lines and lines without text give no row; a page that stands twice is taken once."""
    once = pages.where(F.col("page_id").isNotNull()).select("page_id", "eli", "invoke_id", F.col("page.page_number").alias("page_number"), *[F.col(f"page.{c}").alias(c) for c in AREAS.values()])
    once = once.groupBy("page_id").agg(F.min(F.struct("eli", "invoke_id", "page_number", *[F.transform(c, lambda x: x["text"]).alias(c) for c in AREAS.values()])).alias("p")).select("page_id", "p.*")
    parts = F.array(*[F.struct(F.lit(a).alias("area"), F.col(c).alias("texts")) for a, c in AREAS.items()])
    rows = once.select("page_id", "eli", "invoke_id", "page_number", F.explode(parts).alias("a")).select("page_id", "eli", "invoke_id", "page_number", "a.area", F.size("a.texts").alias("of_lines"), F.posexplode("a.texts").alias("line_no", "text"))
    return rows.where("length(trim(text)) > 0")


def _template(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), r"\d+", "#"), r"(?U)[\s\p{Z}]+", " "))


def is_page_number(text: Column, page: Column) -> Column:
    """Nothing but the page's number, decorated or named."""
    bare = F.lower(F.regexp_replace(text, r"(?U)[\s\p{Z}]+", ""))
    number = F.regexp_extract(bare, r"^[^\p{L}\p{N}]*(?:strona|str|s|page|p)?[^\p{L}\p{N}]*(\d{1,6})(?:(?:/|z)\d{1,6})?[^\p{L}\p{N}]*$", 1)
    return (number != "") & F.coalesce(number.try_cast("int") == page, F.lit(False))


def _edge(reach: int) -> Column:
    return (F.col("line_no") < reach) | (F.col("line_no") >= F.col("of_lines") - reach)


def header_templates(rows: DataFrame) -> DataFrame:
    """(t_): wordings of running headers, with # for numbers. A wording at the edge of an area counts in an act that shows
    it on several pages, with every number the same or running on with the page's number; it is a header's where that
    holds in at least two acts and in half of those that show it twice."""
    shape = rows.where(_edge(2) & F.col("text").rlike(r"\d") & ~is_page_number(F.col("text"), F.col("page_number"))).select(
        "eli", "invoke_id", "page_number", _template(F.col("text")).alias("t_"), F.posexplode(F.regexp_extract_all("text", F.lit(r"(\d{1,15})"), F.lit(1))).alias("slot_", "number_")
    )
    number, page = F.col("number_").cast("long"), F.col("page_number")
    slot = shape.groupBy("eli", "invoke_id", "t_", "slot_").agg(
        (F.min(page) < F.max(page)).alias("pages_"), ((F.min(number) == F.max(number)) | (F.min(number - page) == F.max(number - page))).alias("ok_")
    )
    act = slot.groupBy("eli", "invoke_id", "t_").agg(F.bool_or("pages_").alias("all_"), (F.bool_and("ok_") & F.bool_or("pages_")).alias("same_"))
    wording = act.groupBy("t_").agg(F.count_if("same_").alias("again_"), F.count_if("all_").alias("twice_"))
    return wording.where((F.col("again_") >= 2) & (F.col("again_") * 2 > F.col("twice_")) & (F.length("t_") >= 6)).select("t_")


def _letters(t: str) -> Column:
    return F.array_distinct(F.filter(F.split(t, r"[^\p{L}]+"), lambda w: F.length(w) > 2))


def header_forms(rows: DataFrame, known: DataFrame) -> DataFrame:
    """(t_): spellings at the edges within a fifth of the letters of a known wording. They are found by the words they share
    with it, their first or their last four characters; a spelling with all of these misread is no header."""
    spelled = rows.where(_edge(3) & (F.length("text") >= 6)).select(_template(F.col("text")).alias("t_")).distinct()
    ends = lambda t: F.array(F.concat(F.lit("^"), F.substring(t, 1, 4)), F.concat(F.substring(t, -4, 4), F.lit("$")))
    blocks = lambda t: F.explode(F.array_union(_letters(t), ends(t)))
    reach = F.greatest(F.lit(1), F.floor(F.length("x_") / 5)).cast("int")
    near = (F.abs(F.length("t_") - F.length("x_")) <= reach) & (F.levenshtein("t_", "x_") <= reach)
    asked = known.select(F.col("t_").alias("x_"), blocks("t_").alias("b_"))
    return spelled.select("t_", blocks("t_").alias("b_")).join(asked, "b_").where(near).select("t_").distinct()


def classify_edges(rows: DataFrame) -> DataFrame:
    """Lines with ``edge``: running_header, page_number or null. ``rows`` is read several times and should be a table.
    Wordings and their spellings are tables as well, whose size Spark knows when it chooses the joins."""
    forms = cut(header_forms(rows, cut(header_templates(rows)))).withColumn("known_", F.lit(True))
    number = is_page_number(F.col("text"), F.col("page_number"))
    t = F.when(_edge(3) & (F.length("text") >= 6), _template(F.col("text")))
    return rows.withColumn("t_", t).join(forms, "t_", "left").withColumn("edge", F.when(number, "page_number").when(F.col("known_"), "running_header")).drop("t_", "known_")


_BROKEN = rf"[\p{{L}}\p{{N}}!@†$€][{BREAKS}]\s*$"  # ends inside a word, or a compound at its own sign
_UNIT = r"^\s*(?:Art\.\s*\d|§\s*\d|Rozdział\s|DZIAŁ\s|\d+[a-z]*[.)]\s|[a-z]\)\s)"
_STRIP = r"^[^\p{L}\p{N}!@†$€]+|[^\p{L}\p{N}!@†$€]+$"


def words(body: DataFrame) -> DataFrame:
    """One row per word: the keys of its line, its place, the word as it stands in lower case (``raw``), and whether it is
    the last one of a line that ends with a break sign."""
    split = body.select(*_KEYS, F.col("text").rlike(_BROKEN).alias("broken_"), F.split(F.trim(F.lower("text")), r"\s+").alias("ws_"))
    return split.select(*_KEYS, "broken_", F.size("ws_").alias("of_"), F.posexplode("ws_").alias("at", "raw")).select(*_KEYS, "at", "raw", (F.col("broken_") & (F.col("at") == F.col("of_") - 1)).alias("last"))


def bare(raw: Column) -> Column:
    """A word without outer punctuation."""
    return F.regexp_replace(raw, _STRIP, "")


def broken_ends(body: DataFrame) -> DataFrame:
    """Lines that end with a break sign: their keys, place and ``word`` of the last word, the first word of the line it
    goes on in (``head``, null if none), ``next_no``, that line's number on the same page, and ``to_``, where it lies."""
    text = F.trim(F.lower("text"))
    slim = body.select(*_KEYS, "eli", "invoke_id", "page_number", F.regexp_extract(text, r"^\S+", 0).alias("first_"), F.when(F.col("text").rlike(_BROKEN), F.regexp_extract(text, r"\S+$", 0)).alias("last_"), F.when(F.col("text").rlike(_BROKEN), F.size(F.split(text, r"\s+")) - 1).alias("at"))
    w = Window.partitionBy("page_id", "area").orderBy("line_no")
    slim = slim.withColumns({"next_": F.lead("first_").over(w), "next_no": F.lead("line_no").over(w), "here_": F.row_number().over(w)})
    tops = slim.where("here_ = 1").groupBy("eli", "invoke_id", (F.col("page_number") - 1).alias("page_number"), "area").agg(F.min("first_").alias("over_"), F.min_by(F.struct("page_id", "line_no"), "page_id").alias("top_"))
    ends = slim.where("last_ IS NOT NULL").join(tops, ["eli", "invoke_id", "page_number", "area"], "left")
    word, to = bare(F.col("last_")), F.coalesce(F.when(F.col("next_no").isNotNull(), F.struct("page_id", F.col("next_no").alias("line_no"))), "top_")
    return ends.select(*_KEYS, "at", word.alias("word"), bare(F.coalesce("next_", "over_")).alias("head"), "next_no", to.alias("to_")).where("word <> ''")


def _corrections(rare: DataFrame, lexicon: DataFrame, ratio: int) -> DataFrame:
    """wrong and right for every rare word that one or two confusions turn into a word ``ratio`` times as frequent.
    Ranked: fewest confusions, then the most frequent word.

    One confusion: the hash of the rare word and a difference give that of the frequent one. Two: the rare word goes one
    difference on and the frequent word one back, and the hashes meet half-way, so no word is laid out with all pairs of
    confusions.
    """
    pairs = [((w, r), anagram_value(r) - anagram_value(w), max(len(w), len(r))) for w, r in _pairs()]
    table = lambda side: F.expr("array(" + ", ".join(f"named_struct('s', '{p[side]}', 'd', {d}L, 'c', {c})" for p, d, c in pairs) + ")")
    fits = lambda side, word: F.explode(F.array_distinct(F.transform(F.filter(table(side), lambda x: F.contains(word, x["s"])), lambda x: F.struct(x["d"].alias("d"), x["c"].alias("c"))))).alias("x_")
    on = rare.select("word", "n", anagram_hash(F.col("word")).alias("h_")).select("word", "n", "h_", fits(0, F.col("word"))).select("word", "n", (F.col("h_") + F.col("x_.d")).alias("h_"), F.col("x_.c").alias("c_"))
    right = lexicon.where(F.col("n") >= max(3, ratio)).select(F.col("word").alias("right"), F.col("n").alias("m"), anagram_hash(F.col("word")).alias("h_"))
    ok = (F.col("m") >= ratio * F.col("n")) & (F.col("word") != F.col("right"))
    one = on.join(right, "h_").where(ok & (F.levenshtein("word", "right") <= F.col("c_"))).select("word", "right", "m", F.lit(1).alias("k_"))
    back = right.select("right", "m", "h_", fits(1, F.col("right"))).select("right", "m", (F.col("h_") - F.col("x_.d")).alias("h_"), F.col("x_.c").alias("b_"))
    two = on.join(back, "h_").where(ok & (F.levenshtein("word", "right") <= F.col("c_") + F.col("b_"))).select("word", "right", "m", F.lit(2).alias("k_"))
    return one.unionByName(two).groupBy("word").agg(F.max_by("right", F.struct(-F.col("k_"), "m", "right")).alias("right"))


def _halves(over: DataFrame, body: DataFrame) -> DataFrame:
    """Corrections of broken words: page_id, area, line_no, at, wrong, right for the half before the break and the half
    after it, which stands first in the next line or on the next page. A half that isn't found where it should stand
    leaves both as they are; a word that nothing continues is one half."""
    tail, head, right = F.col("tail"), F.col("head"), F.col("right")
    at = F.when(F.startswith(right, tail), F.length(tail)).when(F.endswith(right, head), F.length(right) - F.length(head)).otherwise(F.least(F.length(tail), F.length(right) - 1))
    split = over.where("right IS NOT NULL").withColumn("cut_", F.when(head.isNull(), F.length(right)).otherwise(at))
    first = body.select(F.struct("page_id", "line_no").alias("to_"), "area", bare(F.regexp_extract(F.trim(F.lower("text")), r"^\S+", 0)).alias("head"), F.lit(True).alias("found_"))
    split = split.join(first, ["to_", "area", "head"], "left").where("head IS NULL OR found_")
    before = split.select(*_KEYS, "at", tail.alias("wrong"), F.substring("right", F.lit(1), F.col("cut_")).alias("right"))
    after = split.where("head IS NOT NULL").select("to_.page_id", "area", "to_.line_no", F.lit(0).alias("at"), head.alias("wrong"), F.substring("right", F.col("cut_") + 1, F.length("right")).alias("right"))
    return before.unionByName(after).where("wrong <> right")


def _cased(right: Column, like: Column) -> Column:
    """``right`` in the case of ``like``: upper case, a capital first, or as it is."""
    capitals, small = F.length(F.regexp_replace(like, r"\P{Lu}", "")), F.length(F.regexp_replace(like, r"\P{Ll}", ""))
    first = F.concat(F.upper(F.substring(right, 1, 1)), F.substring(right, F.lit(2), F.length(right)))
    return F.when((capitals > 1) & (capitals > small), F.upper(right)).when(like.rlike(r"^\p{Lu}"), first).otherwise(right)


def _corrected(text: Column, fixes: Column) -> Column:
    """The line with the words at the places of ``fixes`` replaced; case, blanks and outer punctuation stay."""
    def one(piece: Column, i: Column) -> Column:
        word = F.regexp_replace(piece, _STRIP, "")
        fix = F.get(F.filter(fixes, lambda x: (x["at"] == i) & (x["wrong"] == F.lower(word))), 0)["right"]
        before = F.length(F.regexp_extract(piece, r"^[^\p{L}\p{N}!@†$€]*", 0))
        after = F.substring(piece, before + F.length(word) + 1, F.length(piece))
        return F.when(fix.isNull(), piece).otherwise(F.concat(F.substring(piece, F.lit(1), before), _cased(fix, word), after))

    return F.when(fixes.isNull(), F.trim(text)).otherwise(F.array_join(F.transform(F.split(F.trim(text), r"(?<=\s)(?=\S)"), one), ""))


def _chained(areas: DataFrame, block: int = 256) -> DataFrame:
    """Areas whose last word goes on joined with the same area of the next page, page by page. Where a chain begins is
    carried from block to block of an act's pages, so no window holds an act; of pages with one number the first goes on."""
    act = ["eli", "invoke_id", "area"]
    keys = [*act, "page_number"]
    main = areas.where("page_number IS NOT NULL").groupBy(*keys).agg(F.min("page_id").alias("main_"))
    areas = areas.alias("a").join(main.alias("b"), F.expr(" AND ".join(f"a.{c} <=> b.{c}" for c in keys)) & (F.col("a.page_id") == F.col("b.main_")), "left").select("a.*", F.col("main_").isNotNull().alias("is_main_"))
    flow, alone = areas.where("is_main_").drop("is_main_"), areas.where("NOT is_main_").drop("is_main_")
    open_ = flow.where("open_end").select(*act, (F.col("page_number") + 1).alias("page_number"))
    on = F.expr(" AND ".join(f"a.{c} <=> b.{c}" for c in keys))
    flow = flow.alias("a").join(open_.withColumn("goes_on_", F.lit(True)).alias("b"), on, "left").select("a.*", F.when(F.col("b.goes_on_").isNull(), F.col("a.page_number")).alias("head_"), F.floor(F.col("a.page_number") / block).alias("block_"))
    last = flow.groupBy(*act, "block_").agg(F.max("head_").alias("last_"))
    last = last.select(*act, "block_", F.max("last_").over(Window.partitionBy(*act).orderBy("block_").rowsBetween(Window.unboundedPreceding, -1)).alias("carried_"))
    within = Window.partitionBy(*act, "block_").orderBy("page_number").rowsBetween(Window.unboundedPreceding, 0)
    by = F.expr(" AND ".join(f"a.{c} <=> b.{c}" for c in [*act, "block_"]))
    flow = flow.withColumn("start_", F.max("head_").over(within)).alias("a").join(last.alias("b"), by).select("a.*", F.coalesce("a.start_", "b.carried_").alias("chain_"))
    xs = F.array_sort(F.collect_list(F.struct("page_number", "page_id", "text", "open_end"))).alias("xs")
    chains = flow.groupBy(*act, "chain_").agg(xs)
    x0 = F.element_at("xs", 1)
    text = F.array_join(F.transform("xs", lambda x: x["text"]), "")
    chains = chains.select(x0["page_id"].alias("page_id"), "eli", "invoke_id", x0["page_number"].alias("page_number"), F.element_at("xs", -1)["page_number"].alias("last_page"), "area", text.alias("text"), x0["open_end"].alias("open_end"))
    return chains.unionByName(alone.withColumn("last_page", F.col("page_number")))


def find_noise(pages: DataFrame, ratio: int = 5) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(classified lines, noise, corrections). noise: page_id, area, line_no, noise with one row per line and kind;
    corrections: page_id, area, line_no, at, wrong, right for the misread words that a frequent word explains, at their
    place in the line; a broken word's correction is split over its two halves.

    Words are counted before they are shuffled, so frequent words aren't hot; lines of an act meet only by page. An
    empty table gives no rows.
    """
    rows = cut(classify_edges(cut(lines(pages))))
    body = rows.where("edge IS NULL")
    tokens = words(body)
    ends = cut(broken_ends(body))
    # words are counted as they stand, so outer punctuation is taken off once for every spelling; the first word of a line
    # that continues a broken one is no word of its own
    spelled = cut(tokens.where("NOT last").groupBy("raw").agg(F.count("*").alias("n_")).withColumn("word", bare(F.col("raw"))).where("word <> ''"))
    heads = ends.where("head IS NOT NULL").groupBy("head").agg(F.count("*").alias("k_"))
    counts = spelled.groupBy("word").agg(F.sum("n_").alias("n_")).join(heads, F.col("word") == F.col("head"), "left")
    lexicon = cut(counts.select("word", (F.col("n_") - F.coalesce("k_", F.lit(0))).alias("n")).where("n > 0 AND word RLIKE '\\\\p{L}'"))

    # broken words: as one word, or as a compound?
    tail = F.regexp_replace("word", rf"[{BREAKS}]+$", "")
    ends = ends.withColumn("tail", tail).withColumns({"joined": F.concat("tail", F.coalesce("head", F.lit(""))), "compound": F.concat("tail", F.lit("-"), F.coalesce("head", F.lit("")))})
    hyphened = lexicon.where(F.col("word").contains("-"))
    n_joined = lexicon.select(F.col("word").alias("joined"), F.col("n").alias("nj_"))
    n_compound = hyphened.select(F.col("word").alias("compound"), F.col("n").alias("nc_"))
    first_part = hyphened.groupBy(F.substring_index("word", "-", 1).alias("tail")).agg(F.sum("n").alias("np_"))
    second_part = hyphened.groupBy(F.substring_index("word", "-", -1).alias("head")).agg(F.sum("n").alias("ns_"))
    ends = ends.join(n_joined, "joined", "left").join(n_compound, "compound", "left").join(first_part, "tail", "left").join(second_part, "head", "left")
    none = lambda c: F.coalesce(c, F.lit(0))
    is_compound = F.when(none("nc_") + none("nj_") > 0, none("nc_") > none("nj_")).otherwise((none("np_") > 0) & ((none("ns_") > 0) | F.col("head").isNull()))
    continues = F.col("head").isNull() | F.col("head").rlike(r"^[\p{L}\p{N}!@†$€]")
    ends = cut(ends.withColumn("hyphenation", continues & ~is_compound).select(*_KEYS, "at", "next_no", "to_", "tail", "head", "joined", "hyphenation"))

    # misread words, of lines and of words joined over lines
    whole = ends.where("hyphenation").select(*_KEYS, "at", "next_no", "to_", "tail", "head", F.col("joined").alias("word"))
    loose = lexicon.unionByName(whole.select("word").distinct().select("word", F.lit(0).cast("long").alias("n"))).groupBy("word").agg(F.sum("n").alias("n"))
    rare = loose.select("word", F.greatest("n", F.lit(1)).alias("n"))
    signs = rare.where(F.col("word").rlike(r"\p{L}[!@†$€]|[!@†$€]\p{L}|\p{L}\d+\p{L}")).select("word", F.lit(True).alias("sign_"))
    wrong = cut(_corrections(rare, lexicon, ratio).join(signs, "word", "full").select("word", "right"))
    misspelled = cut(spelled.join(wrong, "word").select("raw", F.col("word").alias("wrong"), "right"))
    plain = tokens.where("NOT last").join(misspelled, "raw").select(*_KEYS, "wrong", "right", "at")
    # the first word of a continuation is judged with the word it ends
    taken = ends.where("head IS NOT NULL AND next_no IS NOT NULL").select("page_id", "area", F.col("next_no").alias("line_no"), F.lit(0).alias("at"))
    plain = plain.join(taken, [*_KEYS, "at"], "left_anti")
    over = whole.join(wrong, "word")
    in_tail = ~F.coalesce(F.startswith(F.col("right"), F.col("tail")), F.col("head").isNull() | F.col("tail").rlike(r"[!@†$€]|\d"))
    in_head = ~F.coalesce(F.endswith(F.col("right"), F.col("head")), ~F.col("head").rlike(r"[!@†$€]|\d"))
    tails = over.where(in_tail | F.col("right").isNull() & F.col("tail").rlike(r"[!@†$€]|\p{L}\d")).select(*_KEYS)
    heads_wrong = over.where(in_head & ~in_tail & F.col("next_no").isNotNull()).select("page_id", "area", F.col("next_no").alias("line_no"))
    misread = plain.select(*_KEYS).unionByName(tails).unionByName(heads_wrong)
    fixes = plain.where("right IS NOT NULL").select(*_KEYS, "at", "wrong", "right").unionByName(_halves(over, body))
    kind = lambda df, k: df.select(*_KEYS, F.lit(k).alias("noise"))
    noise = kind(ends.where("hyphenation"), "hyphenation").unionByName(kind(misread, "misread")).distinct().unionByName(rows.where("edge IS NOT NULL").select(*_KEYS, F.col("edge").alias("noise")))
    return rows, noise, fixes


def repaired(pages: DataFrame) -> DataFrame:
    """Continuous text of the areas: headers and page numbers gone, broken words joined, misread words replaced by their
    correction at their place, a line break before every unit of the act and nowhere else. An area whose last word goes on on the next page has the text of that page too, up to
    ``last_page``; ``open_end`` says that it ran over its page, and with last_page = page_number that nothing continues it."""
    rows, noise, corrections = find_noise(pages)
    fixes = corrections.groupBy(*_KEYS).agg(F.collect_set(F.struct("at", "wrong", "right")).alias("fixes"))
    joins = noise.where("noise = 'hyphenation'").select(*_KEYS, F.lit(True).alias("joins"))
    body = rows.where("edge IS NULL").join(fixes, _KEYS, "left").join(joins, _KEYS, "left")
    fixed = _corrected(F.col("text"), F.col("fixes"))
    # a broken word loses its sign, a compound that breaks at its own keeps it, and neither gets a blank
    broken = F.col("text").rlike(_BROKEN)
    piece = F.when(F.col("joins"), F.regexp_replace(fixed, rf"[{BREAKS}]\s*$", "")).when(broken, F.rtrim(fixed)).otherwise(F.concat(fixed, F.lit(" ")))
    piece = F.concat(F.when((F.col("area") == "paragraph") & (F.col("line_no") > 0) & F.col("text").rlike(_UNIT), F.lit("\n")).otherwise(F.lit("")), piece)
    got = body.select("page_id", "eli", "invoke_id", "page_number", "area", F.struct("line_no", piece.alias("t"), (F.coalesce("joins", F.lit(False)) | broken).alias("j")).alias("x"))
    areas = got.groupBy("page_id", "area").agg(F.min(F.struct("eli", "invoke_id", "page_number")).alias("k"), F.array_sort(F.collect_list("x")).alias("xs")).select("page_id", "k.*", "area", F.trim(F.regexp_replace(F.array_join(F.transform("xs", lambda x: x["t"]), ""), r" *\n", "\n")).alias("text"), F.element_at("xs", -1)["j"].alias("open_end"))
    return _chained(cut(areas))
