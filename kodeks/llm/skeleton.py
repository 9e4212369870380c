"""Visually identical text with different characters (problem 5).

The skeleton of a text is its decomposition with every character replaced by the prototype it looks like, decomposed
again; texts that look the same have one skeleton, and its composed form is the prototype of their group. An original
that differs from it is a candidate. The exact check that follows tells from its word whether a look-alike letter is
foreign on purpose: among Latin letters it is a substitute, among letters of its own script that have no Latin twin it
is meant.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Letters of other scripts that are drawn as the Latin letter beside them.
LOOKALIKES = {
    "Cyrillic": "аa еe оo рp сc уy хx іi јj ѕs һh ԁd ԛq ԝw ѵv АA ВB ЕE КK МM НH ОO РP СC ТT ХX ІI ЈJ ЅS УY ԌG ԚQ ԜW",
    "Greek": "οo ϲc ϳj ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX ϹC",
    "Latin": "ɑa ɡg ıi ſs",
}
# Letters that pass for the Latin one only inside a Latin word; alone they are signs of their own.
LOOSE = "αa ιi κk νv ρp υu ηn γy кk пn гr вb мm тt нh ѡw"
PROTOTYPE = {x[0]: x[1] for row in LOOKALIKES.values() for x in row.split()}
LOOSE_PROTOTYPE = {x[0]: x[1] for x in LOOSE.split()}
STRICT = "".join(PROTOTYPE)

INVISIBLE = r"[­͏؜ᅟᅠ឴឵᠋-᠎​-‏‪-‮⁠-⁯ㅤ︀-️﻿ﾠ]"
_INVISIBLE = re.compile(INVISIBLE)
_BLANK = re.compile(r"[   -   　]")
#: Compatibility characters that are drawn as the letters they stand for: ligatures, Roman numerals, digraphs.
_LIGATURE = re.compile(r"[ĲĳǄ-ǌǱ-ǳⅠ-ⅿﬀ-ﬆ]")
_SAME_LOOK = ("<wide>", "<narrow>", "<font>", "<noBreak>")
_ESCAPE = re.compile(r"\\u[0-9a-fA-F]{4}|\\x[0-9a-fA-F]{2}|\\U[0-9a-fA-F]{8}")
PLAIN = r"^[\x20-\x7eĄĆĘŁŃÓŚŹŻąćęłńóśźż]*$"


def _ordinary(c: str) -> str:
    if ord(c) < 128:
        return c
    if _BLANK.match(c):
        return " "
    tag = unicodedata.decomposition(c).split(" ")[0]
    if tag in _SAME_LOOK or _LIGATURE.match(c):
        return unicodedata.normalize("NFKC", c)
    return c


def ordinary(text: str) -> str:
    """Composed form without invisible characters, full-width, styled and joined letters and odd blanks. Letters of
    other scripts, superscripts, fractions, dashes and quotes stay."""
    if text.isascii():
        return text
    return unicodedata.normalize("NFC", "".join(map(_ordinary, _INVISIBLE.sub("", text))))


def skeleton(text: str) -> str:
    """Decompose, replace every character by its prototype, decompose again."""
    t = unicodedata.normalize("NFD", "".join(map(_ordinary, _INVISIBLE.sub("", text))))
    return unicodedata.normalize("NFD", "".join(PROTOTYPE.get(c) or LOOSE_PROTOTYPE.get(c, c) for c in t))


def prototype(text: str) -> str:
    """The composed skeleton: what all originals of one skeleton are compared with."""
    return unicodedata.normalize("NFC", skeleton(text))


_WORD = re.compile(r"[^\W\d_]+(?:[̀-ͯ]+[^\W\d_]*)*")


def _is_latin(c: str) -> bool:
    return c.isascii() or unicodedata.name(c, "").startswith("LATIN")


def consistent(text: str) -> str:
    """The one consistent form of a text: its ordinary form, with the look-alike letters of every word that is Latin
    otherwise, or looks wholly Latin and stands among Latin words, replaced by their prototypes."""
    t = ordinary(text)
    if t.isascii():
        return t
    words = list(_WORD.finditer(t))
    kinds = []
    for m in words:
        w = m.group()
        letters = [c for c in w if c.isalpha()]
        own = [c for c in letters if c not in PROTOTYPE]
        kinds.append("latin" if any(map(_is_latin, own)) else "foreign" if own else "twin")
    out, at = [], 0
    for i, m in enumerate(words):
        w, k = m.group(), kinds[i]
        if k == "twin":
            near = [next((x for x in part if x != "twin"), "latin") for part in (kinds[:i][::-1], kinds[i + 1 :])]
            k = "foreign" if "foreign" in near else "latin"
        if k == "latin":
            w = "".join(PROTOTYPE.get(c) or (LOOSE_PROTOTYPE.get(c, c) if len(w) > 1 else c) for c in w)
        out += [t[at : m.start()], w]
        at = m.end()
    return unicodedata.normalize("NFC", "".join(out) + t[at:])


@F.pandas_udf(StringType())
def consistent_udf(text: pd.Series) -> pd.Series:
    return text.map(lambda t: t if t is None else consistent(t))


@F.pandas_udf(StringType())
def skeleton_udf(text: pd.Series) -> pd.Series:
    return text.map(lambda t: t if t is None else skeleton(t))


@F.pandas_udf(StringType())
def prototype_udf(text: pd.Series) -> pd.Series:
    return text.map(lambda t: t if t is None else prototype(t))


@F.pandas_udf(StringType())
def ordinary_udf(text: pd.Series) -> pd.Series:
    return text.map(lambda t: t if t is None else ordinary(t))


def skeleton_groups(df: DataFrame, text: str) -> DataFrame:
    """Texts grouped by equal skeleton: skeleton, the consistent form most rows have, number of distinct originals and
    of rows. Null texts are no members. Originals are counted before the shuffle by skeleton."""
    forms = df.where(F.col(text).isNotNull()).groupBy(F.col(text).alias("form")).agg(F.count("*").alias("n"))
    odd = ~F.col("form").rlike(PLAIN)
    plain = forms.where(~odd).withColumns({"skeleton": skeleton_udf("form"), "to": F.col("form")})
    forms = plain.unionByName(forms.where(odd).withColumns({"skeleton": skeleton_udf("form"), "to": consistent_udf("form")}))
    return forms.groupBy("skeleton").agg(F.max_by("to", F.struct("n", "to")).alias("consistent_form"), F.count("*").alias("forms"), F.sum("n").alias("rows"))


def text_cases(df: DataFrame, key: str, text: str) -> DataFrame:
    """Keys of the rows whose text looks right but isn't in the consistent form: it differs from the prototype of its
    skeleton group, and the rule of words confirms it. Since the prototype follows from the skeleton, no group needs to
    be brought together. Null and empty texts and texts with literal backslash escapes are no cases."""
    odd = df.select(key, text).where(F.col(text).isNotNull() & ~F.col(text).rlike(PLAIN) & ~F.col(text).rlike(_ESCAPE.pattern))
    candidates = odd.where(prototype_udf(text) != F.col(text))
    return candidates.where(consistent_udf(text) != F.col(text)).select(key)


def cell_cases(chars: DataFrame, block: int = 4096) -> DataFrame:
    """char_id of every cell that must be changed, merged or removed. Candidates are the cells whose text differs from the
    prototype of its skeleton group, and combining marks, whose skeleton is one with the cell before them.

    The cells of an act are cut into blocks of index ranges, so that an act with a third of all cells spreads over
    many tasks. What lies before and after a block (last break, last Latin letter, ...) is carried over from one row
    per block, so words that cross a border are judged as a whole, whatever their length. Cells without text, act or
    index are no cases; cells that stand twice are listed once.
    """
    t = F.regexp_replace("text", INVISIBLE, "")
    latin = t.rlike("[A-Za-zÀ-ɐḀ-ỿＡ-Ｚａ-ｚﬀ-ﬆ]")
    twin = t.rlike(f"[{STRICT}]")
    strange = t.rlike(rf"[\p{{L}}&&[^{STRICT}A-Za-zÀ-ɐḀ-ỿＡ-Ｚａ-ｚﬀ-ﬆ]]")
    mark = t.rlike(r"^\p{M}")
    cells = chars.select("char_id", F.col("eli").alias("e_"), F.col("index_in_legal_act").cast("long").alias("i_"), "text").where("char_id IS NOT NULL AND e_ IS NOT NULL AND i_ IS NOT NULL AND text IS NOT NULL AND text <> ''")
    cells = cells.withColumn("b_", F.floor(F.col("i_") / block)).withColumn("plain_", F.col("text").rlike("^[A-Za-zĄĆĘŁŃÓŚŹŻąćęłńóśźż]$"))
    at = lambda c: F.when(c, F.col("i_"))
    cells = cells.select(
        "*",
        at(F.when(F.col("plain_"), F.lit(False)).otherwise((t != "") & ~t.rlike(r"[\p{L}\p{M}]"))).alias("brk_"),
        at(F.col("plain_") | latin).alias("lat_"),
        at(F.when(F.col("plain_"), F.lit(False)).otherwise(strange)).alias("str_"),
        F.when(F.col("plain_") | ((t != "") & ~mark), F.struct("i_", "char_id")).alias("base_"),
    )
    marks = ["brk_", "lat_", "str_"]
    sums = cells.groupBy("e_", "b_").agg(*[F.max(c).alias(f"max{c}") for c in [*marks, "base_"]], *[F.min(c).alias(f"min{c}") for c in marks])
    before, after = Window.partitionBy("e_").orderBy("b_").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("e_").orderBy(F.col("b_").desc()).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("e_", "b_", *[F.max(f"max{c}").over(before).alias(f"left{c}") for c in [*marks, "base_"]], *[F.min(f"min{c}").over(after).alias(f"right{c}") for c in marks])
    up, down = Window.partitionBy("e_", "b_").orderBy("i_").rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy("e_", "b_").orderBy(F.col("i_").desc()).rowsBetween(Window.unboundedPreceding, 0)
    seen = cells.repartition("e_", "b_").select("*", *[F.max(c).over(up).alias(f"up{c}") for c in [*marks, "base_"]], *[F.min(c).over(down).alias(f"down{c}") for c in marks])
    odd = seen.where(~F.col("text").rlike(PLAIN)).join(sums, ["e_", "b_"])
    left = {c: F.coalesce(F.greatest(f"up{c}", f"left{c}") if c != "base_" else F.coalesce(f"up{c}", f"left{c}"), F.lit(-1) if c != "base_" else F.lit(None)) for c in [*marks, "base_"]}
    right = {c: F.coalesce(F.least(f"down{c}", f"right{c}"), F.lit(1 << 62)) for c in marks}
    mixed = (left["lat_"] > left["brk_"]) | (right["lat_"] < right["brk_"])
    foreign = (left["str_"] > left["brk_"]) | (right["str_"] < right["brk_"]) | (left["str_"] > left["lat_"]) | (right["str_"] < right["lat_"])
    # a word of nothing but twins goes with the nearest letters on either side
    swap = twin & (mixed | ~foreign)
    loose = t.rlike(f"[{''.join(LOOSE_PROTOTYPE)}]") & mixed
    odd = odd.where(mark | (prototype_udf("text") != F.col("text")))
    odd = odd.select("char_id", "text", (swap | loose).alias("swap_"), mark.alias("mark_"), left["base_"].alias("base_"))
    found = odd.where(F.col("swap_") | F.col("mark_") | (ordinary_udf("text") != F.col("text")))
    return found.select(F.explode(F.array("char_id", F.when(F.col("mark_"), F.col("base_.char_id")))).alias("char_id")).where("char_id IS NOT NULL").distinct()
