"""Column expressions that bring dirty keys, dates and labels to one spelling. All run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Polish month names in the genitive.
MONTHS = ["stycznia", "lutego", "marca", "kwietnia", "maja", "czerwca", "lipca", "sierpnia", "września", "października", "listopada", "grudnia"]
# Entries that stand for "nothing known".
FILLERS = ["", "-", "--", "—", "–", "?", ".", "...", "b.d.", "b.d", "bd", "b. d.", "brak", "brak danych", "n/d", "nd", "n.d.", "nie dotyczy", "nieznany", "nieznana", "null", "none", "nan", "n/a", "0"]


def one_space(c: Column) -> Column:
    """Collapse every run of Unicode blanks to one blank and trim."""
    return F.trim(F.regexp_replace(c, r"(?U)[\s\p{Z}]+", " "))


def act_key(c: Column) -> Column:
    """``du / 2010 / 015`` becomes ``DU/2010/15``; null or blank gives null. What is spelled so already skips the patterns."""
    bare = F.upper(F.regexp_replace(c, r"(?U)[\s\p{Z}\p{Cf}]+", ""))
    return F.when(c.rlike(r"^[A-Z]+/[1-9][0-9]*/[1-9][0-9]*$"), c).otherwise(F.nullif(F.regexp_replace(bare, r"/0+(?=\d)", "/"), F.lit("")))


def label(c: Column) -> Column:
    """Lower-case label with single blanks; null where it is missing or meaningless."""
    t = F.when(c.rlike(r"^\p{Ll}+(?: \p{Ll}+)*$"), c).otherwise(F.lower(one_space(c)))
    return F.when(t.isin(FILLERS) | ~t.rlike(r"\p{L}"), F.lit(None).cast("string")).otherwise(t)


def any_date(c: Column) -> Column:
    """ISO text of a date written as ``2010-04-01``, ``2010/4/1``, ``2010-04-01T00:00:00``, ``1.04.2010`` or
    ``1 kwietnia 2010 r.``; null where it is none of these or names no day of the calendar."""
    t = F.lower(one_space(c))
    iso = r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})(?:[t ].*)?$"
    dmy = r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})(?:\D.*)?$"
    word = r"^(\d{1,2})\.? (\p{L}+) (\d{4})(?:\D.*)?$"
    names = F.create_map(*[x for i, m in enumerate(MONTHS, 1) for x in (F.lit(m), F.lit(str(i)))])

    def ymd(y: Column, m: Column, d: Column) -> Column:
        return F.try_to_date(F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd")

    date = (
        F.when(t.rlike(iso), ymd(F.regexp_extract(t, iso, 1), F.regexp_extract(t, iso, 2), F.regexp_extract(t, iso, 3)))
        .when(t.rlike(dmy), ymd(F.regexp_extract(t, dmy, 3), F.regexp_extract(t, dmy, 2), F.regexp_extract(t, dmy, 1)))
        .when(t.rlike(word), ymd(F.regexp_extract(t, word, 3), F.try_element_at(names, F.regexp_extract(t, word, 2)), F.regexp_extract(t, word, 1)))
    )
    return F.when(c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), c.try_cast("date").cast("string")).otherwise(F.date_format(date, "yyyy-MM-dd"))
