"""Scalar text functions as column expressions; patterns are in Java's dialect."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Super- and subscript digits and the digits they stand for.
RAISED, LOWERED, DIGITS = "⁰¹²³⁴⁵⁶⁷⁸⁹", "₀₁₂₃₄₅₆₇₈₉", "0123456789"
# Letters with marks of the languages at hand and their bare letters; ł has no mark and stays.
MARKED, BARE = "ąćęńóśźżáéíúýčďěňřšťůžäöüôľĺŕàâçèêëîïôùûÿñ", "acenoszzaeiuycdenrstuzaouollraaceeeiiouuyn"


def squeeze(c: Column) -> Column:
    """Runs of blanks to one, ends trimmed."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def fold(c: Column) -> Column:
    """Lower case without marks."""
    return F.translate(F.lower(c), MARKED, BARE)


def title_key(c: Column) -> Column:
    """Lower case, trimmed, with one closing point."""
    t = F.trim(F.lower(c))
    return F.when(F.endswith(t, F.lit(".")), t).otherwise(F.concat(t, F.lit(".")))


# Characters and the raised and lowered ones that stand for them, in equal order.
TO_RAISE = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZąćęłńóśźżĄĆĘŁŃÓŚŹŻ()[]{}<>+-=:.,'/|\\*`~′"
RAISED_ALL = "⁰¹²³⁴⁵⁶⁷⁸⁹ᵃᵇᶜᵈᵉᶠᶢʰⁱʲᵏˡᵐⁿᵒᵖᑫʳˢᵗᵘᵛʷˣʸᶻᴬᴮᶜᴰᴱᶠᴳᴴᴵᴶᴷᴸᴹᴺᴼᴾᵠᴿˢᵀᵁⱽᵂˣʸᶻᵃᶜᵉˡⁿᵒˢᶻᶻᴬᶜᴱᴸᴺᴼˢᶻᶻ⁽⁾⁽⁾⁽⁾ᐸᐳ⁺⁻⁼ː·ˌˈᐟˈ⧹⁎ˋᵠʹ"
TO_LOWER = "0123456789aehijklmnoprstuvxAEHIJKLMNOPRSTUVXąęłńóśźżĄĘŁŃÓŚŹŻ()[]{}+-–=:.,'/|\\*^`~"
LOWERED_ALL = "₀₁₂₃₄₅₆₇₈₉ₐₑₕᵢⱼₖₗₘₙₒₚᵣₛₜᵤᵥₓₐₑₕᵢⱼₖₗₘₙₒₚᵣₛₜᵤᵥₓₐₑₗₙₒₛₓₓₐₑₗₙₒₛₓₓ₍₎₍₎₍₎₊₋₋₌ₐ·ₓₓₓₓₓₓₓₓₓ"
# Dashes that count as the minus sign, and signs with their usual form.
DASHES, MINUS = "-‐‑‒–—﹘﹣－", "−"
SIGNS, USUAL = "Σɡ∗⬚", "∑g*□"
# Mathematical alphabets: first code point of upper and lower case letters, bold and italic.
ALPHABETS = [0x1D400, 0x1D434]
MONTH_NAMES = "stycznia|lutego|marca|kwietnia|maja|czerwca|lipca|sierpnia|września|października|listopada|grudnia"
# Fixed value: what a statute's full title looks like.
FULL_TITLE = rf"(?isu)^Ustawa\s+z\s+dnia\s+(\d{{1,2}}\s+({MONTH_NAMES})|\d{{2}}\.\d{{2}})\s+\d{{4}}\s+r\.\s+.*$"


def raised(c: Column) -> Column:
    """Characters as superscripts; one that has none stays."""
    return F.translate(c, TO_RAISE, RAISED_ALL)


def lowered(c: Column) -> Column:
    """Characters as subscripts; one that has none stays."""
    return F.translate(c, TO_LOWER, LOWERED_ALL)


def usual_signs(c: Column) -> Column:
    """Mathematical letters, dashes and signs in one form each."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    mathematical = "".join(chr(a + i) for a in ALPHABETS for i in range(52))
    return F.translate(c, mathematical + DASHES + SIGNS, letters * len(ALPHABETS) + MINUS * len(DASHES) + USUAL)


def is_full_title(c: Column) -> Column:
    """A statute's full title: day with a month by name or number, year and subject. Null is none."""
    return F.coalesce(F.trim(F.regexp_replace(c, r"(?U)\s+", " ")).rlike(FULL_TITLE), F.lit(False))


def decode_escapes(c: Column) -> Column:
    """Characters written as a backslash, u and four hexadecimal digits."""
    parts = F.split(c, r"\\u(?=[0-9a-fA-F]{4})")
    rest = F.transform(F.slice(parts, F.lit(2), F.size(parts)), lambda x: F.concat(F.decode(F.unhex(F.substring(x, 1, 4)), "UTF-16BE"), F.substring(x, F.lit(5), F.length(x))))
    return F.when(c.rlike(r"\\u[0-9a-fA-F]{4}"), F.concat(parts[0], F.array_join(rest, ""))).otherwise(c)


def encoded(c: Column) -> Column:
    """UTF-8 bytes of a text in base 64, on one line."""
    return F.regexp_replace(F.base64(F.encode(c, "UTF-8")), r"\s+", "")


def is_decodable(c: Column) -> Column:
    """Holds no glyph that a reader could only name by its number. Null is decodable."""
    return ~F.coalesce(c.rlike(r"\(cid:\d+\)"), F.lit(False))


def id_parts(c: Column) -> tuple[Column, Column]:
    """Leading number and the letters behind it; null where there is no number."""
    n = F.regexp_extract(c, r"^(\d+)", 1).try_cast("long")
    return n, F.when(n.isNotNull(), F.regexp_extract(c, r"^\d+\s*(\p{L}*)", 1))


def plain_digits(c: Column) -> Column:
    return F.translate(c, RAISED + LOWERED, DIGITS + DIGITS)


def id_range(c: Column) -> Column:
    """``1-3`` gives [1, 3], ``9 – 9b`` [9, 9b], ``22`` [22], null or blank []; what is none of these gives null."""
    t = F.regexp_replace(c, r"(?U)\s+", "")
    two, one = r"^(\d+[a-z]*)[-–](\d+[a-z]*)$", r"^\d+[a-z]*$"
    return (
        F.when(t.isNull() | (t == ""), F.array().cast("array<string>"))
        .when(t.rlike(two), F.array(F.regexp_extract(t, two, 1), F.regexp_extract(t, two, 2)))
        .when(t.rlike(one), F.array(t))
    )


# Notes that stand for a unit no longer in force, and the long form of such a note.
REPEALED = ["(uchylony)", "(uchylona)", "(uchylone)", "(pominięte)", "(pominięty)", "(utraciłmoc)"]
REPEALED_LONG = r"(?s)^\s*\(\s*zawierający.*?[–-]\s*(uchylony|uchylone|uchylona|pominięte|pominięty|utracił moc)\s*\)\s*$"


def in_force(c: Column) -> Column:
    """Not merely a note that the unit was repealed or expired. Null counts as in force."""
    t = F.regexp_replace(F.regexp_replace(c, r"(?U)\s+", ""), r"[⁰¹²³⁴⁵⁶⁷⁸⁹]+⁾⁽?", "")
    return ~F.coalesce(t.isin(*REPEALED) | c.rlike(REPEALED_LONG), F.lit(False))


def ascending(ids: Column) -> Column:
    """Leading numbers of an array of ids never fall; an id without one counts as infinite. Empty arrays ascend."""
    lead = F.transform(ids, lambda x: F.coalesce(F.regexp_extract(x, r"^(\d+)", 1).try_cast("long"), F.lit(9223372036854775807).cast("long")))
    return lead == F.array_sort(lead)


def nonblank_lines(c: Column) -> Column:
    return F.filter(F.transform(F.split(c, r"\R"), lambda x: F.trim(x)), lambda x: x != "")
