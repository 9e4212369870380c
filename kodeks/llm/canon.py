"""Mapping freely typed titles to a reference list (problem 3).

The reference entries stand in a trie: entries are paths of words, words are paths of characters. A Levenshtein
automaton, simulated with one bit mask per number of errors, walks the characters and returns every word within a
distance that depends on length; the walk over words returns every entry within the sum of these. Alias paths begin
inside an entry and go round to where they began (object before subject), run words together or shorten them. Dates and
the short title settle which of the entries is meant; what fits no entry is reported with ''.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kodeks.functions.normal import MONTHS
from kodeks.llm.skeleton import consistent
from kodeks.session import spread

# Words around a title that don't tell which statute is meant.
GENERIC = "ustawa ustawy ustawie ustawe ust u art par paragraf pkt poz lit nr z ze zm r dn dnia roku w na mocy zob zobacz por patrz zgodnie jw ww j dalej tekst jednolity tj t przedmiotowa przedmiotowej cytowana powolana powyzsza niniejsza wskazana ta sama tamze tam ibidem zmian zmianami pozniejszymi pozn dz dziennik o cyt op".split()

_ESCAPE = re.compile(r"\\u([0-9a-fA-F]{4})|\\x([0-9a-fA-F]{2})")
_FOLD = str.maketrans("łŁ", "lL")


def fold(text: str) -> str:
    """Escapes decoded, one consistent form, lower case, no accents, single blanks."""
    t = _ESCAPE.sub(lambda m: chr(int(m[1] or m[2], 16)), text)
    t = unicodedata.normalize("NFD", consistent(t).translate(_FOLD).lower())
    return re.sub(r"\s+", " ", "".join(c for c in t if not unicodedata.combining(c))).strip()


def most_errors(n: int) -> int:
    """Edits allowed in a word of n letters."""
    return 0 if n < 2 else 1 if n < 6 else 2 if n < 9 else 3


class Trie:
    """Character trie of words, searched with a Levenshtein automaton."""

    def __init__(self) -> None:
        self.root: dict = {}

    def add(self, word: str, value: object) -> None:
        at = self.root
        for c in word:
            at = at.setdefault(c, {})
        at.setdefault("", []).append((word, value))

    def search(self, token: str, prefix: bool = False) -> list[tuple[object, int]]:
        """(value, errors) of every word within most_errors of the token; with ``prefix`` of every word that begins so.

        State k of the automaton is a bit mask: bit i is set where the first i letters of the token agree with the path
        so far with at most k errors. One step for a letter of the path moves all positions at once.
        """
        m, top = len(token), most_errors(len(token)) if not prefix else (0 if len(token) < 5 else 1 if len(token) < 7 else 2)
        mask: dict[str, int] = defaultdict(int)
        for i, c in enumerate(token):
            mask[c] |= 1 << i
        full = 1 << m
        start = [(1 << (k + 1)) - 1 for k in range(top + 1)]
        best: dict[object, int] = {}
        stack = [(self.root, start)]
        while stack:
            node, states = stack.pop()
            hit = next((k for k in range(top + 1) if states[k] & full), None)
            if hit is not None:
                if prefix:
                    deep = [node]
                    while deep:
                        x = deep.pop()
                        for w, v in x.get("", ()):
                            best[v] = min(best.get(v, 9), hit)
                        deep += [y for c, y in x.items() if c]
                else:
                    for w, v in node.get("", ()):
                        if hit <= most_errors(min(m, len(w))):
                            best[v] = min(best.get(v, 9), hit)
            for c, child in node.items():
                if not c:
                    continue
                bits, new, old = mask.get(c, 0), [], 0
                for k in range(top + 1):
                    s = (states[k] & bits) << 1
                    if k:
                        s |= states[k - 1] | states[k - 1] << 1 | old << 1  # letter too many, another letter, letter missing
                    old = s & (2 * full - 1)
                    new.append(old)
                if new[top]:
                    stack.append((child, new))
        return list(best.items())


_TITLE = re.compile(r"^ustawa z dnia (\d+) (\w+) (\d{4}) r\. o (.+)$")
_FOLDED_MONTHS = [fold(m) for m in MONTHS]


@dataclass
class Entry:
    eli: str
    day: int | None
    month: int | None
    year: int | None
    skrot: str


@dataclass
class Catalogue:
    """The reference list with its tries."""

    words: Trie = field(default_factory=Trie)
    months: Trie = field(default_factory=Trie)
    generic: Trie = field(default_factory=Trie)
    phrases: dict = field(default_factory=dict)  # word trie; key None holds the subjects that end there
    inside: dict[str, list[tuple[dict, tuple]]] = field(default_factory=lambda: defaultdict(list))  # nodes before a word
    by_subject: dict[str, list[Entry]] = field(default_factory=lambda: defaultdict(list))
    by_skrot: dict[str, set[str]] = field(default_factory=lambda: defaultdict(set))

    @staticmethod
    def of(rows: list[tuple[str | None, str | None, str | None]]) -> Catalogue:
        self = Catalogue()
        known: set[str] = set()

        def know(w: str) -> None:
            if w not in known:
                known.add(w)
                self.words.add("".join(w.split("+")), w)

        for eli, tytul, skrot in rows:
            if eli is None:
                continue
            if skrot and (s := bare(skrot)):
                self.by_skrot[s].add(eli)
            title = fold(tytul or "")
            m = _TITLE.match(title)
            if m and m[2] in _FOLDED_MONTHS:
                day, month, year, subject = int(m[1]), _FOLDED_MONTHS.index(m[2]) + 1, int(m[3]), m[4]
            else:  # a title of another form is matched as a whole
                day, month, year, rest = date_in(title)
                subject = " ".join(x.rstrip(".") for x in _TOKEN.findall(rest) if not x.isdigit())
            if not subject:
                continue
            self.by_subject[subject].append(Entry(eli, day, month, year, bare(skrot or "")))
            w = subject.split(" ")
            at = self.phrases
            for i, x in enumerate(w):
                know(x)
                know(f"{x}+{w[(i + 1) % len(w)]}")
                if x not in at:
                    at[x] = {}
                    if i:
                        self.inside[x].append((at, tuple(w[:i])))
                at = at[x]
            at.setdefault(None, set()).add(subject)
            know(f"o+{w[0]}")
        for i, x in enumerate(_FOLDED_MONTHS, 1):
            self.months.add(x, i)
        for x in GENERIC:
            self.generic.add(x, x)
        return self


def bare(skrot: str) -> str:
    return re.sub(r"[^a-z0-9]", "", fold(skrot))


_DMY = re.compile(r"(?<!\d)(\d{1,2})[./-] ?(\d{1,2})[./ -] ?((?:19|20)\d{2})(?!\d)")
_WORDED = re.compile(r"(?<!\d)(\d{1,2})\.? ?([a-z]{3,14}) ?((?:19|20)\d{2})(?!\d)")
_YEAR = re.compile(r"(?<!\d)((?:19|20)\d{2})(?!\d)")
_TOKEN = re.compile(r"[a-z]+\.?|\d+")
_DATE_BEFORE, _DATE_AFTER = re.compile(r"\bz (?:dnia |dn\.? ?)?$"), re.compile(r"^ ?r\b\.?")


def date_in(t: str, months: Trie | None = None) -> tuple[int | None, int | None, int | None, str]:
    """Day, month, year and the text without them; names of months may be misspelt where their trie is given."""
    rest = lambda m: _DATE_BEFORE.sub("", t[: m.start()]) + " " + _DATE_AFTER.sub("", t[m.end() :])
    if m := _DMY.search(t):
        if 1 <= int(m[1]) <= 31 and 1 <= int(m[2]) <= 12:
            return int(m[1]), int(m[2]), int(m[3]), rest(m)
    for m in _WORDED.finditer(t):
        got = months.search(m[2]) if months else [(_FOLDED_MONTHS.index(m[2]) + 1, 0)] if m[2] in _FOLDED_MONTHS else []
        if got:
            return int(m[1]), min(got, key=lambda x: x[1])[0], int(m[3]), rest(m)
    if m := _YEAR.search(t):
        return None, None, int(m[1]), rest(m)
    return None, None, None, t


class State(NamedTuple):
    """A place in the trie of entries. On an alias path, ``before`` holds the words of the entry it began behind; once the
    entry's end is reached, ``ends`` names it and these words are still to come."""

    node: dict
    before: tuple[str, ...] | None = None
    ends: frozenset = frozenset()

    def complete(self) -> Iterable[str]:
        """Subjects whose path ends here."""
        return self.node.get(None, ()) if self.before is None else () if self.before else self.ends


def walk(states: list[State], words: Iterable[str]) -> list[State]:
    """The places that are reached from ``states`` by words."""
    for x in words:
        to = []
        for at in states:
            if at.ends:
                if at.before and at.before[0] == x:
                    to.append(State({}, at.before[1:], at.ends))
                continue
            if x in at.node:
                to.append(State(at.node[x], at.before))
            if at.before and at.before[0] == x and (ends := at.node.get(None)):
                to.append(State({}, at.before[1:], frozenset(ends)))
        states = to
    return states


class Matcher:
    def __init__(self, catalogue: Catalogue) -> None:
        self.c = catalogue
        self.near = lru_cache(1 << 18)(self._near)
        self.is_generic = lru_cache(1 << 16)(self._is_generic)

    def _near(self, token: str) -> list[tuple[tuple[str, ...], int]]:
        """Words, or words run together, that a token may stand for."""
        name = token.rstrip(".")
        got = {(v, k) for v, k in self.c.words.search(name)}
        if token.endswith(".") and len(name) >= 2:
            # an abbreviation of words run together reaches into the second
            got |= {(v, k) for v, k in self.c.words.search(name, prefix=True) if len(name) > v.find("+") + 2}
        if not got and name.endswith("z") and len(name) > 4:  # "z" of the date run into the word
            got = {(v, k + 1) for v, k in self.c.words.search(name[:-1])}
        best: dict[str, int] = {}
        for v, k in got:
            best[v] = min(best.get(v, 9), k)
        return [(tuple(v.split("+")), k) for v, k in best.items()]

    def _is_generic(self, token: str) -> bool:
        name = token.rstrip(".")
        return len(name) < 2 or bool(self.c.generic.search(name)) or any(k <= 1 for v, k in self.c.months.search(name))

    def subjects(self, tokens: list[str]) -> dict[str, int]:
        """Subjects whose words, in the order of one of their paths, stand among the tokens, with their errors."""
        found: dict[str, int] = {}
        n = len(tokens)
        # a token may have been torn in two by a stray blank
        options = [[(w, k, 1) for w, k in self.near(tokens[i])] + ([(w, k + 1, 2) for w, k in self.near(tokens[i] + tokens[i + 1]) if tokens[i].isalpha() and len(tokens[i + 1]) > 0] if i + 1 < n and tokens[i].isalpha() and tokens[i + 1][0].isalpha() else []) for i in range(n)]
        stack = [(i, State(self.c.phrases), 0, True) for i in range(n)]
        for i in range(n):  # alias paths begin inside an entry
            for words, k, used in options[i]:
                starts = [State(node, before) for node, before in self.c.inside.get(words[0], ())]
                stack += [(i + used, x, k + (len(words) > 1), False) for x in walk(starts, words)]
        while stack:
            i, state, errors, first = stack.pop()
            for s in state.complete():
                if errors < found.get(s, 99):
                    found[s] = errors
            if i >= n:
                continue
            for words, k, used in options[i]:
                w = words[1:] if first and words[0] == "o" and len(words) > 1 else words
                stack += [(i + used, x, errors + k + (len(words) > 1), False) for x in walk([state], w)]
        return found

    def _read(self, tytul: str | None) -> tuple[tuple[int | None, int | None, int | None], list[str], dict[str, int]]:
        """Date and words of a typed title, and the subjects within the distance with their errors."""
        t = re.sub(r"\b(art|par|pkt|poz|ust|lit|nr|dz)\.? ?\d+\w?", " ", re.sub(r"(?<=[a-z])(?=\d)|(?<=\d)(?=[a-z])", " ", fold(tytul or "")))
        day, month, year, rest = date_in(t, self.c.months)
        tokens = _TOKEN.findall(rest)
        return (day, month, year), tokens, self.subjects([x for x in tokens if not x.isdigit()])

    def candidates(self, tytul: str | None) -> list[tuple[str, int]]:
        """(eli, errors) of all entries within the distance, whatever their date."""
        found = self._read(tytul)[2]
        best: dict[str, int] = {}
        for s, k in found.items():
            for e in self.c.by_subject[s]:
                best[e.eli] = min(best.get(e.eli, 99), k)
        return sorted(best.items())

    def match(self, tytul: str | None, skrot: str | None) -> str:
        """eli of the entry that is meant, or ''."""
        by_skrot = self.c.by_skrot.get(bare(skrot), set()) if skrot else set()
        (day, month, year), tokens, found = self._read(tytul)
        if not found:
            # nothing but general words: the short title alone decides
            vague = all(x.isdigit() or self.is_generic(x) for x in tokens)
            return next(iter(by_skrot)) if vague and len(by_skrot) == 1 else ""
        least = min(found.values())
        subjects = [s for s, k in found.items() if k == least]
        # a subject that lies within a longer one of as few errors gives way to it
        subjects = [s for s in subjects if not any(s != x and s in x for x in subjects)]
        entries = [e for s in subjects for e in self.c.by_subject[s]]
        if year is not None:
            entries = [e for e in entries if e.year == year]
        if day is not None and len(entries) > 1:
            entries = [e for e in entries if (e.day, e.month) == (day, month)]
        if len(entries) > 1 and by_skrot:
            entries = [e for e in entries if e.eli in by_skrot]
        return entries[0].eli if len(entries) == 1 else ""


@lru_cache(2)
def _matcher(entries: tuple) -> tuple[Matcher, Callable, Callable]:
    """Tries and memory of a worker process, kept from task to task."""
    m = Matcher(Catalogue.of(list(entries)))
    return m, lru_cache(1 << 16)(m.match), lru_cache(1 << 16)(m.candidates)


def _catalogue(catalogue: DataFrame, most_entries: int, most_letters: int) -> tuple:
    """The entries, if their number and letters are within bounds; they go to every worker."""
    known = catalogue.select("eli", "tytul", "skrot").where("eli IS NOT NULL").distinct()
    number, letters = known.agg(F.count("*"), F.coalesce(F.sum(F.length("tytul")), F.lit(0))).first()
    if number > most_entries or letters > most_letters:
        raise ValueError(f"the reference list has over {most_entries} entries or {most_letters} letters; it would not fit every worker")
    return tuple(tuple(r) for r in known.orderBy("eli", "tytul", "skrot").collect())


def _titles_once(df: DataFrame, key: str) -> DataFrame:
    """One row per key, spread by it. Of rows with the same key, which meet before they are shuffled, the first in the
    order of (tytul, skrot) counts."""
    keyed = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key_")).agg(F.min(F.struct("tytul", "skrot")).alias("v"))
    return spread(keyed.select("key_", "v.tytul", "v.skrot"), "key_")


def map_titles(df: DataFrame, key: str, catalogue: DataFrame, most_entries: int = 200_000, most_letters: int = 20_000_000) -> DataFrame:
    """key and eli, one row per key: the entry of ``catalogue`` (eli, tytul, skrot) that tytul and skrot mean, '' where
    there is none or it can't be told. Null and empty titles are told by skrot alone."""
    entries, kind = _catalogue(catalogue, most_entries, most_letters), dict(df.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        match = _matcher(entries)[1]
        for b in batches:
            yield pd.DataFrame({"key_": b["key_"], "eli": [match(t, s) for t, s in zip(b["tytul"], b["skrot"], strict=True)]})

    return _titles_once(df, key).mapInPandas(run, f"key_ {kind}, eli string").withColumnRenamed("key_", key)


def title_candidates(df: DataFrame, key: str, catalogue: DataFrame, most_entries: int = 200_000, most_letters: int = 20_000_000) -> DataFrame:
    """(key, eli, errors) of all entries whose subject stands in tytul within the distance. Titles without a candidate and
    null titles have no row."""
    entries, kind = _catalogue(catalogue, most_entries, most_letters), dict(df.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        near = _matcher(entries)[2]
        for b in batches:
            rows = [(k, *x) for k, t in zip(b["key_"], b["tytul"], strict=True) for x in near(t)]
            yield pd.DataFrame(rows, columns=["key_", "eli", "errors"])

    return _titles_once(df, key).mapInPandas(run, f"key_ {kind}, eli string, errors int").withColumnRenamed("key_", key)
