"""Broken prompt and response pairs (problem 1).

Posteriors of the language of prompt and response from a character n-gram naive Bayes model are compared. Truncation is
read from the likelihood that a text ends after its last words: n-grams of word endings are counted over all contents,
inside and at the end of sentences. Copies are answers whose words the question already holds, in order; refusals are
answers of nothing but declining sentences.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kodeks.llm.language import LanguageModel
from kodeks.llm.leakage import POLISH
from kodeks.llm.leakage import plain as plain_word
from kodeks.llm.markup import parse
from kodeks.session import cut, spread

# Entries that stand for no answer.
FILLERS = {"", "brak", "brakodpowiedzi", "brakdanych", "nd", "bd", "n d", "niedotyczy", "xxx", "xx", "x", "tbd", "todo", "test", "null", "none", "na", "puste", "wtrakcie", "douzupelnienia", "wprzygotowaniu", "odpowiedz"}
# Words that name a part of the pair.
LABELS = r"^(?:odpowied[zź]|pytanie(?: brzmia[lł]o)?|tre[sś][cć](?: pytania)?|pytaj[aą]cy(?: pisze)?|zapytanie|dotyczy|cytat|w odpowiedzi na pytanie|odp|pyt|q|a|re|fwd)\s*[:.\-–—]\s*"
# Ways to decline, as stems of words in their order.
DECLINES = [
    r"nie (?:jestem|jestesmy) w stanie", r"wykracza poza to", r"brak (?:mi|nam) (?:uprawnien|kompetencji|wiedzy)", r"(?:moja|nasza) rola nie obejmuje", r"nie (?:moge|mozemy) (?:udzielic|odpowiedziec|pomoc|doradzac|doradzic|wypowiadac|zajac|zajmowac|komentowac|oceniac)",
    r"odmawia(?:m|my) (?:zajecia|odpowiedzi|udzielenia|komentarza|pomocy)", r"nie wolno (?:mi|nam)", r"(?:pozostawiam|zostawiam|pozostawiamy) (?:specjalistom|to|bez|innym|otwarte)", r"pytanie (?:zostawiam|pozostawiam)", r"nie podejmuj(?:e|emy) sie", r"(?:musze|musimy|wole|pragne) (?:pozostawic|odmowic|zostawic|sie powstrzymac|pominac)",
    r"zabrania(?:ja)? (?:mi|nam)", r"nie (?:zabierac|zabieram|zabieramy) (?:glosu|stanowiska)", r"nie udziela(?:m|my)", r"nie (?:odpowiem|odpowiemy|odpowiadam|pomoge|pomozemy|doradze|komentuje|komentujemy|wypowiadam|wypowiem|zajmuje sie|zajmujemy sie|oceniam|rozstrzygam)", r"bez merytorycznej odpowiedzi", r"(?:powstrzymam|powstrzymuje|wstrzymam|wstrzymuje|uchylam|uchyle) sie od", r"nie chce (?:sie wypowiadac|odpowiadac)", r"nie (?:posiadam|mam) (?:uprawnien|kompetencji|prawa|mozliwosci|upowaznienia)", r"i cannot|i can t|unable to",
]
# Courtesies that answer nothing.
COURTESIES = [
    r"^przepraszam", r"^przykro (?:mi|nam)", r"^niestety$", r"^dziekuj", r"^rozumiem", r"nadzieje na zrozumienie", r"^prosze (?:zwrocic|skierowac|skontaktowac|o zrozumienie|poradzic|udac|pytac)", r"^suger(?:uje|ujemy) kontakt", r"^(?:chetnie|z checia) pomog", r"^(?:szanown|dzien dobry|witam|z powazaniem|pozdrawiam)", r"^radze (?:zwrocic|skontaktowac|zapytac)", r"^zachecam do kontaktu", r"^polecam (?:kontakt|zwrocic|prawnika)", r"^w (?:tej|takiej) sprawie prosze", r"^najlepiej (?:zapytac|zwrocic)", r"^z przykroscia",
]
# Greetings before the text proper.
SALUTATION = re.compile(r"^\s*(?:szanown[a-z]+ (?:pani[a-z]*|panie|pan|państwo)(?: [a-zł]+)?|dzień dobry|witam(?: serdecznie| państwa)?|drog[a-z]+ (?:pani[a-z]*|panie|państwo)|dobry wieczór)\s*[,!.]?\s*", re.IGNORECASE)
_ABBREVIATED = re.compile(r"(?:^|[\s(])(?:art|ust|pkt|poz|nr|lit|par|z dn|tj|m\.in|np|por|zob|tzw|ok|ww|św|im|ul|godz|str|s|t|rozdz|dz\. u)\.$", re.IGNORECASE)
_TERMINAL = re.compile(r"[.!?][\"”’')\]»*_]*$")
_ELLIPSIS = re.compile(r"[(\[]?\s*(?:…|\.{3,})[.…\s\"”’')\]»*_]*$")
_SENTENCE = re.compile(r"(?<=[.!?…])[\"”’')\]]*\s+(?=[^\sa-ząćęłńóśźż])|\n+")
_QUOTED = re.compile(r"„[^„”]*”|\"[^\"]*\"|«[^«»]*»")
_END_FORMULA = re.compile(r"(?<=[.!?\"”’')\]])(?:\s*\$[^$]+\$)+\s*$")
_DECLINES, _COURTESIES = re.compile("|".join(DECLINES)), re.compile("|".join(COURTESIES))
_WORD = re.compile(r"[^\W_]+")
ORDERS = (1, 2, 3)


def folded(text: str) -> list[str]:
    """Words in lower case without accents."""
    t = text.lower().translate(POLISH)
    return _WORD.findall(t) if t.isascii() else [plain_word(w) for w in _WORD.findall(text.lower())]


def abbreviated(text: str) -> bool:
    """Ends with an abbreviation; the tail is longer than any of them."""
    return text.endswith(".") and bool(_ABBREVIATED.search(text[-16:]))


def sentences(text: str) -> list[str]:
    out: list[str] = []
    for s in _SENTENCE.split(text):
        if s and (s := s.strip()):
            if out and abbreviated(out[-1]):
                out[-1] += " " + s
            else:
                out.append(s)
    return out


def before_ellipsis(text: str) -> str:
    """The text without an ellipsis at its end and the bracket opened for it: it closes no sentence, what stands before
    it may."""
    while (t := _ELLIPSIS.sub("", text).rstrip()) != text:
        text = t
    return text


def is_filler(text: str) -> bool:
    """Nothing but blanks, signs or a filler."""
    return "".join(folded(text)) in FILLERS or " ".join(folded(text)) in FILLERS


def is_refusal(text: str) -> bool:
    """Every sentence declines or is a courtesy, and one declines."""
    declined = False
    for s in sentences(text):
        t = " ".join(folded(s))
        if _DECLINES.search(t):
            declined = True
        elif t and not _COURTESIES.search(t):
            return False
    return declined


def common_length(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, exact at every length: a bit for each word of ``a``, a step for each of
    ``b`` (Hyyrö's bit-parallel algorithm)."""
    bits: dict[str, int] = {}
    for i, x in enumerate(a):
        bits[x] = bits.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for x in b:
        if m := bits.get(x):
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def says_no_more(question: str, answer: str) -> bool:
    """The answer's words stand in the question, in order, but for a tenth of them: a copy, perhaps altered, shortened
    or labelled."""
    a = answer
    while (b := re.sub(LABELS, "", a.strip(" \"„”'«»"), flags=re.IGNORECASE)) != a:
        a = b
    q, w = folded(question), folded(a)
    if len(w) < 4 or not q:
        return False
    most = max(1, len(w) // 8)
    have = set(q)
    if sum(x not in have for x in w) > most or sum((Counter(w) - Counter(q)).values()) > most:
        return False
    if q == w:
        return True
    return len(w) - common_length(q, w) <= most


def language_differs(prompt: dict[str, float], response: dict[str, float]) -> float:
    """Probability that prompt and response are in different languages."""
    return 1 - sum(p * response.get(k, 0.0) for k, p in prompt.items())


def is_foreign(model: LanguageModel, question: str, answer: str, own: str = "pl") -> bool:
    """The response, its salutation and quotations aside, isn't in the corpus's own language.

    The posteriors of prompt and response are compared. Where they differ, the likelier language of the response needs
    odds of e^4 against the own one; a response in the language of a foreign prompt is a defect too, but as the pair
    agrees it needs odds of e^8. A text is foreign as a whole only if most of its letters are in foreign sentences.
    """
    t = SALUTATION.sub("", answer)
    if len(bare := _QUOTED.sub(" ", t)) > 25:
        t = bare
    s = model.scores(t)
    margin = float(s.max() - s[model.languages.index(own)])
    if margin < 4:
        return False
    differs = language_differs(model.posterior(question), model.posterior(t))
    if margin < (4 if differs >= 0.5 else 8):
        return False
    parts = [(len(x), model.language(x)) for x in sentences(t)]
    return sum(n for n, x in parts if x not in (own, None)) * 2 > sum(n for n, _ in parts)


def end_key(words: list[str], n: int) -> str:
    return " ".join(words[-n:])


def ending_counts(texts: Iterable[str], orders: tuple[int, ...] = ORDERS) -> tuple[Counter, Counter]:
    """How often an n-gram of words ends a sentence, and how often more follows it."""
    ends: Counter = Counter()
    on: Counter = Counter()
    for t in texts:
        for s in sentences(t):
            u = s.rstrip("\"”’')]")
            closed = u[-1:] in (".", "!", "?") and not u.endswith("...") and not abbreviated(s)
            w = folded(s)
            for n in orders:
                runs = [" ".join(x) for x in zip(*(w[k:] for k in range(n)), strict=False)] if n > 1 else w
                if runs and closed:
                    ends[runs[-1]] += 1
                on.update(runs[:-1])
    return ends, on


def gram_hash(gram: str) -> int:
    """64 signed bits that stand for an n-gram in shuffles."""
    return xxhash.xxh64_intdigest(gram) - (1 << 63)


def _plain(df: DataFrame, key: str) -> DataFrame:
    """Plain question and answer of every key. Of contents fetched again the first in order counts."""
    kind = dict(df.dtypes)[key]
    one = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(F.coalesce("question_content", F.lit("")).alias("q"), F.coalesce("answer_content", F.lit("")).alias("a"))).alias("x")).select(key, "x.q", "x.a")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            q, a = [parse(t) for t in b["q"]], [parse(t) for t in b["a"]]
            yield pd.DataFrame({key: b[key], "question": [x.plain for x in q], "answer": [x.plain for x in a], "answer_text": [x.text for x in a], "ends_open": [x.ends_open for x in a]})

    return spread(one, key).mapInPandas(run, f"{key} {kind}, question string, answer string, answer_text string, ends_open boolean")


def defects(df: DataFrame, key: str = "nro", least_end: float = 0.02, least_before: int = 10, most_asked: int = 2_000_000) -> DataFrame:
    """(key, defect) of every pair whose answer is unusable: empty, refusal, copy, other_language or truncated, in this
    order of precedence.

    A null answer is empty. Pairs fetched again count once. Only answers without a closing sign are held against the
    ending counts, which are taken over all contents and summed in every batch before the shuffle. A text breaks off if
    its last words never end a sentence elsewhere, or do in less than ``least_end`` of all cases, or if its last word
    never follows the word before it, which stands ``least_before`` times or more.

    Where the n-grams asked for are at most ``most_asked`` (their number is checked, 8 bytes each), they go to the tasks
    and only they are counted; else all are, which gives the same.
    """
    pairs = cut(_plain(df, key))
    kind = dict(df.dtypes)[key]
    asked_columns = ["e1", "e2", "e3", "before"]

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = LanguageModel()
        for b in batches:
            out = []
            for k, q, a, full, is_open in b[[key, "question", "answer", "answer_text", "ends_open"]].itertuples(index=False):
                defect, grams = None, [None] * 4
                if is_filler(full):
                    defect = "empty"
                elif is_refusal(a):
                    defect = "refusal"
                elif a and says_no_more(q, a):
                    defect = "copy"
                elif a and is_foreign(model, q, a):
                    defect = "other_language"
                elif a and not is_open:
                    t = before_ellipsis(_END_FORMULA.sub("", a).rstrip())
                    last = t.rstrip("\"”’')]»*_ ")
                    if abbreviated(last):
                        defect = "truncated"
                    elif not _TERMINAL.search(t):
                        w = folded((sentences(t) or [""])[-1])
                        if not w or last.endswith((",", "-", "–", "(")):
                            defect = "truncated"
                        else:
                            grams = [gram_hash(end_key(w, n)) if len(w) >= n else None for n in ORDERS]
                            grams.append(gram_hash(w[-2]) if len(w) > 1 and w[-1].isalpha() else None)
                if defect or grams[0] is not None:
                    out.append((k, defect, *grams))
            got = pd.DataFrame(out, columns=[key, "defect", *asked_columns], dtype=object)  # 64 bits don't fit a float
            yield got.astype({c: "Int64" for c in asked_columns})

    judged = cut(pairs.mapInPandas(judge, f"{key} {kind}, defect string, e1 long, e2 long, e3 long, before long"))
    sure = judged.where("defect IS NOT NULL").select(key, "defect")
    slots = F.array(*[F.struct(F.lit(c).alias("slot"), F.col(c).alias("gram")) for c in asked_columns])
    asked = judged.where("defect IS NULL").select(key, F.explode(slots).alias("x")).select(key, "x.*").where("gram IS NOT NULL")
    few = asked.select("gram").distinct().limit(most_asked + 1).toPandas()["gram"].to_numpy(np.int64)
    only = np.sort(few) if len(few) <= most_asked else None

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wanted = None if only is None else set(only.tolist())
        for b in batches:
            ends, on = ending_counts(t for col in ("question", "answer") for t in b[col] if t)
            hashed = ((gram_hash(g), g) for g in on.keys() | ends.keys())
            rows = [(h, ends[g], on[g]) for h, g in hashed if wanted is None or h in wanted]
            yield pd.DataFrame(rows, columns=["gram", "ends", "goes_on"])

    counted = pairs.mapInPandas(count, "gram long, ends long, goes_on long")
    grams = counted.groupBy("gram").agg(F.sum("ends").alias("ends"), F.sum("goes_on").alias("goes_on"))
    none = F.lit(0)
    found = F.struct(F.coalesce("ends", none).alias("ends"), F.coalesce("goes_on", none).alias("on"))
    seen = asked.join(grams, "gram", "left").groupBy(key).agg(*[F.max(F.when(F.col("slot") == c, found)).alias(c) for c in asked_columns])

    def share(n: int):
        """The longest n-gram that was seen decides, backing off."""
        g = F.col(f"e{n}")
        return F.when((g["ends"] + g["on"]) >= (3 if n > 1 else 1), g["ends"] / (g["ends"] + g["on"]))

    total = lambda c: F.coalesce(F.col(c)["ends"] + F.col(c)["on"], none)
    likely = F.coalesce(share(3), share(2), share(1), F.lit(0.0))
    # a word nobody else writes, or nobody writes after that word, was cut itself
    strange = (F.coalesce(F.col("e1")["ends"], none) == 0) | ((total("e2") == 0) & (total("before") >= least_before))
    return sure.unionByName(seen.where((likely < least_end) | strange).select(key, F.lit("truncated").alias("defect")))
