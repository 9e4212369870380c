"""Markup residue (problem 2): which mark-up a content carries, and its clean text with structure kept.

One scan takes code blocks and formulas out first, since their inside is no mark-up, then reads the blocks (headings,
lists) and the rest of HTML, LaTeX, wiki text and Markdown. Suffix arrays over repeated strings, the method named for
this problem, are in ``boilerplate``; they find what pages share but tell nothing about the kind of a mark-up, and README
has the figures.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.entities import html5

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kodeks.session import spread

# Elements of HTML.
TAGS = "a abbr address article aside b big blockquote body br button caption center cite code col colgroup dd del details dfn div dl dt em fieldset figcaption figure font footer form h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label legend li link main mark menu meta nav ol option p param pre q s samp script section select small span strike strong style sub summary sup table tbody td textarea tfoot th thead time title tr tt u ul var"
_NAMES = "|".join(sorted(TAGS.split(), key=len, reverse=True))
_TAG = re.compile(rf"<(/?)({_NAMES})(?=[\s/>])[^<>]*>", re.IGNORECASE)
_ESCAPED_TAG = re.compile(rf"&lt;(?=/?(?:{_NAMES}|math|m[a-z]+)(?:\s|/|&gt;)|!--)((?:(?!&lt;).)*?)&gt;", re.IGNORECASE | re.DOTALL)
_REAL_TAG = re.compile(rf"</?(?:{_NAMES}|math)(?=[\s/>])|<!--", re.IGNORECASE)
_COMMENT = re.compile(r"<!--.*?(?:-->|\Z)", re.DOTALL)
_ENTITY = re.compile(r"&(?:#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});")

_CODE = [
    ("html", re.compile(r"<pre\b[^>]*>(?:\s*<code\b[^>]*>)?(.*?)(?:</code>\s*)?</pre\s*>", re.IGNORECASE | re.DOTALL)),
    ("latex", re.compile(r"\\begin\{(?:verbatim|lstlisting|minted)\*?\}(.*?)\\end\{(?:verbatim|lstlisting|minted)\*?\}", re.DOTALL)),
    ("markdown", re.compile(r"^[ ]{0,3}(?:```|~~~)[^\n]*\n(.*?)(?:^[ ]{0,3}(?:```|~~~)[ ]*$|\Z)", re.DOTALL | re.MULTILINE)),
    ("wiki", re.compile(r"<(?:syntaxhighlight|source|nowiki)\b[^>]*>(.*?)</(?:syntaxhighlight|source|nowiki)>", re.IGNORECASE | re.DOTALL)),
]
_FORMULA = [
    ("html", re.compile(r"<math\b[^>]*>(?=\s*<)(.*?)</math\s*>", re.IGNORECASE | re.DOTALL)),
    ("latex", re.compile(r"<math\b[^>]*>(.*?)</math\s*>", re.IGNORECASE | re.DOTALL)),
    ("latex", re.compile(r"\\begin\{((?:equation|align|gather|multline|eqnarray|displaymath|math)\*?)\}(.*?)\\end\{\1\}", re.DOTALL)),
    ("latex", re.compile(r"(?<![\\$\w])\$(?=[^\s$])([^$\n]*?[\\=^_<>+][^$\n]*?)(?<=[^\s\\])\$(?![\w$])")),
]
_LATEX_HEAD = re.compile(r"\\(?:part|chapter|(?:sub){0,2}section|(?:sub)?paragraph)\*?\{([^{}]*)\}")
_LATEX_LIST = re.compile(r"\\(?:begin|end)\{(?:itemize|enumerate|description)\*?\}(?:\[[^\]]*\])?|\\item\b(?:\[[^\]]*\])?[ \t]*")
_LATEX_NOTE = re.compile(r"\\(?:footnote|label|ref|cite|index|marginpar)\*?\{[^{}]*\}")
_LATEX_SPAN = re.compile(r"\\(?:[a-zA-Z]{2,})\*?(?:\[[^\]]*\])?\{([^{}]*)\}")
_WIKI_HEAD = re.compile(r"^[ \t]*(={2,6})[ \t]*([^=\n].*?)[ \t]*\1[ \t]*$", re.MULTILINE)
_WIKI_NOTE = re.compile(r"\{\{[^{}]*\}\}")
_WIKI_LINK = re.compile(r"\[\[(?:[^\[\]|]*\|)?([^\[\]|]*)\]\]|\[https?://\S+ ([^\]]*)\]")
_SETEXT = re.compile(r"^(?![-=]+[ \t]*$)[ \t]*(\S[^\n]*)\n[ ]{0,3}(?:-{3,}|={3,})[ \t]*$", re.MULTILINE)
_HASHES = re.compile(r"(?:^#+ +[^\n]+(?:\n|\Z))+", re.MULTILINE)
_MD_BULLETS = re.compile(r"^[ ]{0,3}[-+][ \t]+(?=\S)", re.MULTILINE)
_STARS = re.compile(r"^[ ]{0,3}\*+[ \t]+(?=\S)", re.MULTILINE)
_MD_LINK = re.compile(r"!?\[([^\[\]\n]*)\]\((?:[^()\s]|\([^()\s]*\))*(?:\s+\"[^\"]*\")?\)")
_MD_SPANS = [re.compile(p) for p in (r"(?<![\w*])\*(?=[^\s*])([^*\n]+?)(?<=[^\s*])\*(?![\w*])", r"(?<![\w_])_(?=[^\s_])([^_\n]+?)(?<=[^\s_])_(?![\w_])")]
_DISPLAYED = [("$$", "$$"), ("\\[", "\\]"), ("\\(", "\\)")]
_PARAGRAPHS = re.compile(r"(\n{2,})")
_MD_CODE = re.compile(r"(?<!`)(`{1,2})(?=[^`])([^\n]*?[^`])\1(?!`)")
_MD_QUOTE = re.compile(r"^[ ]{0,3}>[ \t]+(?=\S)", re.MULTILINE)


_ANY = re.compile(r"[<&\\`_~\[{$=#]|\*\S|''|^[ ]{0,3}(?:[-+*]\s|[-=]{3,})|^>", re.MULTILINE)


def between(t: str, opener: str, closer: str, make) -> str:
    """Every stretch between an opener and the next closer, not empty, replaced by ``make`` of its inside. One scan: where
    no closer follows, none follows any later opener."""
    out, at = [], 0
    while (i := t.find(opener, at)) >= 0 and (j := t.find(closer, i + len(opener) + 1)) >= 0:
        out += [t[at:i], make(t[i + len(opener) : j])]
        at = j + len(closer)
    return "".join(out) + t[at:] if out else t


def emphasised(t: str, mark: str, sizes: tuple[int, ...], make, whole_words: bool = False) -> str:
    """Spans between marks (``sizes`` times the sign) replaced by ``make`` of their inside. An opening mark has text right
    behind it and a closing one right before it, with ``whole_words`` none of the text around touches them, and no blank
    line lies between. One scan over the marks of every paragraph, whatever the length of a span."""
    if mark * sizes[-1] not in t:
        return t
    runs_of = re.compile(re.escape(mark) + (r"{%d,}" % sizes[-1] if len(sizes) > 1 else r"{%d}" % sizes[0]))
    parts = _PARAGRAPHS.split(t)
    for p, part in enumerate(parts):
        runs = [m.span() for m in runs_of.finditer(part)]
        if len(runs) < 2:
            continue
        closing: list[dict[int, int]] = [{} for _ in range(len(runs) + 1)]  # for every place the next mark that closes
        for k in range(len(runs) - 1, -1, -1):
            a, b = runs[k]
            closing[k] = dict(closing[k + 1])
            if a and not part[a - 1].isspace() and not (whole_words and b < len(part) and (part[b].isalnum() or part[b] == "_")):
                closing[k].update({n: k for n in sizes if b - a >= n})
        out, at, k = [], 0, 0
        while k < len(runs):
            a, b = runs[k]
            free = not (whole_words and a and (part[a - 1].isalnum() or part[a - 1] == "_"))
            size = next((n for n in sizes if free and b - a >= n and a + n < len(part) and not part[a + n].isspace() and n in closing[k + 1] and runs[closing[k + 1][n]][1] - n > a + n), None)
            if size is None:
                k += 1
                continue
            to = closing[k + 1][size]
            end = runs[to][1]
            out += [part[at:a], make(part[a + size : end - size])]
            at, k = end, to + 1
        parts[p] = "".join(out) + part[at:]
    return "".join(parts)


@dataclass
class Parsed:
    """Kinds of mark-up, clean text with structure, and plain text of the sentences alone."""

    kinds: set[tuple[str, str]] = field(default_factory=set)
    text: str = ""
    plain: str = ""
    ends_open: bool = False  # the text ends with a heading, code or formula, which need no full stop


def unescape_markup(text: str) -> str:
    """Escaped mark-up becomes what it stands for: as a whole where no real tag stands in the text, else tag by tag."""
    while _ESCAPED_TAG.search(text) and not _REAL_TAG.search(text):
        text = text.replace("&lt;", "<").replace("&gt;", ">").replace("&quot;", '"').replace("&amp;", "&")
    return text


def parse(source: str | None) -> Parsed:
    out = Parsed()
    if not source:
        return out
    if not _ANY.search(source):
        out.text = re.sub(r"[^\S\n]+", " ", source.strip())
        out.plain = re.sub(r"\s+", " ", source).strip()
        return out
    t = unescape_markup(source.replace("\r\n", "\n").translate({0: None, 1: None, 2: None}))
    kept: list[str] = []

    def keep(kind: str, inside: str) -> str:
        kept.append(f"```\n{inside.strip(chr(10))}\n```" if kind == "code" else f"${inside.strip()}$")
        return f"\n\0{len(kept) - 1}\0\n" if kind == "code" else f"\0{len(kept) - 1}\0"

    def code(lang: str):
        def sub(m: re.Match) -> str:
            out.kinds.add((lang, "code"))
            return keep("code", html.unescape(m[1]) if lang == "html" else m[1])

        return sub

    def formula(lang: str):
        def sub(m: re.Match) -> str:
            out.kinds.add((lang, "formula"))
            inside = m[m.lastindex or 0]
            return keep("formula", re.sub(r"\s+", " ", re.sub(r"<[^<>]*>", " ", inside)) if lang == "html" else inside)

        return sub

    def other(lang: str, element: str, to: str | None = None):
        def sub(m: re.Match) -> str:
            out.kinds.add((lang, element))
            return next((g for g in m.groups() if g is not None), "") if to is None else to

        return sub

    for lang, p in _CODE:
        if lang != "markdown" or "```" in t or "~~~" in t:
            t = p.sub(code(lang), t)
    if "`" in t:
        t = _MD_CODE.sub(lambda m: (out.kinds.add(("markdown", "other")), kept.append(m[2]), f"\0{len(kept) - 1}\0")[2], t)
    t = _ESCAPED_TAG.sub(lambda m: "<" + m[1].replace("&quot;", '"') + ">", t)
    if "<math" in t or "$" in t or "\\" in t or "<MATH" in t:
        def displayed(inside: str) -> str:
            out.kinds.add(("latex", "formula"))
            return keep("formula", inside)

        for lang, p in _FORMULA[:-1]:
            t = p.sub(formula(lang), t)
        for opener, closer in _DISPLAYED:
            t = between(t, opener, closer, displayed)
        t = _FORMULA[-1][1].sub(formula("latex"), t)

    if "<" in t:
        t = _COMMENT.sub(other("html", "other", ""), t)

        def tag(m: re.Match) -> str:
            name, closing = m[2].lower(), bool(m[1])
            if name in ("h1", "h2", "h3", "h4", "h5", "h6"):
                out.kinds.add(("html", "heading"))
                return "\n\n" if closing else "\n\n\1"
            if name in ("ul", "ol", "li", "dl", "dt", "dd", "menu"):
                out.kinds.add(("html", "list"))
                return "\n\2" if name in ("li", "dt", "dd") and not closing else "\n"
            out.kinds.add(("html", "other"))
            return "\n" if name in ("p", "div", "br", "tr", "table", "section", "article", "hr", "blockquote") else " " if name in ("td", "th") else ""

        t = _TAG.sub(tag, t)
    if "&" in t:

        def entity(m: re.Match) -> str:
            if m[0][1] == "#" or m[0][1:] in html5:
                out.kinds.add(("html", "other"))
                return html.unescape(m[0])
            return m[0]

        t = _ENTITY.sub(entity, _ENTITY.sub(entity, t) if "&amp;" in t else t)

    if "\\" in t:
        t = _LATEX_HEAD.sub(lambda m: other("latex", "heading", f"\n\n\1{m[1]}\n")(m), t)
        t = _LATEX_LIST.sub(lambda m: other("latex", "list", "\n\2" if m[0].startswith("\\item") else "\n")(m), t)
        t = _LATEX_NOTE.sub(other("latex", "other", ""), t)
        t = _LATEX_SPAN.sub(other("latex", "other"), t)

    body = t  # its marks at line starts are the source's own; those made above are \1 and \2
    t = _WIKI_HEAD.sub(lambda m: other("wiki", "heading", f"\n\1{m[2]}\n")(m), t)
    t = _WIKI_NOTE.sub(other("wiki", "other", ""), t)
    t = _WIKI_LINK.sub(other("wiki", "other"), t)

    def span(lang: str):
        def make(inside: str) -> str:
            out.kinds.add((lang, "other"))
            return inside

        return make

    t = emphasised(t, "'", (5, 3, 2), span("wiki"))
    t = _MD_LINK.sub(other("markdown", "other"), t)
    t = emphasised(t, "*", (2,), span("markdown"))
    t = emphasised(t, "_", (2,), span("markdown"), whole_words=True)
    t = emphasised(t, "~", (2,), span("markdown"))
    for p in _MD_SPANS:
        t = p.sub(other("markdown", "other"), t)

    def hashes(m: re.Match) -> str:
        """Several lines with one # each are a numbered list of wiki text, one line is a heading of Markdown."""
        lines = m[0].strip("\n").split("\n")
        numbered = len(lines) > 1 and all(x.startswith("# ") for x in lines)
        out.kinds.add(("wiki", "list") if numbered else ("markdown", "heading"))
        return "".join("\n" + ("\2" + x.lstrip("#").strip() if numbered else "\1" + x.strip("# ")) for x in lines) + "\n"

    t = _HASHES.sub(hashes, t)
    t = _SETEXT.sub(lambda m: other("markdown", "heading", f"\n\1{m[1]}\n")(m), t)
    if _MD_BULLETS.search(body):
        out.kinds.add(("markdown", "list"))
        t = _MD_BULLETS.sub("\2", t)
    if _STARS.search(body):  # a list of either language: that of the text around it
        md, wiki = (sum(1 for k in out.kinds if k[0] == x) for x in ("markdown", "wiki"))
        out.kinds.add(("wiki", "list") if wiki > md else ("markdown", "list"))
        t = _STARS.sub("\2", t)
    t = _MD_QUOTE.sub(other("markdown", "other", ""), t)

    # one form for all: "# " heading, "- " item, fenced code, $formula$
    lines: list[str] = []
    for line in t.split("\n"):
        s = re.sub(r"[^\S\n]+", " ", line.strip())
        if s or (lines and lines[-1]):
            lines.append(s)
    while lines and not lines[-1]:
        lines.pop()
    out.ends_open = bool(lines) and bool(re.match(r"[\1]|\0\d+\0$", lines[-1]))
    out.text = re.sub(r"\0(\d+)\0", lambda m: kept[int(m[1])], "\n".join(lines).replace("\1", "# ").replace("\2", "- "))
    plain = " ".join(s.lstrip("\2") for s in lines if s and s[0] != "\1")
    out.plain = re.sub(r"\0(\d+)\0", lambda m: "" if kept[int(m[1])].startswith("```") else kept[int(m[1])], plain).strip()
    return out


def _contents(df: DataFrame, key: str) -> DataFrame:
    """Contents of every key that hold text, in one row, spread by the key. Rows that were fetched again fall together."""
    texts = [F.nullif(c, F.lit("")).alias(f) for f, c in FIELDS.items()]
    return spread(df.where(F.col(key).isNotNull()).select(F.col(key).alias("key_"), *texts).distinct(), "key_")


def _fields(b: pd.DataFrame) -> Iterator[tuple]:
    """(key, field, text) of every content in a batch."""
    for row in b[["key_", *FIELDS]].itertuples(index=False, name=None):
        yield from ((row[0], f, t) for f, t in zip(FIELDS, row[1:], strict=True) if t)


FIELDS = {"question": "question_content", "answer": "answer_content"}


def markup_kinds(df: DataFrame, key: str = "nro") -> DataFrame:
    """(key, field, markup, element), one row per kind of mark-up. Null and empty contents have none."""
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(k, f, *x) for k, f, t in _fields(b) for x in sorted(parse(t).kinds)]
            yield pd.DataFrame(rows, columns=["key_", "field", "markup", "element"])

    return _contents(df, key).mapInPandas(run, f"key_ {kind}, field string, markup string, element string").distinct().withColumnRenamed("key_", key)


def clean_texts(df: DataFrame, key: str = "nro") -> DataFrame:
    """(key, field, text): clean text in which ``# `` marks a heading, ``- `` a list item, fences a code block and
    dollar signs a formula. A content that was fetched twice comes out once."""
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([(k, f, parse(t).text) for k, f, t in _fields(b)], columns=["key_", "field", "text"])

    return _contents(df, key).mapInPandas(run, f"key_ {kind}, field string, text string").distinct().withColumnRenamed("key_", key)
