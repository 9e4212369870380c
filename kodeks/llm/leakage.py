"""Evaluation texts leaking into training text (problem 9).

Every window of ``WINDOW`` words of a document and of the items gets a SimHash of 64 bits; an item of fewer words is one
window of its own size. The fingerprints of the item
windows are indexed by RADIUS + 1 blocks of bits: two fingerprints within RADIUS bits agree in at least one block, so
the index returns all item windows within the radius. The windows found say where an item may lie; there an exact
alignment of words is scored with weighted shingles and decides.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kodeks.session import spread_scan

WINDOW, RADIUS, BITS = 8, 3, 64  # the window is the largest power of two that light changes leave whole
SLICE = 100_000  # windows fingerprinted at a time
PART = 500_000  # letters of text searched at a time, a longer text by itself
BAND = 16  # diagonals counted together
BLOCKS, BLOCK_BITS = RADIUS + 1, BITS // (RADIUS + 1)

_WORD = re.compile(r"[^\W_]+")
# Accented letters of Polish and the plain letters for them.
POLISH = str.maketrans("ąćęłńóśźż", "acelnoszz")


_INSIDE = re.compile(r"[\u00ad\u200b-\u200d\u2060\ufeff]")


@lru_cache(1 << 18)
def plain(word: str) -> str:
    """A word in lower case without accents."""
    w = word if word.isascii() else word.translate(POLISH)
    return w if w.isascii() else "".join(c for c in unicodedata.normalize("NFKD", w) if not unicodedata.combining(c)).translate(POLISH)


def raw_words(text: str | None) -> list[str]:
    """Words in lower case; punctuation, blanks and line breaks only part them."""
    if not text:
        return []
    t = text.lower()
    if not t.isascii():
        t = _INSIDE.sub("", t if unicodedata.is_normalized("NFC", t) else unicodedata.normalize("NFC", t))
    return _WORD.findall(t)


def words(text: str | None) -> list[str]:
    return [plain(w) for w in raw_words(text)]


def sign_rows(vocabulary: np.ndarray) -> np.ndarray:
    """A row of 64 signs for every word: the bits of its hash as +1 and -1."""
    h = np.array([xxhash.xxh64_intdigest(w) for w in vocabulary], dtype=np.uint64)
    return (np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).astype(np.int8) << 1) - 1


def simhash_windows(signs: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """Fingerprints of all windows of ``width`` consecutive rows. Sums are doubled where the width is a power of two."""
    if width & (width - 1):
        sums = np.cumsum(np.vstack([np.zeros((1, BITS), np.int32), signs]), axis=0, dtype=np.int32)
        signs = sums[width:] - sums[:-width]
    else:
        n = 1
        while n < width:
            signs = signs[:-n] + signs[n:]
            n *= 2
    return np.packbits(signs > 0, axis=1).reshape(-1).view(np.uint64)


class BlockIndex:
    """Multi-index over Hamming blocks."""

    def __init__(self, prints: np.ndarray) -> None:
        self.prints = prints
        self.tables = []
        for b in range(BLOCKS):
            key = self._block(prints, b)
            order = np.argsort(key, kind="stable").astype(np.int32)
            starts = np.searchsorted(key[order], np.arange((1 << BLOCK_BITS) + 1)).astype(np.int64)
            self.tables.append((order, starts))

    @staticmethod
    def _block(prints: np.ndarray, b: int) -> np.ndarray:
        return (prints >> np.uint64(b * BLOCK_BITS)) & np.uint64((1 << BLOCK_BITS) - 1)

    def within(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All (query, indexed) pairs of fingerprints that differ in at most RADIUS bits, each once per block that agrees."""
        qs, hits = [], []
        for b, (order, starts) in enumerate(self.tables):
            key = self._block(prints, b).astype(np.int64)
            lo, n = starts[key], starts[key + 1] - starts[key]
            some = np.flatnonzero(n)
            if not len(some):
                continue
            reps = n[some]
            q = np.repeat(some, reps)
            offset = np.arange(len(q)) - np.repeat(np.cumsum(reps) - reps, reps)
            x = order[np.repeat(lo[some], reps) + offset]
            near = np.bitwise_count(prints[q] ^ self.prints[x]) <= RADIUS
            qs.append(q[near])
            hits.append(x[near])
        if not qs:
            return np.empty(0, np.int64), np.empty(0, np.int32)
        return np.concatenate(qs), np.concatenate(hits)


def best_stretches(pairs: list[tuple[np.ndarray, np.ndarray]], cells: int = 1 << 17) -> list[tuple[int, int]]:
    """Of each (item, document) pair of word sequences the best local alignment, +1 for an equal word and -1 for a word
    changed, added or left out: its first and last item word (0, -1 where they share none).

    Pairs of like length are aligned together, one item word at a time for all of them. Runs of words that a document
    adds are settled with a running maximum, which a linear gap cost permits.
    """
    out: list[tuple[int, int]] = [(0, -1)] * len(pairs)
    order = sorted(range(len(pairs)), key=lambda k: len(pairs[k][1]))
    at = 0
    while at < len(order):
        wide = len(pairs[order[at]][1])
        k = at
        while k < len(order) and (k == at or (len(pairs[order[k]][1]) + 1) * (k - at + 1) <= cells and len(pairs[order[k]][1]) <= 2 * wide + 64):
            k += 1
        chunk, at = order[at:k], k
        m, n = max(len(pairs[c][0]) for c in chunk), max(len(pairs[c][1]) for c in chunk)
        items, docs = np.full((len(chunk), m), -2, np.int32), np.full((len(chunk), n), -3, np.int32)
        for r, c in enumerate(chunk):
            items[r, : len(pairs[c][0])], docs[r, : len(pairs[c][1])] = pairs[c]
        ramp, column = np.arange(n + 1, dtype=np.int32), np.arange(len(chunk))
        row, first = np.zeros((len(chunk), n + 1), np.int32), np.zeros((len(chunk), n + 1), np.int32)
        score, begin, end = np.zeros(len(chunk), np.int32), np.zeros(len(chunk), np.int32), np.full(len(chunk), -1, np.int32)
        for i in range(m):
            new, start = row - 1, first
            diagonal = row[:, :-1] + np.where(docs == items[:, i : i + 1], 1, -1)
            better = diagonal >= new[:, 1:]
            new[:, 1:] = np.where(better, diagonal, new[:, 1:])
            start = start.copy()
            start[:, 1:] = np.where(better, np.where(row[:, :-1] > 0, first[:, :-1], i), start[:, 1:])
            low = new <= 0
            new[low] = 0
            start[low] = i + 1
            lifted = new + ramp
            top = np.maximum.accumulate(lifted, axis=1)
            reach = top - ramp
            gap = reach > new
            if gap.any():
                source = np.maximum.accumulate(np.where(lifted >= top, ramp, 0), axis=1)
                start = np.where(gap, np.take_along_axis(start, source, 1), start)
                new = np.where(gap, reach, new)
            row, first = new, start
            j = row.argmax(axis=1)
            high = row[column, j]
            up = high > score
            score[up], begin[up], end[up] = high[up], first[column, j][up], i
        for r, c in enumerate(chunk):
            out[c] = (int(begin[r]), int(end[r]))
    return out


def shingle_similarity(item: np.ndarray, doc: np.ndarray, weight: np.ndarray, size: int = 2) -> float:
    """Weighted share of the item's word shingles that the document holds; a shingle weighs as much as its words. A single
    word is its own shingle."""
    size = min(size, len(item))
    if not size:
        return 0.0
    have = {tuple(doc[k : k + size]) for k in range(len(doc) - size + 1)}
    total = got = 0.0
    for k in range(len(item) - size + 1):
        w = float(weight[k : k + size].sum())
        total += w
        got += w * (tuple(item[k : k + size]) in have)
    return got / total if total else 0.0


class Windows:
    """Index of all item windows of one size."""

    def __init__(self, width: int, items: list[tuple[int, np.ndarray]], signs: np.ndarray) -> None:
        self.width = width
        prints = [simhash_windows(signs[x], width) for _, x in items]
        self.of = np.concatenate([np.full(len(p), k, np.int32) for (k, _), p in zip(items, prints, strict=True)])
        self.at = np.concatenate([np.arange(len(p), dtype=np.int64) for p in prints])
        self.index = BlockIndex(np.concatenate(prints))

    def hits(self, signs: np.ndarray, codes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in ``codes``, item, place in the item) of all windows within the radius that lie in one document."""
        w = self.width
        if len(codes) < w:
            none = np.empty(0, np.int64)
            return none, none, none
        # in slices, so that memory doesn't grow with the length of a document
        prints = np.concatenate([simhash_windows(signs[codes[k : k + SLICE + w - 1]], w) for k in range(0, len(codes) - w + 1, SLICE)])
        where = np.flatnonzero(doc[: len(prints)] == doc[w - 1 :])
        q, hit = self.index.within(prints[where])
        return where[q], self.of[hit].astype(np.int64), self.at[hit]


class LeakFinder:
    def __init__(self, items: list[tuple[int, str | None]], share: float, similarity: float, evidence: float) -> None:
        self.share, self.similarity, self.evidence = share, similarity, evidence
        coded = [(i, x) for i, t in items if (x := words(t))]
        self.ids = [i for i, _ in coded]
        vocabulary = sorted({w for _, x in coded for w in x})
        self.code = {w: k for k, w in enumerate(vocabulary)}
        self.coded = [np.array([self.code[w] for w in x], np.int32) for _, x in coded]
        self.weight = np.array([len(w) for w in vocabulary], float)
        self.length = np.array([len(x) for x in self.coded], np.int32)
        signs = sign_rows(np.array(vocabulary, object)) if vocabulary else np.empty((0, BITS), np.int8)
        by_width: dict[int, list[tuple[int, np.ndarray]]] = {}
        for k, x in enumerate(self.coded):
            by_width.setdefault(min(len(x), WINDOW), []).append((k, x))
        self.windows = [Windows(w, own, signs) for w, own in sorted(by_width.items())]

    def find(self, texts: list[str | None]) -> list[tuple[int, int, int, int, float]]:
        """(document's place in the list, item_id, first and last item word of the stretch, similarity)."""
        tokens = [raw_words(t) for t in texts]
        sizes = np.array([len(x) for x in tokens])
        flat = [w for x in tokens for w in x]
        if not flat or not self.windows:
            return []
        codes, vocabulary = pd.factorize(np.array(flat, object))
        folded, vocabulary = pd.factorize(np.array([plain(w) for w in vocabulary], object))
        codes = folded[codes]
        signs = sign_rows(vocabulary)
        ends = np.cumsum(sizes)
        doc = np.repeat(np.arange(len(texts)), sizes)
        spots: dict[tuple[int, int], list[int]] = {}
        for w in self.windows:
            pos, item, ipos = w.hits(signs, codes, doc)
            if len(pos):
                d = doc[pos]
                self._spots(spots, d, item, ipos, pos - (ends[d] - sizes[d]), int(sizes.max()), w.width)
        code_of = np.array([self.code.get(w, -1) for w in vocabulary], np.int32)
        places, pairs = [], []
        for (x, i), at in spots.items():
            n = int(self.length[i])
            slack = n // 4 + BAND  # words that changes may add to a stretch or take from it
            own = code_of[codes[ends[x] - sizes[x] : ends[x]]]
            at.sort()
            lo = hi = at[0]
            for k in [*at[1:], None]:
                if k is not None and k - hi <= slack:
                    hi = k
                    continue
                part = own[max(0, lo - slack) : hi + n + slack]
                if self._can_reach(i, part):
                    places.append((x, i))
                    pairs.append((self.coded[i], part))
                lo = hi = k
        out: dict[tuple[int, int], tuple[int, int, float]] = {}
        for (x, i), (item_words, part), (first, last) in zip(places, pairs, best_stretches(pairs), strict=True):
            # shorter stretches of a short item are stock phrases
            least = self.share * len(item_words) if len(item_words) >= WINDOW else len(item_words)
            if last - first + 1 >= least:
                stretch = item_words[first : last + 1]
                s = shingle_similarity(stretch, part, self.weight[stretch])
                if s >= self.similarity and ((x, i) not in out or (last - first, s) > (out[(x, i)][1] - out[(x, i)][0], out[(x, i)][2])):
                    out[(x, i)] = (first, last, s)
        return [(x, self.ids[i], f, e, s) for (x, i), (f, e, s) in out.items()]

    def _can_reach(self, i: int, part: np.ndarray) -> bool:
        """Whether any stretch of the least length could have the similarity asked for: a necessary condition of the final
        test, since that counts the same shingles. Weights above the similarity are summed up from the best start."""
        x = self.coded[i]
        if len(x) < 2:
            return True
        wide = np.int64(len(self.code) + 1)
        have = np.isin(x[:-1] * wide + x[1:], part[:-1] * wide + part[1:])
        w = self.weight[x[:-1]] + self.weight[x[1:]]
        gain = np.concatenate([[0.0], np.cumsum(w * (have - self.similarity))])
        least = max(1, int(np.ceil(self.share * len(x))) - 1) if len(x) >= WINDOW else len(x) - 1
        return bool((gain[least:] - np.minimum.accumulate(gain[: len(gain) - least]) >= -1e-9).any())

    def _spots(self, spots: dict[tuple[int, int], list[int]], d: np.ndarray, item: np.ndarray, ipos: np.ndarray, rel: np.ndarray, longest_doc: int, width: int) -> None:
        """Places of a document where an item may begin. The windows of a stretch lie near one diagonal: the item words
        that they cover along each are counted, in bands that overlap, so that a few added words don't part a stretch."""
        most = int(self.length.max())
        diagonal, wide, longest = rel - ipos, np.int64(longest_doc // BAND + 3), np.int64(most + WINDOW)
        negative = most // BAND + 2
        need = self.evidence * self.length
        for shift in (0, BAND // 2):
            key = ((d * len(self.ids) + item) * (wide + negative) + (diagonal + shift) // BAND + negative) * longest
            cells = np.unique((key + ipos)[:, None] + np.arange(width)) // longest
            keys, covered = np.unique(cells, return_counts=True)
            of = keys // (wide + negative)
            enough = covered >= need[of % len(self.ids)]
            for o, band in zip(of[enough], keys[enough] % (wide + negative), strict=True):
                spots.setdefault((int(o // len(self.ids)), int(o % len(self.ids))), []).append(int(band - negative) * BAND - shift)


@lru_cache(2)
def _finder(items: tuple, share: float, similarity: float, evidence: float) -> LeakFinder:
    """The index of a worker process, kept from task to task."""
    return LeakFinder(list(items), share, similarity, evidence)


def leaks(docs: DataFrame, key: str, text: str, items: DataFrame, share: float = 0.4, similarity: float = 0.72, evidence: float = 0.12, most_items: int = 100_000, most_letters: int = 100_000_000) -> DataFrame:
    """(key, item_id, first_word, last_word, similarity): every document that holds an item, or one connected stretch of
    at least ``share`` of its words, lightly altered at most. Items of fewer than WINDOW words must be held whole.

    A stretch is a candidate where windows within the Hamming radius cover ``evidence`` of the item's words. Null and
    empty texts hold nothing, and items without words are held by none; an item with several texts is held where one of
    them is. The items (their number and letters are checked) go to every worker; documents are read once and moved by
    their id at most, so no key or source can be hot.
    """
    kept = items.select("item_id", "text").where("item_id IS NOT NULL AND text IS NOT NULL").distinct()
    number, letters = kept.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    if number > most_items or letters > most_letters:
        raise ValueError(f"over {most_items} items or {most_letters} letters; search them in blocks")
    rows = tuple((r[0], r[1]) for r in kept.orderBy("item_id", "text").collect())
    kind = dict(docs.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        finder = _finder(rows, share, similarity, evidence)
        for b in batches:
            ids = b["key_"].to_numpy()
            texts = list(b["text_"])
            ends = np.cumsum([len(t) for t in texts]) // PART
            for part in np.unique(ends):
                at = int(np.searchsorted(ends, part))
                best: dict[tuple, tuple] = {}
                for x, i, f, e, s in finder.find(texts[at : int(np.searchsorted(ends, part, side="right"))]):
                    if s > best.get((x, i), (0, 0, 0.0))[2]:
                        best[(x, i)] = (f, e, s)
                yield pd.DataFrame([(ids[at + x], i, *v) for (x, i), v in best.items()], columns=["key_", "item_id", "first_word", "last_word", "similarity"])

    found = docs.select(F.col(key).alias("key_"), F.col(text).alias("text_")).where("key_ IS NOT NULL AND length(text_) > 0")
    found = spread_scan(found, "key_").mapInPandas(run, f"key_ {kind}, item_id bigint, first_word int, last_word int, similarity double")
    return found.withColumnRenamed("key_", key)
