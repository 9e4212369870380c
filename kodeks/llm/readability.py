"""Reading level of documents (problem 10).

A regularised softmax model over words, their character n-grams and sentence length gives every sentence a
distribution over levels; a document's level is read from the distribution of its sentences by a second, calibrated
softmax model. Both are fitted here on a bounded sample of rated documents. A word's part of the score is the same
wherever it stands, so it is computed once per distinct word and added up per sentence.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kodeks.llm.language import LanguageModel
from kodeks.session import spread_scan

#: Bounds of the fitting sample: rated documents, and sentences of each.
MOST_DOCUMENTS, MOST_SENTENCES = 1500, 12
LEVELS, DIMENSIONS = 5, 1024

_SENTENCE = re.compile(r"(?<=[.!?…])[\"”')\]]*\s+(?=[^\sa-ząćęłńóśźż])|\n+")
_TOKEN = re.compile(r"[^\W\d_]+|\d+|[–—;:,()]")
_ABBREVIATION = re.compile(r"\b(art|ust|pkt|poz|nr|r|par|lit|tj|np|m\.in|por|zob)\.$", re.IGNORECASE)
LENGTHS = np.array([3, 5, 7, 9, 12, 15, 20, 26, 34, 45])


def sentences(text: str) -> list[str]:
    """Sentences of a text; an abbreviation's point ends none, a line break does."""
    out: list[str] = []
    for part in _SENTENCE.split(text):
        if not (part := part.strip()):
            continue
        if out and _ABBREVIATION.search(out[-1]):
            out[-1] += " " + part
        else:
            out.append(part)
    return out


def _hash(feature: str) -> int:
    return xxhash.xxh32_intdigest(feature) % DIMENSIONS


def word_features(word: str) -> list[int]:
    w = f"^{word.lower()}$" if not word.isdigit() else f"^{'0' * len(word)}$"
    return [_hash("w" + w), _hash("w2" + w), *(_hash(w[i : i + n]) for n in (3, 4) for i in range(len(w) - n + 1))]


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit_softmax(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float, steps: int, rate: float) -> np.ndarray:
    """Weights of a softmax model with an L2 penalty, by gradient descent with Nesterov's momentum."""
    w, v = np.zeros((x.shape[1], LEVELS), np.float32), np.zeros((x.shape[1], LEVELS), np.float32)
    target = np.eye(LEVELS, dtype=np.float32)[y]
    weight = (weight / weight.sum()).astype(np.float32)[:, None]
    for t in range(steps):
        ahead = w + 0.9 * v
        g = x.T @ ((softmax(x @ ahead) - target) * weight) + ridge * ahead
        v = 0.9 * v - rate * g
        w = w + v
    return w


class LevelModel:
    def __init__(self, word_weights: np.ndarray, length_weights: np.ndarray, document_weights: np.ndarray) -> None:
        self.word_weights, self.length_weights, self.document_weights = word_weights, length_weights, document_weights
        self._cache: dict[str, np.ndarray] = {}

    @staticmethod
    def tokens(sentence: str) -> list[str]:
        return _TOKEN.findall(sentence)

    def word(self, w: str) -> np.ndarray:
        got = self._cache.get(w)
        if got is None:
            f = word_features(w)
            got = self.word_weights[f].sum(axis=0) / len(f) ** 0.5
            if len(self._cache) < 1 << 18:
                self._cache[w] = got
        return got

    def sentence_distributions(self, toks: list[list[str]]) -> np.ndarray:
        """Distribution over levels of every sentence; a sentence must hold a token."""
        sizes = np.array([len(t) for t in toks])
        codes, vocabulary = pd.factorize(np.array([w for t in toks for w in t], object))
        table = np.array([self.word(w) for w in vocabulary], np.float32)
        sums = np.add.reduceat(table[codes], np.cumsum(sizes) - sizes, axis=0)
        return softmax(sums / np.sqrt(sizes)[:, None] + self.length_weights[np.searchsorted(LENGTHS, sizes, side="right")])

    @staticmethod
    def document_features(p: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Mean distribution of a document's sentences, unweighted and by words, and the share of each level's sentences."""
        w = sizes / sizes.sum()
        votes = np.bincount(p.argmax(axis=1), minlength=LEVELS) / len(p)
        return np.concatenate([p.mean(axis=0), w @ p, votes, [1.0]]).astype(np.float32)

    def levels(self, texts: list[str], language: LanguageModel | None = None) -> list[int | None]:
        """Level of each text, None where it has no words or, with a language model, isn't Polish."""
        split = [[x for x in map(self.tokens, sentences(t)) if x] for t in texts]
        some = [i for i, own in enumerate(split) if own]
        if language and some:
            sizes = np.array([sum(map(len, split[i])) for i in some])
            codes, vocabulary = pd.factorize(np.array([w for i in some for x in split[i] for w in x], object))
            table = np.array([language.word(w) if w[0].isalpha() else np.zeros(len(language.languages)) for w in vocabulary])
            scores = np.add.reduceat(table[codes], np.cumsum(sizes) - sizes, axis=0)
            polish = (scores.argmax(axis=1) == language.languages.index("pl")) & scores.any(axis=1)
            some = [i for i, p in zip(some, polish, strict=True) if p]
        out: list[int | None] = [None] * len(texts)
        if not some:
            return out
        toks = [x for i in some for x in split[i]]
        p = self.sentence_distributions(toks)
        sizes, counts = np.array([len(x) for x in toks], float), [len(split[i]) for i in some]
        ends = np.cumsum(counts)
        x = np.stack([self.document_features(p[e - c : e], sizes[e - c : e]) for e, c in zip(ends, counts, strict=True)])
        for i, level in zip(some, (x @ self.document_weights).argmax(axis=1) + 1, strict=True):
            out[i] = int(level)
        return out


def fit(rated: list[tuple[str, list[int]]], ridge: float = 1e-4) -> LevelModel:
    """Fit on (text, ratings) pairs. Sentences take their document's level; a document rated unevenly counts for each of
    its ratings with less weight."""
    toks, labels, weights, doc_of = [], [], [], []
    for d, (text, ratings) in enumerate(rated):
        own = [x for x in map(LevelModel.tokens, sentences(text)) if x]
        step = max(1, len(own) // MOST_SENTENCES)
        for t in own[::step][:MOST_SENTENCES]:
            for r in set(ratings):
                toks.append(t)
                labels.append(r - 1)
                weights.append(ratings.count(r) / len(ratings))
                doc_of.append(d)
    if not toks:
        raise ValueError("no rated text has words")
    vocabulary = sorted({w for t in toks for w in t})
    row = {w: k for k, w in enumerate(vocabulary)}
    g = np.zeros((len(vocabulary), DIMENSIONS), np.float32)
    for w, k in row.items():
        f = word_features(w)
        np.add.at(g[k], f, 1 / len(f) ** 0.5)
    sizes = np.array([len(t) for t in toks])
    x = np.zeros((len(toks), DIMENSIONS + len(LENGTHS) + 1), np.float32)
    for i, t in enumerate(toks):
        x[i, :DIMENSIONS] = g[[row[w] for w in t]].sum(axis=0) / len(t) ** 0.5
    x[np.arange(len(toks)), DIMENSIONS + np.searchsorted(LENGTHS, sizes, side="right")] = 1
    y, wt = np.array(labels), np.array(weights)
    wt = wt / np.bincount(y, minlength=LEVELS).clip(1)[y] ** 0.5
    w = fit_softmax(x, y, wt, ridge, 150, 2.0)
    model = LevelModel(w[:DIMENSIONS], w[DIMENSIONS:], np.zeros((3 * LEVELS + 1, LEVELS), np.float32))
    feats, dl, dw = [], [], []
    for text, ratings in rated:
        own = [x for x in map(LevelModel.tokens, sentences(text)) if x]
        f = LevelModel.document_features(model.sentence_distributions(own), np.array([len(t) for t in own], float))
        for r in set(ratings):
            feats.append(f)
            dl.append(r - 1)
            dw.append(ratings.count(r) / len(ratings))
    model.document_weights = fit_softmax(np.stack(feats), np.array(dl), np.array(dw), 1e-4, 600, 3.0)
    return model


def rated_sample(docs: DataFrame, ratings: DataFrame, most: int = MOST_DOCUMENTS) -> list[tuple[str, list[int]]]:
    """At most ``most`` rated documents with text, in the order of a hash of their id; null ratings and ratings outside
    the scale don't count."""
    r = ratings.where(F.col("doc_id").isNotNull() & F.col("level").between(1, LEVELS)).groupBy("doc_id").agg(F.sort_array(F.collect_list(F.col("level").cast("int"))).alias("r_"))
    chosen = r.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = docs.select("doc_id", "text").where("length(trim(text)) > 0").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("r_").alias("r_")).orderBy("doc_id").collect()
    return [(x.text, list(x.r_)) for x in rows if LevelModel.tokens(x.text)]


def reading_levels(docs: DataFrame, ratings: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, level) of every document with a non-blank Polish text. Null, blank and letterless texts and texts in another
    language get no row. Documents are read once and moved by their id at most. Without any rating there is nothing to learn
    from and no row comes out."""
    rated = rated_sample(docs, ratings)
    kind = dict(docs.dtypes)[key]
    schema = f"key_ {kind}, level int"
    pairs = docs.select(F.col(key).alias("key_"), F.col(text).alias("text_")).where("key_ IS NOT NULL AND length(trim(text_)) > 0")
    if not rated:
        return docs.sparkSession.createDataFrame([], schema).withColumnRenamed("key_", key)
    model = fit(rated)
    weights = (model.word_weights, model.length_weights, model.document_weights)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        levels, language = LevelModel(*weights), LanguageModel()
        for b in batches:
            for at in range(0, len(b), 512):
                part = b.iloc[at : at + 512]
                got = levels.levels(list(part["text_"]), language)
                keep = [x is not None for x in got]
                yield pd.DataFrame({"key_": part["key_"][keep], "level": [x for x in got if x is not None]})

    return spread_scan(pairs, "key_").mapInPandas(run, schema).withColumnRenamed("key_", key)
