"""Boilerplate: long strings of tokens that pages share are removed, unique runs are kept (problem 2).

The token streams of all pages of a host make one sequence. Its suffix array is sparse and distributed: suffixes are
put into buckets by their first ``least`` tokens, so that all suffixes with a common prefix of ``least`` tokens or more
are in one bucket, wherever their pages lie. A bucket with suffixes of distinct pages is a repeated string, and the
tokens that repeated strings cover are exactly those that a full suffix array with that least length would cover.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(r"\w+|[^\w\s]")
SALTS = 16  # parts of a bucket that many pages share
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def prefix_prints(texts: list[str], least: int) -> list[np.ndarray]:
    """A print of the first ``least`` tokens of every suffix that is long enough, per text."""
    tokens = [_TOKEN.findall(t) for t in texts]
    sizes = [len(x) for x in tokens]
    if not sum(sizes):
        return [np.empty(0, np.int64) for _ in texts]
    codes, vocabulary = pd.factorize(np.array([w for x in tokens for w in x], object))
    values = np.array([xxhash.xxh64_intdigest(w) for w in vocabulary], np.uint64)[codes]
    out, at = [], 0
    for n in sizes:
        own, at = values[at : at + n], at + n
        total = np.zeros(max(0, n - least + 1), np.uint64)
        for k in range(least if len(total) else 0):
            total = total * _FACTOR + own[k : k + len(total)]
        out.append(total.view(np.int64))
    return out


def unique_runs(pages: DataFrame, host: str, page: str, text: str, least: int = 24) -> DataFrame:
    """(host, page, run, text): the stretches of every page that no repeated string of ``least`` tokens or more covers, in
    order. ``page`` is unique; pages wholly covered have no row, null and empty texts neither.

    Buckets are counted before the shuffle by their least and greatest page. To find the covered places the suffixes meet
    the repeated buckets once more, salted by page, so a string that a third of all pages share is no hot key.
    """
    kinds = dict(pages.dtypes)
    given = pages.select(F.col(host).alias("host_"), F.col(page).alias("page_"), F.col(text).alias("text_")).where("host_ IS NOT NULL AND page_ IS NOT NULL AND length(text_) > 0")

    def suffixes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            prints = prefix_prints(list(b["text_"]), least)
            sizes = [len(x) for x in prints]
            at = np.concatenate([np.arange(n, dtype=np.int32) for n in sizes]) if sizes else np.empty(0, np.int32)
            yield pd.DataFrame({"host_": b["host_"].repeat(sizes).to_numpy(), "page_": b["page_"].repeat(sizes).to_numpy(), "at": at, "bucket": np.concatenate(prints)})

    entries = given.mapInPandas(suffixes, f"host_ {kinds[host]}, page_ {kinds[page]}, at int, bucket long")
    shared = entries.groupBy("host_", "bucket").agg(F.min("page_").alias("a"), F.max("page_").alias("b")).where("a < b")
    salted = shared.select("host_", "bucket", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    hits = entries.withColumn("salt", F.pmod(F.xxhash64("page_"), F.lit(SALTS)).cast("int")).join(salted, ["host_", "bucket", "salt"], "left_semi")
    covered = hits.groupBy("page_").agg(F.sort_array(F.collect_set("at")).alias("starts"))

    def cut_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for h, p, t, starts in b[["host_", "page_", "text_", "starts"]].itertuples(index=False, name=None):
                spans = [m.span() for m in _TOKEN.finditer(t)]
                gone = np.zeros(len(spans) + 1, np.int32)
                for s in [] if starts is None else starts:
                    gone[s] += 1
                    gone[min(s + least, len(spans))] -= 1
                keep = np.cumsum(gone)[:-1] == 0
                edge = np.flatnonzero(np.diff(np.concatenate([[0], keep.astype(np.int8), [0]])))
                rows += [(h, p, k, t[spans[i][0] : spans[j - 1][1]]) for k, (i, j) in enumerate(zip(edge[::2], edge[1::2], strict=True))]
            yield pd.DataFrame(rows, columns=["host_", "page_", "run", "text"])

    got = given.join(covered, "page_", "left").mapInPandas(cut_out, f"host_ {kinds[host]}, page_ {kinds[page]}, run int, text string")
    return got.select(F.col("host_").alias(host), F.col("page_").alias(page), "run", "text")
