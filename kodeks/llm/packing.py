"""Filling fixed-capacity containers with items (problem 8).

Texts are measured in tokens of a public tokenizer. Documents are dealt into randomised groups of bounded size and each
group is packed by itself, first fit in order of decreasing size, with a tournament tree over the free space of its
bins: the leftmost bin that has room is found in logarithmic time.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kodeks.session import cut, spread_scan

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: how byte-level BPE splits text before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(4)
def encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(docs: DataFrame, key: str, text: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """(key, tokens) of every document with text. Null and empty texts have no tokens and get no row. Only ordinary
    tokens are counted: what looks like a special token in a text is text."""
    kind = dict(docs.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        e = encoding(tokenizer)
        for b in batches:
            yield pd.DataFrame({"key_": b["key_"], "tokens": [len(e.encode_ordinary(t)) for t in b["text_"]]})

    texts = docs.select(F.col(key).alias("key_"), F.col(text).alias("text_")).where("key_ IS NOT NULL AND length(text_) > 0")
    return spread_scan(texts, "key_").mapInPandas(run, f"key_ {kind}, tokens long").withColumnRenamed("key_", key)


class TournamentTree:
    """Free space of bins; every inner node holds the most that is free below it."""

    def __init__(self, bins: int, capacity: int) -> None:
        self.leaves = 1 << max(0, (bins - 1).bit_length())
        self.most = [capacity] * (2 * self.leaves)

    def first_fit(self, size: int) -> int:
        """Put an item into the leftmost bin with room for it. There must be one."""
        at, most = 1, self.most
        while at < self.leaves:
            at *= 2
            if most[at] < size:
                at += 1
        bin_ = at - self.leaves
        most[at] -= size
        while at > 1:
            at //= 2
            left, right = most[2 * at], most[2 * at + 1]
            top = left if left > right else right
            if most[at] == top:
                break
            most[at] = top
        return bin_


def pack(sizes: list[int] | np.ndarray, capacity: int) -> list[tuple[int, int, int, int]]:
    """First-fit decreasing: (item, piece, tokens, bin) for every piece. An item over the capacity is cut into full
    bins and a rest; items of equal size go in the order given. Sizes of 0 take no room and go to the first bin."""
    if capacity < 1:
        raise ValueError("a container's capacity must be positive")
    pieces: list[tuple[int, int, int]] = []
    full: list[tuple[int, int, int]] = []
    for i, n in enumerate(sizes):
        k = 0
        while n > capacity:
            full.append((i, k, capacity))
            n -= capacity
            k += 1
        pieces.append((i, k, int(n)))
    pieces.sort(key=lambda x: -x[2])
    tree = TournamentTree(max(1, len(pieces)), capacity)
    out = [(i, k, n, tree.first_fit(n)) for i, k, n in pieces]
    top = 1 + max((x[3] for x in out), default=-1)
    return out + [(i, k, n, top + j) for j, (i, k, n) in enumerate(full)]


def pack_documents(docs: DataFrame, sizes: DataFrame, key: str = "doc_id", text: str = "text", group_size: int = 20_000, tokenizer: str = TOKENIZER, seed: int = 17) -> DataFrame:
    """(pack_id, capacity_tokens, group_id, bin_id, key, piece, tokens): every document in every kind of container.

    ``sizes`` has pack_id and capacity_tokens; rows with a null or no positive capacity describe no container. Groups
    are dealt by a hash of the key, about ``group_size`` documents each, whatever the number of documents: the unused
    space that this costs is at most one open bin's share a group. bin_id is unique within (pack_id, group_id).
    """
    counts = cut(token_counts(docs, key, text, tokenizer))
    groups = max(1, -(-counts.count() // group_size))
    kind = dict(docs.dtypes)[key]
    schema = f"pack_id int, capacity_tokens int, group_id int, bin_id int, key_ {kind}, piece int, tokens long"
    packs = sizes.where("pack_id IS NOT NULL AND capacity_tokens > 0").select("pack_id", "capacity_tokens").distinct()

    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("key_", kind="stable")
        capacity = int(g["capacity_tokens"].iloc[0])
        rows = pack(g["tokens"].to_numpy(), capacity)
        i = [r[0] for r in rows]
        return pd.DataFrame({"pack_id": g["pack_id"].iloc[0], "capacity_tokens": capacity, "group_id": g["group_id"].iloc[0], "bin_id": [r[3] for r in rows], "key_": g["key_"].to_numpy()[i], "piece": [r[1] for r in rows], "tokens": [r[2] for r in rows]})

    dealt = counts.select(F.col(key).alias("key_"), "tokens", F.pmod(F.xxhash64(F.lit(seed), key), F.lit(groups)).cast("int").alias("group_id"))
    # every document goes into every kind of container; the kinds are few and their number is given, not derived
    kinds = [tuple(r) for r in packs.orderBy("pack_id").limit(1001).collect()]
    if len(kinds) > 1000:
        raise ValueError("over 1000 kinds of containers")
    if not kinds:
        return docs.sparkSession.createDataFrame([], schema).withColumnRenamed("key_", key)
    every = F.explode(F.array(*[F.struct(F.lit(p).cast("int").alias("pack_id"), F.lit(c).cast("int").alias("capacity_tokens")) for p, c in kinds]))
    return dealt.select("*", every.alias("k_")).select("key_", "tokens", "group_id", "k_.pack_id", "k_.capacity_tokens").groupBy("pack_id", "group_id").applyInPandas(run, schema).withColumnRenamed("key_", key)
