"""Exact and nearest-neighbour matching."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kodeks.functions.text import title_key
from kodeks.session import parts_for


def exact_titles(asked: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """(key, eli): entry of ``known`` (eli, tytul) with the same normalised title; of several the smallest eli, null
    where there is none."""
    k = known.select(title_key(F.col("tytul")).alias("t_"), "eli").groupBy("t_").agg(F.min("eli").alias("eli"))
    return asked.select(key, title_key(F.col("tytul")).alias("t_")).join(k, "t_", "left").select(key, "eli")


def nearest(rows: DataFrame, queries: DataFrame, key: str, vector: str, block: int = 4096, least: float = -1.0) -> DataFrame:
    """(key, neighbour, score): the row most similar by cosine to each query, itself aside, ties to the smaller key, and
    only at ``least`` or above. Exact.

    The queries, a stated set, are dealt into blocks of about ``block`` vectors and the rows into parts; every pair of a
    block and a part is one matrix product in one task, and the best of the parts meet by query. Nothing passes through
    the driver but the number of queries. Null, empty and zero vectors have no neighbour.
    """
    kind = dict(rows.dtypes)[key]
    one = lambda d: d.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0)).select(F.col(key).alias("key_"), F.col(vector).cast("array<double>").alias("vec_"))
    asked, have = one(queries), one(rows)
    blocks = max(1, -(-asked.count() // block))
    parts = max(1, parts_for(have) // blocks)
    deal = lambda n: F.pmod(F.xxhash64("key_"), F.lit(n)).cast("int")
    q = asked.select("key_", "vec_", deal(blocks).alias("q_"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("p_"))
    r = have.select("key_", "vec_", deal(parts).alias("p_"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("q_"))

    def best(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"key_": [], "neighbour": [], "score": []})
        if a.empty or b.empty:
            return none
        b = b.sort_values("key_", kind="stable")
        x, y = np.array(a["vec_"].tolist(), np.float64), np.array(b["vec_"].tolist(), np.float64)
        n, m = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
        ids, keys = a["key_"].to_numpy()[n > 0], b["key_"].to_numpy()[m > 0]
        if not len(ids) or not len(keys):
            return none
        y = y[m > 0] / m[m > 0][:, None]
        top, at = np.full(len(ids), -2.0), np.zeros(len(ids), np.int64)
        for k in range(0, len(ids), 512):
            s = np.round((x[n > 0][k : k + 512] / n[n > 0][k : k + 512][:, None]) @ y.T, 6)
            s[np.equal.outer(ids[k : k + 512], keys)] = -2
            at[k : k + 512] = s.argmax(axis=1)
            top[k : k + 512] = s.max(axis=1)
        ok = top > -2
        return pd.DataFrame({"key_": ids[ok], "neighbour": keys[at[ok]], "score": top[ok]})

    found = q.groupBy("q_", "p_").cogroup(r.groupBy("q_", "p_")).applyInPandas(best, f"key_ {kind}, neighbour {kind}, score double")
    top = found.groupBy("key_").agg(F.min(F.struct((-F.col("score")).alias("d"), "neighbour")).alias("x"))
    return top.select(F.col("key_").alias(key), "x.neighbour", (-F.col("x.d")).alias("score")).where(F.col("score") >= least)


def title_cascade(asked: DataFrame, known: DataFrame, key: str, title: str, vector: str, least: float = 0.87) -> DataFrame:
    """(key, eli, how): the entry of ``known`` (eli, tytul, vector) with the same normalised title, else the one with the
    nearest vector at ``least`` or above, else null with ``unresolved``. ``asked`` has unique keys. The first step takes
    most of the rows; only the rest are compared by vector."""
    k = known.select(title_key(F.col("tytul")).alias("t_"), "eli").groupBy("t_").agg(F.min("eli").alias("eli"))
    exact = asked.withColumn("t_", title_key(F.col(title))).join(k, "t_", "left")
    rest = exact.where("eli IS NULL").select(F.concat(F.lit("q"), F.col(key).cast("string")).alias("id"), F.col(vector).alias("v"))
    entries = known.select(F.concat(F.lit("e"), "eli").alias("id"), F.col(vector).alias("v"))
    near = nearest(entries, rest, "id", "v", least=least).select(F.substring("id", F.lit(2), F.length("id")).alias("key_"), F.substring("neighbour", F.lit(2), F.length("neighbour")).alias("near_"))
    j = exact.join(near, exact[key].cast("string") == near["key_"], "left")
    how = F.when(F.col("eli").isNotNull(), "title").when(F.col("near_").isNotNull(), "nearest").otherwise("unresolved")
    return j.select(key, F.coalesce("eli", "near_").alias("eli"), how.alias("how"))
