"""History of changing attributes (problem 4).

Snapshots are brought to one row per entity and snapshot, co-partitioned by entity and merged in time order. The
shuffle's sorted runs are merged k ways by Spark's external sort; a streaming iterator reads the merged rows once
and emits a version whenever its payload changes. It holds one Arrow batch and one open version, never a history.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from kodeks.functions.normal import act_key, any_date, label


def latest_of_snapshot(df: DataFrame, keys: dict[str, Column], snapshot: Column, newest: list[Column], payload: dict[str, Column]) -> DataFrame:
    """One row per entity and snapshot: the payload of the row that sorts last by ``newest``.

    Aggregated before the shuffle, so an entity with a third of all rows moves at most one row per snapshot
    and map task. Rows with a null key or snapshot name no entity or time and are left out. Equal ``newest``
    values are settled by the payload itself, so the result doesn't depend on the order of rows.
    """
    flat = df.select(
        *[c.alias(k) for k, c in keys.items()],
        snapshot.alias("snapshot_"),
        F.struct(*[c.alias(f"n{i}") for i, c in enumerate(newest)], *[c.alias(p) for p, c in payload.items()]).alias("last_"),
    ).where(" AND ".join(f"`{k}` IS NOT NULL" for k in [*keys, "snapshot_"]))
    top = flat.groupBy(*keys, "snapshot_").agg(F.max("last_").alias("last_"))
    return top.select(*keys, "snapshot_", *[F.col("last_")[p].alias(p) for p in payload])


def _versions(keys: list[str], payload: list[str]):
    cols = [*keys, "valid_from", "valid_to", *payload]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_row: pd.DataFrame | None = None  # last row read, with its payload filled and the start of its version
        for b in batches:
            if b.empty:
                continue
            b = b.assign(start_=None)
            if open_row is not None:
                b = pd.concat([open_row, b], ignore_index=True)
            entity = np.ones(len(b), bool)
            for k in keys:
                v = b[k].to_numpy(object)
                entity[1:] &= v[1:] == v[:-1]
            entity[0] = False
            fresh = ~entity  # first row of an entity
            group = np.cumsum(fresh)
            for p in payload:
                b[p] = b[p].groupby(group).ffill()
            begins = fresh.copy()
            n = b["n_"].to_numpy()
            begins[1:] |= n[1:] != n[:-1] + 1
            for p in payload:
                v = b[p].where(b[p].notna(), "").to_numpy(object)
                begins[1:] |= v[1:] != v[:-1]
            at = np.flatnonzero(begins)
            ends = np.append(at[1:], len(b)) - 1
            first = b["snapshot_"].to_numpy(object)[at]
            if open_row is not None:  # row 0 continues the open version
                first[0] = b["start_"].iloc[0]
            out = b.iloc[ends][[*keys, *payload, "next_"]].rename(columns={"next_": "valid_to"})
            out["valid_from"] = first
            open_row = b.iloc[[-1]].assign(start_=first[-1])
            yield out[cols].iloc[:-1]
        if open_row is not None:
            yield open_row.rename(columns={"next_": "valid_to", "start_": "valid_from"})[cols]

    return run


def versions(rows: DataFrame, keys: list[str], payload: list[str]) -> DataFrame:
    """Versions with their period, from one row per entity and ``snapshot_``.

    ``valid_to`` is the next snapshot of the whole table after the version's last one, '' after the last snapshot.
    A null payload keeps the value before it; an entity that is missing from a snapshot ends its version and a new
    one starts where it returns. An empty table gives no versions.
    """
    snaps = rows.select("snapshot_").distinct()
    w = Window.orderBy("snapshot_")  # one row per snapshot of the table
    snaps = snaps.select("snapshot_", F.row_number().over(w).alias("n_"), F.coalesce(F.lead("snapshot_").over(w), F.lit("")).alias("next_"))
    merged = rows.join(snaps, "snapshot_").select(*keys, "snapshot_", "n_", "next_", *payload).repartition(*keys).sortWithinPartitions(*keys, "n_")
    schema = StructType([StructField(c, StringType()) for c in [*keys, "valid_from", "valid_to", *payload]])
    return merged.mapInPandas(_versions(keys, payload), schema)


def act_change_history(changes: DataFrame) -> DataFrame:
    """Versions of type_of_change and date_of_change_annotation of every link between two acts."""
    rows = latest_of_snapshot(
        changes,
        {"eli": act_key(F.col("eli")), "eli_annotation": act_key(F.col("eli_annotation"))},
        F.col("snapshot_date").try_cast("date").cast("string"),
        [F.col("loaded_at"), F.col("change_row_id")],
        {"type_of_change": label(F.col("type_of_change")), "date_of_change_annotation": any_date(F.col("date_of_change_annotation"))},
    )
    return versions(rows, ["eli", "eli_annotation"], ["type_of_change", "date_of_change_annotation"])
