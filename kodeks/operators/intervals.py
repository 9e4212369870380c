"""Ordered rows and intervals: running offsets, islands, gaps, sliding counts, interval joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_offsets(df: DataFrame, by: list[str], order: list[str], length: Column, name: str = "start_at") -> DataFrame:
    """Start of every piece: the lengths of the pieces before it."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(name, F.coalesce(F.sum(length).over(w), F.lit(0)).cast("long"))


def islands(df: DataFrame, by: list[str], start: str, end: str, ties: list[str], slack: float = 0.0) -> DataFrame:
    """``df`` with island_id: a row goes on with the island before it while start + slack <= the furthest end so far.
    Equal to merging one row after the other, since rows are in the order of their start."""
    order = Window.partitionBy(*by).orderBy(start, end, *ties)
    far = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    breaks = F.when(F.col(start) + slack <= far, 0).otherwise(1)
    return df.withColumn("break_", breaks).withColumn("island_id", F.sum("break_").over(order.rowsBetween(Window.unboundedPreceding, 0)).cast("int")).drop("break_")


def gaps(df: DataFrame, by: list[str], start: str, end: str, ties: list[str], bounds: tuple[Column, Column] | None = None) -> DataFrame:
    """Complement: what no interval covers, between the first and the last one or, with ``bounds`` (columns that are the same
    in all rows of a group), between these."""
    order = Window.partitionBy(*by).orderBy(start, end, *ties).rowsBetween(Window.unboundedPreceding, -1)
    lo = F.max(end).over(order) if bounds is None else F.greatest(F.max(end).over(order), bounds[0])
    inner = df.withColumn("gap_start", lo).where(F.col("gap_start") < F.col(start)).select(*by, "gap_start", F.col(start).alias("gap_end"))
    if bounds is None:
        return inner
    last = df.groupBy(*by).agg(F.greatest(F.max(end), F.max(bounds[0])).alias("gap_start"), F.max(bounds[1]).alias("gap_end")).where("gap_start < gap_end")
    return inner.unionByName(last)


def sessions(df: DataFrame, by: list[str], order: str, new: Column) -> DataFrame:
    """``df`` with session_no: the number of rows up to it at which ``new`` holds; the first row opens one."""
    w = Window.partitionBy(*by).orderBy(order)
    flag = F.when(F.row_number().over(w) == 1, 1).when(new, 1).otherwise(0)
    return df.withColumn("new_", flag).withColumn("session_no", F.sum("new_").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int")).drop("new_")


def sliding_count(df: DataFrame, by: list[str], ts: str, seconds: int, name: str = "n_window", blocks: int = 20) -> DataFrame:
    """Events of the last ``seconds`` up to and with each row; an event exactly that old no longer counts.

    Time is cut into blocks of ``blocks`` times the window. An event counts in its block and, where it may still be in the
    window of one there, in the next; so a key with a third of all events is many groups and each window one block."""
    size = seconds * 1_000_000
    t = F.unix_micros(ts)
    own = F.floor(t / (size * blocks))
    late = t >= (own + 1) * (size * blocks) - size
    rows = df.withColumns({"t_": t, "b_": own}).withColumn("e_", F.explode(F.when(late, F.array("b_", F.col("b_") + 1)).otherwise(F.array("b_"))))
    w = Window.partitionBy(*by, "e_").orderBy("t_").rangeBetween(-(size - 1), 0)
    return rows.withColumn(name, F.count("*").over(w)).where("b_ = e_").drop("t_", "b_", "e_")


def overlap(a: DataFrame, b: DataFrame, by: list[str], width: float, start: str = "lo", end: str = "hi") -> DataFrame:
    """Pairs of intervals of two tables, of equal ``by``, that share more than a point. Both are cut into cells of
    ``width``, so that the join is an equi-join; a pair is kept in the first cell that both reach."""
    cells = lambda d: d.withColumn("cell_", F.explode(F.sequence(F.floor(F.col(start) / width), F.floor(F.col(end) / width))))
    x, y = cells(a), cells(b.select(*by, *[F.col(c).alias(f"{c}_b") for c in b.columns if c not in by]).withColumnsRenamed({f"{start}_b": start, f"{end}_b": end})).withColumnsRenamed({start: f"{start}_b", end: f"{end}_b"})
    first = F.col("cell_") == F.floor(F.greatest(F.col(start), F.col(f"{start}_b")) / width)
    return x.join(y, [*by, "cell_"]).where(first & (F.col(end) > F.col(f"{start}_b")) & (F.col(f"{end}_b") > F.col(start))).drop("cell_")
