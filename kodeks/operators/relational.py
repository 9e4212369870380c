"""Relational operators of incremental ingest: alignment, change detection, anti and mark joins, upsert, routing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def align(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema`` in its order, cast to its types; missing ones are null, others are dropped. A value
    that can't be cast becomes null."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*[(F.col(f"`{have[f.name.lower()]}`").try_cast(f.dataType) if f.name.lower() in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of every key in the given order. Rows equal in it are settled by all other columns."""
    w = Window.partitionBy(*keys).orderBy(*order, *[F.col(c).asc_nulls_first() for c, t in df.dtypes if not t.startswith("map")])
    return df.withColumn("rank_", F.row_number().over(w)).where("rank_ = 1").drop("rank_")


def detect_changes(new: DataFrame, state: DataFrame, key: str, tracked: list[str]) -> DataFrame:
    """Rows of ``new`` that the state lacks or holds with another value: key, missing, and <column>_changed flags. Flags
    of missing rows are null; null equals null."""
    s = state.select(F.col(key).alias("key_"), *[F.col(c).alias(f"{c}_old_") for c in tracked])
    j = new.join(s, new[key] == s["key_"], "left")
    missing = F.col("key_").isNull()
    flags = {c: F.when(~missing, ~F.col(c).eqNullSafe(F.col(f"{c}_old_"))) for c in tracked}
    any_ = reduce(lambda a, b: a | b, [F.coalesce(f, F.lit(False)) for f in flags.values()])
    return j.where(missing | any_).select(key, missing.alias("missing"), *[f.alias(f"{c}_changed") for c, f in flags.items()])


def outer_indicator(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join of the distinct keys of two tables with the side they are on: both, left_only or right_only.
    Null keys match null keys."""
    a = left.select(*keys).distinct().withColumn("in_left_", F.lit(True))
    b = right.select(*[F.col(k).alias(f"{k}_r_") for k in keys]).distinct().withColumn("in_right_", F.lit(True))
    on = reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[f"{k}_r_"]) for k in keys])
    side = F.when(F.col("in_left_") & F.col("in_right_"), "both").when(F.col("in_left_"), "left_only").otherwise("right_only")
    return a.join(b, on, "full").select(*[F.coalesce(a[k], b[f"{k}_r_"]).alias(k) for k in keys], side.alias("side"))


def new_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``left`` whose keys ``right`` lacks; a null key is never known."""
    return left.join(right.select(*keys), keys, "left_anti")


def mark(left: DataFrame, right: DataFrame, keys: list[str], flag: str) -> DataFrame:
    """``left`` with a flag that says whether its keys exist in ``right``. The join is with the distinct keys only, so it
    adds no rows."""
    known = right.select(*keys).distinct().withColumn(flag, F.lit(True))
    return left.join(known, keys, "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` and the rows of ``old`` whose keys it lacks."""
    return old.join(new.select(*keys), keys, "left_anti").select(*new.columns).unionByName(new)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that stand more than once, with their number of rows. Counted before the shuffle."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def violations(df: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """(key, violation), one row per broken rule. A rule that is null is broken."""
    names = F.array(*[F.when(~F.coalesce(r, F.lit(False)), F.lit(n)) for n, r in rules.items()])
    return df.select(key, F.explode(F.array_compact(names)).alias("violation"))


def route(df: DataFrame, ok: Column) -> tuple[DataFrame, DataFrame]:
    """(good rows, failed rows); a null verdict is a failure."""
    good = F.coalesce(ok, F.lit(False))
    return df.where(good), df.where(~good)


def drop_suffix(df: DataFrame, suffix: str) -> DataFrame:
    """Without the columns whose names end with ``suffix``."""
    return df.drop(*[c for c in df.columns if c.endswith(suffix)])


def strip_suffix(df: DataFrame, suffix: str) -> DataFrame:
    """Columns whose names end with ``suffix`` renamed to what stands before it; where that name is taken they stay."""
    return df.withColumnsRenamed({c: c.removesuffix(suffix) for c in df.columns if c.endswith(suffix) and c.removesuffix(suffix) not in df.columns and c != suffix})


def tagged(df: DataFrame, key: str, kinds: dict[str, list[str]]) -> DataFrame:
    """(key, type, json): rows as objects with a type tag. The type of a row is the first of ``kinds`` (type to columns)
    whose columns are all there; the object holds these columns only."""
    have = {k: reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]) for k, cols in kinds.items()}
    tag = F.coalesce(*[F.when(c, F.lit(k)) for k, c in have.items()])
    body = F.coalesce(*[F.when(c, F.to_json(F.struct(F.lit(k).alias("type"), *kinds[k]))) for k, c in have.items()])
    return df.select(key, tag.alias("type"), body.alias("json"))


def untagged(df: DataFrame, key: str, schema: str) -> DataFrame:
    """Objects with a type tag as columns of ``schema``; fields that a type lacks are null."""
    return df.select(key, "type", F.from_json("json", schema).alias("x")).select(key, "type", "x.*")


def assignments(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, expression, names, values) of an update that sets the columns which aren't null: ``SET a = :a, b = :b``."""
    names = F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.lit(c)) for c in columns]))
    values = F.array_compact(F.array(*[F.col(c).cast("string") for c in columns]))
    return df.select(key, F.concat(F.lit("SET "), F.array_join(F.transform(names, lambda n: F.concat(n, F.lit(" = :"), n)), ", ")).alias("expression"), names.alias("names"), values.alias("values")).where("size(names) > 0")
