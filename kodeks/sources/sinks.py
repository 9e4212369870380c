"""Sinks: Parquet, single files, JSON, keyed insert and upsert into a table folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kodeks.operators.relational import duplicate_keys, upsert


def write_parquet(df: DataFrame, path: str, by: list[str] | None = None) -> str:
    """Snappy Parquet under ``path``, replaced as a whole; returns the path for the next step."""
    w = df.write.mode("overwrite").option("compression", "snappy")
    (w.partitionBy(*by) if by else w).parquet(path)
    return path


def write_single(df: DataFrame, path: str) -> str:
    """One Parquet file; for results that are small by nature."""
    df.coalesce(1).write.mode("overwrite").parquet(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").json(path)
    return path


class DuplicateKey(ValueError):
    """A row's key stands in the table already, or twice among the new rows."""


def insert_unique(df: DataFrame, path: str, keys: list[str], version: int) -> str:
    """Append rows as the folder ``version=<n>``; refused where a key would stand twice. Every version is a folder of
    its own, so a repeated write replaces what a failed one left."""
    spark = df.sparkSession
    twice = duplicate_keys(df, keys).limit(1).count()
    known = 0
    if version > 0:
        old = spark.read.parquet(path).where(F.col("version") < version)
        known = df.join(old.select(*keys), keys, "left_semi").limit(1).count()
    if twice or known:
        raise DuplicateKey(f"keys {keys} are not unique")
    df.write.mode("overwrite").parquet(f"{path}/version={version}")
    return path


def upsert_table(new: DataFrame, path: str, keys: list[str], version: int) -> str:
    """Write version n of a keyed table: version n - 1 with the new rows in place of those of the same keys. The version
    before stays readable until it is removed, so a lost job can be run again."""
    full = new if version == 0 else upsert(new.sparkSession.read.parquet(f"{path}/v{version - 1}"), new, keys)
    full.write.mode("overwrite").parquet(f"{path}/v{version}")
    return f"{path}/v{version}"


def drop_expired(df: DataFrame, as_of, column: str = "expires_at") -> DataFrame:
    """Rows that have not expired at ``as_of``; a null never expires."""
    return df.where(F.col(column).isNull() | (F.col(column) > F.lit(as_of)))


def insert_valid(df: DataFrame, path: str, keys: list[str], rules: dict[str, Column], version: int) -> DataFrame:
    """Write the rows that keep all ``rules`` and have their keys as the folder ``version=<n>``, the others, with the names
    of what they break, beside it under ``<path>-rejects``; returns the latter. A rule that is null is broken."""
    all_ = {f"no_{k}": F.col(k).isNotNull() for k in keys} | rules
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(r, F.lit(False)), F.lit(n)) for n, r in all_.items()]))
    df.where(F.size(broken) == 0).write.mode("overwrite").parquet(f"{path}/version={version}")
    at = f"{path}-rejects/version={version}"
    df.withColumn("broken", broken).where(F.size("broken") > 0).write.mode("overwrite").parquet(at)
    return df.sparkSession.read.parquet(at)


def read_buckets(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """The rows of a table of buckets, of every bucket its last version (before ``before``), with the column ``bucket``."""
    rows = spark.read.parquet(path)
    if before is not None:
        rows = rows.where(F.col("version") < before)
    last = rows.groupBy("bucket").agg(F.max("version").alias("version"))  # a row for each bucket, whose number is given
    return rows.join(F.broadcast(last), ["bucket", "version"]).drop("version")


def upsert_buckets(new: DataFrame, path: str, keys: list[str], version: int, buckets: int = 64) -> str:
    """Put rows in place of those of the same keys in a table of buckets by a hash of the key. Only the buckets that new
    rows fall into are written again, as version n; a repeated write replaces what a failed one left."""
    new = new.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    if version > 0:
        touched = [r[0] for r in new.select("bucket").distinct().collect()]
        old = read_buckets(new.sparkSession, path, version).where(F.col("bucket").isin(touched))
        new = upsert(old, new, keys)
    new.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/version={version}")
    return path


def write_status(spark: SparkSession, path: str, invoke_id: str, status: str, error: str | None = None) -> str:
    """One row of a run's log: IN_PROGRESS, DONE or FAILED, with its time."""
    row = spark.createDataFrame([(invoke_id, status, error)], "invoke_id string, status string, error string").withColumn("at", F.current_timestamp())
    row.write.mode("append").parquet(path)
    return path
