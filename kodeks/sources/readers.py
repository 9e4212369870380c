"""Scans: declared-schema Parquet, files, captured responses, and a segmented key-value scan as a Python data source."""

from __future__ import annotations

import glob
import json
import os
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from kodeks.operators.relational import align


def parquet(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A Parquet table, or a glob of them, with the declared columns only: pruned at the scan, then cast."""
    return align(spark.read.parquet(path), schema)


def files(spark: SparkSession, path: str, pattern: str = "*.pdf") -> DataFrame:
    """path, modificationTime, length, content of binary files."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)


def responses(spark: SparkSession, path: str, url_part: str, body: str) -> DataFrame:
    """Captured responses (JSON lines with url and body, gzip or not) whose url contains a part, their body parsed with
    the schema ``body``; a body that doesn't fit is null."""
    raw = spark.read.schema("url string, body string").json(path)
    return raw.where(F.contains(F.col("url"), F.lit(url_part))).select("url", F.from_json("body", body).alias("body"))


def bucket_and_key(uri: Column) -> tuple[Column, Column]:
    p = r"^s3://([^/]+)/(.*)$"
    return F.regexp_extract(uri, p, 1), F.regexp_extract(uri, p, 2)


class Segment(InputPartition):
    def __init__(self, number: int, of: int) -> None:
        self.number, self.of = number, of


class SegmentReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict) -> None:
        self.schema, self.path, self.of = schema, options["path"], int(options.get("segments", "4"))

    def partitions(self) -> list[InputPartition]:
        return [Segment(i, self.of) for i in range(self.of)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        """Pages of the store are JSON-lines files; a segment has every of-th of them. Items lack columns at will."""
        pages = sorted(glob.glob(os.path.join(self.path, "*.jsonl")))
        for page in pages[partition.number :: partition.of]:
            with open(page, encoding="utf-8") as f:
                for line in f:
                    if line.strip():
                        item = json.loads(line)
                        yield tuple(item.get(c.name) for c in self.schema.fields)


class KeyValueSource(DataSource):
    """``spark.read.format("kodeks_kv").schema(...).option("segments", n).load(folder)``: a parallel scan, one task a
    segment, of items without a fixed schema."""

    @classmethod
    def name(cls) -> str:
        return "kodeks_kv"

    def reader(self, schema: StructType) -> DataSourceReader:
        return SegmentReader(schema, dict(self.options))


def fetch_rows(keys: DataFrame, key: str, fetch: Callable[[object], str], parallel: int) -> DataFrame:
    """(key, body, error) of an external call for every key, one client a task. The caller materialises the result once,
    so that no later action repeats the calls."""
    import pandas as pd

    kind = dict(keys.dtypes)[key]

    def run(batches):
        for b in batches:
            out = []
            for k in b[key]:
                try:
                    out.append((k, fetch(k), None))
                except Exception as e:  # noqa: BLE001
                    out.append((k, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=[key, "body", "error"])

    return keys.select(key).repartition(parallel, key).mapInPandas(run, f"{key} {kind}, body string, error string")
