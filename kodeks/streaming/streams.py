"""Structured Streaming forms of the sliding counter and of incremental ingest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def read_stream(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int = 100) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def sliding_counts(stream: DataFrame, ts: str, by: list[str], window: str = "180 seconds", slide: str = "60 seconds", late: str = "10 minutes") -> DataFrame:
    """Events per sliding window; events later than ``late`` are dropped and their windows' state is freed."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, window, slide), *by).agg(F.count("*").alias("n_events")).select(*by, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "n_events")


def first_seen(stream: DataFrame, ts: str, keys: list[str], late: str = "1 day") -> DataFrame:
    """Rows whose keys were not seen within the watermark: the streaming form of skipping what is done."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def ingest(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what is there to a Parquet folder and stop; the checkpoint makes every file count once, also after a
    failure."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).outputMode("append").start()
