import gzip
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from kodeks.schemas import ACT_CORE
from kodeks.sources import readers, sinks
from kodeks.streaming import streams


def test_parquet_scan_is_pruned(spark, data):
    df = readers.parquet(spark, data + "/acts.parquet", ACT_CORE).where("type = 'Ustawa'").select("eli")
    plan = df._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(type), EqualTo(type,Ustawa)]" in plan and "ReadSchema: struct<eli:string,type:string>" in plan


def test_key_value_segments(spark, tmp_path):
    for i in range(5):
        (tmp_path / f"{i}.jsonl").write_text("".join(json.dumps({"eli": f"{i}-{j}", "pos": j} if j else {"eli": f"{i}-0"}) + "\n" for j in range(3)))
    spark.dataSource.register(readers.KeyValueSource)
    df = spark.read.format("kodeks_kv").schema("eli string, pos long").option("path", str(tmp_path)).option("segments", "3").load()
    assert df.count() == 15 and df.where("pos IS NULL").count() == 5 and df.rdd.getNumPartitions() == 3


def test_responses_and_files(spark, tmp_path):
    with gzip.open(tmp_path / "a.json.gz", "wt") as f:
        f.write(json.dumps({"url": "http://x/api/list", "body": '{"n": 1}'}) + "\n" + json.dumps({"url": "http://x/other", "body": "{}"}) + "\n" + json.dumps({"url": "/api/list", "body": "broken"}))
    got = readers.responses(spark, str(tmp_path / "a.json.gz"), "/api/list", "n int").collect()
    assert sorted((r.body.n if r.body else None) or 0 for r in got) == [0, 1]
    (tmp_path / "x.pdf").write_bytes(b"%PDF")
    assert readers.files(spark, str(tmp_path)).first().length == 4
    a, b = readers.bucket_and_key(F.lit("s3://b/k/1.pdf"))
    assert tuple(spark.range(1).select(a, b).first()) == ("b", "k/1.pdf")


def test_fetch_rows(spark):
    def fetch(k):
        if k == 1:
            raise OSError("down")
        return f"body{k}"

    got = {r.id: (r.body, r.error) for r in readers.fetch_rows(spark.range(3), "id", fetch, 2).collect()}
    assert got == {0: ("body0", None), 1: (None, "OSError: down"), 2: ("body2", None)}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    p = sinks.insert_unique(df, str(tmp_path / "t"), ["k"], 0)
    with pytest.raises(sinks.DuplicateKey):
        sinks.insert_unique(df.limit(1), p, ["k"], 1)
    with pytest.raises(sinks.DuplicateKey):
        sinks.insert_unique(df.union(df).selectExpr("k + 9 AS k", "v"), p, ["k"], 1)
    sinks.upsert_table(df, str(tmp_path / "u"), ["k"], 0)
    at = sinks.upsert_table(spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string"), str(tmp_path / "u"), ["k"], 1)
    assert sorted(map(tuple, spark.read.parquet(at).collect())) == [(1, "a"), (2, "c"), (3, "d")]
    assert spark.read.parquet(sinks.write_parquet(df, str(tmp_path / "w"), ["k"])).count() == 2
    assert spark.read.json(sinks.write_json(df, str(tmp_path / "j"))).count() == 2 and spark.read.parquet(sinks.write_single(df, str(tmp_path / "s"))).count() == 2
    e = spark.createDataFrame([(1, datetime(2024, 1, 1)), (2, datetime(2025, 1, 1)), (3, None)], "k int, expires_at timestamp")
    assert [r.k for r in sinks.drop_expired(e, datetime(2024, 6, 1)).collect()] == [2, 3]


def test_streams(spark, tmp_path):
    rows = [(i, datetime(2024, 1, 1, 0, i), "a") for i in range(10)]
    df = spark.createDataFrame(rows, "k int, ts timestamp, kind string")
    df.write.parquet(str(tmp_path / "in"))
    s = streams.read_stream(spark, str(tmp_path / "in"), df.schema)
    q = streams.ingest(s, str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(60)
    df.limit(1).write.mode("append").parquet(str(tmp_path / "in"))
    q = streams.ingest(streams.read_stream(spark, str(tmp_path / "in"), df.schema), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(60)
    assert spark.read.schema(df.schema).parquet(str(tmp_path / "out")).count() == 11
    counts = streams.sliding_counts(streams.read_stream(spark, str(tmp_path / "in"), df.schema), "ts", ["kind"])
    q = counts.writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.table("counts").agg(F.sum("n_events")).first()[0] == 33
