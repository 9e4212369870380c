"""Boxes, tables and raised characters; sinks of buckets and of valid rows; the pipeline of steps."""

import pytest
from pyspark.sql import functions as F

from kodeks.operators import geometry as G
from kodeks.operators.tasks import Pipeline
from kodeks.sources import sinks

BOX = "struct<start_x:double,end_x:double,start_y:double,end_y:double>"


def test_tables_and_boxes(spark):
    rows = [(1, [(0.0, 5.0, 0.0, 10.0), (1.0, 9.0, 20.0, 30.0), (2.0, 7.0, 9.0, 21.0), (0.0, 1.0, 30.0, 40.0)]), (2, []), (3, None)]
    df = spark.createDataFrame(rows, f"k long, t array<{BOX}>")
    got = {r.k: None if r.m is None else [tuple(x) for x in r.m] for r in df.select("k", G.merge_tables(F.col("t")).alias("m")).collect()}
    # the third joins the first it overlaps; the regions then overlap and stay two, and touching is no overlap
    assert got == {1: [(0.0, 7.0, 0.0, 21.0), (1.0, 9.0, 20.0, 30.0), (0.0, 1.0, 30.0, 40.0)], 2: [], 3: None}
    b = df.where("k = 1").select(F.col("t")[0].alias("a"), F.col("t")[1].alias("b"), F.col("t")[2].alias("c"))
    assert tuple(b.select(G.boxes_overlap(F.col("a"), F.col("c")), G.boxes_overlap(F.col("a"), F.col("b")), G.box_within(F.col("a"), F.col("a")), G.box_within(F.col("a"), F.col("c"))).first()) == (True, False, True, False)


def test_raised_and_pixels(spark):
    rows = [("2", 90.0, 6.0), ("a", 99.0, 6.0), ("2", 90.0, 10.0), ("!", 90.0, 6.0), (" ", 90.0, 6.0)]
    df = spark.createDataFrame(rows, "t string, b double, h double")
    got = [r[0] for r in df.select(G.baseline_text(F.col("t"), F.col("b"), F.col("h"), F.lit(100.0), F.lit(10.0))).collect()]
    assert got == ["²", "a", "2", " ", " "]
    assert tuple(df.limit(1).select(G.to_page(F.lit(300), F.lit(600), F.lit(50.0)), G.to_page(F.lit(1), F.lit(0), F.lit(1.0))).first()) == (25.0, None)


def test_buckets_and_valid_rows(spark, tmp_path):
    make = lambda rows: spark.createDataFrame(rows, "k long, v string")
    path = str(tmp_path / "t")
    sinks.upsert_buckets(make([(i, "a") for i in range(50)]), path, ["k"], 0, 8)
    sinks.upsert_buckets(make([(3, "b"), (99, "c")]), path, ["k"], 1, 8)
    assert {r.k: r.v for r in sinks.read_buckets(spark, path).collect()} == {i: "a" for i in range(50)} | {3: "b", 99: "c"}
    assert len(list((tmp_path / "t" / "version=1").glob("bucket=*"))) <= 2
    bad = sinks.insert_valid(make([(1, "x"), (None, "y"), (2, None)]), str(tmp_path / "u"), ["k"], {"v": F.col("v") != ""}, 0)
    assert sorted((r.v or "", tuple(r.broken)) for r in bad.collect()) == [("", ("v",)), ("y", ("no_k",))]
    assert [r.k for r in spark.read.parquet(str(tmp_path / "u")).collect()] == [1]
    sinks.write_status(spark, str(tmp_path / "log"), "i", "IN_PROGRESS")
    sinks.write_status(spark, str(tmp_path / "log"), "i", "FAILED", "e")
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2


def test_pipeline():
    seen, cache = [], {}

    def flaky(x):
        seen.append(x)
        if len(seen) < 2:
            raise ValueError("once")
        return x + 1

    def fails(x):
        raise ValueError("always")

    assert Pipeline(cache).step("a", lambda x: 1).step("b", flaky, retries=2).run(0) == 2 and seen == [1, 1]
    undone = []
    with pytest.raises(ValueError):
        Pipeline(cache).step("a", lambda x: 1, undone.append).step("c", lambda x: x + 5, undone.append).step("d", fails).run(0)
    assert undone == [6]
