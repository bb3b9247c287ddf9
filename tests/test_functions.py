"""Scalar helpers and the arrival stream."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from ladle.functions.text import message, split_location
from ladle.functions.time import expiry_epoch, parse_iso, recipe_pattern
from ladle.session import scratch_dir
from ladle.streaming.envelope import arrivals, completion_events


def test_split_location_first_slash(spark):
    df = spark.createDataFrame([("bucket/dir/recipe.json",), ("no-slash",), (None,)], "loc string")
    b, k, ok = split_location(F.col("loc"))
    got = [tuple(r) for r in df.select(b, k, ok).collect()]
    assert got == [("bucket", "dir/recipe.json", True), (None, None, False), (None, None, False)]


def test_iso_parse_and_expiry(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:05.123Z",), ("2024-01-01T00:00:05Z",), ("bad",)], "t string")
    got = [r.p for r in df.select(parse_iso(F.col("t")).alias("p")).collect()]
    assert got[0] == dt.datetime(2024, 1, 1, 0, 0, 5, 123000) and got[1] == dt.datetime(2024, 1, 1, 0, 0, 5)
    assert got[2] is None
    e = spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "t timestamp_ntz").select(expiry_epoch(F.col("t"))).first()[0]
    assert e == 1704067200 + 7 * 86400


def test_message_template(spark):
    df = spark.createDataFrame([("E1", None)], "a string, b string")
    assert df.select(message("error: {}, cause: {} (100%)", F.col("a"), F.col("b"))).first()[0] == \
        "error: E1, cause: null (100%)"


def test_recipe_pattern_dialect():
    assert recipe_pattern("yyyy-mm-dd*HH:MM:SS") == ("yyyy-MM-dd[ HH:mm:ss]", True)
    assert recipe_pattern("yyyy-mm-dd") == ("yyyy-MM-dd", False)


def test_completion_filter(spark):
    evs = [json.dumps({"source": "jobs", "detail-type": "Job State Change", "detail": {"jobRunId": "r1", "state": "SUCCEEDED"}}),
           json.dumps({"source": "other", "detail-type": "Job State Change", "detail": {"jobRunId": "r2"}})]
    df = spark.createDataFrame([(e,) for e in evs], "event string")
    got = [(r.job_id, r.state) for r in completion_events(df, "jobs", "Job State Change").collect()]
    assert got == [("r1", "SUCCEEDED")]


def test_arrivals_stream_skips_empty_files(spark):
    root = scratch_dir(spark, "arr").replace("file:", "")
    os.makedirs(f"{root}/inbound")
    with open(f"{root}/inbound/a.csv", "w") as f:
        f.write("x\n1\n")
    open(f"{root}/inbound/empty-file-object", "w").close()
    q = (arrivals(spark, f"{root}/inbound", "text").writeStream.format("memory").queryName("arr_q")
         .trigger(availableNow=True).start())
    q.awaitTermination(60)
    rows = spark.table("arr_q").collect()
    assert {r.file_path.rsplit("/", 1)[-1] for r in rows} == {"a.csv"}
    assert all(r.file_size > 0 for r in rows)
