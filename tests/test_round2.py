"""Sizes, ties and damaged input: cases where a result must not depend on chunking, order or luck."""

import datetime as dt
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ladle.operators.category import map_categories
from ladle.operators.crypto import hash_entities_within
from ladle.operators.dates import mask_date
from ladle.operators.positions import CHUNK, chunked, max_before, positions_within, with_row_id
from ladle.operators.randomize import shuffle_rows
from ladle.plans.recipe import RecipeContext, RecipeError, apply_recipe
from ladle.session import scratch_dir
from ladle.sources.files import read_inbound

T0 = dt.datetime(2024, 1, 1)


def act(op, **params):
    return {"Action": {"Operation": op, "Parameters": params}}


def _folder(spark, name):
    path = scratch_dir(spark, name).replace("file:", "")
    os.makedirs(path)
    return path


def _files(path, frames):
    os.makedirs(path, exist_ok=True)
    for i, f in enumerate(frames):
        f.to_parquet(f"{path}/{i:03d}.parquet", index=False, coerce_timestamps="us", allow_truncated_timestamps=True)


def _memory(df, spark, name):
    q = df.writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(300)
    return spark.table(name)


# ---- streams over several Arrow chunks of one key

def test_newer_only_stream_over_chunks(spark):
    from ladle.streaming.live import newer_only_stream
    n, path = 24_000, _folder(spark, "s")
    # written with the latest first; by arrival order every row is newer than those before
    rows = pd.DataFrame({"k": "a", "ts": [T0 + dt.timedelta(seconds=n - i) for i in range(n)], "seq": [n - i for i in range(n)]})
    _files(path, [rows])
    src = spark.readStream.schema("k string, ts timestamp_ntz, seq long").parquet(path)
    assert _memory(newer_only_stream(src, "k", "ts", "seq"), spark, "newer_chunks").count() == n


def test_single_flight_stream_over_chunks(spark):
    from ladle.streaming.live import single_flight_stream
    n, path = 24_000, _folder(spark, "s")
    rows = pd.DataFrame({"k": "a", "requested_at": [T0 + dt.timedelta(seconds=n - 1 - i) for i in range(n)]})
    _files(path, [rows])
    src = spark.readStream.schema("k string, requested_at timestamp_ntz").parquet(path)
    out = _memory(single_flight_stream(src, "k", "requested_at", 3600), spark, "flight_chunks")
    assert out.count() == n and out.where("started").count() == 7


def test_ledger_start_in_a_later_chunk_than_its_completion(spark):
    from ladle.streaming.ledger import match_completions
    from ladle.streaming.live import run_ledger_stream
    a, b = _folder(spark, "starts"), _folder(spark, "comps")
    n = 12_000
    starts = pd.DataFrame({"job_id": "j", "task_token": [f"t{i:05d}" for i in range(n)],
                           "started_at": [T0 + dt.timedelta(minutes=2 * (n - i)) for i in range(n)]})
    comps = pd.DataFrame({"job_id": ["j"] * 5, "state": ["SUCCEEDED"] * 4 + ["FAILED"], "completed_at": [
        T0, T0 + dt.timedelta(minutes=2), T0 + dt.timedelta(minutes=9001), T0 + dt.timedelta(days=40), T0 + dt.timedelta(minutes=50)]})
    _files(a, [starts])
    _files(b, [comps])
    cols = {"starts": "job_id string, task_token string, started_at timestamp_ntz",
            "comps": "job_id string, state string, completed_at timestamp_ntz"}
    from test_streaming import _run_until
    out = _run_until(run_ledger_stream(spark.readStream.schema(cols["starts"]).parquet(a),
                                       spark.readStream.schema(cols["comps"]).parquet(b)), spark, "ledger_chunks", 5)
    got = {r.completed_at.replace(tzinfo=None): (r.result, r.task_token) for r in out.collect()}
    batch = match_completions(spark.read.parquet(b), spark.read.parquet(a), chunk_rows=700).collect()
    assert got == {r.completed_at: (r.result, r.task_token) for r in batch}
    assert got[T0] == ("Fail", None)
    assert got[T0 + dt.timedelta(minutes=2)] == ("Success", f"t{n - 1:05d}")
    assert got[T0 + dt.timedelta(minutes=9001)] == ("Success", f"t{n - 4500:05d}")
    assert got[T0 + dt.timedelta(days=40)] == ("Fail", None)
    assert got[T0 + dt.timedelta(minutes=50)] == ("Fail", f"t{n - 25:05d}")


def test_unmatched_completion_of_a_stream_join(spark):
    from ladle.streaming.live import completions_with_runs
    a, b = _folder(spark, "starts"), _folder(spark, "comps")
    far = T0 + dt.timedelta(days=60)
    _files(a, [pd.DataFrame({"job_id": ["j1", "x"], "task_token": ["t1", "tx"], "started_at": [T0, far]}),
               pd.DataFrame({"job_id": ["y"], "task_token": ["ty"], "started_at": [far + dt.timedelta(days=1)]})])
    _files(b, [pd.DataFrame({"job_id": ["j1", "j3", "x"], "completed_at": [T0 + dt.timedelta(hours=1)] * 2 + [far]}),
               pd.DataFrame({"job_id": ["y"], "completed_at": [far + dt.timedelta(days=1)]})])
    s = spark.readStream.schema("job_id string, task_token string, started_at timestamp_ntz").option("maxFilesPerTrigger", 1).parquet(a)
    c = spark.readStream.schema("job_id string, completed_at timestamp_ntz").option("maxFilesPerTrigger", 1).parquet(b)
    out = _memory(completions_with_runs(c, s), spark, "join_unmatched")
    assert {(r.job_id, r.task_token) for r in out.collect()} == {("j1", "t1"), ("j3", None), ("x", "tx"), ("y", "ty")}


# ---- batch twins: ties, bursts, hot values

def test_single_flight_with_equal_times(spark):
    from ladle.streaming.flight import single_flight
    rows = [("k", 5), ("k", 5), ("k", 7), ("j", 1), ("j", 1), ("j", 1), (None, 3), (None, 3), ("j", 200), ("j", 200)]
    rows += [("hot", i // 40) for i in range(4000)]
    df = spark.createDataFrame([(k, T0 + dt.timedelta(seconds=t)) for k, t in rows], "k string, ts timestamp_ntz")
    want = {}
    for key in {k for k, _ in rows}:
        until, n = None, 0
        for t in sorted(t for k, t in rows if k == key):
            if until is None or t >= until:
                until, n = t + 10, n + 1
        want[key] = n
    for chunk_rows in (10_000, 150):
        out = single_flight(df, "k", "ts", 10, chunk_rows=chunk_rows)
        assert out.count() == len(rows)
        assert {r.k: r.n for r in out.groupBy("k").agg(F.count_if("started").alias("n")).collect()} == want


def _largest_chunk(x):
    return x.groupBy(CHUNK).count().agg(F.max("count")).first()[0]


def test_no_chunk_grows_with_a_hot_value_or_a_burst(spark):
    n, limit = 20_000, 1000
    hot = with_row_id(spark.range(n).select(F.lit("s").alias("g"), F.when(F.col("id") % 3 > 0, F.lit("zip")).otherwise(
        F.col("id").cast("string")).alias("v")))
    x, several = chunked(hot, ["g"], [F.col("v"), F.col("__rid")], limit)
    assert several and _largest_chunk(x) <= 2 * limit
    burst = with_row_id(spark.range(n).select(F.lit("k").alias("g"), F.when(F.col("id") == 0, F.lit(0)).otherwise(
        F.lit(10 ** 12) + F.col("id")).alias("t")))
    x, _ = chunked(burst, ["g"], [F.col("t"), F.col("__rid")], limit)
    assert _largest_chunk(x) <= 2 * limit


def test_shuffle_of_a_hot_value_keeps_all_rows(spark):
    df = spark.range(5000).select("id", F.lit("st").alias("state"), F.when(F.col("id") % 3 > 0, F.lit("00000")).otherwise(
        F.col("id").cast("string")).alias("zip"))
    out = shuffle_rows(df, ["zip"], ["state"], chunk_rows=200)
    assert out.count() == 5000 and out.select("id").distinct().count() == 5000
    assert out.where("zip = '00000'").count() == df.where("zip = '00000'").count()


def test_shuffle_after_random_step_keeps_all_rows(spark):
    df = spark.range(3000).repartition(7, "id").select("id", F.col("id").alias("v"), (F.col("id") % 5).alias("g"))
    out = apply_recipe(df, [act("REPLACE_WITH_RANDOM_BETWEEN", sourceColumns='["v"]', lowerBound="1", upperBound="1000000"),
                            act("ENCRYPT", sourceColumns='["v"]', kmsKeyArn="k"),
                            act("SHUFFLE_ROWS", sourceColumns='["v"]', groupByColumns='["g"]')],
                       RecipeContext(secrets={"k": b"k" * 32}, options={"chunk_rows": 300}))
    assert out.count() == 3000 and out.where("v is null").count() == 0


def test_key_mode_shuffle_needs_a_secret(spark):
    df = spark.range(5).withColumn("v", F.col("id"))
    with pytest.raises(RecipeError):
        shuffle_rows(df, ["v"], [], key_columns=["id"])


def test_random_steps_are_independent_and_spread(spark):
    df = spark.range(1000).select("id", F.lit(1).alias("a"), F.lit(1).alias("b"))
    one = act("REPLACE_WITH_RANDOM_BETWEEN", sourceColumns='["a"]', lowerBound="1", upperBound="50")
    two = act("REPLACE_WITH_RANDOM_BETWEEN", sourceColumns='["b"]', lowerBound="1", upperBound="50")
    for options in ({}, {"random_key_columns": ["id"]}):
        rows = apply_recipe(df, [one, two], RecipeContext(options=options)).collect()
        assert sum(r.a == r.b for r in rows) < 60
        assert {r.a for r in rows} == set(range(1, 51))


def test_max_before_and_positions_agree_over_chunks(spark):
    df = with_row_id(spark.range(2000).select((F.col("id") % 3).alias("g"), F.xxhash64("id").alias("o"), F.xxhash64(
        "id", F.lit(1)).alias("v")))
    order = [F.col("o"), F.col("__rid")]
    for f in (lambda n: positions_within(df, ["g"], order, "x", n), lambda n: max_before(df, ["g"], order, F.col("v"), "x", n)):
        a, b = ({(r.o, r.x) for r in f(n).collect()} for n in (10_000, 90))
        assert a == b


# ---- maps, dates, entities

def test_category_maps_give_one_result_at_every_size(spark):
    values = {"n": None, "t": True, "i": 7, "f": 2.5, "s": "x"}
    df = spark.createDataFrame([(k,) for k in [*values, "outside", None]], "v string")
    big = {**values, **{f"pad{i}": "p" for i in range(1500)}}
    for other, delete in (("other", False), (None, False), ("other", True)):
        a, b = (sorted(map(tuple, map_categories(df, "v", "m", m, other, delete).collect()), key=repr) for m in (values, big))
        assert a == b
    assert ("t", "true") in a and ("i", "7") in a and ("n", "other") in a


def test_numeric_maps_never_kill_the_job(spark):
    df = spark.createDataFrame([("a",), ("word",), ("3",), (None,)], "v string")
    got = {r.v: r.m for r in map_categories(df, "v", "m", {"a": "1.5"}, None, map_type="NUMERIC").collect()}
    assert got == {"a": 1.5, "word": None, "3": 3.0, None: None}
    with pytest.raises(RecipeError):
        map_categories(df, "v", "m", {"a": "1"}, "Others", map_type="NUMERIC")


def test_dates_are_read_to_their_end(spark):
    df = spark.createDataFrame([(x,) for x in ["1958-04-2199", "1958-04-21abc", "1958-04-21", "1958-04-21 10:11:12.5", "1958-04-21T10:11:12Z"]],
                               "d string")
    assert [r.m for r in df.select(mask_date(F.col("d"), ["YEAR", "DAY"]).alias("m")).collect()] == [None, None, *["####/04/##"] * 3]


def _mac(text):
    import base64
    import hashlib
    import hmac
    return base64.b64encode(hmac.new(b"k", text.encode(), hashlib.sha256).digest()).decode()


def test_entities_in_text_are_hashed_by_place(spark):
    cases = {
        "408 496-7223,785-939-6046": "{408 496-7223},{785-939-6046}",
        "zjo@x.com and jo@x.com": "{zjo@x.com} and {jo@x.com}",
        "call 4084967223 or (408)496-7223.": "call {4084967223} or {(408)496-7223}.",
        "cards 378282246310005 4111111111111111 4111111111111112": "cards {378282246310005} {4111111111111111} 4111111111111112",
        "at 10.0.0.1, 10.0.0.999": "at {10.0.0.1}, 10.0.0.999",
        "none here": "none here",
    }
    df = spark.createDataFrame(list(enumerate(cases)), "i int, v string")
    out = [r.v for r in hash_entities_within(df, "v", b"k", ["USA_ALL"]).orderBy("i").collect()]
    import re
    assert out == [re.sub(r"\{(.*?)\}", lambda m: _mac(m[1]), want) for want in cases.values()]


# ---- checks before work, files

def test_recipe_errors_come_before_any_job(spark):
    df = spark.range(10).select("id", F.lit("x").alias("a"))
    group = act("GROUP_BY", sourceColumns='["a"]', useNewDataFrame="false",
                groupByAggFunctionOptions='[{"sourceColumnName": "id", "targetColumnName": "n", "functionName": "COUNT"}]')
    bad = [act("YEAR", sourceColumn="nope"), act("MASK_RANGE", sourceColumns='["a"]', firstN="many"),
           act("FLAG_COLUMN_FROM_PATTERN", sourceColumn="a"), act("CRYPTOGRAPHIC_HASH", secretId="missing", sourceColumns='["a"]')]
    sc = spark.sparkContext
    for i, step in enumerate(bad):
        sc.setJobGroup(f"validate-{i}", "recipe checks")
        try:
            with pytest.raises(RecipeError):
                apply_recipe(df, [group, step])
            assert not sc.statusTracker().getJobIdsForGroup(f"validate-{i}")
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)
    assert apply_recipe(df, [group, act("FLAG_COLUMN_FROM_PATTERN", pattern="1", sourceColumn="n", targetColumn="f")]).count() == 10


def _job_count(spark, name, work):
    sc = spark.sparkContext
    sc.setJobGroup(name, name)
    try:
        work()
        return len(sc.statusTracker().getJobIdsForGroup(name))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_jobs_while_plans_are_built_are_few(spark):
    from ladle.plans.catalog import QUERIES
    assert _job_count(spark, "jobs-shuffle", lambda: QUERIES["shuffle_rows_default"](spark, "/root/testdata/sf0.001")) <= 8
    assert _job_count(spark, "jobs-flight", lambda: QUERIES["single_flight"](spark, "/root/testdata/sf0.001")) <= 15


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(text)


def test_csv_files_with_different_headers(spark):
    root = _folder(spark, "csv")
    _write(f"{root}/in/a.csv", "id,email\r\n1,a@x.com\r\n")
    _write(f"{root}/in/b.csv", 'email,id,extra\r\nb@x.com,2,"He said ""hi"""\r\n')
    got = read_inbound(spark, f"{root}/in/")
    assert sorted(map(tuple, got.select("id", "email", "extra").collect())) == [("1", "a@x.com", None), ("2", "b@x.com", 'He said "hi"')]
    _write(f"{root}/lines/a.csv", 'id,note\r\n1,"two\r\nlines"\r\n')
    assert [r.note.replace("\r", "") for r in read_inbound(spark, f"{root}/lines/", multi_line=True).collect()] == ["two\nlines"]


def test_connector_takes_each_file_once_and_survives_a_replay(spark):
    import time

    from ladle.streaming.connector import Connector
    root = _folder(spark, "conn")
    _write(f"{root}/inbound/a.csv", "email\r\na1@x.com\r\na2@x.com")
    name = os.path.basename(root).replace("-", "_")
    c = Connector(spark, f"{root}/inbound/", f"ladle_conn.t_{name}", f"ladle_conn.o_{name}", f"{root}/_ckpt", gap_seconds=1,
                  table_location=f"{root}/transform/t", short_gaps=True)
    batches = []
    inner = c._launch_batch
    c._launch_batch = lambda df, epoch: (batches.append((df.collect(), epoch)), inner(df, epoch))
    q = c.start(trigger={"processingTime": "1 second"})

    def wait(n):
        end = time.time() + 60
        while time.time() < end and not (spark.catalog.tableExists(c.table) and spark.read.table(c.table).count() >= n):
            time.sleep(1)

    try:
        wait(2)
        _write(f"{root}/inbound/b.csv", "email\r\nb1@x.com")
        wait(3)
    finally:
        q.stop()
    want = ["a1@x.com", "a2@x.com", "b1@x.com"]
    assert sorted(r.email for r in spark.read.table(c.table).collect()) == want
    for rows, epoch in [b for b in batches if b[0]]:
        inner(spark.createDataFrame(rows), epoch)  # the same micro-batch again
    assert sorted(r.email for r in spark.read.table(c.table).collect()) == want
    assert sorted(r.rows_written for r in spark.read.table(c.outcomes_table).collect()) == [1, 2]


def test_failure_causes_are_whole(spark):
    from ladle.plans.job import run_recipe_job
    out = run_recipe_job(spark, "/nowhere/at/all/", "ladle_test.none")
    assert out["state"] == "FAILED" and len(out["cause"].splitlines()) >= 1 and "/nowhere/at/all" in out["cause"]


def test_latest_event_time_is_the_latest_instant(spark):
    from ladle.streaming.envelope import key_and_latest
    rows = [(1, t, "b", "k", None) for t in ("2024-01-01T00:00:00Z", "2024-01-01T00:00:00.500Z", "2024-01-01T01:00:00+02:00")]
    df = spark.createDataFrame(rows, "batch int, event_time string, bucket string, object_key string, reject_reason string")
    assert key_and_latest(df, ["batch"]).first().latest_event_time == "2024-01-01T00:00:00.500000Z"


def test_csv_headers_with_empty_cells_and_line_breaks(spark):
    root = _folder(spark, "csv-odd")
    _write(f"{root}/in/a.csv", "id,email\r\n1,a@x.com\r\n")
    _write(f"{root}/in/b.csv", "email,id,\r\nb@x.com,2,\r\nc@x.com,3,more\r\n")
    _write(f"{root}/in/c.csv", "id,email,\r\n4,d@x.com,last\r\n")
    got = read_inbound(spark, f"{root}/in/").select("id", "email", "_c2").collect()
    assert sorted(map(tuple, got)) == [("1", "a@x.com", None), ("2", "b@x.com", None), ("3", "c@x.com", "more"), ("4", "d@x.com", "last")]
    _write(f"{root}/lines/a.csv", 'id,"full\r\nname"\r\n1,"x\r\ny"\r\n')
    _write(f"{root}/lines/b.csv", 'note,id,"full\nname"\nn,2,z\n')
    got = read_inbound(spark, f"{root}/lines/", multi_line=True).select("id", "full\nname", "note").collect()
    assert sorted((r.id, r[1].replace("\r", ""), r.note) for r in got) == [("1", "x\ny", None), ("2", "z", "n")]
    _write(f"{root}/in/d.csv", "\r\nid,other\r\n9,z\r\n,\r\n")
    with pytest.raises(Exception, match="no header row found"):
        read_inbound(spark, f"{root}/in/").count()
