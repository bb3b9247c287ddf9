"""Streaming forms: stateful processors and the stream-stream join."""

import datetime as dt
import os
import time

import pandas as pd

from ladle.session import scratch_dir
from ladle.streaming.live import (completions_with_runs, newer_only_stream, quiet_period_live,
                                  single_flight_stream)


def _local(p):
    return p.replace("file:", "")


def _drop(folder, name, pdf):
    os.makedirs(folder, exist_ok=True)
    pdf.to_parquet(f"{folder}/{name}.parquet", index=False, coerce_timestamps="us", allow_truncated_timestamps=True)


def _run(df, spark, name, trigger=None, wait=None):
    q = df.writeStream.format("memory").queryName(name).outputMode("append")
    q = q.trigger(**(trigger or {"availableNow": True})).start()
    if wait:
        deadline = time.time() + wait
        while time.time() < deadline:
            time.sleep(0.5)
    else:
        q.awaitTermination(120)
    q.stop()
    return spark.table(name)


def _run_until(df, spark, name, n_rows, timeout=90):
    """Processing-time trigger, stopped once ``n_rows`` rows reached the sink
    (processors in processing-time mode keep running no-data batches)."""
    q = df.writeStream.format("memory").queryName(name).outputMode("append") \
        .trigger(processingTime="1 second").start()
    deadline = time.time() + timeout
    while time.time() < deadline and spark.table(name).count() < n_rows:
        time.sleep(1)
    q.stop()
    return spark.table(name)


def test_newer_only_stream_across_batches(spark):
    root = _local(scratch_dir(spark, "s"))
    t = dt.datetime(2024, 1, 1)
    _drop(f"{root}/in", "a", pd.DataFrame({"k": ["a", "a", "b"], "ts": [t, t + dt.timedelta(1), t], "seq": [1, 2, 3]}))
    _drop(f"{root}/in", "b", pd.DataFrame({"k": ["a", "a", "b"], "ts": [t, t + dt.timedelta(2), t], "seq": [4, 5, 6]}))
    src = spark.readStream.schema("k string, ts timestamp_ntz, seq long").option("maxFilesPerTrigger", 1) \
        .parquet(f"{root}/in")
    out = _run(newer_only_stream(src, "k", "ts", "seq"), spark, "newer_q")
    assert sorted(r.seq for r in out.collect()) == [1, 2, 3, 5]


def test_single_flight_stream(spark):
    root = _local(scratch_dir(spark, "s"))
    t = dt.datetime(2024, 1, 1)
    reqs = [t, t + dt.timedelta(minutes=5), t + dt.timedelta(minutes=11), t + dt.timedelta(minutes=12)]
    _drop(f"{root}/in", "a", pd.DataFrame({"k": ["x"] * 4, "requested_at": reqs}))
    src = spark.readStream.schema("k string, requested_at timestamp_ntz").parquet(f"{root}/in")
    out = _run(single_flight_stream(src, "k", "requested_at", 600), spark, "flight_q")
    assert [r.started for r in out.orderBy("requested_at").collect()] == [True, False, True, False]


def test_quiet_period_live_fires_without_new_data(spark):
    root = _local(scratch_dir(spark, "s"))
    t = dt.datetime(2024, 1, 1)
    _drop(f"{root}/in", "a", pd.DataFrame({"k": ["x", "x", "y"], "ts": [t, t + dt.timedelta(seconds=1), t]}))
    src = spark.readStream.schema("k string, ts timestamp_ntz").parquet(f"{root}/in")
    out = _run(quiet_period_live(src, "k", "ts", 2), spark, "quiet_q",
               trigger={"processingTime": "1 second"}, wait=9)
    got = {r.key: r.n_events for r in out.collect()}
    assert got == {"x": 2, "y": 1}


def test_stream_stream_completion_join(spark):
    root = _local(scratch_dir(spark, "s"))
    t = dt.datetime(2024, 1, 1)
    _drop(f"{root}/starts", "a", pd.DataFrame({"job_id": ["j1", "j2"], "task_token": ["t1", "t2"],
                                               "started_at": [t, t]}))
    _drop(f"{root}/comps", "a", pd.DataFrame({"job_id": ["j1", "j3"], "completed_at": [t + dt.timedelta(hours=1)] * 2}))
    starts = spark.readStream.schema("job_id string, task_token string, started_at timestamp_ntz") \
        .parquet(f"{root}/starts")
    comps = spark.readStream.schema("job_id string, completed_at timestamp_ntz").parquet(f"{root}/comps")
    out = _run(completions_with_runs(comps, starts), spark, "join_q")
    got = {r.job_id: r.task_token for r in out.collect()}
    assert got.get("j1") == "t1"


def test_connector_end_to_end(spark):
    import json
    from ladle.plans.recipe import RecipeContext
    from ladle.streaming.connector import Connector
    root = _local(scratch_dir(spark, "conn"))
    os.makedirs(f"{root}/inbound")
    for i, rows in enumerate([["jwhite@domain.com", "mhall@domain.com"], ["cdiaz@domain.com"]]):
        with open(f"{root}/inbound/drop{i}.csv", "w") as f:
            f.write("email\r\n" + "\r\n".join(rows))
    open(f"{root}/inbound/empty-file-object", "w").close()
    recipe = json.dumps([{"Action": {"Operation": "MASK_RANGE", "Parameters": {
        "alphabet": "[\"WHITESPACE\",\"SYMBOLS\"]", "firstN": "5", "maskMode": "MASK_FIRST_N",
        "maskSymbol": "#", "sourceColumns": "[\"email\"]", "stop": "5"}}}])
    name = os.path.basename(root).replace("-", "_")
    c = Connector(spark, f"{root}/inbound/", f"ladle_conn.t_{name}", f"ladle_conn.o_{name}", f"{root}/_ckpt",
                  recipe=recipe, ctx=RecipeContext(), table_location=f"{root}/transform/t", gap_seconds=2, short_gaps=True)
    q = c.start(trigger={"processingTime": "1 second"})
    deadline = time.time() + 40
    while time.time() < deadline and not spark.catalog.tableExists(c.outcomes_table):
        time.sleep(1)
    time.sleep(2)
    q.stop()
    out = sorted(r.email for r in spark.read.table(c.table).collect())
    assert out == ["#####@domain.com", "#####@domain.com", "#####e@domain.com"]
    res = spark.read.table(c.outcomes_table).collect()
    assert len(res) == 1 and res[0].result == "Success" and res[0].n_files == 2 and res[0].rows_written == 3


def test_run_ledger_stream_with_ttl_state(spark):
    from ladle.streaming.live import run_ledger_stream
    root = _local(scratch_dir(spark, "s"))
    t = dt.datetime(2024, 1, 1)
    _drop(f"{root}/starts", "a", pd.DataFrame({"job_id": ["j1", "j3", "j4"], "task_token": ["t1", "t3", "t4"],
                                               "started_at": [t, t, t]}))
    _drop(f"{root}/comps", "a", pd.DataFrame({
        "job_id": ["j1", "j2", "j3", "j4"],
        "completed_at": [t + dt.timedelta(hours=1), t, t + dt.timedelta(days=8), t + dt.timedelta(hours=2)],
        "state": ["SUCCEEDED", "SUCCEEDED", "SUCCEEDED", "FAILED"]}))
    starts = spark.readStream.schema("job_id string, task_token string, started_at timestamp_ntz").parquet(f"{root}/starts")
    comps = spark.readStream.schema("job_id string, completed_at timestamp_ntz, state string").parquet(f"{root}/comps")
    out = _run_until(run_ledger_stream(starts, comps), spark, "ledger_q", 4)
    got = {r.job_id: (r.result, r.task_token, r.cause) for r in out.collect()}
    assert got == {"j1": ("Success", "t1", None), "j2": ("Fail", None, "no open run for the job id"),
                   "j3": ("Fail", None, "no open run for the job id"),
                   "j4": ("Fail", "t4", "run ended in state FAILED")}
