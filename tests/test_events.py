"""Event envelope, late data, quiet period, ledger -- with the reference's fixtures."""

import datetime as dt
import json

from pyspark.sql import functions as F

from ladle.streaming.envelope import accepted, key_and_latest, rejects, unpack_messages
from ladle.streaming.ledger import build_ledger, live_ledger, match_completions, orphan_completions
from ladle.streaming.newer import newer_only
from ladle.streaming.quiet import quiet_sessions


def _body(records):
    return json.dumps({"Records": records})


def _rec(bucket, key, t):
    return {"eventTime": t, "s3": {"bucket": {"arn": bucket}, "object": {"key": key}}}


def test_two_level_envelope_and_rejects(spark):
    good = {"Records": [{"body": _body([_rec("bucket-b", "inbound/x.csv", "2024-01-01T00:00:05.000Z"),
                                        _rec("bucket-a", "inbound/y.csv", "2024-01-01T00:00:09.000Z")])},
                        {"body": _body([_rec("bucket-a", "inbound/z.csv", "2024-01-01T00:00:01.000Z")])},
                        {"body": json.dumps({"Event": "test"})}]}
    bad = {"Records": [{"body": _body([{"eventTime": "2024-01-01T00:00:00.000Z"}])}]}
    df = spark.createDataFrame([(1, json.dumps(good)), (2, json.dumps(bad))], "batch int, message string")
    recs = unpack_messages(df, "message", keep=["batch"])
    assert accepted(recs).count() == 3
    rj = rejects(recs).collect()
    assert len(rj) == 1 and rj[0].batch == 2 and "s3" in rj[0].reject_reason
    got = {r.batch: (r.watching_key, r.latest_event_time, r.n_records) for r in key_and_latest(recs, ["batch"]).collect()}
    assert got == {1: ("bucket-a;bucket-b", "2024-01-01T00:00:09.000000Z", 3)}


def _events(spark, n=400, seed=1):
    import random
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        k = "hot" if rnd.random() < 0.5 else f"k{rnd.randint(0, 5)}"
        ts = base + dt.timedelta(seconds=rnd.randint(0, 40000))
        arr = ts + dt.timedelta(seconds=rnd.randint(0, 3000))
        rows.append((i, k, ts, arr))
    return rows, spark.createDataFrame(rows, "id long, k string, ts timestamp_ntz, arr timestamp_ntz")


def test_newer_only_matches_brute_force(spark):
    rows, df = _events(spark)
    best, keep = {}, set()
    for i, k, ts, arr in sorted(rows, key=lambda r: (r[3], r[0])):
        if k not in best or ts > best[k]:
            keep.add(i)
        best[k] = max(best.get(k, ts), ts)
    got = {r.id for r in newer_only(df, "k", "ts", "arr", tiebreak="id").collect()}
    assert got == keep
    adaptive = {r.id for r in newer_only(df, "k", "ts", "arr", tiebreak="id", chunk_rows=13).collect()}
    assert adaptive == keep


def test_quiet_sessions_match_brute_force(spark):
    rows, df = _events(spark, 600, seed=4)
    gap = 120
    expect = []
    for k in {r[1] for r in rows}:
        ts = sorted(r[2] for r in rows if r[1] == k)
        start = prev = ts[0]
        n = 0
        for t in ts:
            if (t - prev).total_seconds() > gap:
                expect.append((k, start, prev, n))
                start, n = t, 0
            prev, n = t, n + 1
        expect.append((k, start, prev, n))
    got = [(r.k, r.session_start, r.session_end, r.n_events) for r in quiet_sessions(df, "k", "ts", gap).collect()]
    assert sorted(got) == sorted(expect)
    launch = quiet_sessions(df, "k", "ts", gap).select(
        (F.col("launch_at") - F.col("session_end")).alias("d")).distinct().collect()
    assert [r.d for r in launch] == [dt.timedelta(seconds=gap)]


def test_quiet_period_minimum():
    import pytest
    from ladle.streaming.quiet import check_gap
    with pytest.raises(ValueError):
        check_gap(10)


def test_ledger_expiry_is_seven_days_and_last_write_wins(spark):
    t0 = dt.datetime(2024, 1, 1, 12, 0, 0)
    starts = spark.createDataFrame([("job-1", "tok-a", t0), ("job-1", "tok-b", t0 + dt.timedelta(hours=1)),
                                    ("job-2", "tok-c", t0)], "job_id string, task_token string, started_at timestamp_ntz")
    led = {r.job_id: r for r in build_ledger(starts).collect()}
    assert led["job-1"].task_token == "tok-b"
    assert led["job-2"].exp_timestamp - int(t0.replace(tzinfo=dt.timezone.utc).timestamp()) == 7 * 86400
    now = F.lit(t0 + dt.timedelta(days=7, minutes=30)).cast("timestamp_ntz")
    assert [r.job_id for r in live_ledger(build_ledger(starts), now).collect()] == ["job-1"]
    comps = spark.createDataFrame([
        (1, "job-1", t0 + dt.timedelta(days=1), "SUCCEEDED"),
        (2, "job-2", t0 + dt.timedelta(days=8), "SUCCEEDED"),   # expired
        (3, "job-3", t0, "SUCCEEDED"),                          # unknown
        (4, "job-2", t0 + dt.timedelta(days=2), "FAILED")],
        "completion_id int, job_id string, completed_at timestamp_ntz, state string")
    res = {r.completion_id: (r.result, r.task_token, r.cause)
           for r in match_completions(comps, starts).collect()}
    assert res[1] == ("Success", "tok-b", None)
    assert res[2][0] == "Fail" and res[2][1] is None
    assert res[3][0] == "Fail"
    assert res[4] == ("Fail", "tok-c", "run ended in state FAILED")
    assert sorted(r.completion_id for r in orphan_completions(comps, starts).collect()) == [2, 3]


def test_single_flight_batch_matches_greedy(spark):
    import random
    from ladle.streaming.flight import single_flight
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(700):
        k = "hot" if rnd.random() < 0.6 else f"k{rnd.randint(0, 4)}"
        rows.append((i, k, base + dt.timedelta(seconds=rnd.randint(0, 200000))))
    df = spark.createDataFrame(rows, "id long, k string, ts timestamp_ntz")
    run = 3600
    expect = {}
    for k in {r[1] for r in rows}:
        until = None
        for i, _, t in sorted((r for r in rows if r[1] == k), key=lambda r: (r[2], r[0])):
            start = until is None or t >= until
            if start:
                until = t + dt.timedelta(seconds=run)
            expect[i] = start
    got = {r.id: r.started for r in single_flight(df, "k", "ts", run, tiebreak="id", chunk_rows=37).collect()}
    assert got == expect
