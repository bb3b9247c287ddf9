"""Event-time streams: any order within the delay, over several micro-batches, gives what the batch forms give."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ladle.functions.time import parse_iso
from ladle.streaming import eventtime as et
from ladle.streaming.envelope import key_and_latest, message_key_and_latest, unpack_messages
from ladle.streaming.ledger import match_completions
from ladle.streaming.live import run_available_now
from ladle.streaming.quiet import quiet_sessions


class Replay:
    """Files landed in turns; after each the stream takes in what is new."""

    def __init__(self, spark, tmp_path, name):
        self.spark, self.root, self.name = spark, tmp_path, f"default.{name}_{random.randrange(1 << 40)}"
        self.turn, self.checkpoint = 0, str(tmp_path / "checkpoint")

    def stream(self, what, schema):
        (self.root / what).mkdir(exist_ok=True)
        return self.spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(str(self.root / what))

    def take(self, out, **frames):
        self.turn += 1
        for what, df in frames.items():
            df.write.parquet(str(self.root / what / str(self.turn)))
        run_available_now(out, self.name, self.checkpoint)
        return self.spark.table(self.name)


def times(seconds):
    return F.timestamp_seconds(F.lit(1_700_000_000) + seconds)


def test_bursts_closed_over_micro_batches_in_any_order(spark, tmp_path):
    rng = random.Random(4)
    rows = [(rng.choice("abc"), rng.randrange(0, 12000)) for _ in range(400)] + [("a", 20000), ("a", 20040), ("a", 20081), (None, 5)]
    r = Replay(spark, tmp_path, "bursts")
    src = spark.createDataFrame(rows, "k string, s int").select("k", "s", times(F.col("s")).alias("ts"))
    out = et.quiet_period_replay(r.stream("in", src.schema), "k", "ts", 40, delay="50 minutes")
    r.take(out, **{"in": src.where("s < 6000")})
    first = r.take(out, **{"in": src.where("s >= 5000 and s < 9000 and s >= 6000")}).count()
    end = spark.createDataFrame([("~", 10**6)], "k string, s int").select("k", "s", times(F.col("s")).alias("ts"))
    got = r.take(out, **{"in": src.where("s >= 9000").unionByName(end)}).where("key <> '~'")
    assert 0 < first < got.count()
    want = quiet_sessions(src.where("k is not null"), "k", "ts", 40)
    key = lambda df, k: sorted((x[k], x[1], x[2], x[3], x["launch_at"]) for x in df.collect())
    assert key(got, "key") == key(want.select("k", "session_start", "session_end", "n_events", "launch_at"), "k")


@pytest.mark.parametrize("seed", range(5))
def test_fold_bursts_against_one_by_one(seed):
    rng = np.random.default_rng(seed)
    first = rng.integers(0, 500, 60)
    last = first + rng.integers(0, 15, 60)
    got = list(zip(*[x.tolist() for x in et.fold_bursts(first, last, np.ones(60, np.int64), 5)]))
    want = []
    for a, b in sorted(zip(first.tolist(), last.tolist())):
        if want and a - want[-1][1] <= 5:
            want[-1] = (want[-1][0], max(want[-1][1], b), want[-1][2] + 1)
        else:
            want.append((a, b, 1))
    assert got == want


def test_ledger_holds_completions_until_the_watermark(spark, tmp_path):
    """A start that arrives after its completion, runs of one job, expiry, and the runs left open."""
    day = 86400
    starts = [("a", "t1", 100), ("a", "t2", 5000), ("b", "late", 50), ("c", "c1", 0), ("d", "d1", 9 * day), ("d", "d0", 9 * day), ("e", "e1", 9 * day + 5)]
    comps = [(1, "a", 150, "SUCCEEDED"), (2, "a", 5000, "FAILED"), (3, "b", 60, "SUCCEEDED"), (4, "c", 7 * day, "SUCCEEDED"),
             (5, "c", 7 * day + 1, "SUCCEEDED"), (6, "x", 10, None), (7, "a", 99, "SUCCEEDED"), (8, "e", 9 * day + 6, None)]
    s = spark.createDataFrame(starts, "job_id string, task_token string, s long").select("job_id", "task_token", times(F.col("s")).alias("started_at"))
    c = spark.createDataFrame(comps, "id long, job_id string, s long, state string").select(
        "id", "job_id", times(F.col("s")).alias("completed_at"), "state")
    r = Replay(spark, tmp_path, "ledger")
    out = et.ledger_outcomes(r.stream("s", s.schema), r.stream("c", c.schema), delay="1 hour", ref="id")
    r.take(out, s=s.where("job_id = 'a' and task_token = 't1'"), c=c.where("id in (1, 3)"))  # b's start is yet to come
    r.take(out, s=s.where("task_token in ('t2', 'late', 'c1')"), c=c.where("id in (2, 6, 7)"))
    r.take(out, s=s.where("task_token in ('d0', 'd1', 'e1')"), c=c.where("id in (4, 5, 8)"))
    end = spark.createDataFrame([("~", "", 9 * day + 7200)], "job_id string, task_token string, s long").select(
        "job_id", "task_token", times(F.col("s")).alias("started_at"))
    got = r.take(out, s=end, c=c.limit(0))
    cols = ["job_id", "completed_at", "state", "task_token", "started_at", "result", "cause"]
    row = lambda x: tuple(str(x[k]) for k in cols)
    want = {str(x["id"]): row(x) for x in match_completions(c, s).collect()}
    assert {x["ref"]: row(x) for x in got.collect()} == want and len(want) == 8
    live = {(x.job_id, x.task_token) for x in et.open_runs(spark, r.checkpoint).collect()}
    assert live == {("d", "d0"), ("d", "d1"), ("~", "")}  # e's run ended in an unknown state; the others are done or expired


def test_ledger_shares_state_keys_among_jobs(spark, tmp_path):
    """State has a key per group, however many jobs there are; the jobs of a group do not touch each other's runs."""
    rng = random.Random(11)
    starts = [(f"j{rng.randrange(300)}", f"t{i}", rng.randrange(0, 20000)) for i in range(500)]
    starts += starts[:20] + [("j0", "same", 100), ("j1", "same", 100)]
    comps = [(i, f"j{i % 301}", 30000 + 7 * i, "SUCCEEDED" if i % 3 else "FAILED") for i in range(400)]
    s = spark.createDataFrame(starts, "job_id string, task_token string, s long").select("job_id", "task_token", times(F.col("s")).alias("started_at"))
    c = spark.createDataFrame(comps, "id long, job_id string, s long, state string").select(
        "id", "job_id", times(F.col("s")).alias("completed_at"), "state")
    r = Replay(spark, tmp_path, "groups")
    out = et.ledger_outcomes(r.stream("s", s.schema), r.stream("c", c.schema), ref="id", groups=4)
    r.take(out, s=s, c=c.where("id < 200"))
    end = spark.createDataFrame([("~", "", 50000)], "job_id string, task_token string, s long").select(
        "job_id", "task_token", times(F.col("s")).alias("started_at"))
    got = r.take(out, s=end, c=c.where("id >= 200"))
    row = lambda x: (x["job_id"], x["task_token"], x["result"], x["cause"])
    assert {x["ref"]: row(x) for x in got.collect()} == {str(x["id"]): row(x) for x in match_completions(c, s).collect()}
    done = {(x["job_id"], x["task_token"]) for x in got.collect()}
    live = [(x.job_id, x.task_token) for x in et.open_runs(spark, r.checkpoint).collect()]
    assert sorted(live) == sorted(({x[:2] for x in starts} | {("~", "")}) - done)
    state = spark.read.format("statestore").option("path", r.checkpoint).option("stateVarName", "runs").load()
    assert state.count() <= 4


def message(*records):
    return json.dumps({"Records": [{"body": json.dumps({"Records": [x]} if x is not None else {"Event": "test"})} for x in records]})


def record(bucket=None, key=None, at=None):
    return {"eventTime": at, "s3": {"bucket": {"arn": bucket}, "object": {"key": key}}}


def test_message_key_within_the_row_equals_the_grouped_form(spark):
    rows = [(1, message(record("b", "x", "2024-01-01T00:00:00Z"), record("a", "y", "2024-01-01T02:00:00+03:00"))),
            (2, message(record("b", None, "2024-01-01T00:00:00Z"), record("a", "y", "2024-01-01 00:00:00.5"))),
            (3, message(None, record("b", "k"))), (4, "not json"), (5, None), (6, message({"eventTime": "2024-01-01T00:00:00Z"})),
            (7, message(record("z", "k", "no time"), record("z", "l", "2024-01-01T00:00:00.123456Z")))]
    df = spark.createDataFrame(rows, "id long, message string")
    got = {r.id: (r.watching_key, r.us, r.n_records) for r in message_key_and_latest(df, "message", ["id"])
           .withColumn("us", F.unix_micros("latest")).collect()}
    want = {r.id: (r.watching_key, r.us, r.n_records) for r in key_and_latest(unpack_messages(df, "message", ["id"]), ["id"])
            .withColumn("us", F.unix_micros(parse_iso(F.col("latest_event_time")))).collect()}
    assert got == want and set(got) == {1, 2, 7}
    assert {r.reject_reason for r in et.message_rejects(df, "message", ["id"]).collect()} == {
        "record has no bucket or object key", "record has no eventTime", "record has no s3 section"}


def test_launches_chain_newer_and_quiet(spark, tmp_path):
    """Messages of two keys over three turns; those not newer than all before them start nothing and stretch no burst."""
    iso = lambda s: f"2024-01-01T{s // 3600:02d}:{s // 60 % 60:02d}:{s % 60:02d}Z"
    sent = [(i, k, s) for i, (k, s) in enumerate([("a", 100), ("a", 130), ("b", 500), ("a", 120), ("a", 161), ("a", 160),  # one burst of a
                                                  ("a", 500), ("b", 510), ("a", 480), ("a", 531), ("b", 9000), ("a", 8000)])]
    rows = [(f"{i:04d}", message(record(k, "o", iso(s)))) for i, k, s in sent]
    df = spark.createDataFrame(rows, "seq string, message string")
    r = Replay(spark, tmp_path, "launches")
    out = et.launches(r.stream("m", df.schema), "message", "seq", 30, delay="10 minutes")
    for lo, hi in (("0000", "0004"), ("0004", "0009")):
        r.take(out, m=df.where((F.col("seq") >= lo) & (F.col("seq") < hi)))
    end = spark.createDataFrame([("~", message(record("~", "o", "2030-01-01T00:00:00Z")))], df.schema)
    got = r.take(out, m=df.where("seq >= '0009'").unionByName(end)).where("key <> '~'")
    got = sorted((x.key, x.a, x.b, x.n_events) for x in got.select(
        "key", (F.unix_seconds("first_arrival") - 1704067200).alias("a"), (F.unix_seconds("last_arrival") - 1704067200).alias("b"), "n_events").collect())
    # 161 is 31 s after 130 and begins a burst; 120, 160 and 480 are not newer; 531 is 31 s after 500
    assert got == [("a", 100, 130, 2), ("a", 161, 161, 1), ("a", 500, 500, 1), ("a", 531, 531, 1), ("a", 8000, 8000, 1),
                   ("b", 500, 510, 2), ("b", 9000, 9000, 1)]


@pytest.mark.parametrize("text,want", [
    ("2024-01-01T00:00:00Z", 0), ("2024-01-01T00:00:00", 0), ("2024-01-01 00:00:00", 0), ("2024-01-01T02:00:00+02:00", 0),
    ("2024-01-01T00:00:00.250Z", 250_000), ("2024-01-01T00:00:00.000001Z", 1), ("2023-12-31T21:30:00-02:30", 0),
    ("2024-01-01", None), ("2024-13-01T00:00:00Z", None), ("now", None), ("", None), (None, None), ("2024-1-1T0:0:0Z", None)])
def test_iso_forms(spark, text, want):
    (r,) = spark.createDataFrame([(text,)], "t string").select(F.unix_micros(parse_iso(F.col("t"))).alias("us")).collect()
    assert (r.us if r.us is None else r.us - 1704067200_000_000) == want


def test_notified_connector_runs_over_what_landed(spark, tmp_path):
    """Messages -> launch -> a run over the new files; repeated messages and replays add nothing."""
    import uuid

    from ladle.streaming.connector import NotifiedConnector
    (tmp_path / "in").mkdir()
    (tmp_path / "q").mkdir()
    name = f"ladle_note.t_{uuid.uuid4().hex[:8]}"
    c = NotifiedConnector(spark, str(tmp_path / "q"), str(tmp_path / "in"), name, f"{name}_runs", f"{name}_bad", str(tmp_path / "ck"),
                          table_location=str(tmp_path / "t"), gap_seconds=30, delay="1 minute")

    def send(file, *records):
        (tmp_path / "q" / file).write_text(message(*records) + "\n")
        for q in c.start(trigger={"availableNow": True}):
            q.awaitTermination()

    (tmp_path / "in" / "a.csv").write_text("id,v\n1,x\n2,y\n")
    send("1", record("landing", "a.csv", "2024-01-01T00:00:00Z"), record("landing", None, "2024-01-01T00:00:00Z"))
    assert not spark.catalog.tableExists(name)  # the burst is not quiet yet
    send("2", record("other", "z.csv", "2024-01-01T01:00:00Z"))  # an hour later: landing's burst has closed
    ids = lambda: sorted(r.id for r in spark.table(name).collect())
    assert ids() == ["1", "2"]
    (tmp_path / "in" / "b.csv").write_text("id,v\n3,z\n")
    send("3", record("landing", "a.csv", "2024-01-01T00:00:00Z"))  # an old message again
    send("4", record("landing", "b.csv", "2024-01-01T02:00:00Z"))
    send("5", record("heartbeat", "-", "2024-01-01T05:00:00Z"))
    assert ids() == ["1", "2", "3"]
    runs = spark.table(f"{name}_runs").collect()
    assert sorted(r.rows_written for r in runs) == [1, 2] and {r.result for r in runs} == {"Success"}
    assert [r.reject_reason for r in spark.table(f"{name}_bad").collect()] == ["record has no bucket or object key"]
