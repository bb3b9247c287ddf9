"""Registered replays of streams: each table is landed in drops, and the stream takes in one drop after the other.

After every drop the stream is started again from its checkpoint, takes in what is new and stops.  Drops follow each
other in time; rows within a drop come in any order.  The last drop also holds a closing row of a key of its
own, far enough ahead to take the watermark past all other rows; it takes effect after the drop is taken in.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.plans.catalog import _landing, _stream_table, query, table

DROPS = 2
END = "~end"


def _cuts(spark: SparkSession, sf: str) -> list:
    """Ends of the drops: whole hours that cut the events' time into equal parts."""
    lo, hi = table(spark, sf, "events").agg(F.min("ts"), F.max("ts")).first()
    if lo is None:
        return []
    return [(lo + (hi - lo) * k / DROPS).replace(minute=0, second=0, microsecond=0) for k in range(1, DROPS)]


def _drops(df: DataFrame, at: str, cuts: list) -> list[DataFrame]:
    """``df`` cut at the given times of its column ``at``."""
    ends = [None, *cuts, None]
    out = []
    for lo, hi in zip(ends, ends[1:]):
        part = df if lo is None else df.where(F.col(at) >= F.lit(lo).cast("timestamp_ntz"))
        out.append(part if hi is None else part.where(F.col(at) < F.lit(hi).cast("timestamp_ntz")))
    return out


def _replay(spark: SparkSession, drops: list[dict[str, DataFrame]], build: Callable[..., DataFrame]) -> tuple[DataFrame, str]:
    """Lands each drop's frames, runs ``build(**streams)`` after each; (what it wrote, its checkpoint)."""
    from ladle.session import with_state_store
    from ladle.streaming.live import run_available_now
    with_state_store(spark)
    root = _landing(spark)
    name, checkpoint = _stream_table(spark)
    out = None
    for i, drop in enumerate(drops):
        for what, df in drop.items():
            df.write.parquet(f"{root}/{what}/drop{i}")
        if out is None:  # the folders are there now
            out = build(**{what: spark.readStream.schema(df.schema).option("recursiveFileLookup", True).parquet(f"{root}/{what}")
                           for what, df in drop.items()})
        run_available_now(out, name, checkpoint)
    return spark.read.table(name), checkpoint


def _end(spark: SparkSession, like: DataFrame, values: dict[str, str]) -> DataFrame:
    """A closing row: SQL expressions by column, the other columns null."""
    columns = [F.expr(values.get(f.name, "null")).cast(f.dataType).alias(f.name) for f in like.schema.fields]
    return spark.range(1).select(*columns)


def _wall(df: DataFrame, *columns: str) -> DataFrame:
    """Instants as UTC wall-clock times, whatever the session's time zone."""
    return df.withColumns({c: F.expr(f"timestampadd(MICROSECOND, unix_micros({c}), TIMESTAMP_NTZ '1970-01-01 00:00:00')") for c in columns})


# ---------------------------------------------------------------- E5 by event time
_SESSIONS = """
WITH e AS (SELECT event_type, ts,
                  CASE WHEN ts - lag(ts) OVER (PARTITION BY event_type ORDER BY ts) > INTERVAL 30 MINUTE
                       THEN 1 ELSE 0 END AS brk FROM events),
s AS (SELECT event_type, ts, sum(brk) OVER (PARTITION BY event_type ORDER BY ts
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM e)
SELECT event_type, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n_events,
       max(ts) + INTERVAL 30 MINUTE AS launch_at
FROM s GROUP BY event_type, sid
"""


@query("stream_quiet_period", _SESSIONS)
def stream_quiet_period(spark, sf):
    """E5 live, by event-time timers: the rows of ``quiet_period`` from a stream over several drops."""
    from ladle.streaming.eventtime import quiet_period_replay
    ev = table(spark, sf, "events").select("event_type", "ts")
    parts = _drops(ev, "ts", _cuts(spark, sf))
    end = _end(spark, ev, {"event_type": f"'{END}'", "ts": "timestamp_ntz'2200-01-01 00:00:00'"})
    parts[-1] = parts[-1].unionByName(end)
    got, _ = _replay(spark, [{"e": p} for p in parts], lambda e: quiet_period_replay(e, "event_type", "ts", 30 * 60))
    rows = _wall(got.where(F.col("key") != END), "first_arrival", "last_arrival", "launch_at")
    return rows.select(F.col("key").alias("event_type"), F.col("first_arrival").alias("session_start"),
                       F.col("last_arrival").alias("session_end"), "n_events", "launch_at")


# ---------------------------------------------------------------- E1-E5 in one stream
_NO_KEY, _NO_TIME = "event_id % 23 = 0", "event_id % 29 = 0"


@query("stream_launches", f"""
WITH e AS (SELECT *, ts AS at, date_trunc('hour', ts) AS slot, {_NO_KEY} AS no_key, {_NO_TIME} AND NOT {_NO_KEY} AS no_time FROM events),
m AS (SELECT slot, user_id, array_to_string(list_sort(list_distinct(list('landing-' || event_type))), ';') AS k, max(ts) AS t
      FROM e WHERE NOT no_key AND NOT no_time GROUP BY slot, user_id),
n AS (SELECT *, max(t) OVER (PARTITION BY k ORDER BY slot, user_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM m),
b AS (SELECT k, t, CASE WHEN t - lag(t) OVER (PARTITION BY k ORDER BY t) > INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS brk
      FROM n WHERE seen IS NULL OR t > seen),
s AS (SELECT k, t, sum(brk) OVER (PARTITION BY k ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM b)
SELECT 'launch' AS kind, k AS watching_key, min(t) AS first_arrival, max(t) AS last_arrival, count(*) AS n, NULL AS object_key,
       max(t) + INTERVAL 30 MINUTE AS launch_at FROM s GROUP BY k, sid
UNION ALL
SELECT CASE WHEN no_key THEN 'record has no bucket or object key' ELSE 'record has no eventTime' END, 'landing-' || event_type,
       NULL, NULL, count(*), CASE WHEN no_time THEN 'inbound/' || event_id || '.csv' END, NULL
FROM e WHERE no_key OR no_time GROUP BY ALL
""")
def stream_launches(spark, sf):
    """Envelope messages -> newer than all before for their key -> quiet period, in one query; rejected records in a second sink.

    A message holds what a user's events of one hour brought; some records lack their object key or time.
    """
    from ladle.functions.time import iso_text
    from ladle.streaming.envelope import message_body
    from ladle.streaming.eventtime import launches, message_rejects
    ev = table(spark, sf, "events")
    gone = F.expr(_NO_KEY)
    body = message_body(F.when(~F.expr(_NO_TIME) | gone, iso_text(F.col("ts"))), F.concat(F.lit("landing-"), F.col("event_type")),
                        F.when(~gone, F.concat(F.lit("inbound/"), F.col("event_id").cast("string"), F.lit(".csv"))))
    slot = F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz")
    messages = (ev.select("user_id", slot.alias("slot"), F.struct(body.alias("body")).alias("r"))
                .groupBy("slot", "user_id").agg(F.to_json(F.struct(F.collect_list("r").alias("Records"))).alias("message"))
                .withColumn("seq", F.concat_ws(" ", F.date_format("slot", "yyyyMMddHH"), F.format_string("%018d", "user_id"))))
    parts = [p.select("seq", "message") for p in _drops(messages, "slot", _cuts(spark, sf))]
    end = spark.range(1).select(
        F.lit("~").alias("seq"), F.to_json(F.struct(F.array(F.struct(message_body(
            F.lit("2200-01-01T00:00:00Z"), F.lit(END), F.lit("end")).alias("body"))).alias("Records"))).alias("message"))
    parts[-1] = parts[-1].unionByName(end)
    drops = [{"m": p} for p in parts]
    got, _ = _replay(spark, drops, lambda m: launches(m, "message", "seq", 30 * 60, delay="2 hours"))
    bad, _ = _replay(spark, drops, lambda m: message_rejects(m, "message", ["seq"]))
    got = _wall(got.where(F.col("key") != END), "first_arrival", "last_arrival", "launch_at").select(
        F.lit("launch").alias("kind"), F.col("key").alias("watching_key"), "first_arrival", "last_arrival", F.col("n_events").alias("n"),
        F.lit(None).cast("string").alias("object_key"), "launch_at")
    bad = bad.groupBy(F.col("reject_reason").alias("kind"), F.col("bucket").alias("watching_key"), "object_key").agg(
        F.count(F.lit(1)).alias("n"))
    return got.unionByName(bad, allowMissingColumns=True)


# ---------------------------------------------------------------- E7: outcomes and open runs
@query("stream_ledger", """
WITH s AS (SELECT 'job-' || user_id AS job_id, max(md5(CAST(event_id AS VARCHAR))) AS task_token, ts AS started_at
           FROM events WHERE event_type = 'view' GROUP BY 1, 3),
c AS (SELECT event_id, 'job-' || user_id AS job_id, ts AS completed_at, CASE WHEN value >= 1.0 THEN 'SUCCEEDED' ELSE 'FAILED' END AS state
      FROM events WHERE event_type = 'purchase'),
j AS (SELECT c.*, s.started_at, CASE WHEN floor(epoch(c.completed_at)) <= floor(epoch(s.started_at)) + 604800 THEN s.task_token END AS task_token
      FROM c ASOF LEFT JOIN s ON c.job_id = s.job_id AND c.completed_at >= s.started_at),
e AS (SELECT date_trunc('second', max(ts)) + INTERVAL 2 SECOND AS at FROM events)
SELECT CAST(event_id AS VARCHAR) AS ref, job_id, completed_at, task_token,
       CASE WHEN task_token IS NULL THEN 'no open run for the job id'
            WHEN state <> 'SUCCEEDED' THEN 'run ended in state ' || state ELSE state END AS outcome FROM j
UNION ALL
SELECT NULL, s.job_id, NULL, s.task_token, 'open' FROM s, e
WHERE NOT EXISTS (SELECT 1 FROM j WHERE j.job_id = s.job_id AND j.task_token = s.task_token)
  AND epoch(e.at) < floor(epoch(s.started_at)) + 604801
""")
def stream_ledger(spark, sf):
    """Run starts and completions through keyed state: every completion's outcome, and the runs that are open at the
    end, read from the state store."""
    from ladle.streaming.eventtime import ledger_outcomes, open_runs
    ev = table(spark, sf, "events")
    job = F.concat(F.lit("job-"), F.col("user_id").cast("string")).alias("job_id")
    views = ev.where("event_type = 'view'").select(job, F.md5(F.col("event_id").cast("string")).alias("task_token"),
                                                   F.col("ts").alias("started_at"))
    starts = views.groupBy("job_id", "started_at").agg(F.max("task_token").alias("task_token"))
    comps = ev.where("event_type = 'purchase'").select(
        F.col("event_id"), job, F.col("ts").alias("completed_at"),
        F.when(F.col("value") >= 1.0, F.lit("SUCCEEDED")).otherwise(F.lit("FAILED")).alias("state"))
    cuts = _cuts(spark, sf)
    last = ev.agg(F.date_trunc("second", F.max("ts")).cast("timestamp_ntz")).first()[0]
    at = f"timestamp_ntz'{last or '2000-01-01 00:00:00'}' + interval 1 hour 2 seconds"  # the watermark's delay, and past the last row
    drops = [{"s": s, "c": c} for s, c in zip(_drops(starts, "started_at", cuts), _drops(comps, "completed_at", cuts))]
    drops[-1]["s"] = drops[-1]["s"].unionByName(_end(spark, starts, {"job_id": f"'{END}'", "task_token": "''", "started_at": at}))
    got, checkpoint = _replay(spark, drops, lambda s, c: ledger_outcomes(s, c, ref="event_id"))
    text = F.when(F.col("result") == "Success", F.col("state")).otherwise(F.col("cause"))
    done = _wall(got, "completed_at").select("ref", "job_id", "completed_at", "task_token", text.alias("outcome"))
    live = open_runs(spark, checkpoint).where(F.col("job_id") != END).select("job_id", "task_token", F.lit("open").alias("outcome"))
    return done.unionByName(live, allowMissingColumns=True)


# ---------------------------------------------------------------- E8
@query("stream_completions", f"""
WITH s AS (SELECT 'job-' || CAST(event_id AS VARCHAR) AS job_id, md5(CAST(event_id AS VARCHAR)) AS token, ts AS started_at
           FROM events WHERE event_id % 3 <> 0),
c AS (SELECT 'job-' || CAST(event_id AS VARCHAR) AS job_id, ts + INTERVAL 1 DAY * (event_id % 10) AS completed_at FROM events)
SELECT c.job_id, c.completed_at, s.token AS task_token
FROM c LEFT JOIN s ON c.job_id = s.job_id AND c.completed_at <= s.started_at + INTERVAL 7 DAY
""")
def stream_completions(spark, sf):
    """Every completion with the run it finishes, or none, stream with stream; some were never started, some come
    after the expiry.  A closing row on both sides takes the watermark past the last completion."""
    from ladle.streaming.live import completions_with_runs
    ev = table(spark, sf, "events")
    job = F.concat(F.lit("job-"), F.col("event_id").cast("string")).alias("job_id")
    starts = ev.where("event_id % 3 <> 0").select(job, F.md5(F.col("event_id").cast("string")).alias("task_token"),
                                                  F.col("ts").alias("started_at"))
    comps = ev.select(job, (F.col("ts") + F.make_dt_interval(days=(F.col("event_id") % 10).cast("int"))).alias("completed_at"))
    far = "timestamp_ntz'2200-01-01 00:00:00'"
    drop = {"s": starts.unionByName(_end(spark, starts, {"job_id": f"'{END}s'", "task_token": "''", "started_at": far})),
            "c": comps.unionByName(_end(spark, comps, {"job_id": f"'{END}'", "completed_at": far}))}
    got, _ = _replay(spark, [drop],
                     lambda s, c: completions_with_runs(c, s).select("job_id", "completed_at", "task_token"))
    return got.where(F.col("job_id") != END).withColumn("completed_at", F.col("completed_at").cast("timestamp_ntz"))
