"""Structured Streaming forms of the event logic.

Per-key state lives in the state store (RocksDB provider); Python only
runs inside the stateful processors, once per key per micro-batch.  A call
gets its key's rows in Arrow chunks and orders them all together, so what
a call holds is one key's rows of one micro-batch: bound it at the source
with ``maxFilesPerTrigger`` or, where files are large, ``maxBytesPerTrigger``.

* ``NewerOnly`` (E4): emit an event only when it is strictly newer than
  every earlier event of its key.
* ``QuietPeriod`` (E5, live): each arrival re-arms a processing-time
  timer ``gap`` ahead; when it fires with no newer arrival, one launch row
  is emitted for the burst.  Event-time sessions cannot do this: a session
  only closes when a later event moves the watermark.
* ``SingleFlight`` (E6): a launch request starts a run only when no run
  of the key is still going; otherwise it is reported as skipped.
* ``completions_with_runs`` (E7/E8): watermarked stream-stream left join
  of completions to run starts within the ledger's 7-day expiry.
* ``RunLedger`` (E7 + J1/J2): the same as keyed state with a 7-day
  time-to-live -- the ledger entry disappears from the state store on its
  own, like the reference's expiring table rows.

Processors in processing-time mode (``QuietPeriod``, ``RunLedger``) keep
Spark scheduling no-data batches for timers and TTL eviction, so they run
under a processing-time trigger; ``availableNow`` suits the others.
"""

from __future__ import annotations

import bisect
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ladle.functions.time import LEDGER_TTL_DAYS

_US = 1_000_000


def _all(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    """All of a key's rows in this call."""
    return pd.concat(list(rows), ignore_index=True)


def _epoch_us(s: pd.Series) -> pd.Series:
    """Microseconds of timestamps; whole numbers are microseconds already."""
    if pd.api.types.is_integer_dtype(s):
        return s
    return pd.to_datetime(s, utc=True).astype("int64") // 1000


class NewerOnly(StatefulProcessor):
    """Rows: key, ts (timestamp), arrival order column ``seq``."""

    def __init__(self, key: str, ts: str, seq: str):
        self.key, self.ts, self.seq = key, ts, seq

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.best = handle.getValueState("best_us", "best_us long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        best = self.best.get()[0] if self.best.exists() else None
        pdf = _all(rows)
        pdf = pdf[pdf[self.ts].notna()].sort_values(self.seq, kind="stable")
        if not len(pdf):
            return
        us = _epoch_us(pdf[self.ts]).to_numpy()
        start = best if best is not None else int(us.min()) - 1
        prior = np.maximum.accumulate(np.append(start, us))[:-1]
        self.best.update((int(max(start, us.max())),))
        kept = pdf[us > prior]
        if len(kept):
            yield kept.reset_index(drop=True)

    def close(self) -> None:
        pass


def newer_only_stream(df: DataFrame, key: str, ts: str, seq: str) -> DataFrame:
    return df.groupBy(key).transformWithStateInPandas(
        statefulProcessor=NewerOnly(key, ts, seq), outputStructType=df.schema,
        outputMode="Append", timeMode="None")


LAUNCH_SCHEMA = ("key string, first_arrival timestamp, last_arrival timestamp, n_events long, launched_at timestamp, "
                 "items array<string>")


class QuietPeriod(StatefulProcessor):
    """Rows: key, ts, item.  Output: one launch per quiet burst (LAUNCH_SCHEMA).

    State per key: the burst's bounds and the names of its items (files),
    so the run can read just these; nothing else grows with the burst.
    """

    def __init__(self, ts: str, gap_seconds: float):
        self.ts, self.gap_ms = ts, int(gap_seconds * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.burst = handle.getValueState("burst", "first_us long, last_us long, n long, timer_ms long")
        self.items = handle.getListState("items", "item string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first = last = None
        n = 0
        if self.burst.exists():
            first, last, n, timer = self.burst.get()
            self.handle.deleteTimer(timer)
        for pdf in rows:
            us = _epoch_us(pdf[self.ts])
            lo, hi = int(us.min()), int(us.max())
            first = lo if first is None else min(first, lo)
            last = hi if last is None else max(last, hi)
            n += len(pdf)
            items = [(x,) for x in pdf["item"] if x is not None]
            if items:
                self.items.appendList(items)
        timer = timerValues.getCurrentProcessingTimeInMs() + self.gap_ms
        self.handle.registerTimer(timer)
        self.burst.update((first, last, n, timer))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.burst.exists():
            return
        first, last, n, _ = self.burst.get()
        items = sorted({x[0] for x in self.items.get()}) if self.items.exists() else []
        self.burst.clear()
        self.items.clear()
        now = timerValues.getCurrentProcessingTimeInMs()
        yield pd.DataFrame({"key": [str(key[0])],
                            "first_arrival": [pd.Timestamp(first, unit="us")],
                            "last_arrival": [pd.Timestamp(last, unit="us")],
                            "n_events": [n], "launched_at": [pd.Timestamp(now, unit="ms")], "items": [items]})

    def close(self) -> None:
        pass


def quiet_period_live(df: DataFrame, key: str, ts: str, gap_seconds: float, item: str | None = None) -> DataFrame:
    src = df.select(F.col(key).cast("string").alias("key"), F.col(ts).cast("timestamp").alias("ts"),
                    (F.col(item) if item else F.lit(None)).cast("string").alias("item"))
    return src.groupBy("key").transformWithStateInPandas(
        statefulProcessor=QuietPeriod("ts", gap_seconds), outputStructType=LAUNCH_SCHEMA,
        outputMode="Append", timeMode="ProcessingTime")


FLIGHT_SCHEMA = "key string, requested_at timestamp, started boolean, running_until timestamp"


class SingleFlight(StatefulProcessor):
    """Rows: key, requested_at.  At most one run per key at a time."""

    def __init__(self, run_seconds: float):
        self.run_us = int(run_seconds * _US)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.until = handle.getValueState("until_us", "until_us long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        until = self.until.get()[0] if self.until.exists() else None
        out, pdf = [], _all(rows)
        for t in sorted(_epoch_us(pdf["requested_at"][pdf["requested_at"].notna()]).tolist()):
            start = until is None or t >= until
            if start:
                until = t + self.run_us
            out.append((str(key[0]), pd.Timestamp(t, unit="us"), start, pd.Timestamp(until, unit="us")))
        if until is not None:
            self.until.update((until,))
        if out:
            yield pd.DataFrame(out, columns=["key", "requested_at", "started", "running_until"])

    def close(self) -> None:
        pass


def single_flight_stream(df: DataFrame, key: str, requested_at: str, run_seconds: float) -> DataFrame:
    src = df.select(F.col(key).cast("string").alias("key"),
                    F.col(requested_at).cast("timestamp").alias("requested_at"))
    return src.groupBy("key").transformWithStateInPandas(
        statefulProcessor=SingleFlight(run_seconds), outputStructType=FLIGHT_SCHEMA,
        outputMode="Append", timeMode="None")


def completions_with_runs(completions: DataFrame, starts: DataFrame, late: str = "1 hour",
                          ttl_days: int = LEDGER_TTL_DAYS) -> DataFrame:
    """Each completion with the run it finishes (null run when none is
    open within ``ttl_days``).  Both sides are watermarked, so join state is
    dropped once a start is older than its expiry."""
    s = (starts.select(F.col("job_id").alias("s_job_id"), "task_token",
                       F.col("started_at").cast("timestamp").alias("started_at"))
         .withWatermark("started_at", f"{ttl_days} days"))
    c = (completions.withColumn("completed_at", F.col("completed_at").cast("timestamp"))
         .withWatermark("completed_at", late))
    cond = F.expr(f"job_id = s_job_id AND started_at <= completed_at "
                  f"AND completed_at <= started_at + INTERVAL {ttl_days} DAYS")
    return c.join(s, cond, "leftOuter").drop("s_job_id")


def run_available_now(df: DataFrame, sink_table: str, checkpoint: str, mode: str = "append"):
    """On-demand run -- process everything available, then stop."""
    q = (df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).toTable(sink_table))
    q.awaitTermination()
    return q


LEDGER_OUT_SCHEMA = ("job_id string, completed_at timestamp, state string, task_token string, "
                     "started_at timestamp, result string, cause string")


class RunLedger(StatefulProcessor):
    """E7 + J1/J2 on one keyed stream: rows are run starts and completions
    for a ``job_id``.  A start adds (token, start time) to the job's runs in
    state, which have a time-to-live and drop out once they are older than
    it by event time; a completion takes the last run
    started by its time (ties: the greatest token) and emits one outcome,
    like the batch form.  A completion after the expiry, or with no such
    run in this or an earlier micro-batch, is a failure, as is a run that
    ended in a state other than SUCCEEDED."""

    def __init__(self, ttl_days: int = LEDGER_TTL_DAYS):
        self.ttl_us = ttl_days * 86400 * _US
        self.ttl_ms = ttl_days * 86400 * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.runs = handle.getValueState("runs", "tokens array<string>, started_us array<long>", ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _all(rows)
        pdf = pdf[pdf["at"].notna()].assign(at_us=lambda x: _epoch_us(x["at"]))
        if not len(pdf):
            return
        tokens, times = self.runs.get() if self.runs.exists() else ([], [])
        start = pdf["kind"] == "start"
        runs = sorted({*zip(map(int, times), tokens), *zip(map(int, pdf["at_us"][start]), pdf["task_token"][start])})
        if start.any():
            since = int(pdf["at_us"].max()) - self.ttl_us - _US
            kept = runs[bisect.bisect_left(runs, since, key=lambda x: x[0]):]
            self.runs.update(([token for _, token in kept], [us for us, _ in kept]))
        done = pdf[~start].sort_values("at_us", kind="stable")
        out = []
        for r in done.itertuples(index=False):
            i = bisect.bisect_right(runs, int(r.at_us), key=lambda x: x[0])
            started, token = runs[i - 1] if i else (None, None)
            live = started is not None and r.at_us // _US <= started // _US + self.ttl_us // _US
            ok = live and r.state == "SUCCEEDED"
            cause = None if ok else ("no open run for the job id" if not live else f"run ended in state {r.state}")
            out.append((str(key[0]), pd.Timestamp(int(r.at_us), unit="us"), r.state, token if live else None,
                        pd.Timestamp(started, unit="us") if live else None, "Success" if ok else "Fail", cause))
        if out:
            yield pd.DataFrame(out, columns=["job_id", "completed_at", "state", "task_token", "started_at",
                                             "result", "cause"])

    def close(self) -> None:
        pass


def run_ledger_stream(starts: DataFrame, completions: DataFrame, ttl_days: int = LEDGER_TTL_DAYS) -> DataFrame:
    """Starts (job_id, task_token, started_at) and completions (job_id,
    completed_at, state) -> one outcome per completion."""
    s = starts.select("job_id", F.lit("start").alias("kind"), "task_token",
                      F.col("started_at").cast("timestamp").alias("at"), F.lit(None).cast("string").alias("state"))
    c = completions.select("job_id", F.lit("completion").alias("kind"), F.lit(None).cast("string").alias("task_token"),
                           F.col("completed_at").cast("timestamp").alias("at"), "state")
    return s.unionByName(c).groupBy("job_id").transformWithStateInPandas(
        statefulProcessor=RunLedger(ttl_days), outputStructType=LEDGER_OUT_SCHEMA,
        outputMode="Append", timeMode="ProcessingTime")
