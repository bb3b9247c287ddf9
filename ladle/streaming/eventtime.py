"""Event-time forms of the event path: they can be replayed and give what the batch forms give.

``launches`` chains E2/A4 (envelope to watching key and latest time, within
each message), E4 (``NewerOnly``) and E5 (``QuietByEventTime``) in one streaming
query; ``message_rejects`` is the second sink, for records that cannot be used.
``ledger_outcomes`` is E7 with J1/J2, ``open_runs`` reads its state.

Timers fire when the watermark passes them: a burst closes once no arrival of
it can still come, a completion is matched once no start before it can still
come.  So rows may come in any order within the watermark's delay, over any
micro-batches.  A finite replay ends with a closing row of a key of its own that
takes the watermark past everything before it.

What a key holds is bounded by the delay: bursts that are not yet closed, open
runs of seven days, completions that wait.  Ledger jobs share keys, so a key
there holds these for its group of jobs.  Before rows are shuffled to their
key, each task folds arrivals less than a gap apart into one row
(``fold_arrivals``), so a key with most of the rows sends few.
"""

from __future__ import annotations

import bisect
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ladle.functions.time import LEDGER_TTL_DAYS, epoch_micros
from ladle.streaming.envelope import message_key_and_latest, rejects, unpack_messages
from ladle.streaming.ledger import CAUSE_NO_RUN, RESULT_FAIL, RESULT_OK
from ladle.streaming.live import NewerOnly, _all
from ladle.streaming.quiet import DEFAULT_GAP_SECONDS, check_gap

_US = 1_000_000
_BURST = "key string, first_us long, last_us long, n_events long"
_OUTCOME = ("job_id string, ref string, completed_us long, state string, task_token string, started_us long, result string, "
            "cause string")


class OneTimer:
    """The one event-time timer of a key, kept in state beside its value."""

    def __init__(self, handle: StatefulProcessorHandle):
        self.handle, self.at = handle, handle.getValueState("timer", "at_ms long")

    def move(self, at_ms: int | None) -> None:
        old = self.at.get()[0] if self.at.exists() else None
        if old == at_ms:
            return
        if old is not None:
            self.handle.deleteTimer(old)
        if at_ms is None:
            self.at.clear()
        else:
            self.handle.registerTimer(at_ms)
            self.at.update((at_ms,))

    def fired(self) -> None:
        self.at.clear()


# ---- E5 by event time -----------------------------------------------------------


def fold_bursts(first: np.ndarray, last: np.ndarray, n: np.ndarray, gap_us: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bursts (first, last, count) with those at most ``gap_us`` apart made one, in order of time."""
    o = np.lexsort((last, first))
    first, last, n = first[o], last[o], n[o]
    reach = np.maximum.accumulate(last)
    new = np.ones(len(first), bool)
    new[1:] = first[1:] - reach[:-1] > gap_us
    at = np.flatnonzero(new)
    return first[at], np.maximum.reduceat(last, at), np.add.reduceat(n, at)


class QuietByEventTime(StatefulProcessor):
    """Rows: key, first_us, last_us, n (folded arrivals).  Output: one row per burst (microseconds)."""

    def __init__(self, gap_seconds: float):
        self.gap_us = int(gap_seconds * _US)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.bursts = handle.getValueState("bursts", "first_us array<long>, last_us array<long>, n array<long>")
        self.timer = OneTimer(handle)

    def _held(self) -> list[np.ndarray]:
        return [np.array(x, np.int64) for x in (self.bursts.get() if self.bursts.exists() else ([], [], []))]

    def _keep(self, bursts: list[np.ndarray]) -> None:
        if not len(bursts[0]):
            self.bursts.clear()
            self.timer.move(None)
            return
        self.bursts.update(tuple(x.tolist() for x in bursts))
        self.timer.move(int(bursts[1][0] + self.gap_us) // 1000 + 1)  # no arrival of the burst can come any more

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _all(rows)
        new = [pdf[c].to_numpy(np.int64) for c in ("first_us", "last_us", "n")]
        self._keep(list(fold_bursts(*[np.append(a, b) for a, b in zip(self._held(), new)], self.gap_us)))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.timer.fired()
        first, last, n = self._held()
        done = last + self.gap_us < timerValues.getCurrentWatermarkInMs() * 1000
        self._keep([x[~done] for x in (first, last, n)])
        if done.any():
            yield pd.DataFrame({"key": str(key[0]), "first_us": first[done], "last_us": last[done], "n_events": n[done]})

    def close(self) -> None:
        pass


def _bursts(raw: DataFrame, gap_seconds: float) -> DataFrame:
    return raw.select("key", F.timestamp_micros("first_us").alias("first_arrival"), F.timestamp_micros("last_us").alias("last_arrival"),
                      "n_events", F.timestamp_micros(F.col("last_us") + int(gap_seconds * _US)).alias("launch_at"))


def fold_arrivals(gap_us: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(key, us) rows -> per Arrow batch and key its bursts (key, first_us, last_us, n)."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pdf = pd.DataFrame({"key": b.column(0).to_pandas(), "us": b.column(1).to_numpy(zero_copy_only=False)}).dropna()
            parts = []
            for key, us in pdf.groupby("key", sort=False)["us"]:
                us = us.to_numpy(np.int64)
                first, last, n = fold_bursts(us, us, np.ones(len(us), np.int64), gap_us)
                parts.append(pd.DataFrame({"key": key, "first_us": first, "last_us": last, "n": n}))
            if parts:
                yield pa.RecordBatch.from_pandas(pd.concat(parts, ignore_index=True), schema=_FOLDED, preserve_index=False)
    return work


_FOLDED = pa.schema([("key", pa.string()), ("first_us", pa.int64()), ("last_us", pa.int64()), ("n", pa.int64())])


def quiet_period_replay(df: DataFrame, key: str, ts: str, gap_seconds: float = DEFAULT_GAP_SECONDS, delay: str = "1 hour") -> DataFrame:
    """E5 as a stream with event-time timers; rows may be out of order by ``delay``.

    One row per burst: key, first_arrival, last_arrival, n_events, launch_at.
    """
    check_gap(gap_seconds)
    folded = (df.select(F.col(key).cast("string").alias("key"), epoch_micros(df, ts).alias("us"))
              .mapInArrow(fold_arrivals(int(gap_seconds * _US)), "key string, first_us long, last_us long, n long")
              .withColumn("at", F.timestamp_micros("first_us")).withWatermark("at", delay))
    return _bursts(folded.groupBy("key").transformWithStateInPandas(
        statefulProcessor=QuietByEventTime(gap_seconds), outputStructType=_BURST, outputMode="Append", timeMode="EventTime"), gap_seconds)


# ---- E1-E5 in one query -----------------------------------------------------------


class QuietOfNewer(QuietByEventTime):
    """The same over the messages that ``NewerOnly`` lets through."""

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        us = _all(rows)["latest_us"].to_numpy(np.int64)
        yield from super().handleInputRows(key, iter([pd.DataFrame({"first_us": us, "last_us": us, "n": np.ones(len(us), np.int64)})]),
                                           timerValues)


def launches(messages: DataFrame, message: str, seq: str, gap_seconds: float = DEFAULT_GAP_SECONDS, delay: str = "1 hour") -> DataFrame:
    """Queue messages in order of ``seq`` -> one launch per quiet burst of newer messages of a watching key.

    A message's watching key is its buckets; its time is its latest record's.  A message that is not newer than all
    before it for its key starts nothing.
    """
    check_gap(gap_seconds)
    keyed = (message_key_and_latest(messages, message, [seq]).withColumn("latest_us", F.unix_micros("latest"))
             .withWatermark("latest", delay))
    newer = keyed.groupBy("watching_key").transformWithStateInPandas(
        statefulProcessor=NewerOnly("watching_key", "latest_us", seq), outputStructType=keyed.schema, outputMode="Append",
        timeMode="EventTime", eventTimeColumnName="latest")
    return _bursts(newer.groupBy("watching_key").transformWithStateInPandas(
        statefulProcessor=QuietOfNewer(gap_seconds), outputStructType=_BURST, outputMode="Append", timeMode="EventTime"), gap_seconds)


def message_rejects(messages: DataFrame, message: str, keep: list[str]) -> DataFrame:
    """The records of the same messages that ``launches`` cannot use, with the reason."""
    return rejects(unpack_messages(messages, message, keep))


# ---- E7 by event time ---------------------------------------------------------------

RUNS = "jobs array<string>, tokens array<string>, started_us array<long>, states array<string>"
WAITING = "jobs array<string>, at_us array<long>, states array<string>, refs array<string>"

#: Jobs share so many keys of state: what a call costs by itself is paid per group, not per job.
LEDGER_GROUPS = 1024


class LedgerByEventTime(StatefulProcessor):
    """Rows: job_id, kind (start or completion), us, task_token, state, ref; the key is a group of jobs.

    ``runs`` in state has the jobs' runs with the state each ended in (null: open) until they expire;
    ``waiting`` has completions that the watermark has not passed.
    """

    def __init__(self, ttl_days: int = LEDGER_TTL_DAYS):
        self.ttl = ttl_days * 86400

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.runs = handle.getValueState("runs", RUNS)
        self.waiting = handle.getValueState("waiting", WAITING)
        self.timer = OneTimer(handle)

    def _load(self) -> tuple[list[list], list[list]]:
        """Runs (job, token, start, state) and completions (job, time, state, ref)."""
        return tuple([list(r) for r in zip(*state.get())] if state.exists() else [] for state in (self.runs, self.waiting))

    def _ends(self, started_us: int) -> int:
        """The first second in which a run is no longer open."""
        return started_us // _US + self.ttl + 1

    def _store(self, runs: list[list], waiting: list[list]) -> None:
        for state, rows in ((self.runs, runs), (self.waiting, waiting)):
            if rows:
                state.update(tuple(list(x) for x in zip(*rows)))
            elif state.exists():
                state.clear()
        due = [w[1] // 1000 + 1 for w in waiting] + [self._ends(r[2]) * 1000 for r in runs]
        self.timer.move(min(due, default=None))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _all(rows)
        runs, waiting = self._load()
        known = {(job, us, token) for job, token, us, _ in runs}
        for job, kind, us, token, state, ref in zip(*[pdf[c].tolist() for c in ("job_id", "kind", "us", "task_token", "state", "ref")]):
            if kind != "start":
                waiting.append([job, us, state, ref])
            elif (job, us, token) not in known:
                known.add((job, us, token))
                runs.append([job, token, us, None])
        self._store(runs, waiting)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.timer.fired()
        now_us = timerValues.getCurrentWatermarkInMs() * 1000
        runs, waiting = self._load()
        by_job: dict[str | None, tuple[list[int], list[list]]] = {}
        for r in sorted(runs, key=lambda r: (r[2], r[1] is not None, r[1] or "")):
            times, own = by_job.setdefault(r[0], ([], []))
            times.append(r[2])
            own.append(r)
        out = []
        for job, at, state, ref in sorted((w for w in waiting if w[1] < now_us), key=lambda w: w[1]):
            times, own = by_job.get(job, ((), ()))
            i = bisect.bisect_right(times, at) - 1
            run = own[i] if i >= 0 and at // _US < self._ends(times[i]) else None
            ok = run is not None and state == "SUCCEEDED"
            cause = None if ok else CAUSE_NO_RUN if run is None else f"run ended in state {state or 'unknown'}"
            if run is not None:
                run[3] = state or "unknown"
            out.append((str(job), ref, at, state, run[1] if run else None, run[2] if run else None, RESULT_OK if ok else RESULT_FAIL, cause))
        self._store([r for r in runs if self._ends(r[2]) * _US > now_us], [w for w in waiting if w[1] >= now_us])
        if out:
            names = [c.split()[0] for c in _OUTCOME.split(", ")]
            yield pd.DataFrame(out, columns=names).astype({"started_us": "Int64"})

    def close(self) -> None:
        pass


def ledger_outcomes(starts: DataFrame, completions: DataFrame, ttl_days: int = LEDGER_TTL_DAYS, delay: str = "1 hour",
                    ref: str | None = None, groups: int = LEDGER_GROUPS) -> DataFrame:
    """Starts (job_id, task_token, started_at) and completions (job_id, completed_at, state) -> one outcome per completion.

    A completion that comes in time for the watermark is matched to the run that was open at its time, also when the
    start arrives after it; ``ref`` names a column of the completions that comes back with the outcome.  Jobs are dealt
    by hash into ``groups`` keys of state; a call holds one group's open rows, and a checkpoint keeps its number of groups.
    """
    none = F.lit(None).cast("string")
    s = starts.select("job_id", F.lit("start").alias("kind"), epoch_micros(starts, "started_at").alias("us"), "task_token",
                      none.alias("state"), none.alias("ref"))
    c = completions.select("job_id", F.lit("completion").alias("kind"), epoch_micros(completions, "completed_at").alias("us"),
                           none.alias("task_token"), "state", (F.col(ref).cast("string") if ref else none).alias("ref"))
    rows = s.unionByName(c).where("us is not null").withColumn("at", F.timestamp_micros("us")).withWatermark("at", delay)
    dealt = rows.withColumn("jobs", F.pmod(F.xxhash64("job_id"), F.lit(groups)))
    out = dealt.groupBy("jobs").transformWithStateInPandas(
        statefulProcessor=LedgerByEventTime(ttl_days), outputStructType=_OUTCOME, outputMode="Append", timeMode="EventTime")
    return out.select("job_id", "ref", F.timestamp_micros("completed_us").alias("completed_at"), "state", "task_token",
                      F.timestamp_micros("started_us").alias("started_at"), "result", "cause")


def open_runs(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Runs that are open in a ledger stream's state: job_id, task_token, started_at.  The stream need not run."""
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "runs").load()
    runs = state.select(F.explode(F.arrays_zip("value.jobs", "value.tokens", "value.started_us", "value.states")).alias("r"))
    return runs.where(F.col("r.states").isNull()).select(
        F.col("r.jobs").alias("job_id"), F.col("r.tokens").alias("task_token"), F.timestamp_micros("r.started_us").alias("started_at"))
