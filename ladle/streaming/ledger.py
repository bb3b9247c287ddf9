"""Run ledger and completion matching.

Batch forms here; the streaming forms (state with TTL, stream-stream
join) are in ``ladle.streaming.live``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.functions.text import message
from ladle.functions.time import LEDGER_TTL_DAYS, SECONDS_PER_DAY, epoch_micros, epoch_seconds
from ladle.operators.positions import DEFAULT_CHUNK_ROWS, ROW_ID, max_before, with_row_id

# Source, result words and subject of an outcome.
SOURCE = "transform"
RESULT_OK, RESULT_FAIL = "Success", "Fail"
SUBJECT = "Pipeline result [{}]"
# Message and cause texts are the library's own.
MSG_OK = "Job run {} completed with state {}."
MSG_FAIL = "Job fails to launch or finish, error: {}, cause: {}"
CAUSE_NO_RUN = "no open run for the job id"


def latest_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """K6 keyed upsert, last write wins: one row per key, the greatest ``order``.

    ``max_by`` aggregates partially, so a hot key costs one row per task.
    """
    others = [c for c in df.columns if c != key]
    best = F.max_by(F.struct(*others), F.struct(*order))
    return df.groupBy(key).agg(best.alias("__r")).select(key, "__r.*")


def build_ledger(starts: DataFrame, job_id: str = "job_id", token: str = "task_token",
                 started_at: str = "started_at", ttl_days: int = LEDGER_TTL_DAYS) -> DataFrame:
    """job_id -> task_token, started_at, exp_timestamp (epoch seconds, E7)."""
    latest = latest_per_key(starts.select(job_id, token, started_at), job_id, [started_at, token])
    return latest.withColumn("exp_timestamp", epoch_seconds(latest, started_at) + F.lit(ttl_days * SECONDS_PER_DAY))


def live_ledger(ledger: DataFrame, now: Column | None = None) -> DataFrame:
    """Entries not yet expired at ``now`` (default: the current time)."""
    now_s = F.unix_timestamp(now if now is not None else F.current_timestamp())
    return ledger.where(F.col("exp_timestamp") > now_s)


def _last_starts(completions: DataFrame, starts: DataFrame, job_id: str, completed_at: str, ttl_days: int,
                 chunk_rows: int) -> DataFrame:
    """Each completion with ``task_token`` and ``started_at`` of the last run of its job that started no
    later (ties: the greatest token), when that run had not expired by then; else nulls.

    Starts and completions are put in one order of time per job, and the last start before a completion
    is the largest (time, token) before it: a running maximum over chunks, so a hot job is never gathered.
    """
    kept = F.struct(*[F.col(c) for c in completions.columns])
    run = starts.select(F.col(job_id).alias("__job"), epoch_micros(starts, "started_at").alias("__us"), F.lit(0).alias("__kind"),
                        F.struct(epoch_micros(starts, "started_at").alias("us"), F.col("task_token"), F.col("started_at")).alias("__run"))
    done = completions.select(F.col(job_id).alias("__job"), epoch_micros(completions, completed_at).alias("__us"),
                              F.lit(1).alias("__kind"), kept.alias("__row"))
    both = with_row_id(run.unionByName(done, allowMissingColumns=True))
    x = max_before(both, ["__job"], [F.col("__us"), F.col("__kind"), F.col(ROW_ID)], F.col("__run"), "__last", chunk_rows)
    seconds = lambda us: F.floor(us / F.lit(1_000_000))
    live = (F.col("__last").isNotNull() & F.col("__us").isNotNull() & F.col("__job").isNotNull()
            & (seconds(F.col("__us")) <= seconds(F.col("__last.us")) + ttl_days * SECONDS_PER_DAY))
    return x.where(F.col("__kind") == 1).select("__row.*", F.when(live, F.col("__last.task_token")).alias("task_token"),
                                                F.when(live, F.col("__last.started_at")).alias("started_at"), live.alias("__live"))


def match_completions(completions: DataFrame, starts: DataFrame, job_id: str = "job_id",
                      completed_at: str = "completed_at", state: str = "state", ttl_days: int = LEDGER_TTL_DAYS,
                      chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """J1 + E9: each completion with the run that was open for it then, and the outcome.

    ``starts``: every run start (job id, ``task_token``, ``started_at``), not only the latest per job: the
    run open at a completion is the last one started by that time, within ``ttl_days``.
    """
    j = _last_starts(completions, starts, job_id, completed_at, ttl_days, chunk_rows)
    ok = F.col("__live") & F.coalesce(F.col(state) == F.lit("SUCCEEDED"), F.lit(False))
    cause = (F.when(~F.col("__live"), F.lit(CAUSE_NO_RUN))
             .when(~ok, F.concat(F.lit("run ended in state "), F.coalesce(F.col(state), F.lit("unknown")))))
    return (j.withColumn("result", F.when(ok, F.lit(RESULT_OK)).otherwise(F.lit(RESULT_FAIL)))
            .withColumn("cause", cause).drop("__live"))


def orphan_completions(completions: DataFrame, starts: DataFrame, job_id: str = "job_id", completed_at: str = "completed_at",
                       ttl_days: int = LEDGER_TTL_DAYS, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Completions with no run open at their time -> failures."""
    j = _last_starts(completions, starts, job_id, completed_at, ttl_days, chunk_rows)
    return j.where(~F.col("__live")).select(*completions.columns)


def outcome_rows(df: DataFrame, job_id: str = "job_id", state: str = "state") -> DataFrame:
    """K5: source, cause, result, subject, message for each outcome row."""
    subj = message(SUBJECT, F.col("result"))
    msg = F.when(F.col("result") == RESULT_OK, message(MSG_OK, F.col(job_id), F.col(state))) \
           .otherwise(message(MSG_FAIL, F.col(state), F.col("cause")))
    return df.withColumn("source", F.lit(SOURCE)).withColumn("subject", subj).withColumn("message", msg)
