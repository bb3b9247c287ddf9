"""E5: quiet period -- one launch per burst of arrivals.

A new session starts when an arrival comes more than ``gap`` after the
previous arrival of the same key; the launch happens once ``gap`` has
passed after the session's last arrival.

Batch and replay form (``quiet_sessions``): arrivals are bucketed into
``gap``-wide time buckets.  Two arrivals in one bucket are less than
``gap`` apart, so a bucket never splits a session: sessions are decided
on the per-(key, bucket) summary alone.  The raw rows only go through a
partial aggregation (skew-proof); the ordered window of a key runs over its
buckets, at most time span / gap rows however many arrivals there are
(about a million per key and year at 30 seconds).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ladle.functions.time import epoch_micros

DEFAULT_GAP_SECONDS = 60  # fixed value: default quiet period, 1 minute
MIN_GAP_SECONDS = 30  # fixed value: shortest allowed quiet period


def check_gap(gap_seconds: int) -> None:
    if gap_seconds < MIN_GAP_SECONDS:
        raise ValueError(f"quiet period must be at least {MIN_GAP_SECONDS} s")


def quiet_sessions(df: DataFrame, key: str, ts: str, gap_seconds: int = DEFAULT_GAP_SECONDS) -> DataFrame:
    """key, session_start, session_end, n_events, launch_at (= end + gap)."""
    check_gap(gap_seconds)
    gap_us = gap_seconds * 1_000_000
    src = df.where(F.col(ts).isNotNull()).withColumn("__us", epoch_micros(df, ts))
    buckets = (src.groupBy(key, F.floor(F.col("__us") / F.lit(gap_us)).cast("long").alias("__b"))
               .agg(F.min(ts).alias("__first"), F.max(ts).alias("__last"), F.count(F.lit(1)).alias("__n"),
                    F.min("__us").alias("__first_us"), F.max("__us").alias("__last_us")))
    w = Window.partitionBy(key).orderBy("__b")
    brk = (F.col("__first_us") - F.lag("__last_us").over(w)) > gap_us
    flagged = buckets.withColumn("__new", F.coalesce(brk, F.lit(True)).cast("int"))
    sid = flagged.withColumn("__sid", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return (sid.groupBy(key, "__sid")
            .agg(F.min("__first").alias("session_start"), F.max("__last").alias("session_end"),
                 F.sum("__n").alias("n_events"))
            .withColumn("launch_at", F.col("session_end") + F.make_dt_interval(secs=F.lit(gap_seconds)))
            .drop("__sid"))


def quiet_sessions_stream(df: DataFrame, key: str, ts: str, gap_seconds: int = DEFAULT_GAP_SECONDS,
                          watermark: str | None = None) -> DataFrame:
    """Event-time streaming form with Spark's session windows (append mode).

    Spark closes a session when the next event is at least ``gap`` later
    (the batch form: strictly more than ``gap``); they differ only for
    arrivals exactly ``gap`` apart.
    """
    check_gap(gap_seconds)
    t = F.col(ts).cast("timestamp")
    src = df.withColumn("__ts", t).withWatermark("__ts", watermark or f"{gap_seconds} seconds")
    return (src.groupBy(F.col(key), F.session_window("__ts", f"{gap_seconds} seconds").alias("__s"))
            .agg(F.min("__ts").alias("session_start"), F.max("__ts").alias("session_end"),
                 F.count(F.lit(1)).alias("n_events"))
            .select(key, "session_start", "session_end", "n_events",
                    (F.col("session_end") + F.make_dt_interval(secs=F.lit(gap_seconds))).alias("launch_at")))
