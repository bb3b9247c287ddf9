"""Streaming twin == batch twin on the same data (driver events table)."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL
from ladle.session import scratch_dir
from ladle.streaming.live import newer_only_stream
from ladle.streaming.newer import newer_only
from ladle.streaming.quiet import quiet_sessions, quiet_sessions_stream


def _replay_files(spark, df, order_col, root, n_files=5):
    """Write ``df`` as ``n_files`` files in ``order_col`` order (one write per file)."""
    bounds = df.agg(F.min(order_col), F.max(order_col)).first()
    lo, hi = bounds[0], bounds[1]
    step = (hi - lo) / n_files
    for i in range(n_files):
        a, b = lo + step * i, lo + step * (i + 1)
        part = df.where((F.col(order_col) >= a) & ((F.col(order_col) < b) if i < n_files - 1 else F.lit(True)))
        part.write.mode("overwrite").parquet(f"{root}/in/part{i:02d}")
    return f"{root}/in/*"


def _stream(spark, path, schema, fn, name, mode="append"):
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    q = fn(src).writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(300)
    return spark.table(name)


def test_quiet_period_stream_equals_batch(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_type", "ts")
    gap = 30 * 60
    far = ev.groupBy("event_type").agg((F.max("ts") + F.expr("INTERVAL 30 DAYS")).alias("ts"))
    root = scratch_dir(spark, "twin")
    path = _replay_files(spark, ev, "ts", root)
    far.write.mode("overwrite").parquet(f"{root}/in/part99")  # closing sentinel, written last
    out = _stream(spark, path, ev.schema, lambda s: quiet_sessions_stream(s, "event_type", "ts", gap), "quiet_twin")
    last_real = ev.agg(F.max("ts")).first()[0]
    got = sorted((r.event_type, r.session_start.replace(tzinfo=None), r.session_end.replace(tzinfo=None), r.n_events)
                 for r in out.collect() if r.session_start.replace(tzinfo=None) <= last_real)
    exp = sorted((r.event_type, r.session_start, r.session_end, r.n_events)
                 for r in quiet_sessions(ev, "event_type", "ts", gap).collect())
    assert got == exp


def test_newer_only_stream_equals_batch(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    d = ev.select("event_id", "event_type", "ts",
                  (F.col("ts") + F.make_dt_interval(mins=F.get_json_object("props", "$.k").cast("int")))
                  .alias("delivered_at"))
    root = scratch_dir(spark, "twin")
    path = _replay_files(spark, d, "delivered_at", root)
    out = _stream(spark, path, d.schema, lambda s: newer_only_stream(s, "event_type", "ts", "delivered_at"),
                  "newer_twin")
    got = sorted(r.event_id for r in out.collect())
    exp = sorted(r.event_id for r in newer_only(d, "event_type", "ts", "delivered_at", "event_id").collect())
    assert got == exp and len(exp) > 0
