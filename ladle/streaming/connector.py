"""The whole push path as one streaming query.

``Connector`` watches files:

file lands under a prefix -> quiet period per watching key (processing-time
timers) -> one run at a time: read the landed data, apply the recipe,
append to the Parquet catalog table -> one outcome row per run.

Arrivals are detected from file metadata only (the binary-file source with
``content`` pruned), so landing a large file costs no read until the run.
Launch rows are few (one per quiet burst and key) and ``foreachBatch``
runs them one after another on the driver, which is also what makes the
runs single-flight.  Each run is an ordinary distributed batch job over the
burst's new files alone, and its rows are the table's partition of the
burst: when a batch is replayed the burst's rows and outcome are replaced,
not added again.  A failed run is tried ``attempts`` times in all.

``NotifiedConnector`` takes queue messages about files instead: the messages go
through ``eventtime.launches`` (envelope, newer than all before for the key,
quiet period by event time), records that cannot be used go to a second sink,
and a launch runs an ``IncrementalJob``: whatever landed and is in no batch of
its manifest.  So a message that comes twice, or a replayed micro-batch, adds
nothing.  A burst closes when messages of any key are later than it by the
quiet period and the delay; where none come for long, a heartbeat message does.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.plans.job import run_recipe_job
from ladle.plans.recipe import RecipeContext
from ladle.session import with_state_store
from ladle.sinks.tables import ensure_database, write_batch
from ladle.sources.manifest import IncrementalJob
from ladle.streaming.eventtime import launches, message_rejects
from ladle.streaming.ledger import MSG_FAIL, MSG_OK, RESULT_FAIL, RESULT_OK, SOURCE, SUBJECT
from ladle.streaming.live import quiet_period_live
from ladle.streaming.quiet import DEFAULT_GAP_SECONDS, check_gap

OUTCOME_SCHEMA = ("job_id string, watching_key string, first_arrival timestamp, last_arrival timestamp, "
                  "n_files long, started_at timestamp, finished_at timestamp, rows_written long, state string, "
                  "result string, cause string, source string, subject string, message string")


def _outcome(res: dict, launch: dict, n_files: int | None) -> dict:
    """An outcome row of a run for a launch (key, first_arrival, last_arrival)."""
    ok = res["state"] == "SUCCEEDED"
    result = RESULT_OK if ok else RESULT_FAIL
    return {**res, "watching_key": launch["key"], "first_arrival": launch["first_arrival"], "last_arrival": launch["last_arrival"],
            "n_files": n_files, "result": result, "source": SOURCE, "subject": SUBJECT.format(result),
            "message": (MSG_OK.format(res["job_id"], res["state"]) if ok else MSG_FAIL.format(res["state"], res["cause"]))}


@dataclass
class Connector:
    spark: SparkSession
    landing: str                      # prefix to watch and read, e.g. .../inbound/
    table: str                        # catalog table the runs append to
    outcomes_table: str               # one row per run
    checkpoint: str                   # streaming checkpoint folder (shared storage)
    recipe: str | list | None = None
    ctx: RecipeContext = field(default_factory=RecipeContext)
    fmt: str = "CsvWithHeaderRow"
    upload_type: str = "Incremental"
    table_location: str | None = None
    gap_seconds: float = DEFAULT_GAP_SECONDS
    max_files_per_trigger: int = 30   # files taken in per trigger; more wait for the next
    attempts: int = 2                 # tries of a run in all
    short_gaps: bool = False          # allow gaps below the minimum (tests)

    def __post_init__(self):
        if not self.short_gaps:
            check_gap(self.gap_seconds)

    def arrivals(self) -> DataFrame:
        files = (self.spark.readStream.format("binaryFile")
                 .schema("path string, modificationTime timestamp, length long, content binary")
                 .option("recursiveFileLookup", True)
                 .option("maxFilesPerTrigger", self.max_files_per_trigger).load(self.landing))
        return (files.where(F.col("length") > 0)
                .select(F.lit(self.landing).alias("watching_key"), F.col("modificationTime").alias("ts"), "path"))

    def launches(self) -> DataFrame:
        return quiet_period_live(self.arrivals(), "watching_key", "ts", self.gap_seconds, item="path")

    def _run(self, launch) -> dict:
        files = list(launch["items"])
        burst = hashlib.sha256("\n".join([str(launch["key"]), *files]).encode()).hexdigest()[:32]
        for _ in range(max(1, self.attempts)):
            res = run_recipe_job(self.spark, self.landing, self.table, self.recipe, self.ctx, self.fmt, self.upload_type,
                                 self.table_location, files=files if self.upload_type == "Incremental" else None, batch_id=burst)
            if res["state"] == "SUCCEEDED":
                break
        return _outcome(res, launch.asDict(), len(files))

    def _launch_batch(self, batch: DataFrame, epoch_id: int) -> None:
        launches = batch.collect()  # one row per finished quiet burst: small by construction
        if not launches:
            return
        outcomes = self.spark.createDataFrame([self._run(row) for row in launches], OUTCOME_SCHEMA)
        write_batch(outcomes, self.outcomes_table, f"epoch-{epoch_id}")

    def start(self, trigger: dict | None = None):
        with_state_store(self.spark)
        return (self.launches().writeStream.option("checkpointLocation", self.checkpoint)
                .trigger(**(trigger or {"processingTime": "10 seconds"}))
                .foreachBatch(self._launch_batch).start())


@dataclass
class NotifiedConnector:
    spark: SparkSession
    messages: str                     # folder of text files, one queue message (JSON) a line
    landing: str                      # prefix the messages' files land under
    table: str                        # catalog table the runs append to
    outcomes_table: str               # one row per run
    rejects_table: str                # records that cannot be used, with the reason
    checkpoint: str                   # folder of the streaming checkpoints (shared storage)
    recipe: str | list | None = None
    ctx: RecipeContext = field(default_factory=RecipeContext)
    fmt: str = "CsvWithHeaderRow"
    table_location: str | None = None
    gap_seconds: float = DEFAULT_GAP_SECONDS
    delay: str = "5 minutes"          # how late messages may come
    max_files_per_trigger: int = 1000

    def arrivals(self) -> DataFrame:
        """Messages in the order in which their files came."""
        lines = (self.spark.readStream.option("maxFilesPerTrigger", self.max_files_per_trigger).text(self.messages))
        return lines.select(F.col("value").alias("message"), F.concat_ws(
            " ", F.unix_micros("_metadata.file_modification_time").cast("string"), "_metadata.file_path").alias("seq"))

    def launches(self) -> DataFrame:
        return launches(self.arrivals(), "message", "seq", self.gap_seconds, self.delay)

    def _launch_batch(self, batch: DataFrame, epoch_id: int) -> None:
        closed = batch.orderBy("last_arrival").collect()  # one row per finished quiet burst: small by construction
        if not closed:
            return
        # bursts that close together are served by one run: it takes all that has landed
        job = IncrementalJob(self.spark, self.landing, self.table, f"{self.table}_files", self.recipe, self.ctx, self.fmt, self.table_location)
        whole = {"key": ";".join(sorted({r["key"] for r in closed})), "first_arrival": min(r["first_arrival"] for r in closed),
                 "last_arrival": closed[-1]["last_arrival"]}
        runs = [_outcome(res, whole, None) for res in job.run()]
        if runs:
            write_batch(self.spark.createDataFrame(runs, OUTCOME_SCHEMA), self.outcomes_table, f"epoch-{epoch_id}")

    def start(self, trigger: dict | None = None) -> list:
        """The two running queries: launches, and rejected records."""
        with_state_store(self.spark)
        for name in (self.table, self.outcomes_table, self.rejects_table):
            if "." in name:
                ensure_database(self.spark, name.split(".")[0])
        trigger = trigger or {"processingTime": "10 seconds"}
        runs = (self.launches().writeStream.option("checkpointLocation", f"{self.checkpoint}/launches")
                .trigger(**trigger).foreachBatch(self._launch_batch).start())
        bad = (message_rejects(self.arrivals(), "message", ["seq"]).writeStream.option("checkpointLocation", f"{self.checkpoint}/rejects")
               .trigger(**trigger).toTable(self.rejects_table))
        return [runs, bad]
