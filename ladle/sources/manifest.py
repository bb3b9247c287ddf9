"""S6 for batch runs: a run takes in the landed files that no run before it has taken.

The manifest is a table of files (path, time, length) by batch.  A run first
writes the files it is going to take as a batch, then reads them, applies the
recipe and writes their rows as the target's partition of that batch, then
marks the batch as done.  A batch that was taken but is not done, because its
run failed or was stopped, is run again with the same files and replaces what
it wrote: every file's rows stand in the target once.

New files are the listing without the manifest's rows (an anti-join on path,
time and length, so a file that was written anew is new).  They are taken in
batches of at most ``max_files``, oldest first; a batch's names are on the
driver, as in any read of listed files.  One run at a time per manifest.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.operators.positions import materialized
from ladle.plans.job import run_recipe_job
from ladle.plans.recipe import RecipeContext
from ladle.sinks.tables import ensure_database, write_batch
from ladle.sources.files import PLACEHOLDER_OBJECT, list_files

FILE = ["path", "modificationTime", "length"]


@dataclass
class IncrementalJob:
    spark: SparkSession
    landing: str
    table: str                        # rows are written here, by batch
    manifest: str                     # table of the files taken; ``<manifest>_done`` has the finished batches
    recipe: str | list | None = None
    ctx: RecipeContext = field(default_factory=RecipeContext)
    fmt: str = "CsvWithHeaderRow"
    table_location: str | None = None
    max_files: int = 100_000
    read_options: dict = field(default_factory=dict)

    def _taken(self) -> DataFrame:
        if self.spark.catalog.tableExists(self.manifest):
            return self.spark.read.table(self.manifest)
        return self.spark.createDataFrame([], "path string, modificationTime timestamp, length long, batch_id string")

    def _unfinished(self) -> list[str]:
        """Batches that were taken but not done: none, or the one whose run broke off."""
        open_ = self._taken().select("batch_id").distinct()
        if self.spark.catalog.tableExists(f"{self.manifest}_done"):
            open_ = open_.join(self.spark.read.table(f"{self.manifest}_done").select("batch_id"), "batch_id", "left_anti")
        return sorted(r[0] for r in open_.collect())

    def new_files(self) -> DataFrame:
        """Landed files that are in no batch."""
        files = list_files(self.spark, self.landing).where((F.col("length") > 0) & ~F.col("path").endswith("/" + PLACEHOLDER_OBJECT))
        return files.join(self._taken().select(*FILE), FILE, "left_anti")

    def _take(self) -> str | None:
        """Writes the next batch to the manifest; its id follows from its files."""
        batch = materialized(self.new_files().orderBy("modificationTime", "path").limit(self.max_files))
        n, code = batch.agg(F.count(F.lit(1)), F.hex(F.bit_xor(F.xxhash64(*FILE)))).first()
        if not n:
            return None
        batch_id = f"{n:x}-{code}"
        write_batch(batch.select(*FILE), self.manifest, batch_id)
        return batch_id

    def _run(self, batch_id: str) -> dict:
        files = [r[0] for r in self._taken().where(F.col("batch_id") == batch_id).select("path").orderBy("path").collect()]
        out = run_recipe_job(self.spark, self.landing, self.table, self.recipe, self.ctx, self.fmt, "Incremental",
                             self.table_location, files=files, batch_id=batch_id, **self.read_options)
        if out["state"] == "SUCCEEDED":
            done = self.spark.range(1).select(F.current_timestamp().alias("finished_at"))
            write_batch(done, f"{self.manifest}_done", batch_id)
        return out

    def run(self) -> list[dict]:
        """Runs what was left unfinished, then all that is new; one outcome per batch.  Stops at a failure."""
        for name in (self.manifest, self.table):
            if "." in name:
                ensure_database(self.spark, name.split(".")[0])
        outcomes = []
        for batch_id in self._unfinished():
            outcomes.append(self._run(batch_id))
        while all(o["state"] == "SUCCEEDED" for o in outcomes) and (batch_id := self._take()):
            outcomes.append(self._run(batch_id))
        return outcomes
