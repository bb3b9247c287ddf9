"""Batch jobs as the reference declares them: a recipe job (read the landed
dataset, apply the recipe, append to the catalog table) and a profile job
(statistics and personal-data detection for every column, written next to
the data).  Both are ordinary distributed Spark jobs; the functions return
a small outcome record for the caller (or the streaming connector)."""

from __future__ import annotations

import traceback
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ladle.operators.entities import detect_entities
from ladle.operators.profile import profile, top_values
from ladle.plans.recipe import RecipeContext, apply_recipe
from ladle.sinks.tables import ensure_database, write_batch, write_profile, write_table
from ladle.sources.files import read_inbound


TOP_VALUES = 10  # most frequent values reported per column


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def run_recipe_job(spark: SparkSession, landing: str, table: str, recipe=None, ctx: RecipeContext | None = None,
                   fmt: str = "CsvWithHeaderRow", upload_type: str = "Incremental",
                   table_location: str | None = None, connector: str = "push", files: list[str] | None = None,
                   batch_id: str | None = None, **read_options) -> dict:
    """Run once; failures are reported in the outcome, not raised.

    ``files``: read only these (what arrived since the last run).
    ``batch_id``: write as a batch that may be repeated (``write_batch``).
    Rows are counted while they are written.
    """
    job_id, started = batch_id or uuid.uuid4().hex, _now()
    rows, state, cause = None, "SUCCEEDED", None
    try:
        if "." in table:
            ensure_database(spark, table.split(".")[0])
        df = read_inbound(spark, landing, fmt, upload_type, connector=connector, files=files, **read_options)
        seen = Observation()
        out = apply_recipe(df, recipe, ctx or RecipeContext()).observe(seen, F.count(F.lit(1)).alias("rows"))
        if batch_id:
            write_batch(out, table, batch_id, table_location)
        else:
            write_table(out, table, table_location)
        rows = seen.get["rows"]
    except Exception as err:  # noqa: BLE001 -- the outcome carries the cause
        state, cause = "FAILED", f"{type(err).__name__}: {err}"
        traceback.print_exc()
    return {"job_id": job_id, "started_at": started, "finished_at": _now(), "rows_written": rows,
            "state": state, "cause": cause}


def run_profile_job(spark: SparkSession, landing: str, report_path: str, fmt: str = "CsvWithHeaderRow",
                    upload_type: str = "Incremental", entities: list[str] | None = None,
                    exact_distinct: bool = False) -> tuple[DataFrame, DataFrame, str]:
    """Column profile and top values of the whole dataset plus entity detection
    (``USA_ALL`` by default) on its text columns; all written under ``profile/``."""
    df = read_inbound(spark, landing, fmt, upload_type)
    prof = profile(df, exact_distinct=exact_distinct, quantiles=[0.25, 0.5, 0.75])
    text_cols = [c for c, t in df.dtypes if t == "string"]
    ents = detect_entities(df, text_cols, entities or ["USA_ALL"]) if text_cols else None
    out = write_profile(prof, report_path)
    top_values(df, k=TOP_VALUES).write.mode("overwrite").json(out.rstrip("/") + "/top_values/")
    if ents is not None:
        ents.write.mode("overwrite").json(out.rstrip("/") + "/entities/")
    return prof, ents, out
