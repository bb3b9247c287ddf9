"""Ordered work within groups, without one task per group.

``row_number().over(Window.partitionBy(g))`` sorts a whole group in one
task; with one key holding a third of the rows that task is the job.
Here the rows are cut into chunks: ``repartitionByRange`` on (group,
order) samples the data and deals contiguous ranges of about equal size,
whatever the spread of the order values (bursts, outliers).  A chunk is
such a range; each window runs inside one (group, chunk), and a small
table of one row per (group, chunk) carries what earlier chunks add up to.

The order must end in something that tells rows apart (``with_row_id``),
or rows that tie in all of it stay together in one chunk.

Frames passed in are materialized (``materialized``), so chunks, counts
and ranks are all taken from the same rows, also after an executor loss.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladle.operators.joins import attach_checked
from ladle.session import checkpoint_root

DEFAULT_CHUNK_ROWS = 2_000_000
CHUNK = "__chunk"
ROW_ID = "__rid"


def materialized(df: DataFrame) -> DataFrame:
    """``df`` as a reliable checkpoint in ``spark.checkpoint.dir``."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def with_row_id(df: DataFrame) -> DataFrame:
    """``df`` materialized, with a unique number per row."""
    return materialized(df.withColumn(ROW_ID, F.monotonically_increasing_id()))


def uniform_from_hex(hexdigest: Column) -> Column:
    """Map a hex digest (e.g. md5) onto [0, 1) by its first 13 digits."""
    return F.conv(F.substring(hexdigest, 1, 13), 16, 10).cast("double") / F.lit(float(16 ** 13))


def chunked(df: DataFrame, group_cols: list[str], order: list[Column], chunk_rows: int = DEFAULT_CHUNK_ROWS) -> tuple[DataFrame, bool]:
    """``df`` with ``CHUNK``, ascending along (group, order), and whether there are several chunks."""
    n = df.count()
    if n <= chunk_rows:
        return df.withColumn(CHUNK, F.lit(0)), False
    parts = math.ceil(1.5 * n / chunk_rows)  # ranges come from a sample: keep clear of the limit
    ranged = df.repartitionByRange(parts, *[F.col(g) for g in group_cols], *order)
    return materialized(ranged.withColumn(CHUNK, F.spark_partition_id())), True


def positions_within(df: DataFrame, group_cols: list[str], order: list[Column], pos_col: str = "_pos",
                     chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """``df`` plus ``pos_col``: the row's 0-based position within its group by ``order``."""
    x, several = chunked(df, group_cols, order, chunk_rows)
    parts = [*group_cols, CHUNK]
    local = F.row_number().over(Window.partitionBy(*parts).orderBy(*order)) - 1
    ranked = x.withColumn(pos_col, local.cast("long"))
    if not several:
        return ranked.drop(CHUNK)
    counts = x.groupBy(*parts).agg(F.count(F.lit(1)).alias("__cnt"))
    before = Window.partitionBy(*group_cols).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__off", F.coalesce(F.sum("__cnt").over(before), F.lit(0))).drop("__cnt")
    return (attach_checked(ranked, offsets, parts).withColumn(pos_col, F.col(pos_col) + F.col("__off"))
            .drop("__off", CHUNK))


def max_before(df: DataFrame, group_cols: list[str], order: list[Column], value: Column, out: str,
               chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """``df`` plus ``out``: the largest ``value`` of the rows before this one in its group (null: none)."""
    x, several = chunked(df.withColumn("__value", value), group_cols, order, chunk_rows)
    parts = [*group_cols, CHUNK]
    rows = Window.partitionBy(*parts).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    y = x.withColumn(out, F.max("__value").over(rows))
    if not several:
        return y.drop("__value", CHUNK)
    top = x.groupBy(*parts).agg(F.max("__value").alias("__top"))
    before = Window.partitionBy(*group_cols).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carry = top.withColumn("__carry", F.max("__top").over(before)).drop("__top")
    return (attach_checked(y, carry, parts).withColumn(out, F.greatest(F.col(out), F.col("__carry")))  # skips nulls
            .drop("__value", "__carry", CHUNK))
