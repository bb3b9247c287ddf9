"""K1-K4 and K6 sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TRANSFORM_PREFIX = "transform/"  # fixed value: transformed output goes under this prefix


def ensure_database(spark: SparkSession, database: str) -> None:
    """K2: create the catalog database ahead of the first write."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")


def write_batch(df: DataFrame, table: str, batch_id: str, location: str | None = None) -> None:
    """K1 for a batch that may be repeated: its rows are the table's partition ``batch_id``.

    Writing the batch again replaces that partition, so a run that failed
    after its append, or is replayed, leaves each row once.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        w = df.withColumn("batch_id", F.lit(batch_id)).write.format("parquet").partitionBy("batch_id")
        (w.option("path", location) if location else w).saveAsTable(table)
        return
    rows = _aligned(df.withColumn("batch_id", F.lit(batch_id)), table).drop("batch_id")
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (batch_id = :batch) SELECT * FROM {{rows}}".replace(
        ":batch", "'" + batch_id.replace("'", "") + "'"), rows=rows)


def _aligned(df: DataFrame, table: str) -> DataFrame:
    """``df`` in the table's column order; new columns are added to the table, missing ones are null."""
    spark = df.sparkSession
    have = {f.name.lower() for f in spark.read.table(table).schema}
    new = [f for f in df.schema.fields if f.name.lower() not in have]
    if new:
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({cols})")
    current = spark.read.table(table).schema
    mine = {c.lower() for c in df.columns}
    return df.select(*[F.col(f.name) if f.name.lower() in mine else F.lit(None).cast(f.dataType).alias(f.name)
                       for f in current.fields])


def write_table(df: DataFrame, table: str, location: str | None = None, mode: str = "append") -> None:
    """K1: append Parquet to a catalog table (created on first write).

    The table has no fixed schema (K2): a run that brings new columns adds
    them to the table first (``ALTER TABLE ... ADD COLUMNS``; older rows
    read them as null), and columns a run lacks are written as nulls.
    """
    spark = df.sparkSession
    if mode == "append" and spark.catalog.tableExists(table):
        df = _aligned(df, table)
    w = df.write.mode(mode).format("parquet")
    if location:
        w = w.option("path", location)
    w.saveAsTable(table)


def write_single_json(df: DataFrame, path: str) -> None:
    """K3: land as one JSON file.

    ``coalesce(1)`` writes through a single task: only for small entity
    extracts, which is what the pull connector lands.  Large data should
    use ``write_json`` (one file per task).
    """
    df.coalesce(1).write.mode("overwrite").json(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def write_profile(profile_df: DataFrame, data_path: str) -> str:
    """K4: the profile report next to the data, under ``profile/``."""
    out = data_path.rstrip("/") + "/profile/"
    profile_df.write.mode("overwrite").json(out)
    return out


def write_sketches(sketches: DataFrame, data_path: str, drop: str) -> None:
    """K4 for one drop: its column sketches, under ``profile/sketches/``; writing a drop again replaces it."""
    sketches.write.mode("overwrite").parquet(f"{data_path.rstrip('/')}/profile/sketches/drop={drop}")


def read_sketches(spark: SparkSession, data_path: str) -> DataFrame:
    """The column sketches of all drops, for ``merge_profiles``."""
    return spark.read.parquet(f"{data_path.rstrip('/')}/profile/sketches")
