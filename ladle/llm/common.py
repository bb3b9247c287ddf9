"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.session import scratch_dir

#: ASCII white space, as character class content
SPACE_WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet under ``spark.checkpoint.dir`` and read back.

    Cuts the lineage: what follows never recomputes ``df``, also when
    executors are lost.  Parquet rather than ``checkpoint()`` because it
    is compressed and later reads prune columns.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def total_bytes(df: DataFrame, col: str) -> int:
    """UTF-8 bytes of a text column over all rows."""
    return df.agg(F.coalesce(F.sum(F.octet_length(F.col(col))), F.lit(0))).first()[0]


#: A table joined by broadcast has at most so many bytes of keys and numbers.
BROADCAST_BYTES = 32 << 20


def _row_bytes(table: DataFrame) -> Column:
    sizes = [F.coalesce(F.octet_length(F.col(c)), F.lit(0)) if t == "string" else F.lit(16) for c, t in table.dtypes]
    total = F.lit(0)
    for s in sizes:
        total = total + s
    return total


def attach_small(big: DataFrame, side: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """``big`` with the columns of ``side`` (one row per key, nulls equal).

    The side is broadcast when its measured bytes are few; beyond that the
    join is by sort and merge, where Spark splits a hot key's rows.
    """
    names = [f"__{k}_key" for k in keys]
    small = (side.agg(F.coalesce(F.sum(_row_bytes(side)), F.lit(0))).first()[0] or 0) <= BROADCAST_BYTES
    t = side.withColumnsRenamed(dict(zip(keys, names)))
    test = None
    for k, n in zip(keys, names):
        one = big[k].eqNullSafe(t[n])
        test = one if test is None else test & one
    return big.join(F.broadcast(t) if small else t, test, how).drop(*names)
