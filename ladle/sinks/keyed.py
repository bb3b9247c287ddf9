"""K6 as a table: one row per key, last write wins, kept in Parquet files.

Rows lie in buckets by a hash of their key.  An upsert reads the buckets that
its batch touches, merges, and writes these buckets anew; all other files
stay as they are.  What the table consists of is one small file per version:
the folder of every bucket.  Writing that file is the commit, so a reader sees
the table before or after an upsert, never half of it, and an upsert that
fails leaves files that no version names.  A batch that was committed already
is not applied again.

The row with the greatest ``order`` stays; of equals, the one written last.
Keys are unique within a bucket, so buckets are of about equal size whatever
the batches hold; a batch's rows are reduced to one per key before they are
shuffled.  One writer at a time.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ladle.operators.positions import materialized

_VERSION = "bucket int, folder string, batch string, schema string, version long"
_MARK = -1  # the row of a version that names its batch and the table's columns


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str, key: list[str], order: list[str], buckets: int = 64):
        self.spark, self.path, self.key, self.order, self.buckets = spark, path.rstrip("/"), key, order, buckets

    def _versions(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(_VERSION).parquet(f"{self.path}/versions")
        except AnalysisException as err:
            if err.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _current(self) -> tuple[int, dict[int, str], StructType | None]:
        """(version, folder of each bucket, columns); a version has at most one row per bucket."""
        versions = self._versions()
        last = versions.agg(F.max("version")).first()[0] if versions is not None else None
        if last is None:
            return 0, {}, None
        rows = versions.where(F.col("version") == last).collect()
        schema = next(r.schema for r in rows if r.bucket == _MARK)
        return last, {r.bucket: r.folder for r in rows if r.bucket != _MARK}, StructType.fromJson(json.loads(schema))

    def _read(self, folders: list[str], schema: StructType) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def read(self) -> DataFrame:
        version, folders, schema = self._current()
        if schema is None:
            raise FileNotFoundError(f"no keyed table at {self.path}")
        return self._read(sorted(folders.values()), schema)

    def _best(self, df: DataFrame, turn: str) -> DataFrame:
        others = [c for c in df.columns if c not in (*self.key, turn)]
        best = F.max_by(F.struct(*others, turn), F.struct(*self.order, turn))
        return df.groupBy(*self.key).agg(best.alias("__best")).select(*self.key, "__best.*")

    def upsert(self, batch: DataFrame, batch_id: str | None = None) -> int:
        """Applies ``batch`` and returns the version the table is at."""
        version, folders, schema = self._current()
        if batch_id is not None and version and self._versions().where(
                (F.col("bucket") == _MARK) & (F.col("batch") == batch_id)).limit(1).count():
            return version
        bucket = F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")
        new = materialized(self._best(batch.withColumn("__turn", F.lit(1)), "__turn").withColumn("__bucket", bucket))
        touched = [r[0] for r in new.select("__bucket").distinct().collect()]  # at most the number of buckets
        merged = new.drop("__bucket")
        if schema is not None:
            old = self._read([folders[b] for b in touched if b in folders], schema).withColumn("__turn", F.lit(0))
            merged = self._best(merged.unionByName(old, allowMissingColumns=True), "__turn")
        rows = merged.drop("__turn")
        data = f"data/{uuid.uuid4().hex}"
        (rows.withColumn("__bucket", bucket).repartition(max(1, len(touched)), "__bucket")
         .write.partitionBy("__bucket").parquet(f"{self.path}/{data}"))
        folders |= {b: f"{data}/__bucket={b}" for b in touched}
        named = [(b, f, batch_id, None) for b, f in sorted(folders.items())] + [(_MARK, None, batch_id, rows.schema.json())]
        version += 1
        (self.spark.createDataFrame(named, "bucket int, folder string, batch string, schema string").coalesce(1)
         .write.parquet(f"{self.path}/versions/version={version}"))  # one small file: it is there as a whole or not at all
        return version
