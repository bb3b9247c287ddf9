"""File-arrival notifications.

A notification message is ``{"Records": [{"body": "<json text>"}]}`` and
each body is itself JSON text holding ``Records`` of ``{eventTime,
s3: {bucket: {arn}, object: {key}}}`` (two-level envelope, C5/C6).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ladle.functions.time import iso_from_micros, iso_micros, parse_iso

# The notification payload schema.
RECORD_SCHEMA = StructType([
    StructField("eventTime", StringType()),
    StructField("s3", StructType([
        StructField("bucket", StructType([StructField("arn", StringType())])),
        StructField("object", StructType([StructField("key", StringType())])),
    ])),
])
BODY_SCHEMA = StructType([StructField("Records", ArrayType(RECORD_SCHEMA))])
MESSAGE_SCHEMA = StructType([StructField("Records", ArrayType(StructType([StructField("body", StringType())])))])


def message_body(event_time: Column, bucket: Column, key: Column) -> Column:
    """Build one body text with a single record (the inverse of ``unpack``)."""
    rec = F.struct(event_time.alias("eventTime"),
                   F.struct(F.struct(bucket.alias("arn")).alias("bucket"),
                            F.struct(key.alias("key")).alias("object")).alias("s3"))
    return F.to_json(F.struct(F.array(rec).alias("Records")))


def unpack(df: DataFrame, body_col: str = "body", keep: list[str] | None = None) -> DataFrame:
    """One row per inner record: event_time, bucket, object_key, reject_reason.

    A body without ``Records`` yields no rows; a record without ``s3`` (or
    without bucket/key/time) is kept with a ``reject_reason`` so one bad
    record cannot fail the whole job -- route it with ``rejects()``.
    """
    keep = keep or []
    parsed = df.select(*keep, F.from_json(F.col(body_col), BODY_SCHEMA).alias("__b"))
    recs = parsed.select(*keep, F.explode(F.col("__b.Records")).alias("__r"))
    bucket, key, when = F.col("__r.s3.bucket.arn"), F.col("__r.s3.object.key"), F.col("__r.eventTime")
    reason = (F.when(F.col("__r.s3").isNull(), F.lit("record has no s3 section"))
              .when(bucket.isNull() | key.isNull(), F.lit("record has no bucket or object key"))
              .when(when.isNull(), F.lit("record has no eventTime")))
    return recs.select(*keep, when.alias("event_time"), bucket.alias("bucket"), key.alias("object_key"),
                       reason.alias("reject_reason"))


def unpack_messages(df: DataFrame, message_col: str = "message", keep: list[str] | None = None) -> DataFrame:
    """Queue messages (outer envelope) -> bodies -> records."""
    keep = keep or []
    outer = df.select(*keep, F.from_json(F.col(message_col), MESSAGE_SCHEMA).alias("__m"))
    bodies = outer.select(*keep, F.explode(F.col("__m.Records.body")).alias("body"))
    return unpack(bodies, "body", keep)


def accepted(records: DataFrame) -> DataFrame:
    return records.where(F.col("reject_reason").isNull()).drop("reject_reason")


def rejects(records: DataFrame) -> DataFrame:
    return records.where(F.col("reject_reason").isNotNull())


def key_and_latest(records: DataFrame, batch_cols: list[str]) -> DataFrame:
    """A4 per batch: distinct buckets sorted and joined by ';', latest event time.

    Times are compared as instants (offsets and fractions differ in the
    text) and given back as UTC text; one that cannot be read counts as
    none.  Buckets are de-duplicated per batch first (partial aggregation),
    so the collected set holds distinct bucket names only.
    """
    good = accepted(records).withColumn("__us", iso_micros(F.col("event_time")))
    per_bucket = good.groupBy(*batch_cols, "bucket").agg(F.max("__us").alias("__t"),
                                                         F.count(F.lit(1)).alias("__n"))
    return per_bucket.groupBy(*batch_cols).agg(
        F.concat_ws(";", F.array_sort(F.collect_list("bucket"))).alias("watching_key"),
        iso_from_micros(F.max("__t")).alias("latest_event_time"),
        F.sum("__n").alias("n_records"))


def message_key_and_latest(df: DataFrame, message_col: str = "message", keep: list[str] | None = None) -> DataFrame:
    """A4 per message, within the row: watching_key, latest (timestamp), n_records.

    The same as ``key_and_latest`` of each message by itself, but without a shuffle or state, so it can stand
    before stateful steps of a stream.  Messages without a usable record are left out.
    """
    m = F.from_json(F.col(message_col), MESSAGE_SCHEMA)
    bodies = F.transform(F.col("__m.Records"), lambda r: F.coalesce(F.from_json(r["body"], BODY_SCHEMA)["Records"], F.array()))
    good = F.filter(F.flatten(bodies), lambda r: r["s3"]["bucket"]["arn"].isNotNull() & r["s3"]["object"]["key"].isNotNull()
                    & r["eventTime"].isNotNull())
    keyed = df.select(*(keep or []), m.alias("__m")).select(*(keep or []), good.alias("__r")).where(F.size("__r") > 0)
    return keyed.select(
        *(keep or []), F.array_join(F.array_sort(F.array_distinct(F.transform("__r", lambda r: r["s3"]["bucket"]["arn"]))), ";").alias("watching_key"),
        F.array_max(F.transform("__r", lambda r: parse_iso(r["eventTime"]))).alias("latest"), F.size("__r").cast("long").alias("n_records"))


def arrivals(spark: SparkSession, path: str, fmt: str = "text", schema: StructType | str | None = None,
             max_files_per_trigger: int | None = 30, min_bytes: int = 1) -> DataFrame:
    """A file stream with each row's source file, its size and time.

    Zero-byte placeholder objects yield no rows (S7).
    """
    reader = spark.readStream.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = reader.load(path)
    return (df.select("*", F.col("_metadata.file_path").alias("file_path"),
                      F.col("_metadata.file_size").alias("file_size"),
                      F.col("_metadata.file_modification_time").alias("file_time"))
            .where(F.col("file_size") >= min_bytes))


def completion_events(df: DataFrame, source: str, detail_type: str, event_col: str = "event") -> DataFrame:
    """Keep job state-change events of one source and detail type and
    pull out the run id and state (C6).

    ``event_col`` holds JSON text ``{"source", "detail-type", "detail":
    {"jobRunId", "state"}}``; the source and detail type to match are the
    caller's (they name the service that runs the jobs).
    """
    schema = ("source string, `detail-type` string, "
              "detail struct<jobRunId: string, state: string, jobName: string>")
    ev = df.select("*", F.from_json(F.col(event_col), schema).alias("__e"))
    return (ev.where((F.col("__e.source") == F.lit(source)) & (F.col("__e.`detail-type`") == F.lit(detail_type)))
            .select(*df.columns, F.col("__e.detail.jobRunId").alias("job_id"),
                    F.col("__e.detail.state").alias("state"), F.col("__e.detail.jobName").alias("job_name")))
