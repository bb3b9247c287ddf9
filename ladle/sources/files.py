"""Landed files -> DataFrame.

Formats (fixed values, the names used in connector configuration):
``CSV`` (no header), ``CsvWithHeaderRow``, ``JSON`` (one JSON document
that may span many lines) and ``JSONMultiLine`` (JSON Lines -- one
document per line; the name is the configuration's, the meaning is
line-delimited).  Upload types: ``Bulk`` (the newest single file under
the prefix) and ``Incremental`` (every file under the prefix).
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ladle.operators.joins import attach_checked, checked
from ladle.session import scratch_dir

FORMATS = ("CSV", "CsvWithHeaderRow", "JSON", "JSONMultiLine")
UPLOAD_TYPES = ("Bulk", "Incremental")
PUSH_PREFIX = "inbound/"  # fixed value: pushed files land under this prefix
PLACEHOLDER_OBJECT = "empty-file-object"  # fixed value: zero-byte placeholder name


def flow_prefix(flow_name: str) -> str:
    """Pulled data lands under ``<flow name>-flow/``."""
    return f"{flow_name}-flow/"


def check_combination(connector: str, upload_type: str, fmt: str) -> None:
    """Pulled data is Bulk + JSON Lines only; pushed data takes every combination."""
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}; expected one of {FORMATS}")
    if upload_type not in UPLOAD_TYPES:
        raise ValueError(f"unknown upload type {upload_type!r}")
    if connector == "pull" and (upload_type, fmt) != ("Bulk", "JSONMultiLine"):
        raise ValueError("pulled data is read as Bulk + JSONMultiLine only")


def _reader(spark: SparkSession, fmt: str, schema: StructType | str | None,
            infer_sampling_ratio: float | None = None, multi_line: bool = False):
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    elif infer_sampling_ratio and fmt in ("JSON", "JSONMultiLine"):
        # Schema inference reads the whole input once more; at scale pass a
        # schema, or infer from a sample of the records.
        r = r.option("samplingRatio", infer_sampling_ratio)
    if fmt in ("CSV", "CsvWithHeaderRow"):
        # Every column as text; steps cast with try_cast (ANSI mode is on).  A quote
        # inside quotes is doubled, as spreadsheet exports write it.
        return (r.format("csv").option("header", fmt == "CsvWithHeaderRow").option("inferSchema", False)
                .option("escape", '"').option("multiLine", multi_line))
    if fmt == "JSON":
        return r.format("json").option("multiLine", True)
    if fmt == "JSONMultiLine":
        return r.format("json").option("multiLine", False)
    raise ValueError(f"unknown format {fmt!r}")


def list_files(spark: SparkSession, prefix: str) -> DataFrame:
    """path, modificationTime, length of every file under ``prefix`` (a
    distributed listing through the binary-file source; contents are not
    read because only metadata columns are selected)."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(prefix)
            .select("path", "modificationTime", "length"))


def latest_file(spark: SparkSession, prefix: str) -> str | None:
    """Path of the newest non-empty file under ``prefix`` (ties -> greatest path).

    Returns one small value to the driver; the file itself is read by the
    executors (a large file is still split across tasks).
    """
    files = list_files(spark, prefix).where((F.col("length") > 0)
                                            & ~F.col("path").endswith("/" + PLACEHOLDER_OBJECT))
    row = files.agg(F.max_by("path", F.struct("modificationTime", "path")).alias("p")).first()
    return row["p"] if row else None


#: Lines handed to Python at a time where a file's head is looked for.
HEAD_LINES = 16


def _head_session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose scans put each split into a task of its own and read it in small batches."""
    s = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if s.conf.isModifiable(k):
            s.conf.set(k, v)
    s.conf.set("spark.sql.files.openCostInBytes", s.conf.get("spark.sql.files.maxPartitionBytes"))
    s.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(HEAD_LINES))
    return s


def file_headers(spark: SparkSession, paths: str | list[str], multi_line: bool = False) -> DataFrame:
    """``file`` and ``names`` (the cells of its first record) of every non-empty file; written once.

    A task has one split of a file and stops reading after the first record,
    or at once when its split is not the file's first.  With ``multi_line`` a
    line break in quotes does not end the record.  A blank first line is a
    header without names.
    """
    path = scratch_dir(spark, "headers")
    lines = (_head_session(spark).read.option("recursiveFileLookup", True).text(paths)
             .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value"))
    lines.mapInArrow(_first_record(multi_line), "file string, names array<string>").write.parquet(path)
    return spark.read.schema("file string, names array<string>").parquet(path)


def _first_record(multi_line: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = None
        for b in batches:
            for file, start, line in zip(*[c.to_pylist() for c in b.columns]):
                if start:
                    return
                head = line if head is None else f"{head}\n{line}"
                if not multi_line or head.count('"') % 2 == 0:
                    yield _header_row(file, head)
                    return
        if head is not None:
            yield _header_row(file, head)

    return work


def _header_row(file: str, head: str) -> pa.RecordBatch:
    names = next(csv.reader(io.StringIO(head.lstrip("\ufeff").rstrip("\r"), newline="")), [])
    return pa.RecordBatch.from_arrays([pa.array([file]), pa.array([names], pa.list_(pa.string()))], ["file", "names"])


# ---- line breaks in quotes, split by split ------------------------------------------


def _split_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return (spark.read.option("recursiveFileLookup", True).option("lineSep", "\n").text(paths)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value"))


def quoted_records(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``file``, ``first`` and ``record`` of CSV files with line breaks in quotes, each file read by as many tasks as it has splits.

    A line's quotes tell whether it ends inside quotes, if one knows whether it
    begins there.  So the first pass counts the quotes of every split; running
    sums over the splits of a file tell which splits begin inside quotes.  The
    second pass cuts each split's lines into records.  What a split has of a
    record that began before it or ends behind it is put together from the
    pieces, at most two of a split.

    A quote inside quotes is doubled, and cells with quotes are quoted as a
    whole.  A file that ends inside quotes raises an error.
    """
    lines = _split_lines(spark, paths)
    quotes = F.length("value") - F.length(F.regexp_replace("value", '"', ""))
    per_split = lines.groupBy("file", "start").agg(F.sum(quotes).alias("q"))
    before = Window.partitionBy("file").orderBy("start")  # one row per split
    inside = per_split.select("file", "start", (F.sum("q").over(before) % 2).alias("ends"),
                              F.lead("start").over(before).isNull().alias("last"),
                              (F.coalesce(F.sum("q").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2 == 1).alias("open"))
    splits, small = checked(inside)
    if not small:
        raise ValueError("too many splits: raise spark.sql.files.maxPartitionBytes")
    unclosed = splits.where(F.col("last") & (F.col("ends") == 1)).select("file").limit(1).collect()
    if unclosed:
        raise ValueError(f"{unclosed[0]['file']} ends inside quotes")
    known = splits.where("open").select(F.col("file").alias("__f"), F.col("start").alias("__s"), F.lit(True).alias("open"))
    told = lines.join(F.broadcast(known), (F.col("file") == F.col("__f")) & (F.col("start") == F.col("__s")), "left")
    path = scratch_dir(spark, "records")
    pieces = told.select("file", "start", F.coalesce("open", F.lit(False)).alias("open"), "value").mapInArrow(
        _cut_records, "file string, start long, kind string, first boolean, record string")
    pieces.write.partitionBy("kind").parquet(path)
    cut = spark.read.schema("file string, start long, first boolean, record string, kind string").parquet(path)
    whole = cut.where("kind = 'whole'").select("file", "first", "record")
    # a split's head closes the record that the last tail before it opened; those in between hold nothing but its middle
    along = Window.partitionBy("file").orderBy("start", F.when(F.col("kind") == "tail", 1).otherwise(0))
    parts = cut.where("kind <> 'whole'").withColumn("n", F.sum((F.col("kind") == "tail").cast("int")).over(along))
    joined = (parts.groupBy("file", "n").agg(F.array_sort(F.collect_list(F.struct("start", "record"))).alias("p"), F.bool_or("first").alias("first"))
              .select("file", "first", F.array_join(F.transform("p", lambda x: x["record"]), "\n").alias("record")))
    return whole.unionByName(joined).select("file", "first", F.regexp_replace("record", "\r$", "").alias("record"))


def _cut_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of splits, in order -> whole records, and the head, middle or tail that a split has of a longer one."""
    now, held, inside, began, first = None, [], False, False, False
    out: list[tuple] = []

    def batch() -> pa.RecordBatch:
        cols = list(zip(*out)) or [()] * 5
        kinds = [pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.string()]
        rows = pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)], ["file", "start", "kind", "first", "record"])
        out.clear()
        return rows

    def close(kind: str) -> None:
        nonlocal first
        out.append((*now, kind, first, "\n".join(held)))
        held.clear()
        first = False

    for b in batches:
        for file, start, open_, line in zip(*[c.to_pylist() for c in b.columns]):
            if (file, start) != now:
                if held:  # the split before ended inside quotes
                    close("middle" if began else "tail")
                now, inside, began, first = (file, start), open_, open_, start == 0
            held.append(line)
            if line.count('"') % 2:
                inside = not inside
            if not inside:
                close("head" if began else "whole")
                began = False
        yield batch()
    if held:
        close("middle" if began else "tail")
    yield batch()


def _read_mixed_headers(spark: SparkSession, paths: str | list[str], heads: DataFrame, multi_line: bool,
                        records: DataFrame | None = None) -> DataFrame:
    """CSV files whose headers differ in order or columns -> the union of their columns by name.

    One scan: the reader skips each file's first record, whatever it holds, and
    a row's cells are put in place by its file's header.  Columns a file lacks
    are null.  A column without a name is ``_c`` and its place, as Spark names
    it; of two columns of one name the first counts.  A file with rows whose
    header has no names raises an error.
    """
    named = heads.where(F.exists("names", lambda n: n != "")).select("file", F.transform("names", lambda n, i: F.when(n == "", F.concat(F.lit("_c"), i.cast("string"))).otherwise(n))
                         .alias("names"))
    layouts = named.select("names").distinct()
    # columns in the order in which layouts, as texts, have them; their names are the result's schema
    columns = [r["name"] for r in layouts.select(F.array_join("names", ",").alias("l"), F.posexplode("names").alias("at", "name"))
               .groupBy("name").agg(F.min(F.struct("at", "l")).alias("first")).orderBy("first", "name").select("name").collect()]
    width = layouts.agg(F.max(F.size("names"))).first()[0] or 0
    own = [f"_c{i}" for i in range(width)]
    schema = ", ".join(f"{c} string" for c in own)
    if records is None:
        raw = _reader(spark, "CsvWithHeaderRow", schema, multi_line=multi_line).option("recursiveFileLookup", True).load(paths)
        raw = raw.select(F.array(*own).alias("__cells"), F.col("_metadata.file_path").alias("__path"))
    else:
        parsed = records.where("NOT first AND record <> ''").select("file", F.from_csv("record", schema, {"escape": '"'}).alias("r"))
        raw = parsed.select(F.array(*[f"r.{c}" for c in own]).alias("__cells"), F.col("file").alias("__path"))
    cells = raw.select("*", F.xxhash64("__path").alias("__file"))
    # per layout, where each column of the result stands (0: nowhere); per file, its layout: a few bytes a file
    wanted = F.array(*[F.lit(c) for c in columns])
    places = layouts.select("names", F.xxhash64("names").alias("__layout"),
                            F.transform(wanted, lambda c: F.array_position("names", c).cast("int")).alias("__places"))
    files = named.select(F.xxhash64("file").alias("__file"), F.xxhash64("names").alias("__layout"))
    n, codes, forms, kinds = named.select(F.count(F.lit(1)), F.count_distinct(F.xxhash64("file")), F.count_distinct("names"),
                                          F.count_distinct(F.xxhash64("names"))).first()
    if not n:
        raise ValueError("no file has a header row")
    if n != codes or forms != kinds:
        raise ValueError("two file names or headers have the same 64-bit hash")
    rows = attach_checked(attach_checked(cells, files, ["__file"]), places.drop("names"), ["__layout"])
    lost = F.raise_error(F.concat(F.lit("no header row found in "), F.col("__path"))).cast("boolean")
    rows = rows.where(F.when(F.col("__layout").isNull(), lost).otherwise(True))
    place = lambda i: F.element_at("__places", i + 1)
    return rows.select(*[F.when(place(i) > 0, F.element_at("__cells", place(i))).alias(c) for i, c in enumerate(columns)])


def read_inbound(spark: SparkSession, path: str, fmt: str = "CsvWithHeaderRow", upload_type: str = "Incremental",
                 schema: StructType | str | None = None, connector: str = "push",
                 column_names: list[str] | None = None, infer_sampling_ratio: float | None = None,
                 multi_line: bool | str = False, same_header: bool = False, files: list[str] | None = None) -> DataFrame:
    """Read landed data under ``path`` with the connector's settings.

    Incremental reads every file under the prefix (recursively), or only
    ``files`` (what arrived since the last run); Bulk reads only the newest
    file.  Zero-byte placeholders contribute no rows.
    ``column_names`` names the generated ``_c0.._cN`` columns of headerless CSV.
    ``multi_line`` reads CSV with line breaks inside quotes: ``True`` by one
    task per file; ``"split"`` by one task per split (``quoted_records``; CSV
    with header, Incremental).  ``same_header`` promises that all CSV headers are
    alike and saves the look at each file's first record.
    """
    check_combination(connector, upload_type, fmt)
    if upload_type == "Bulk":
        newest = latest_file(spark, path)
        if newest is None:
            raise FileNotFoundError(f"no non-empty file under {path}")
        return _named(_reader(spark, fmt, schema, infer_sampling_ratio, multi_line).load(newest), fmt, column_names)
    paths = path if files is None else [f for f in files if not f.endswith("/" + PLACEHOLDER_OBJECT)]
    if multi_line == "split":
        if fmt != "CsvWithHeaderRow":
            raise ValueError("multi_line='split' reads CsvWithHeaderRow")
        return _read_mixed_headers(spark, paths, file_headers(spark, paths, True), True, quoted_records(spark, paths))
    if fmt == "CsvWithHeaderRow" and schema is None and not same_header:
        heads = file_headers(spark, paths, multi_line)
        if heads.select("names").distinct().limit(2).count() > 1:
            return _read_mixed_headers(spark, paths, heads, multi_line)
    return _named(_reader(spark, fmt, schema, infer_sampling_ratio, multi_line).option("recursiveFileLookup", True).load(paths),
                  fmt, column_names)


def _named(df: DataFrame, fmt: str, column_names: list[str] | None) -> DataFrame:
    return df.toDF(*column_names) if column_names and fmt == "CSV" else df
