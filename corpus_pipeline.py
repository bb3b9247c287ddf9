"""Training-corpus pipeline: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns the rows it keeps, with
the columns of ``docs``; the last one writes token files and returns what it
read back from them, one row per document of the mixture.

* ``quality``: rejected documents go (labels: the ``labels`` table);
* ``near_duplicates``: one document of each SimHash group stays (4-word
  shingles, 4 bits);
* ``decontaminate``: documents with a word inside an occurrence of a
  benchmark window go;
* ``mix``: documents are repeated or left out so that sources meet their
  targets;
* ``token_files``: what is left is written as token-id files.

Documents are long, so the stages hand ``BATCH_ROWS`` of them to Python at a
time (Spark's setting for the session); results do not depend on it.

Empty tables, nulls, repeated rows and further columns: as the operators'
modules say.  No stage depends on the order of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ladle.llm.decontaminate import decontaminate
from ladle.llm.mixing import mix
from ladle.llm.quality import keep_good
from ladle.llm.queries import tokenizer_path
from ladle.llm.simhash import simhash_dedup
from ladle.llm.token_files import read_token_files, write_token_files
from ladle.session import scratch_dir


BATCH_ROWS = 1000


def _small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    return simhash_dedup(docs, shingle=4, max_bits=4)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    path = scratch_dir(spark, "token-files")
    write_token_files(docs, path, tokenizer_path())
    return read_token_files(spark, path)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", drop_benchmark),
    ("mix", mix_sources),
    ("token_files", token_files),
]

#: Hashed n-gram models, XXH64 fingerprints and tokenization have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again by the next stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
