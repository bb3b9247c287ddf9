"""Registered queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.llm.common import table
from ladle.llm.oracles import ORACLES  # noqa: F401
from ladle.session import scratch_dir

TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def byte_tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(BYTE_TOKENIZER)


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ladle.llm.token_files import read_token_files, write_token_files

    path = scratch_dir(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, tokenizer_path())
    return read_token_files(spark, path)


def op2_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ladle.llm.simhash import simhash_groups

    return simhash_groups(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ladle.llm.minhash import next_fingerprints

    return next_fingerprints(table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ladle.llm.decontaminate import mark

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = mark(docs, table(spark, sf_dir, "benchmark"), window=10, prefix="m_")
    return found.select("doc_id", F.col("m_n_words").alias("n_words"), F.col("m_n_hit").alias("n_hit"),
                        F.size("m_items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("m_items", ","), 256).alias("items_sha256"),
                        (F.col("m_n_hit") > 0).alias("contaminated"))


def op5_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ladle.llm.pseudo_lm import train_and_score

    return train_and_score(table(spark, sf_dir, "documents"))


def op6_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ladle.llm.mixing import plan

    return plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ladle.llm.language import learn_and_identify

    return learn_and_identify(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ladle.llm.quality import scores

    return scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("b")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ladle.llm.warc import read_warc, write_warc

    path = scratch_dir(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    return read_warc(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ladle.llm.licenses import scan

    found = scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word",
                        F.array_join("base_labels", ",").alias("base_labels"),
                        F.array_join("labels", ",").alias("labels"), "score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ladle.llm.negatives import mine, usable

    rows = table(spark, sf_dir, "embeddings")
    moved = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return mine(usable(moved), F.col("id") % 100 == 0)


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ladle.llm.conversations import damage, repair

    return repair(damage(table(spark, sf_dir, "conversations")), copies="copies")


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ladle.llm.packing import pack_pieces

    return pack_pieces(table(spark, sf_dir, "documents"), byte_tokenizer_path(), with_ids=False)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_token_files": op1_token_files,
    "op2_simhash_pivots": op2_simhash_pivots,
    "op3_minhash": op3_minhash,
    "op4_decontaminate": op4_decontaminate,
    "op5_pseudo_likelihood": op5_pseudo_likelihood,
    "op6_pareto_mix": op6_pareto_mix,
    "op7_language": op7_language,
    "op8_quality": op8_quality,
    "op9_warc": op9_warc,
    "op10_licenses": op10_licenses,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_conversations": op12_conversations,
    "op13_packing": op13_packing,
    "pipeline": pipeline,
}
