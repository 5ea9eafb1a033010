"""Registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.llm import bpe, chat_format, collocations, hard_negatives, license_scan, line_quality, mixing, ngram_join, secret_scan, suffix_dedup, topk, toxicity, warc

#: The splitting pattern and the rank file of the byte-level vocabulary.
RANK_FILE = "byte_bpe_50k.tiktoken"
PROBE = "\\### Assistant: </turn> ok"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bpe_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"), 100)
    return kept.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents").select("doc_id", "text", "source"), (5, 2, 1), 1.5, 2.0)
    return mixed.select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_source_size").cast("long").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_size") * F.col("_copies")).cast("long").alias("taken"),
    )


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_components(_table(spark, sf_dir, "documents"), 3, 90)


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string")
    records = chat_format.message_records(rows.unionByName(probe))
    return chat_format.read_back(chat_format.format_records(records))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_table(spark, sf_dir, "documents"), bpe.vocabulary(RANK_FILE), bpe_pattern())


def op6_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = line_quality.line_verdicts(_table(spark, sf_dir, "documents"))
    return verdicts.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_left_words"
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    net = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, net)
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    return scored.select(
        "doc_id",
        F.coalesce(remainder == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10, 1024)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archived(_table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(_table(spark, sf_dir, "documents"), 100, 5, 2000)


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return secret_scan.scan(docs, secret_scan.train(docs))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", noisy), F.col("vec_id") % 100 == 0, 5, 10, 256, 30, 90)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_suffix_dedup, op2_source_mixing, op3_ngram_join, op4_chat_format, op5_byte_bpe,
        op6_line_quality, op7_toxicity, op8_exact_topk, op9_warc, op10_license_scan,
        op11_collocations, op12_secret_scan, op13_hard_negatives,
    )
}
