"""A corpus pipeline: five stages over the documents table, each calling one operator.

Every stage takes (spark, docs, sf_dir), works on all that the stage before it kept, and
returns documents (the last one the digests of their tokens). Null texts count as empty, tables
may be empty, and columns beyond those of the table pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.llm import bpe, mixing, ngram_join, suffix_dedup, toxicity
from orderlake.llm.names import free_name, free_prefix
from orderlake.llm.queries import RANK_FILE, bpe_pattern
from orderlake.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.5, by a network fitted on the labelled ones among them."""
    net = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = free_name(docs.columns, "_toxicity")
    return toxicity.score(docs, net, score).where(F.col(score) < 0.5).drop(score)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group that word 5-gram sets of a similarity of at least 0.8 link."""
    return ngram_join.one_of_each(docs, 5, 80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes of 100-byte strings that start earlier, too."""
    return suffix_dedup.without_repeats(docs, 100)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    prefix = free_prefix(docs.columns, "_mix_")
    mixed = mixing.mix(docs, (5, 2, 1), 1.5, 2.0, prefix)
    copies = F.col(f"{prefix}copies")
    return mixed.where(copies > 0).withColumn(f"{prefix}copy", F.explode(F.sequence(F.lit(1).cast("long"), copies))).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of the ids and of the decoded bytes of each document."""
    return bpe.round_trip(docs, bpe.vocabulary(RANK_FILE), bpe_pattern())


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("source_mixing", mix_sources),
    ("byte_bpe", tokenize),
]

#: A trained network and merges have no SQL form; tests hold run() against a plain Python pipeline that only asks the network for its scores.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
