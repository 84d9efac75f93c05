"""A corpus from raw documents to token ids: quality, repeated lines, near copies, source weights, encoding.

Each stage takes (spark, docs, sf_dir) and is written and read again before the next one. All stages but the last return
the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segue.llm import bpe, line_dedup, mixing, quality, simhash
from segue.llm.queries import byte_bpe, table
from segue.session import scratch_path, ship_package

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labelled ones among them, does not reject."""
    ship_package(spark)
    model = quality.train(docs, table(spark, sf_dir, "labels"), metadata=["n_chars"])
    return quality.keep_good(docs, model, metadata=["n_chars"])


def line_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that stand earlier, equal or within one edit; n_chars counts what is left."""
    ship_package(spark)
    return line_dedup.dedup_lines(docs).withColumn("n_chars", F.char_length("text").cast("bigint"))


def copy_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies; texts that lost all lines are one such group."""
    ship_package(spark)
    return simhash.keep_one(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources wants them, in one seeded order."""
    ship_package(spark)
    return mixing.mix_sources(docs, copy=None)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256) for each document of the mix."""
    ship_package(spark)
    encoded = bpe.encode_decode(docs, byte_bpe())
    return encoded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_filter),
    ("line_dedup", line_filter),
    ("simhash_near_dedup", copy_filter),
    ("source_mixing", source_mix),
    ("bpe_encoding", token_ids),
]

#: A classifier and a tokenizer stand in the way of SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf)
