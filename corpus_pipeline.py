"""A training corpus from raw documents: toxicity, quality rules, near duplicates, source mixing, token ids."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reviewlake.llm import bpe, jaccard_join, mixing, quality_rules, toxicity
from reviewlake.llm.queries import MAX_EPOCHS, TARGET_ENTROPY, tokenizer_file
from reviewlake.llm.texts import shielded
from reviewlake.operators.placement import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not call toxic. Labels come from the labels table."""
    return toxicity.reject_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.keep_good(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near duplicates: five words, similarity 0.8."""
    return jaccard_join.keep_one_per_component(docs, percent=80, n=5)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's weight asks for; each at least once."""
    return shielded(docs, lambda rows: mixing.mix(rows, TARGET_ENTROPY, MAX_EPOCHS), ("doc_id", "text", "source"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the token ids of each document, (doc_id, n_tokens, ids_sha256, decoded_sha256)."""
    import public_tokenizers

    return bpe.digest_documents(docs, tokenizer_file("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", reject_toxic),
    ("quality_rules", keep_good),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("encoding", encode),
]

#: A trained classifier decides the first stage, which SQL cannot express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"corpus-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
