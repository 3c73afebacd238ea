"""The corpus pipeline: five stages over ``documents``, each on what the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import bpe, decontaminate, neardup, quality, secrets
from quarry.llm.common import materialize


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five words, similarity 0.8) the smallest doc_id stays."""
    return neardup.keep_first(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover half of a benchmark item's tokens or more go."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    return secrets.redact(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the digest of the text decoded from them, for every document."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    columns = ("doc_id", "ids", "n_tokens", "decoded")
    return bpe.round_trip(docs, path, public_tokenizers.PATTERN, columns).select(
        "doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality classifier", drop_low_quality), ("near-dedup", drop_near_copies),
          ("decontamination", drop_benchmark_leaks), ("secret scan", redact_secrets), ("byte-level BPE", encode_tokens)]

#: The learned classifier, signatures and merges cannot be written in SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result but the last is written as Parquet and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


def q_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality, near-dedup, decontamination, secrets and tokens over all documents."""
    return run(spark, sf_dir)


QUERIES = {"pipeline": q_pipeline}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
