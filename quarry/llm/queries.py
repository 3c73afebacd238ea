"""The registered corpus queries: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import (ann, bpe, chatformat, decontaminate, filteraudit, neardup, packing, quality, secrets, toxicity,
                        urlfilter, variants, warc)
from quarry.llm.oracle import SQL

VOCABULARY = "byte_bpe_50k.tiktoken"
WORD_VOCABULARY = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def q_op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that cover half of a benchmark item's tokens or more, with the items."""
    found = decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "covered", "tokens", F.size("tiles").cast("long").alias("n_tiles"))


def q_op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth vector by inner product."""
    return ann.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def q_op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of the URL rules on every page."""
    return urlfilter.judge_urls(_table(spark, sf_dir, "pages"))


def q_op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document by patterns and randomness tests."""
    return secrets.secret_digest(_table(spark, sf_dir, "documents"))


def q_op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation with roles repaired at least cost, as rendered fragments."""
    return chatformat.repair(_table(spark, sf_dir, "conversations"))


def q_op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of the bytes decoded from them."""
    return bpe.digests(_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY),
                       public_tokenizers.PATTERN)


def q_op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as read back from WARC files converted from ARC files."""
    return warc.pages_to_warc(_table(spark, sf_dir, "pages")).drop("uri")


def q_op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document by its nearest labelled examples."""
    scores = toxicity.toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scores.select("doc_id", "held_out", "score", "predicted")


def q_op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents over 4-word shingles at similarity 0.8."""
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"), size=4)


def q_op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document by averaged subword embeddings."""
    return quality.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def q_op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps and Shapley values of five text filters in all orders, by language."""
    return filteraudit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def q_op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of 2,048 tokens."""
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_VOCABULARY))


def q_op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with its more frequent spelling and the root of its variants."""
    return variants.spelling_variants(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_decontaminate": q_op1_decontaminate,
    "op2_nearest": q_op2_nearest,
    "op3_url_filter": q_op3_url_filter,
    "op4_toxicity": q_op4_toxicity,
    "op5_near_duplicates": q_op5_near_duplicates,
    "op6_secrets": q_op6_secrets,
    "op7_chat": q_op7_chat,
    "op8_bpe": q_op8_bpe,
    "op9_warc": q_op9_warc,
    "op10_quality": q_op10_quality,
    "op11_filter_audit": q_op11_filter_audit,
    "op12_packing": q_op12_packing,
    "op13_spelling_variants": q_op13_spelling_variants,
}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of the queries that SQL can express."""
    return dict(SQL)
