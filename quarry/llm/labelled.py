"""Bounded samples of labelled documents, for the classifiers that are fitted on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PER_CLASS = 2000
MAX_CHARS = 32_768


def in_fold(doc_id: Column, modulus: int, remainder: int) -> Column:
    """True for rows whose crc32 of the decimal doc_id leaves ``remainder``; false for null ids."""
    left = F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(modulus))
    return F.coalesce(left == remainder, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, modulus: int, remainder: int,
                    per_class: int = PER_CLASS, max_chars: int = MAX_CHARS):
    """(ids, texts, labels, shares): at most ``per_class`` rows of each class, in order of doc_id.

    Rows of the held-out fold, null ids and labels other than 0 and 1 are left out; an id with
    several labels counts once, with the largest.  The ids with the smallest hashes are taken,
    and of their texts the smallest of up to ``max_chars`` characters, so the sample's size is bounded
    by ``2 * per_class * max_chars`` characters whatever the corpus.  ``shares`` are the rows of
    each class among all labels of the fold.
    """
    rows = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("y"))
            .filter(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1))
            .filter(~in_fold(F.col("doc_id"), modulus, remainder))
            .groupBy("doc_id").agg(F.max("y").alias("y")))
    shares = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    picked = []
    for y in (0, 1):
        picked += rows.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class).collect()
    spark = docs.sparkSession
    chosen = spark.createDataFrame([(r.doc_id, r.y) for r in picked], "doc_id long, y int")
    texts = (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
             .filter(F.length("text") <= max_chars)
             .join(F.broadcast(chosen), "doc_id")  # at most 2 * per_class ids
             .groupBy("doc_id", "y").agg(F.min("text").alias("text")))
    found = {r.doc_id: (r.text, r.y) for r in texts.collect()}
    order = sorted(found)
    return (order, [found[i][0] for i in order], [found[i][1] for i in order],
            (shares.get(0, 0), shares.get(1, 0)))
