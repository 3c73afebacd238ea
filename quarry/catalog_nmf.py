"""Queries of stemmed text and its non-negative factors."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators.stemmer import doc_stems
from quarry.operators.text_nmf import fit_text_nmf
from quarry.operators.topn import top_n_by_group
from quarry.session import session_key
from quarry.sources.tables import load

_CACHE: dict = {}


def _model(spark, sf_dir):
    """Ten features of the documents' stems, 1,000 terms of at least 5 documents."""
    key = (session_key(spark), sf_dir)
    if key not in _CACHE:
        _CACHE[key] = fit_text_nmf(load(spark, sf_dir, "documents"), "doc_id", "text", k=10, max_features=1000, min_docs=5)
    return _CACHE[key]


def q_text_stems(spark, sf_dir):
    """Stems of all documents with the documents and the words they count."""
    return doc_stems(load(spark, sf_dir, "documents"), "doc_id", "text").groupBy("term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("tf").alias("n"))


def q_text_nmf_terms(spark, sf_dir):
    """The ten heaviest stems of every feature."""
    e = _model(spark, sf_dir).view("E")
    return top_n_by_group(e, ["feature_id"], [F.col("coefficient").desc(), F.col("attribute_name").asc()], 10,
                          salt_cols=["attribute_name"], rank_col="rank")


def q_text_nmf_features(spark, sf_dir):
    """Documents by feature of largest value; NULL for documents without known stems."""
    ids = _model(spark, sf_dir).feature_id(load(spark, sf_dir, "documents"), "doc_id", "text")
    return ids.groupBy("feature_id").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("avg_value"))


def q_text_nmf_errors(spark, sf_dir):
    """Squared error of the factors after every step."""
    return _model(spark, sf_dir).errors_df(spark)


QUERIES = {
    "text_stems": q_text_stems,
    "text_nmf_terms": q_text_nmf_terms,
    "text_nmf_features": q_text_nmf_features,
    "text_nmf_errors": q_text_nmf_errors,
}
