"""Registered text queries: term extraction, TF-IDF, ESA (section 2.12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.catalog import R, rnd
from quarry.operators import text as tx
from quarry.session import session_key
from quarry.sources.tables import load

ESA_MIN_ITEMS = 5
ESA_MIN_DOCS = 2
ESA_TOP_N = 5
TFIDF_MIN_DOCS = 2

_CACHE: dict = {}


def esa_model(spark, sf_dir):
    """ESA whose concepts are the benchmark passages."""
    key = ("esa", session_key(spark), sf_dir)
    if key not in _CACHE:
        _CACHE[key] = tx.ESA(min_items=ESA_MIN_ITEMS, min_docs=ESA_MIN_DOCS, name="ESA_BENCH").fit(
            load(spark, sf_dir, "benchmark"), "item_id", "text")
    return _CACHE[key]


def q_term_extract(spark, sf_dir):
    d = load(spark, sf_dir, "documents")
    return tx.term_extract(d, "doc_id", "text").select("doc_id", "term", rnd("value").alias("value"))


def q_tfidf(spark, sf_dir):
    d = load(spark, sf_dir, "documents")
    tc = tx.doc_terms(d, "doc_id", "text")
    v = tx.vocabulary(tc, min_docs=TFIDF_MIN_DOCS).persist()
    return tx.tfidf(tc, v).select("doc_id", "term", rnd("weight").alias("weight"))


def q_text_vocabulary(spark, sf_dir):
    """Top 3000 terms by document frequency (ODMS_TEXT_MAX_FEATURES style)."""
    d = load(spark, sf_dir, "documents")
    v = tx.vocabulary(tx.doc_terms(d, "doc_id", "text"), min_docs=1, max_features=3000)
    return v.select("term", "df", rnd("idf").alias("idf"))


def q_esa_index(spark, sf_dir):
    m = esa_model(spark, sf_dir)
    return m.index.select("feature_id", "term", rnd("weight").alias("weight"))


def q_esa_top_features(spark, sf_dir):
    """Top 5 benchmark concepts of every document."""
    m = esa_model(spark, sf_dir)
    t = m.top_features(load(spark, sf_dir, "documents"), "doc_id", "text", ESA_TOP_N)
    return t.select(F.col("id").alias("doc_id"), "feature_id", rnd("value").alias("value"),
                    F.col("rank").cast("long").alias("rank"))


def q_feature_compare(spark, sf_dir):
    """ESA distance between consecutive turns of every conversation."""
    m = esa_model(spark, sf_dir)
    c = load(spark, sf_dir, "conversations")
    a = c.select("conv_id", "turn", F.col("text").alias("text_a"))
    b = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("text_b"))
    pairs = a.join(b, ["conv_id", "turn"])
    out = m.compare(pairs, "text_a", "text_b", ["conv_id", "turn"])
    return out.select("conv_id", "turn", rnd("compare").alias("compare"))


QUERIES = {
    "term_extract": q_term_extract,
    "tfidf": q_tfidf,
    "text_vocabulary": q_text_vocabulary,
    "esa_index": q_esa_index,
    "esa_top_features": q_esa_top_features,
    "feature_compare": q_feature_compare,
}
