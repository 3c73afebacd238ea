"""Queries of transient models: fitted per partition, used once."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.catalog import rnd
from quarry.operators import partitioned as P
from quarry.operators.topn import top_n_by_group
from quarry.session import session_key
from quarry.sources import cases

COLS = ["acctbal", "n_orders", "avg_price", "sum_qty", "last_gap_days"]

_FITS: dict = {}


def _anomalies(spark, sf_dir):
    key = (session_key(spark), sf_dir)
    if key not in _FITS:
        _FITS[key] = P.anomalies_over(cases.case_table(spark, sf_dir), "segment", COLS)
    return _FITS[key]


def q_transient_anomaly(spark, sf_dir):
    """The two most atypical customers of every segment under a model of the segment, and why."""
    m = _anomalies(spark, sf_dir)
    scored = m.score(cases.case_table(spark, sf_dir)).select(
        "cust_id", "segment", F.round("anomaly_probability", 8).alias("anomaly_probability"), "anomaly_details")
    return top_n_by_group(scored, ["segment"], [F.col("anomaly_probability").desc(), F.col("cust_id")], 2,
                          salt_cols=["cust_id"], rank_col="rank_anom")


def q_transient_anomaly_models(spark, sf_dir):
    """Rows, iterations, convergence and outlier share of every segment's one-class model."""
    return _anomalies(spark, sf_dir).models(spark)


def q_transient_regression(spark, sf_dir):
    """Every customer's quantity as predicted by a line of the customer's region."""
    out = P.regression_over(cases.case_table(spark, sf_dir), "region", "sum_qty", ["n_orders"])
    return out.select("cust_id", "region", rnd("prediction", 5).alias("prediction"))


def q_transient_features(spark, sf_dir):
    """The two features of largest value of every customer under a PCA of the customer's segment."""
    c = cases.case_table(spark, sf_dir)
    return P.features_over(c, "segment", COLS, 4).feature_set(c.select("cust_id", "segment", *COLS), 2).select(
        "cust_id", "segment", "features")


def q_partitioned_pca(spark, sf_dir):
    """Shares of variance of a PCA of two columns in every region."""
    c = cases.case_table(spark, sf_dir).filter("acctbal IS NOT NULL AND sum_qty IS NOT NULL")
    v = P.features_over(c, "region", ["acctbal", "sum_qty"], 2).variances(spark)
    return v.select("partition_name", "feature_id", rnd("variance").alias("variance"), rnd("share").alias("share"),
                    rnd("cumulative_share").alias("cumulative_share"))


def q_transient_clusters(spark, sf_dir):
    """Sizes and mean distances of four clusters in every segment."""
    c = cases.case_table(spark, sf_dir)
    scored = P.clusters_over(c, "segment", ["acctbal", "n_orders", "sum_qty"], 4).cluster_id(c)
    return scored.groupBy("segment", "cluster_id").agg(F.count("*").alias("n"),
                                                       F.avg("cluster_id_distance").alias("mean_distance"))


QUERIES = {
    "transient_anomaly": q_transient_anomaly,
    "transient_anomaly_models": q_transient_anomaly_models,
    "transient_regression": q_transient_regression,
    "transient_features": q_transient_features,
    "partitioned_pca": q_partitioned_pca,
    "transient_clusters": q_transient_clusters,
}
