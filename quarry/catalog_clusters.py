"""Queries of cluster rules and of k-means on a nested bag."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.catalog import rnd
from quarry.catalog_models import KM_COLS, _km_start
from quarry.operators.cluster_rules import cluster_rules
from quarry.operators.clustering import HierarchicalKMeans, nearest
from quarry.operators.sparse_kmeans import fit_bag_kmeans
from quarry.session import session_key
from quarry.sources import cases

RULE_NUMERIC = ["acctbal", "n_orders", "sum_qty", "avg_price"]
RULE_CATEGORICAL = ["segment", "region"]

_FITS: dict = {}


def q_cluster_rules(spark, sf_dir):
    """Rules of the four clusters around the means of the key's residue classes."""
    z, centers = _km_start(spark, sf_dir)
    ids = z.select("cust_id", nearest([F.col(a) for a in KM_COLS], centers).alias("cluster_id"))
    rules = cluster_rules(cases.case_table(spark, sf_dir).join(ids, "cust_id"), "cluster_id", RULE_NUMERIC, RULE_CATEGORICAL)
    return rules.select("cluster_id", "attribute_name", "lower_bin", "upper_bin",
                        F.array_join("attribute_values", ",").alias("attribute_values"), "support",
                        rnd("confidence").alias("confidence"), "rule_support", rnd("rule_confidence").alias("rule_confidence"))


def q_kmeans_rules(spark, sf_dir):
    """Rules of the leaves of the hierarchical k-means tree, bounds in original units."""
    c = cases.case_table(spark, sf_dir)
    m = HierarchicalKMeans(k=6, name="customer_rules").fit(c, KM_COLS)
    return cluster_rules(c.withColumn("cluster_id", m.cluster_id(c)), "cluster_id", KM_COLS, RULE_CATEGORICAL)


def _star(spark, sf_dir):
    key = (session_key(spark), sf_dir)
    if key not in _FITS:
        c = cases.case_table(spark, sf_dir).join(cases.cust_type_map(spark, sf_dir), "cust_id", "left")
        _FITS[key] = fit_bag_kmeans(c, ["acctbal", "n_orders"], "type_sums", 5), c
    return _FITS[key]


def q_star_kmeans_centroids(spark, sf_dir):
    """Centroids of five clusters over customer columns and the nested sums by part type."""
    return _star(spark, sf_dir)[0].centroids_df(spark)


def q_star_kmeans_means(spark, sf_dir):
    """Those centroids weighted by their rows: the table's own means, by attribute and part type."""
    c = _star(spark, sf_dir)[0].centroids_df(spark)
    return c.groupBy("attribute_name", "attribute_subname").agg(
        F.round(F.sum(F.col("mean") * F.col("record_count")) / F.sum("record_count"), 3).alias("mean"),
        F.sum("record_count").alias("n"))


def q_star_kmeans_assign(spark, sf_dir):
    """Customers and mean distance of each of those clusters."""
    m, c = _star(spark, sf_dir)
    return m.cluster_id(c).groupBy("cluster_id").agg(F.count("*").alias("n"), F.avg("cluster_distance").alias("mean_distance"))


QUERIES = {
    "cluster_rules": q_cluster_rules,
    "kmeans_rules": q_kmeans_rules,
    "star_kmeans_centroids": q_star_kmeans_centroids,
    "star_kmeans_means": q_star_kmeans_means,
    "star_kmeans_assign": q_star_kmeans_assign,
}
