"""Queries of the mixed-attribute EM model."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.catalog import rnd
from quarry.operators.mixture import Mixture
from quarry.session import session_key
from quarry.sources import cases

NUMERIC = ["acctbal", "n_orders", "sum_qty"]
CATEGORICAL = ["segment", "region"]

_FITS: dict = {}


def _model(spark, sf_dir):
    key = (session_key(spark), sf_dir)
    if key not in _FITS:
        _FITS[key] = Mixture(components=8, clusters=4, improvement=1e-4, name="customer_mixture").fit(
            cases.case_table(spark, sf_dir), NUMERIC, CATEGORICAL)
    return _FITS[key]


def q_em_component_priors(spark, sf_dir):
    """View O: each component's prior and the cluster it was merged into."""
    return _model(spark, sf_dir).view("O")


def q_em_gaussian_moments(spark, sf_dir):
    """View M summed up: the components' means and second moments, weighted by their priors, by attribute."""
    m = _model(spark, sf_dir)
    both = m.view("M").join(m.view("O"), "component_id")
    p = F.col("prior_probability")
    return both.groupBy("attribute_name").agg(
        F.round(F.sum(p * F.col("mean")), 4).alias("mean"),
        F.round(F.sqrt(F.sum(p * (F.col("variance") + F.col("mean") * F.col("mean")))), 4).alias("root_mean_square"))


def q_em_frequency_shares(spark, sf_dir):
    """View F summed up: every value's frequency over all components, weighted by their priors."""
    m = _model(spark, sf_dir)
    both = m.view("F").join(m.view("O"), "component_id")
    return both.groupBy("attribute_name", "attribute_value").agg(
        rnd(F.sum(F.col("prior_probability") * F.col("frequency"))).alias("share"))


def q_em_mixed_clusters(spark, sf_dir):
    """Customers and mean probability of every merged cluster."""
    m = _model(spark, sf_dir)
    return m.score(cases.case_table(spark, sf_dir)).groupBy("cluster_id").agg(
        F.count("*").alias("n"), F.avg("cluster_probability").alias("mean_probability"))


def q_em_merges(spark, sf_dir):
    """The merges of components into clusters with their distances."""
    return _model(spark, sf_dir).view("T")


QUERIES = {
    "em_component_priors": q_em_component_priors,
    "em_gaussian_moments": q_em_gaussian_moments,
    "em_frequency_shares": q_em_frequency_shares,
    "em_mixed_clusters": q_em_mixed_clusters,
    "em_merges": q_em_merges,
}
