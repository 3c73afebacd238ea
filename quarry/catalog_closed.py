"""Fits whose result has a closed form, so that SQL can check the fitting itself.

Each query runs an estimator of the library on whole tables; the oracle computes the same numbers
from covariances, logarithms of odds or least squares on logarithms.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.catalog import R, rnd
from quarry.operators import prep
from quarry.operators.decomposition import SVD
from quarry.operators.linear import GLM
from quarry.operators.survival import AFT
from quarry.sources import cases


def q_glm_two_predictors(spark, sf_dir):
    """Linear GLM of the bought quantity on two predictors: its three coefficients."""
    m = GLM(target="sum_qty", numeric=["n_orders", "acctbal"], name="quantity_2d").fit(cases.case_table(spark, sf_dir))
    names = ["(intercept)", "n_orders", "acctbal"]
    return spark.createDataFrame([(n, round(float(b), R)) for n, b in zip(names, m.beta)],
                                 "attribute_name string, coefficient double")


def q_glm_logistic_groups(spark, sf_dir):
    """Logistic GLM of affinity on one 0/1 attribute: log odds of one group, and their difference."""
    c = cases.case_table(spark, sf_dir).select("affinity", (F.col("n_orders") >= 10).cast("double").alias("frequent"))
    m = GLM(target="affinity", numeric=["frequent"], family="binomial", name="affinity_groups").fit(c)
    return spark.createDataFrame([(round(float(m.beta[0]), 5), round(float(m.beta[1]), 5))],
                                 "log_odds double, difference double")


def q_pca_two_columns(spark, sf_dir):
    """PCA of two standardized columns: each component's share of the variance."""
    c = cases.case_table(spark, sf_dir).filter("acctbal IS NOT NULL AND sum_qty IS NOT NULL")
    m = SVD(pca=True, name="pca_2d").fit(c, ["acctbal", "sum_qty"])
    share = m.S ** 2 / (m.S ** 2).sum()
    return spark.createDataFrame([(i + 1, round(float(x), R)) for i, x in enumerate(share)],
                                 "feature_id int, variance_share double")


def q_aft_exact(spark, sf_dir):
    """AFT on uncensored gaps only, normal errors: least squares on the logarithm of the gap."""
    g = cases.order_gaps(spark, sf_dir).filter("rbound > 0").withColumn("price", F.col("o_totalprice") / 100000)
    m = AFT("lbound", "rbound", numeric=["price"], dist="normal", scale=0.7, name="gap_aft").fit(g)
    return spark.createDataFrame([(round(float(m.beta[0]), 5), round(float(m.beta[1]), 5), m.stats["events"])],
                                 "intercept double, slope double, events long")


def q_one_hot_names(spark, sf_dir):
    """The (attribute, value) pairs that a one-hot encoding of segment and region makes."""
    return prep.one_hot_names(cases.case_table(spark, sf_dir), ["segment", "region"])


def q_normalization_view(spark, sf_dir):
    """View N: shift and scale of every numeric attribute."""
    norm = prep.fit_normalizer(cases.case_table(spark, sf_dir), ["acctbal", "n_orders", "sum_qty"], "mean", "stddev")
    return norm.detail_df(spark).select("attribute_name", rnd("shift").alias("shift"), rnd("scale").alias("scale"))


QUERIES = {
    "glm_two_predictors": q_glm_two_predictors,
    "glm_logistic_groups": q_glm_logistic_groups,
    "pca_two_columns": q_pca_two_columns,
    "aft_exact": q_aft_exact,
    "one_hot_names": q_one_hot_names,
    "normalization_view": q_normalization_view,
}
