"""Queries of support vector classification: coefficients, probabilities, Gaussian kernel."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.catalog import rnd
from quarry.operators.svm import SVMClassifier
from quarry.session import session_key
from quarry.sources import cases

NUMERIC = ["acctbal", "n_orders", "avg_price", "sum_qty", "last_gap_days"]
CATEGORICAL = ["segment", "region"]
REG = 0.01

_FITS: dict = {}


def _fit(spark, sf_dir, kind):
    key = (session_key(spark), sf_dir, kind)
    if key not in _FITS:
        c = cases.case_table(spark, sf_dir)
        if kind == "groups":
            _FITS[key] = SVMClassifier("affinity", ["frequent"], reg=REG, name="affinity_groups").fit(_groups(c))
        else:
            build = cases.split(c, cases.SPLIT_BUILD)
            _FITS[key] = SVMClassifier("affinity", NUMERIC, CATEGORICAL, kernel=kind, name=f"affinity_{kind}").fit(build)
    return _FITS[key]


def _groups(c):
    return c.select("cust_id", "affinity", (F.col("n_orders") >= 10).cast("double").alias("frequent"))


def q_svm_group_coefficients(spark, sf_dir):
    """Coefficient view of a linear SVM on one 0/1 attribute; the bias row has no attribute."""
    return _fit(spark, sf_dir, "groups").view("C").select(
        "target_value", "attribute_name", "attribute_value", rnd("coefficient").alias("coefficient"))


def q_svm_group_probabilities(spark, sf_dir):
    """Every customer's prediction and calibrated probability under that model."""
    scored = _fit(spark, sf_dir, "groups").score(_groups(cases.case_table(spark, sf_dir)))
    return scored.select("cust_id", "prediction", rnd("probability", 5).alias("probability"))


def q_svm_coefficients(spark, sf_dir):
    """Coefficient view of a linear SVM on numerics and levels."""
    return _fit(spark, sf_dir, "linear").view("C")


def q_svm_gaussian_confusion(spark, sf_dir):
    """Confusion totals of the Gaussian-kernel SVM on the test split."""
    test = cases.split(cases.case_table(spark, sf_dir), cases.SPLIT_TEST)
    scored = _fit(spark, sf_dir, "gaussian").score(test)
    return scored.groupBy("affinity", "prediction").agg(F.count("*").alias("n"), F.avg("probability").alias("mean_probability"))


QUERIES = {
    "svm_group_coefficients": q_svm_group_coefficients,
    "svm_group_probabilities": q_svm_group_probabilities,
    "svm_coefficients": q_svm_coefficients,
    "svm_gaussian_confusion": q_svm_gaussian_confusion,
}
