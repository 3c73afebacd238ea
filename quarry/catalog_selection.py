"""Queries of GLM feature selection, full statistics and row diagnostics."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.catalog import R, rnd
from quarry.operators.linear import GLM
from quarry.operators.selection import (GLOBAL_SCHEMA, SelectedGLM, classification_rows, global_statistics,
                                        regression_rows)
from quarry.session import session_key
from quarry.sources import cases

TARGET = "sum_qty"
NUMERIC = ["n_orders", "acctbal", "avg_price"]
FORCED = "acctbal"

_FITS: dict = {}


def _fit(spark, sf_dir, criterion):
    key = (session_key(spark), sf_dir, criterion)
    if key not in _FITS:
        _FITS[key] = SelectedGLM(TARGET, NUMERIC, quadratic=True, force_in=[FORCED], criterion=criterion,
                                 prune_level=None, name=f"quantity_{criterion}").fit(cases.case_table(spark, sf_dir))
    return _FITS[key]


def _steps(model):
    return model.view("S").select("step", "feature_expression", "action", rnd("sse_before", 2).alias("sse_before"),
                                  rnd("sse_after", 2).alias("sse_after"))


def q_glm_selection_alpha(spark, sf_dir):
    """Alpha investing over numerics, squares and products, one forced in: every step's sums of squares."""
    return _steps(_fit(spark, sf_dir, "alpha"))


def q_glm_selection_sbic(spark, sf_dir):
    """The same stream under the Bayesian criterion."""
    return _steps(_fit(spark, sf_dir, "sbic"))


def q_glm_selected_coefficients(spark, sf_dir):
    """Coefficients of the model with segment and region levels as candidates, pruned, with their limits."""
    m = SelectedGLM(TARGET, NUMERIC + ["last_gap_days"], ["segment", "region"], quadratic=True, force_in=[FORCED],
                    name="quantity_selected").fit(cases.case_table(spark, sf_dir))
    return m.view("D")


def _line(spark, sf_dir):
    c = cases.case_table(spark, sf_dir)
    return GLM(target=TARGET, numeric=["n_orders"], name="quantity_line").fit(c), c


def q_glm_global_statistics(spark, sf_dir):
    """All 24 global statistics of the line of the quantity on the number of orders."""
    m, c = _line(spark, sf_dir)
    r = c.filter(f"{TARGET} IS NOT NULL").agg(F.avg(TARGET).alias("mean"), F.var_pop(TARGET).alias("v")).first()
    n = m.stats["num_rows"]
    rows = global_statistics(n, m.stats["num_params"], float(m.stats["sse"]), float(r["v"] * n), float(r["mean"]))
    return spark.createDataFrame(rows, GLOBAL_SCHEMA).select("name", rnd("numeric_value", 4).alias("numeric_value"),
                                                             "string_value")


def q_glm_regression_rows(spark, sf_dir):
    """Row diagnostics of that line for every customer."""
    m, c = _line(spark, sf_dir)
    rows = regression_rows(m, c, "cust_id")
    return rows.select("case_id", *[rnd(x, 5).alias(x) for x in rows.columns[1:]])


def q_glm_classification_rows(spark, sf_dir):
    """Row diagnostics of the logistic model of affinity on one 0/1 attribute."""
    c = cases.case_table(spark, sf_dir).select("cust_id", "affinity",
                                               (F.col("n_orders") >= 10).cast("double").alias("frequent"))
    m = GLM(target="affinity", numeric=["frequent"], family="binomial", name="affinity_groups").fit(c)
    rows = classification_rows(m, c, "cust_id")
    return rows.select("case_id", *[rnd(x, 5).alias(x) for x in rows.columns[1:]])


QUERIES = {
    "glm_selection_alpha": q_glm_selection_alpha,
    "glm_selection_sbic": q_glm_selection_sbic,
    "glm_selected_coefficients": q_glm_selected_coefficients,
    "glm_global_statistics": q_glm_global_statistics,
    "glm_regression_rows": q_glm_regression_rows,
    "glm_classification_rows": q_glm_classification_rows,
}
