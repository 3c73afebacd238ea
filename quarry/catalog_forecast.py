"""Queries of forecast regression and of dense text vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.catalog import rnd
from quarry.catalog_text import esa_model
from quarry.operators.dense_text import dense_places
from quarry.operators.forecast_regression import compare_forecasts, error_summary, forecast_features
from quarry.operators.timeseries import accumulate
from quarry.sources.tables import load

SERIES = ["click", "purchase", "view"]
TARGET = "purchase"
ORIGINS = ["2024-01-20 23:00:00", "2024-01-22 23:00:00", "2024-01-24 23:00:00"]


def _features(spark, sf_dir):
    hourly = accumulate(load(spark, sf_dir, "events"), "ts", "value", "hour", series_cols=["event_type"])
    names = sorted(r.event_type for r in hourly.select("event_type").distinct().limit(50).collect())
    wanted = [n for n in SERIES if n in names] or names
    target = TARGET if TARGET in wanted else wanted[0]
    series = hourly.withColumnRenamed("event_type", "series")
    return forecast_features(series, wanted, ORIGINS, 24, "hour", "winters_add", 24), target, wanted


def q_forecast_regression(spark, sf_dir):
    """Hourly purchases after three origins: actual, forecast by regression on all forecasts, and baseline."""
    return compare_forecasts(*_features(spark, sf_dir))


def q_forecast_errors(spark, sf_dir):
    """Errors of the regression and of the baseline over all origins; one row a model."""
    return error_summary(compare_forecasts(*_features(spark, sf_dir)))


def q_esa_dense_places(spark, sf_dir):
    """Dense concept vectors, 1,024 wide, of every document: the places that hold a value."""
    v = esa_model(spark, sf_dir).vectors(load(spark, sf_dir, "documents"), "doc_id", "text")
    return dense_places(v).select(F.col("id").alias("doc_id"), "place", rnd("value").alias("value"))


QUERIES = {
    "forecast_regression": q_forecast_regression,
    "forecast_errors": q_forecast_errors,
    "esa_dense_places": q_esa_dense_places,
}
