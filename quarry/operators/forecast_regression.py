"""Forecasts as features of a regression, compared with the plain forecast over rolling origins.

Each origin cuts every series.  All (origin, series) pairs are smoothed in parallel, one group per
pair of accumulated rows; their one-step backcasts before the cut and forecasts after it become aligned
columns by time (a pivot over the listed series).  A regression of the target on these columns, fitted
on the backcast rows of its own origin, predicts the forecast rows; all origins' regressions are one
keyed pass.  Errors are those of the rows after the cuts that have an actual value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.partitioned import regression_over
from quarry.operators.timeseries import INTERVAL_UNITS, smooth

_KEY = "\u0001"


def forecast_features(series: DataFrame, names: list[str], origins: list, horizon: int, interval: str = "hour",
                      form: str = "auto", season: int = 1) -> DataFrame:
    """(origin, period, prod, value and forecast of every named series) from ``series(series, period, value)``.

    ``prod`` is 0 up to the origin (backcasts) and 1 after it (forecasts of ``horizon`` periods).  The
    columns are ``y_<name>`` - NULL where no value is known - and ``f_<name>``.  A series without rows
    before an origin has NULL forecasts there.
    """
    _, step = INTERVAL_UNITS[interval]
    times = F.array(*[F.to_timestamp(F.lit(str(o))) for o in origins])
    named = series.filter(F.col("series").isin(list(names))).select(
        F.col("series").cast("string").alias("series"), F.col("period").cast("timestamp").alias("period"),
        F.col("value").cast("double").alias("value"))
    cut = named.select("*", F.explode(times).alias("origin")).filter(F.col("period") <= F.col("origin"))
    pair = F.concat(F.date_format("origin", "yyyy-MM-dd HH:mm:ss"), F.lit(_KEY), F.col("series"))
    fitted = smooth(cut.withColumn("pair", pair), "pair", "period", "value", form=form, season=season, horizon=horizon)
    parts = F.split("series", _KEY)
    steps = fitted.filter("kind <> 'stat'").select(
        F.to_timestamp(parts[0]).alias("origin"), parts[1].alias("series"), "step", "prediction")
    last = cut.groupBy("origin", "series").agg(F.max("period").alias("last"))
    placed = steps.join(last, ["origin", "series"]).select(
        "origin", "series", (F.col("last") + F.expr(f"step * INTERVAL {step}")).alias("period"), "prediction")
    forecasts = placed.groupBy("origin", "period").pivot("series", list(names)).agg(F.first("prediction"))
    forecasts = forecasts.select("origin", "period", *[F.nanvl(F.col(f"`{n}`"), F.lit(None).cast("double")).alias(f"f_{n}") for n in names])
    actual = named.groupBy("period").pivot("series", list(names)).agg(F.first("value"))
    actual = actual.select("period", *[F.col(f"`{n}`").alias(f"y_{n}") for n in names])
    return forecasts.join(actual, "period", "left").withColumn("prod", (F.col("period") > F.col("origin")).cast("int"))


def compare_forecasts(features: DataFrame, target: str, names: list[str]) -> DataFrame:
    """Every forecast row with the target's actual value, the regression's forecast and the baseline's, and their errors."""
    fitted_on = F.when(F.col("prod") == 0, F.col(f"y_{target}"))
    scored = regression_over(features.withColumn("fitted_on", fitted_on), "origin", "fitted_on", [f"f_{n}" for n in names],
                             "regression_forecast")
    actual, baseline = F.col(f"y_{target}"), F.col(f"f_{target}")
    return scored.filter("prod = 1").select(
        "origin", "period", actual.alias("actual"), "regression_forecast", baseline.alias("baseline_forecast"),
        (actual - F.col("regression_forecast")).alias("regression_error"), (actual - baseline).alias("baseline_error"))


def error_summary(compared: DataFrame) -> DataFrame:
    """model, n, rmse, mae, mape (0 actuals left out) over all rows that have an actual and a forecast; one row a model."""
    def row(model: str, error: Column) -> Column:
        return F.struct(F.lit(model).alias("model"), error.alias("error"), F.col("actual"))

    long = compared.select(F.inline(F.array(row("regression", F.col("regression_error")), row("baseline", F.col("baseline_error")))))
    e = F.col("error")
    return long.groupBy("model").agg(
        F.count(e).alias("n"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
        F.avg(F.when(F.col("actual") != 0, F.abs(e / F.col("actual")))).alias("mape"))
