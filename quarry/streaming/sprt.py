"""Sequential probability ratio test on a stream: one keyed state per series.

Rows must reach the test in time order.  :func:`windowed_accumulate` in append mode gives exactly that:
an interval leaves the aggregate once, when the watermark has passed its end, and every interval that
leaves later ends later.  Spark takes no second keyed operator behind an aggregate in append mode, so
the closed intervals are written to a table in the shared folder (:func:`closed_intervals`) and a second
query reads that table as a stream: the file sink commits batch by batch, so what the second query
finds is always a prefix in time.  The state of a series is only the running evidence of each residual
and the alarms of the last intervals; nothing is buffered, whatever the number of events of a
series, and a hot series is added up map-side before its few intervals meet in one task.

Late rows: an event whose interval has already left is dropped by the aggregate and changes nothing.
Intervals that the watermark has not passed wait in the aggregate for a later run.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quarry.streaming.stream import run_to_path

STATE = "high array<double>, low array<double>, recent array<int>"


def limits(alpha: float, beta: float) -> tuple[float, float]:
    """Evidence that raises an alarm and evidence that clears one, for error rates ``alpha`` and ``beta``."""
    if not (0 < alpha < 1 and 0 < beta < 1 and alpha + beta < 1):
        raise ValueError("alpha and beta must be above 0 with a sum below 1")
    return math.log((1 - beta) / alpha), math.log(beta / (1 - alpha))


def run_test(residuals: np.ndarray, high: np.ndarray, low: np.ndarray, shift: float, alarm: float, clear: float):
    """Alarm (0 or 1) of every row of standardized ``residuals`` (rows x attributes), and the evidence left.

    ``high`` and ``low`` hold, by attribute, the log likelihood ratio of a mean shifted up or down by
    ``shift``.  Evidence at a limit starts again at 0.  A missing residual adds no evidence.
    """
    flags = np.zeros(len(residuals), np.int32)
    high, low = high.copy(), low.copy()
    for i, r in enumerate(residuals):
        known = ~np.isnan(r)
        high[known] += shift * r[known] - shift * shift / 2
        low[known] += -shift * r[known] - shift * shift / 2
        flags[i] = bool((high >= alarm).any() or (low >= alarm).any())
        high[(high >= alarm) | (high <= clear)] = 0.0
        low[(low >= alarm) | (low <= clear)] = 0.0
    return flags, high, low


def residuals(df: DataFrame, baseline: DataFrame, series_cols: list[str], cols: list[str]) -> DataFrame:
    """``df`` with every column of ``cols`` as its distance from the series' mean in standard deviations.

    ``baseline`` holds one row a series: the series columns, ``<col>_mean`` and ``<col>_sd``.  Without
    a baseline, or with a deviation of 0, the residual is NULL.
    """
    joined = df.join(baseline, series_cols, "left")
    return joined.select(*[c for c in df.columns if c not in cols], *[
        F.when(F.col(f"{c}_sd") > 0, (F.col(c) - F.col(f"{c}_mean")) / F.col(f"{c}_sd")).cast("double").alias(c)
        for c in cols])


def baseline(df: DataFrame, series_cols: list[str], cols: list[str]) -> DataFrame:
    """Mean and population deviation of ``cols`` by series, for :func:`residuals`."""
    return df.groupBy(*series_cols).agg(*[F.avg(c).alias(f"{c}_mean") for c in cols],
                                        *[F.stddev_pop(c).alias(f"{c}_sd") for c in cols])


def closed_intervals(hours: DataFrame, root: str | None = None) -> DataFrame:
    """A stream of the intervals of ``hours`` that the watermark has passed, in time order by batch.

    ``hours`` comes from :func:`windowed_accumulate`.  With ``root``, a folder named again by a later
    run, the aggregate goes on from its checkpoint there and adds the intervals closed since.
    """
    path = run_to_path(hours, "intervals", root)
    return hours.sparkSession.readStream.schema(hours.schema).parquet(path)


def _schema(df: DataFrame, series_cols: list[str], time_col: str) -> T.StructType:
    return T.StructType([df.schema[c] for c in [*series_cols, time_col]] + [
        T.StructField("alarm", T.IntegerType()), T.StructField("alerts", T.IntegerType()),
        T.StructField("prediction", T.IntegerType())])


def _rows(pdf: pd.DataFrame, p: dict, high, low, recent) -> tuple:
    """Output rows of one series' next intervals, and its state behind them."""
    pdf = pdf.sort_values(p["time"])
    flags, high, low = run_test(pdf[p["cols"]].to_numpy(float), high, low, p["shift"], p["alarm"], p["clear"])
    before = np.concatenate((np.zeros(p["window"] - len(recent), np.int32), np.asarray(recent, np.int32), flags))
    alerts = np.convolve(before, np.ones(p["window"] + 1, np.int64))[p["window"]:p["window"] + len(flags)]
    out = pdf[[*p["series"], p["time"]]].assign(alarm=flags, alerts=alerts.astype(np.int32),
                                                prediction=(alerts < p["count"]).astype(np.int32))
    return out, high, low, before[len(before) - p["window"]:]


def _params(series_cols, time_col, cols, alpha, beta, shift, alert_count, alert_window) -> dict:
    if not 1 <= alert_count <= alert_window:
        raise ValueError("alert_count must be in 1..alert_window")
    alarm, clear = limits(alpha, beta)
    return {"series": list(series_cols), "time": time_col, "cols": list(cols), "shift": float(shift), "alarm": alarm,
            "clear": clear, "count": alert_count, "window": alert_window - 1}


def sprt_alerts(stream: DataFrame, series_cols: list[str], time_col: str, cols: list[str], alpha: float = 0.1,
                beta: float = 0.1, shift: float = 3.0, alert_count: int = 3, alert_window: int = 5) -> DataFrame:
    """Alerts on a stream of standardized residuals whose rows come in time order by series.

    Returns the series columns, ``time_col``, alarm (1: some residual's evidence reached the limit),
    alerts (alarms among the last ``alert_window`` intervals) and prediction (0, an anomaly, from
    ``alert_count`` alerts on).  The state lives in the query's keyed state store, so a restarted query
    goes on where it stopped.  NULL residuals add no evidence; a NULL series is a series of its own.
    """
    p = _params(series_cols, time_col, cols, alpha, beta, shift, alert_count, alert_window)

    def alerts(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.exists:
            high, low, recent = state.get
        else:
            high, low, recent = [0.0] * len(p["cols"]), [0.0] * len(p["cols"]), []
        out, high, low, recent = _rows(pd.concat(list(frames)), p, np.array(high, float), np.array(low, float), recent)
        state.update((high.tolist(), low.tolist(), [int(x) for x in recent]))
        yield out

    return stream.groupBy(*series_cols).applyInPandasWithState(
        alerts, _schema(stream, series_cols, time_col), STATE, "append", GroupStateTimeout.NoTimeout)


def sprt_alerts_batch(df: DataFrame, series_cols: list[str], time_col: str, cols: list[str], alpha: float = 0.1,
                      beta: float = 0.1, shift: float = 3.0, alert_count: int = 3, alert_window: int = 5) -> DataFrame:
    """The same alerts on a finished table of intervals; alerts are counted by a window."""
    p = _params(series_cols, time_col, cols, alpha, beta, shift, alert_count, alert_window)
    zero = np.zeros(len(p["cols"]))
    flags = df.groupBy(*series_cols).applyInPandas(lambda pdf: _rows(pdf, p, zero, zero, [])[0],
                                                   _schema(df, series_cols, time_col)).drop("alerts", "prediction")
    recent = Window.partitionBy(*series_cols).orderBy(time_col).rowsBetween(-(alert_window - 1), 0)
    return flags.withColumn("alerts", F.sum("alarm").over(recent).cast("int")).withColumn(
        "prediction", F.when(F.col("alerts") >= alert_count, 0).otherwise(1))
