"""Time series: accumulation, exponential smoothing, model search, MSET-SPRT.

Raw events are first *accumulated* in Spark (``date_trunc`` + ``groupBy``
sum, calendar gaps filled from a per-series ``sequence`` - its length is
the number of intervals, not the number of rows).  Only the accumulated
series - one row per interval - reach the per-series model fits, which run
in parallel with ``groupBy(series).applyInPandas``; a group's size is
bounded by the series length, never by the raw data volume.

Smoothing forms (additive error): simple, Holt (additive trend), damped
trend, additive and multiplicative Holt-Winters, damped Winters.  The
parameters minimise the one-step squared error by a bounded Nelder-Mead
in numpy [design]; initial states come from the first seasons.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

INTERVAL_UNITS = {"day": ("day", "1 day"), "week": ("week", "1 week"), "month": ("month", "1 month"),
                  "quarter": ("quarter", "3 months"), "year": ("year", "1 year"), "hour": ("hour", "1 hour")}


def accumulate(df: DataFrame, ts_col: str, value_col: str, interval: str = "day",
               series_cols: list[str] | None = None, how: str = "sum", fill: float | None = 0.0) -> DataFrame:
    """EXSM_ACCUMULATE: (series..., period, value) with every interval present.

    Periods without events get ``fill`` (0 for totals; None keeps NULL as a
    missing value for the model to handle).
    """
    series_cols = list(series_cols or [])
    unit, step = INTERVAL_UNITS[interval]
    period = F.date_trunc(unit, F.col(ts_col).cast("timestamp"))
    agg = {"sum": F.sum, "avg": F.avg, "max": F.max, "min": F.min, "count": F.count}[how]
    acc = df.groupBy(*series_cols, period.alias("period")).agg(agg(F.col(value_col)).alias("value"))
    bounds = acc.groupBy(*series_cols).agg(F.min("period").alias("lo"), F.max("period").alias("hi"))
    cal = bounds.select(*series_cols, F.explode(F.sequence("lo", "hi", F.expr(f"INTERVAL {step}"))).alias("period"))
    out = cal.join(acc, series_cols + ["period"], "left")
    if fill is not None:
        out = out.withColumn("value", F.coalesce(F.col("value"), F.lit(float(fill))))
    return out


# ---------------------------------------------------------------- smoothing core (numpy)
FORMS = ("simple", "holt", "holt_damped", "winters_add", "winters_mul", "winters_damped")


def _init(y: np.ndarray, m: int, form: str):
    known = y[~np.isnan(y)]
    level = known[0] if len(known) else 0.0
    trend = 0.0
    season = np.zeros(m) if form != "winters_mul" else np.ones(m)
    if form.startswith("winters") and len(y) >= 2 * m:
        # missing values of the first seasons take no part; a place without any value is neutral
        first, second = y[:m], y[m:2 * m]
        if np.isnan(first).all() or np.isnan(second).all():
            return level, trend, season
        s1, s2 = np.nanmean(first), np.nanmean(second)
        level = s1
        trend = (s2 - s1) / m
        if form == "winters_mul":
            season = np.where(np.isnan(first), 1.0, first / s1) if s1 != 0 else np.ones(m)
        else:
            season = np.where(np.isnan(first), 0.0, first - s1)
    elif form in ("holt", "holt_damped") and len(known) >= 2:
        trend = known[1] - known[0]
    return level, trend, season


def _run(y: np.ndarray, params, m: int, form: str, h: int = 0):
    """One pass: fitted one-step values, final state and h-step forecasts."""
    a, b, g, phi = params
    level, trend, season = _init(y, m, form)
    season = season.copy()
    fitted = np.empty(len(y))
    damped = form in ("holt_damped", "winters_damped")
    has_trend = form != "simple"
    seasonal = form.startswith("winters")
    mul = form == "winters_mul"
    ph = phi if damped else 1.0
    for t, yt in enumerate(y):
        s = season[t % m] if seasonal else (1.0 if mul else 0.0)
        base = level + (ph * trend if has_trend else 0.0)
        yhat = base * s if mul else base + (s if seasonal else 0.0)
        fitted[t] = yhat
        if np.isnan(yt):  # missing: carry the forecast
            yt = yhat
        if mul:
            new_level = a * (yt / s if s != 0 else yt) + (1 - a) * base
        else:
            new_level = a * (yt - (s if seasonal else 0.0)) + (1 - a) * base
        if has_trend:
            trend = b * (new_level - level) + (1 - b) * ph * trend
        if seasonal:
            if mul:
                season[t % m] = g * (yt / new_level if new_level != 0 else 1.0) + (1 - g) * s
            else:
                season[t % m] = g * (yt - new_level) + (1 - g) * s
        level = new_level
    fc = []
    for k in range(1, h + 1):
        tr = sum(ph ** i for i in range(1, k + 1)) * trend if has_trend else 0.0
        s = season[(len(y) + k - 1) % m] if seasonal else (1.0 if mul else 0.0)
        base = level + tr
        fc.append(base * s if mul else base + (s if seasonal else 0.0))
    return fitted, np.array(fc)


def _nelder_mead(f, x0, lo, hi, iters: int = 200):
    n = len(x0)
    clip = lambda x: np.minimum(np.maximum(x, lo), hi)
    simplex = [clip(np.array(x0, float))]
    for i in range(n):
        x = np.array(x0, float)
        x[i] = x[i] + 0.1 if x[i] + 0.1 <= hi[i] else x[i] - 0.1
        simplex.append(clip(x))
    vals = [f(x) for x in simplex]
    for _ in range(iters):
        order = np.argsort(vals)
        simplex = [simplex[i] for i in order]
        vals = [vals[i] for i in order]
        if abs(vals[-1] - vals[0]) < 1e-10 * (abs(vals[0]) + 1e-12):
            break
        c = np.mean(simplex[:-1], axis=0)
        xr = clip(c + (c - simplex[-1]))
        fr = f(xr)
        if fr < vals[0]:
            xe = clip(c + 2 * (c - simplex[-1]))
            fe = f(xe)
            simplex[-1], vals[-1] = (xe, fe) if fe < fr else (xr, fr)
        elif fr < vals[-2]:
            simplex[-1], vals[-1] = xr, fr
        else:
            xc = clip(c + 0.5 * (simplex[-1] - c))
            fc = f(xc)
            if fc < vals[-1]:
                simplex[-1], vals[-1] = xc, fc
            else:
                simplex = [simplex[0]] + [clip(simplex[0] + 0.5 * (x - simplex[0])) for x in simplex[1:]]
                vals = [vals[0]] + [f(x) for x in simplex[1:]]
    i = int(np.argmin(vals))
    return simplex[i], vals[i]


def fit_series(y: np.ndarray, form: str, m: int = 1, h: int = 1, conf: float = 0.95) -> dict:
    """Fit one smoothing form; returns parameters, statistics and forecasts."""
    y = np.asarray(y, float)
    n_params = {"simple": 1, "holt": 2, "holt_damped": 3, "winters_add": 3, "winters_mul": 3,
                "winters_damped": 4}[form]

    # only the parameters that the form has are searched
    used = [0] + ([1] if form != "simple" else []) + ([2] if form.startswith("winters") else []) + (
        [3] if "damped" in form else [])
    start = np.array([0.3, 0.1, 0.1, 0.95])

    def full(p):
        out = start.copy()
        out[used] = p
        return out

    def sse(p):
        e = y - _run(y, full(p), m, form)[0]
        e = e[~np.isnan(e)]
        return float((e * e).sum())
    lo = np.array([1e-4, 1e-4, 1e-4, 0.8])[used]
    hi = np.array([0.9999, 0.9999, 0.9999, 0.98])[used]
    best, val = _nelder_mead(sse, start[used], lo, hi)
    best = full(best)
    fitted, fc = _run(y, tuple(best), m, form, h)
    e = y - fitted
    e = e[~np.isnan(e)]
    n = len(e)
    mse = float((e * e).mean()) if n else float("nan")
    sigma = math.sqrt(mse) if mse == mse else float("nan")
    k = n_params + 1 + (1 if form != "simple" else 0) + (m if form.startswith("winters") else 0)
    # an exact fit has no finite likelihood; the error is floored relative to the series' size
    floor = 1e-12 * max(float(np.nanmean(y * y)), 1e-12) if n else 1.0
    ll = -0.5 * n * (math.log(2 * math.pi * max(mse, floor)) + 1) if n else float("nan")
    aic = -2 * ll + 2 * k
    aicc = aic + (2 * k * (k + 1)) / (n - k - 1) if n - k - 1 > 0 else float("nan")
    bic = -2 * ll + k * math.log(n) if n > 0 else float("nan")
    z = 1.959963984540054 if abs(conf - 0.95) < 1e-9 else _z(conf)
    # the j-step forecast's response to a unit error of the last value gives the form's own variance
    last = y.copy()
    if n:
        last[-1] = fitted[-1]
        moved = last.copy()
        moved[-1] += max(1.0, sigma)
        response = (_run(moved, tuple(best), m, form, h)[1] - _run(last, tuple(best), m, form, h)[1]) / max(1.0, sigma)
    else:
        response = np.zeros(h)
    bounds = [sigma * math.sqrt(1 + float((response[:i - 1] ** 2).sum())) * z for i in range(1, h + 1)]
    return {"form": form, "alpha": best[0], "beta": best[1] if form != "simple" else None,
            "gamma": best[2] if form.startswith("winters") else None,
            "phi": best[3] if "damped" in form else None, "mse": mse, "mae": float(np.abs(e).mean()) if n else None,
            "sigma": sigma, "neg2ll": -2 * ll, "aic": aic, "aicc": aicc, "bic": bic, "num_rows": n,
            "fitted": fitted, "forecast": fc, "bound": bounds}


def _no_fit(y: np.ndarray, form: str, h: int) -> dict:
    """For a series without any value: NULL forecasts and only the row count."""
    none = dict.fromkeys(("alpha", "beta", "gamma", "phi", "mse", "mae", "sigma", "neg2ll", "aicc", "bic"))
    return {"form": form, **none, "aic": float("inf"), "num_rows": 0, "fitted": np.full(len(y), np.nan),
            "forecast": np.full(h, np.nan), "bound": [float("nan")] * h}


def _z(conf: float) -> float:
    from statistics import NormalDist
    return NormalDist().inv_cdf(0.5 + conf / 2)


FORECAST_SCHEMA = ("series string, step int, kind string, value double, prediction double, "
                   "lower double, upper double")
STATS_SCHEMA = ("series string, form string, name string, numeric_value double")


def smooth(series: DataFrame, series_col: str, order_col: str, value_col: str, form: str = "auto",
           season: int = 1, horizon: int = 1, conf: float = 0.95, backcast: bool = True):
    """Fit per series in parallel; returns (forecasts/backcasts, statistics).

    ``form='auto'`` is the model search: every admissible form is fitted and
    the one of lowest AIC kept.  A series without any value gets NULL forecasts.
    """
    forms = [f for f in FORMS if season > 1 or not f.startswith("winters")] if form == "auto" else [form]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order_col)
        y = pdf[value_col].astype(float).to_numpy()
        key = str(pdf[series_col].iloc[0])
        fits = []
        for fm in forms:
            try:
                fits.append(fit_series(y, fm, season, horizon, conf))
            except (FloatingPointError, ValueError, ZeroDivisionError):
                continue
        fits = [f for f in fits if f["aic"] == f["aic"]] or [_no_fit(y, forms[0], horizon)]
        best = min(fits, key=lambda f: f["aic"])
        rows = []
        if backcast:
            for i, (v, p) in enumerate(zip(y, best["fitted"])):
                rows.append((key, i + 1 - len(y), "backcast", float(v), float(p), None, None))
        for i, (p, bd) in enumerate(zip(best["forecast"], best["bound"])):
            rows.append((key, i + 1, "forecast", None, float(p), float(p - bd), float(p + bd)))
        stats = [(key, best["form"], k, float(best[k])) for k in
                 ("alpha", "beta", "gamma", "phi", "mse", "mae", "sigma", "neg2ll", "aic", "aicc", "bic", "num_rows")
                 if best[k] is not None]
        cols = ["series", "step", "kind", "value", "prediction", "lower", "upper", "form", "name",
                "numeric_value"]
        recs = [r + (best["form"], None, None) for r in rows]
        recs += [(k_, None, "stat", None, None, None, None, fm, nm, v) for k_, fm, nm, v in stats]
        return pd.DataFrame.from_records(recs, columns=cols)

    schema = FORECAST_SCHEMA + ", form string, name string, numeric_value double"
    both = series.select(F.col(series_col).cast("string").alias(series_col), order_col, value_col) \
        .groupBy(series_col).applyInPandas(run, schema)
    return both


def simple_smoothing_fixed(series: DataFrame, series_col: str, order_col: str, value_col: str,
                           alpha: float) -> DataFrame:
    """Simple exponential smoothing with a fixed alpha: s_1 = y_1, s_t = a y_t + (1 - a) s_{t-1}."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order_col)
        out, s = [], None
        for v in pdf[value_col].astype(float):
            s = v if s is None else alpha * v + (1 - alpha) * s
            out.append(s)
        return pd.DataFrame({series_col: pdf[series_col].to_numpy(), order_col: pdf[order_col].to_numpy(),
                             "smoothed": out})
    schema = series.select(series_col, order_col).schema.simpleString()[7:-1] + ", smoothed double"
    return series.select(series_col, order_col, value_col).groupBy(series_col).applyInPandas(run, schema)


# ---------------------------------------------------------------- MSET-SPRT
def mset_sprt(train: DataFrame, test: DataFrame, series_col: str, order_col: str, cols: list[str],
              memory_vectors: int = 100, alpha: float = 0.1, beta: float = 0.1, std_tol: float = 3.0,
              alert_count: int = 3, alert_window: int = 5) -> DataFrame:
    """Multivariate state estimation + sequential probability ratio test, per series.

    [design] Memory matrix D: the rows holding each variable's min and max,
    then rows evenly spaced by norm order, up to ``memory_vectors``.
    Estimate x_hat = D w with w from a Gaussian-kernel similarity
    (Nadaraya-Watson form).  Residuals are standardized by the training
    residual std; a two-sided SPRT for a mean shift of ``std_tol`` sigmas
    runs in time order; its alarm flags feed the alert window: a row is an
    anomaly (prediction 0) when at least ``alert_count`` of the last
    ``alert_window`` rows alarmed.  Per series, the model and the test rows
    are bounded by the accumulated series length.
    """
    tr = train.select(F.col(series_col).cast("string").alias("__s"), order_col, *cols).withColumn("__train", F.lit(1))
    te = test.select(F.col(series_col).cast("string").alias("__s"), order_col, *cols).withColumn("__train", F.lit(0))
    both = tr.unionByName(te)
    params = dict(mv=memory_vectors, alpha=alpha, beta=beta, tol=std_tol, cols=cols, order=order_col)
    schema = f"__s string, {order_col} {test.schema[order_col].dataType.simpleString()}, alarm int, residual_norm double"
    flags = both.groupBy("__s").applyInPandas(lambda pdf: _mset_group(pdf, params), schema)
    w = Window.partitionBy("__s").orderBy(order_col).rowsBetween(-(alert_window - 1), 0)
    return flags.withColumn("alerts", F.sum("alarm").over(w)).select(
        F.col("__s").alias(series_col), order_col, "alarm", "residual_norm",
        F.when(F.col("alerts") >= alert_count, 0).otherwise(1).alias("prediction"))


def _mset_group(pdf: pd.DataFrame, p: dict) -> pd.DataFrame:
    cols, order = p["cols"], p["order"]
    pdf = pdf.sort_values(order)
    tr = pdf[pdf["__train"] == 1][cols].to_numpy(float)
    te_df = pdf[pdf["__train"] == 0]
    te = te_df[cols].to_numpy(float)
    if len(tr) == 0 or len(te) == 0:
        return pd.DataFrame({"__s": [], order: [], "alarm": [], "residual_norm": []})
    mu, sd = tr.mean(0), tr.std(0)
    sd[sd == 0] = 1.0
    Z, T = (tr - mu) / sd, (te - mu) / sd
    idx = set()
    for j in range(Z.shape[1]):
        idx.add(int(np.argmin(Z[:, j])))
        idx.add(int(np.argmax(Z[:, j])))
    order_norm = np.argsort(np.linalg.norm(Z, axis=1))
    k = max(p["mv"] - len(idx), 0)
    if k > 0:
        for i in np.linspace(0, len(order_norm) - 1, num=min(k, len(order_norm))).astype(int):
            idx.add(int(order_norm[i]))
    D = Z[sorted(idx)]
    # kernel width: the median distance between different memory vectors, whatever the series' length
    apart = np.linalg.norm(D[:, None, :] - D[None, :, :], axis=2)
    apart = apart[apart > 0]
    bw = float(np.median(apart)) if len(apart) else 1.0

    def est(X):
        out = np.empty_like(X)
        for lo in range(0, len(X), 4096):
            d2 = ((X[lo:lo + 4096, None, :] - D[None, :, :]) ** 2).sum(2)
            w = np.exp(-(d2 - d2.min(1, keepdims=True)) / (2 * bw * bw))
            out[lo:lo + 4096] = (w / w.sum(1, keepdims=True)) @ D
        return out
    r_tr = Z - est(Z)
    rs = r_tr.std(0)
    rs[rs == 0] = 1.0
    R = (T - est(T)) / rs
    A, B = math.log((1 - p["beta"]) / p["alpha"]), math.log(p["beta"] / (1 - p["alpha"]))
    M = p["tol"]
    llr_pos = np.zeros(R.shape[1])
    llr_neg = np.zeros(R.shape[1])
    alarms = []
    for r in R:
        llr_pos += M * r - M * M / 2
        llr_neg += -M * r - M * M / 2
        fire = bool((llr_pos >= A).any() or (llr_neg >= A).any())
        alarms.append(1 if fire else 0)
        llr_pos[(llr_pos >= A) | (llr_pos <= B)] = 0.0
        llr_neg[(llr_neg >= A) | (llr_neg <= B)] = 0.0
    return pd.DataFrame({"__s": te_df["__s"].to_numpy(), order: te_df[order].to_numpy(),
                         "alarm": alarms, "residual_norm": np.linalg.norm(R, axis=1)})
