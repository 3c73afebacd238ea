"""Sequential tests on a stream against the batch run and a plain loop."""

import datetime as dt
import math
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir
from quarry.streaming import sprt
from quarry.streaming.stream import run_to_path, windowed_accumulate

SCHEMA = "series string, ts timestamp, value double"
START = dt.datetime(2024, 1, 1)


def _folder(spark, tag):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/test-{tag}-{uuid.uuid4().hex}"


def _plain(rows, shift, alpha, beta):
    """Alarms of a list of residual lists, one value at a time."""
    a, b = math.log((1 - beta) / alpha), math.log(beta / (1 - alpha))
    evidence, out = {}, []
    for r in rows:
        hit = 0
        for j, x in enumerate(r):
            for sign in (1, -1):
                e = evidence.get((j, sign), 0.0)
                if x is not None:
                    e += sign * shift * x - shift * shift / 2
                hit |= e >= a
                evidence[j, sign] = 0.0 if e >= a or e <= b else e
        out.append(int(hit))
    return out


def test_alarms_equal_a_plain_loop():
    rng = np.random.default_rng(3)
    x = rng.normal(0.4, 1.0, (400, 3))
    x[rng.random((400, 3)) < 0.1] = np.nan
    a, b = sprt.limits(0.1, 0.05)
    flags, high, low = sprt.run_test(x, np.zeros(3), np.zeros(3), 1.0, a, b)
    want = _plain([[None if v != v else v for v in r] for r in x], 1.0, 0.1, 0.05)
    assert flags.tolist() == want and 0 < sum(want) < 400
    # cut anywhere, the evidence carried over gives the same alarms
    f1, h1, l1 = sprt.run_test(x[:123], np.zeros(3), np.zeros(3), 1.0, a, b)
    f2, h2, l2 = sprt.run_test(x[123:], h1, l1, 1.0, a, b)
    assert f1.tolist() + f2.tolist() == want and np.array_equal(h2, high) and np.array_equal(l2, low)


def test_limits_and_counts_are_checked(spark):
    with pytest.raises(ValueError):
        sprt.limits(0.6, 0.5)
    df = spark.createDataFrame([], "s string, t int, x double")
    with pytest.raises(ValueError):
        sprt.sprt_alerts_batch(df, ["s"], "t", ["x"], alert_count=6, alert_window=5)


def test_batch_counts_alerts_in_the_window(spark):
    x = [0.0, 9.0, 9.0, 9.0, 0.0, 0.0, None, 0.0, -9.0]
    rows = [(s, i, v) for s in ("a", None) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "s string, t int, x double")
    out = sprt.sprt_alerts_batch(df, ["s"], "t", ["x"], shift=1.0, alert_count=3, alert_window=3)
    got = {(r.s, r.t): (r.alarm, r.alerts, r.prediction) for r in out.collect()}
    alarm = _plain([[v] for v in x], 1.0, 0.1, 0.1)
    assert alarm == [0, 1, 1, 1, 0, 0, 0, 0, 1]
    for s in ("a", None):
        for i in range(len(x)):
            alerts = sum(alarm[max(0, i - 2):i + 1])
            assert got[s, i] == (alarm[i], alerts, 0 if alerts >= 3 else 1)
    assert sprt.sprt_alerts_batch(df.limit(0), ["s"], "t", ["x"]).count() == 0


def test_residuals_without_baseline_or_spread(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("b", 1, 5.0), ("c", 1, 5.0)], "s string, t int, x double")
    base = spark.createDataFrame([("a", 3.0, 2.0), ("b", 5.0, 0.0)], "s string, x_mean double, x_sd double")
    got = {r.s: r.x for r in sprt.residuals(df, base, ["s"], ["x"]).collect()}
    assert got == {"a": 1.0, "b": None, "c": None}


def test_stream_goes_on_from_its_state_and_equals_the_batch_run(spark):
    """Three runs over growing input, out of order within the delay, with late rows, equal one batch run."""
    rng = np.random.default_rng(11)
    source, hours_root, alerts_root = (_folder(spark, t) for t in ("events", "hours", "alerts"))

    def event(series, minute, value):
        return series, START + dt.timedelta(minutes=int(minute)), float(value)

    kept, late = [], []
    for part in range(3):  # days 0-1, 1-2, 2-3
        minutes = rng.integers(part * 1440, (part + 1) * 1440, 900)
        events = [event(s, m, rng.normal(2.0 if s == "hot" else 0.0, 1.0))
                  for m in minutes for s in (["hot", "hot", "cold"] if m % 3 else ["cold"])]
        if part:  # these hours have left long ago
            gone = [event("cold", (part - 1) * 1440 + 60, 1e6)]
            late += gone
            events = events + gone
        rng.shuffle(events)
        kept += [e for e in events if e[2] != 1e6]
        events = [event(*[e[0], (e[1] - START).total_seconds() // 60, e[2]]) for e in events]
        spark.createDataFrame(events, SCHEMA).repartition(2).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        hours = windowed_accumulate(stream, "ts", "value", "1 hour", "2 hours", ["series"]).select(
            "series", "window_start", "n", "total")
        closed = sprt.closed_intervals(hours, hours_root)
        z = closed.select("series", "window_start", ((F.col("n") - 25) / 10.0).alias("n"), (F.col("total") / 10.0).alias("total"))
        path = run_to_path(sprt.sprt_alerts(z, ["series"], "window_start", ["n", "total"], shift=0.5), "alerts", alerts_root)
    assert late
    got = spark.read.parquet(path)
    table = spark.createDataFrame(kept, SCHEMA).groupBy("series", F.date_trunc("hour", "ts").alias("window_start")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    last = max(e[1] for e in kept) - dt.timedelta(hours=2)
    table = table.filter(F.col("window_start") + F.expr("INTERVAL 1 HOUR") <= F.lit(last))
    z = table.select("series", "window_start", ((F.col("n") - 25) / 10.0).alias("n"), (F.col("total") / 10.0).alias("total"))
    want = sprt.sprt_alerts_batch(z, ["series"], "window_start", ["n", "total"], shift=0.5)
    cols = ["series", "window_start", "alarm", "alerts", "prediction"]
    rows = sorted(map(tuple, got.select(cols).collect()))
    assert rows == sorted(map(tuple, want.select(cols).collect()))
    assert {r[2] for r in rows} == {0, 1} and {r[4] for r in rows} == {0, 1} and len(rows) > 100
