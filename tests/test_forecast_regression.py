"""Forecast features, their comparison, and dense text vectors."""

import datetime as dt
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import dense_text as D
from quarry.operators import forecast_regression as R
from quarry.operators.timeseries import fit_series

START = dt.datetime(2024, 3, 1)
SCHEMA = "series string, period timestamp, value double"


def _hour(i):
    return START + dt.timedelta(hours=i)


def _table(spark, n=120):
    rng = np.random.default_rng(1)
    lead = 50 + 10 * np.sin(np.arange(n) * 2 * np.pi / 12) + rng.normal(scale=0.3, size=n)
    follow = 2 * lead + rng.normal(scale=8, size=n)
    rows = [("lead", _hour(i), float(lead[i])) for i in range(n)] + [("follow", _hour(i), float(follow[i])) for i in range(n)]
    rows += [("other", _hour(i), 1.0) for i in range(30)] + [("unlisted", _hour(0), 5.0)]
    return spark.createDataFrame(rows, SCHEMA), lead, follow


def test_features_are_aligned_fits(spark):
    df, lead, _ = _table(spark)
    f = R.forecast_features(df, ["lead", "follow"], [_hour(83), _hour(95)], 12, "hour", "winters_add", 12)
    rows = {(r.origin, r.period): r for r in f.collect()}
    assert len(rows) == (84 + 12) + (96 + 12)
    for cut in (83, 95):
        fit = fit_series(lead[:cut + 1], "winters_add", 12, 12, 0.95)
        for i in range(cut + 1):
            r = rows[_hour(cut), _hour(i)]
            assert r.prod == 0 and r.f_lead == pytest.approx(fit["fitted"][i]) and r.y_lead == pytest.approx(lead[i])
        for i in range(12):
            r = rows[_hour(cut), _hour(cut + 1 + i)]
            assert r.prod == 1 and r.f_lead == pytest.approx(fit["forecast"][i]) and r.y_lead == pytest.approx(lead[cut + 1 + i])


def test_regression_uses_the_other_forecasts(spark):
    df, lead, follow = _table(spark)
    f = R.forecast_features(df, ["lead", "follow"], [_hour(83), _hour(95)], 12, "hour", "winters_add", 12).cache()
    compared = R.compare_forecasts(f, "follow", ["lead", "follow"]).orderBy("origin", "period").collect()
    assert len(compared) == 24
    for cut in (83, 95):
        own = sorted([r for r in f.collect() if r.origin == _hour(cut)], key=lambda r: r.period)
        x = np.array([[1.0, r.f_lead, r.f_follow] for r in own])
        y = follow[:cut + 1]
        beta = np.linalg.lstsq(x[:cut + 1], y, rcond=None)[0]
        got = [r for r in compared if r.origin == _hour(cut)]
        assert np.allclose([r.regression_forecast for r in got], x[cut + 1:] @ beta, atol=1e-5)
        assert np.allclose([r.actual for r in got], follow[cut + 1:cut + 13])
        assert all(r.baseline_error == pytest.approx(r.actual - r.baseline_forecast) for r in got)
    errors = {r.model: r for r in R.error_summary(R.compare_forecasts(f, "follow", ["lead", "follow"])).collect()}
    e = np.array([r.regression_error for r in compared])
    assert errors["regression"].rmse == pytest.approx(np.sqrt((e ** 2).mean())) and errors["regression"].n == 24
    assert errors["regression"].mae == pytest.approx(np.abs(e).mean())
    assert errors["regression"].rmse <= errors["baseline"].rmse * 1.2


def test_short_and_missing_series(spark):
    df, _, _ = _table(spark)
    f = R.forecast_features(df, ["lead", "other", "never"], [_hour(83)], 6, "hour", "simple")
    rows = {r.period: r for r in f.collect()}
    assert all(r.f_never is None and r.y_never is None for r in rows.values())
    assert rows[_hour(84)].f_other is None and rows[_hour(30)].f_other == pytest.approx(1.0)  # its forecasts follow its own end
    late = R.compare_forecasts(R.forecast_features(df, ["lead"], [_hour(117)], 6, "hour", "simple"), "lead", ["lead"])
    assert late.count() == 6 and late.filter("actual IS NULL").count() == 4
    assert {r.n for r in R.error_summary(late).collect()} == {2}
    assert R.forecast_features(df, ["lead"], [START - dt.timedelta(days=1)], 6).count() == 0


def test_dense_vectors_equal_plain_hashing(spark):
    rng = np.random.default_rng(0)
    rows = [(i, int(f), float(rng.normal())) for i in range(20) for f in rng.choice(5000, 60, replace=False)]
    df = spark.createDataFrame(rows + [(99, None, 1.0), (None, 3, 1.0), (98, 3, None)], "id long, feature_id long, value double")
    want = np.zeros((20, 64))
    for i, f, v in rows:
        m = hashlib.md5(str(f).encode()).hexdigest()
        want[i, int(m[:6], 16) % 64] += v if int(m[8], 16) % 2 == 0 else -v
    places = D.dense_places(df, 64)
    got = {r.id: r.vector for r in D.dense_vectors(places, 64).collect()}
    assert set(got) == set(range(20)) and np.allclose([got[i] for i in range(20)], want)
    assert D.dense_vectors(D.dense_places(df.limit(0), 64), 64).count() == 0
    with pytest.raises(ValueError, match="width"):
        D.dense_places(df, 0)


def test_dense_products_stand_for_sparse_ones(spark):
    rng = np.random.default_rng(2)
    sparse = rng.normal(size=(6, 3000)) * (rng.random((6, 3000)) < 0.1)
    sparse /= np.linalg.norm(sparse, axis=1)[:, None]
    sparse[1] = 0.8 * sparse[0] + 0.6 * sparse[1]
    rows = [(i, int(j), float(sparse[i, j])) for i in range(6) for j in np.flatnonzero(sparse[i])]
    v = {r.id: np.array(r.vector) for r in D.dense_vectors(D.dense_places(spark.createDataFrame(
        rows, "id long, feature_id long, value double"))).collect()}
    dense = np.array([v[i] for i in range(6)])
    assert np.abs(dense @ dense.T - sparse @ sparse.T).max() < 0.2
