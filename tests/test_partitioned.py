"""Transient models: all partitions at once equal one partition at a time, and direct numpy solutions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import partitioned as P

COLS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def table(spark):
    """A hot partition with most rows, small ones, a NULL key, NULL numbers and a constant column in one."""
    rng = np.random.default_rng(2)
    rows = []
    for key, n in (("hot", 700), ("small", 60), (None, 40), ("flat", 30), ("one", 1)):
        x = rng.normal(size=(n, 3)) * [1, 5, 0.1] + [0, 100, -3]
        for i, r in enumerate(x):
            a, b, c = map(float, r)
            rows.append((len(rows), key, None if i % 17 == 3 else a, b, 2.0 if key == "flat" else c,
                         None if i % 23 == 5 else 1.5 * a - 0.2 * b + (3 if key == "hot" else 0)))
    return spark.createDataFrame(rows, "id long, k string, a double, b double, c double, y double").repartition(6, "id").cache()


def _alone(table):
    for key in ("hot", "small", None, "flat", "one"):
        yield key, table.filter(F.col("k").eqNullSafe(F.lit(key)))


def _x(df):
    return np.array([[np.nan if v is None else v for v in r] for r in df.orderBy("id").select(*COLS).collect()], float)


def _z(x):
    with np.errstate(all="ignore"):
        mean = np.nanmean(x, 0)
        sd = np.nanstd(x, 0, ddof=1) if len(x) > 1 else np.ones(x.shape[1])
    sd = np.where((sd > 1e-9) & np.isfinite(sd), sd, 1.0)
    return np.where(np.isnan(x), 0.0, (x - mean) / sd)


def test_anomaly_equals_separate_fits(table):
    every = P.anomalies_over(table, "k", COLS, n_features=24)
    assert set(every.states) == {"hot", "small", None, "flat", "one"}
    scored = {r.id: r for r in every.score(table).collect()}
    assert len(scored) == table.count()
    for key, part in [x for x in _alone(table) if x[0] in ("hot", None)]:
        own = P.anomalies_over(part.repartition(1), "k", COLS, n_features=24)
        assert own.states[key].converged and every.states[key].converged
        assert own.states[key].rho == pytest.approx(every.states[key].rho, abs=1e-4)
        for r in own.score(part).collect():
            assert r.anomaly_probability == pytest.approx(scored[r.id].anomaly_probability, abs=5e-3)
    assert all(0 <= r.anomaly_probability <= 1 and len(r.anomaly_details) == 3 for r in scored.values())


def test_anomaly_fit_is_the_minimum(table):
    m = P.anomalies_over(table, "k", COLS, n_features=16, outlier_rate=0.2)
    rng = np.random.default_rng(0)
    for key, part in _alone(table):
        phi, s = P._features(_z(_x(part)), m.W, m.b), m.states[key]

        def value(w, rho):
            b = P._one_class_block(phi, w, rho, P.SMOOTH[-1])
            return 0.1 * w @ w - 0.2 * rho + b[1] / b[0]

        best = value(s.w, s.rho)
        for size in (1e-3, 1e-2, 0.1, 1.0):
            for _ in range(20):
                assert value(s.w + size * rng.normal(size=16), s.rho + size * rng.normal()) >= best - 1e-9
        score = phi @ s.w
        assert (score < s.rho - P.SMOOTH[-1]).mean() <= 0.2 + 1e-9  # at most the outlier rate lies clearly below
        assert (score < s.rho + P.SMOOTH[-1]).mean() >= 0.2 - 1e-9


def test_planted_outlier_is_explained(table, spark):
    """A far row of the small partition lies below its threshold, for its odd attribute."""
    odd = spark.createDataFrame([(9999, "small", 0.0, 140.0, -3.0, None)], table.schema)
    some = table.filter("k = 'small'").unionAll(odd)
    scored = P.anomalies_over(some, "k", COLS, n_features=200).score(some).orderBy(F.desc("anomaly_probability")).collect()
    place = [r.id for r in scored].index(9999)
    assert place < 6 and scored[place].anomaly_probability > 0.5
    assert scored[place].anomaly_details[0].attribute == "b" and scored[place].anomaly_details[0].actual_value == 140.0


def test_regression_equals_least_squares(table):
    got = {r.id: r.prediction for r in P.regression_over(table, "k", "y", COLS).collect()}
    for key, part in _alone(table):
        x, rows = _x(part), part.orderBy("id").collect()
        y = np.array([np.nan if r.y is None else r.y for r in rows])
        if key == "one":
            assert got[rows[0].id] == pytest.approx(y[0])
            continue
        z = np.column_stack([np.ones(len(x)), _z(x)])
        beta = np.linalg.lstsq(z[~np.isnan(y)], y[~np.isnan(y)], rcond=1e-10)[0]
        assert np.allclose([got[r.id] for r in rows], z @ beta, atol=1e-6)
    bare = P.regression_over(table.withColumn("y", F.lit(None).cast("double")), "k", "y", COLS)
    assert bare.filter("prediction IS NOT NULL").count() == 0


def test_features_equal_eigenvectors(table):
    m = P.features_over(table, "k", COLS, 2)
    for key, part in _alone(table):
        z = _z(_x(part))
        values = np.linalg.eigvalsh(z.T @ z / max(len(z) - 1, 1))[::-1]
        assert np.allclose(m.values[key], np.maximum(values, 0), atol=1e-9)
        assert np.allclose(((z @ m.axes[key]) ** 2).sum(0) / max(len(z) - 1, 1), np.maximum(values[:2], 0), atol=1e-9)
    for r in m.feature_set(table, 2).limit(50).collect():
        assert abs(r.features[0].value) >= abs(r.features[1].value) and {f.feature_id for f in r.features} == {1, 2}
    spark = table.sparkSession
    assert m.loadings(spark).count() == 5 * 2 * 3 and m.variances(spark).count() == 5 * 3


def test_clusters_equal_separate_fits_and_are_fixed_points(table):
    every = P.clusters_over(table, "k", COLS, 3)
    ids = {r.id: (r.cluster_id, r.cluster_id_distance) for r in every.cluster_id(table).collect()}
    assert all(every.converged.values())
    for key, part in _alone(table):
        own = P.clusters_over(part.repartition(1), "k", COLS, 3)
        assert np.allclose(own.centers[key], every.centers[key], atol=1e-3)
        z = _z(_x(part))
        order = [r.id for r in part.orderBy("id").collect()]
        member = np.array([ids[i][0] for i in order]) - 1
        d = ((z[:, None] - every.centers[key][None]) ** 2).sum(2)
        assert (d.argmin(1) == member).all()
        assert np.allclose([ids[i][1] for i in order], np.sqrt(d.min(1)))
        for c in set(member):
            assert np.allclose(z[member == c].mean(0), every.centers[key][c], atol=0.05)


def test_nothing_to_fit_and_too_much(table, monkeypatch):
    none = table.limit(0)
    assert P.regression_over(none, "k", "y", COLS).count() == 0
    assert P.anomalies_over(none, "k", COLS).score(none).count() == 0
    assert P.clusters_over(none, "k", COLS, 3).cluster_id(none).count() == 0
    monkeypatch.setattr(P, "MAX_BYTES", 1000)
    with pytest.raises(ValueError, match="at the driver"):
        P.anomalies_over(table, "k", COLS)
