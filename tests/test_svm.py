"""Support vector machines against their optimality conditions, computed on the collected rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import svm as S


def _rows(n=300, seed=2):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        a, b = map(float, rng.normal(size=2))
        g = "uvw"[rng.integers(3)]
        y = int(a - 0.7 * b + (1.0 if g == "u" else 0) + rng.normal(scale=0.4) > 0)
        ring = int(a * a + b * b > 1.4)
        out.append((i, None if i % 41 == 7 else a, b, g if i % 37 else None, y, ring, "xyz"[(a > 0) + (b > 0)]))
    return out


SCHEMA = "id long, a double, b double, g string, y int, ring int, k string"


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(_rows(), SCHEMA).repartition(5, "id").cache()


def _x(m, df):
    return np.array([list(r) for r in df.orderBy("id").select(*m.design.columns(df)).collect()], float)


def _gradient(phi, y, c, beta, reg):
    phi = np.column_stack((phi, np.ones(len(phi))))
    gap = np.maximum(1 - y * (phi @ beta), 0)
    return reg * np.append(beta[:-1], 0) - (c * gap * y) @ phi / c.sum()


@pytest.mark.parametrize("weights", [None, {1: 3.0, 0: 0.5}])
def test_linear_fit_is_the_minimum(table, weights):
    m = S.SVMClassifier("y", ["a", "b"], ["g"], class_weights=weights).fit(table)
    y = np.array([r.y for r in table.orderBy("id").collect()])
    c = np.array([(weights or {}).get(v, 1.0) for v in y.tolist()])
    assert m.machines[0].converged
    assert np.abs(_gradient(_x(m, table), 2 * y - 1, c, m.machines[0].beta, 1e-3)).max() < 1e-7
    view = {(r.attribute_name, r.attribute_value): r for r in m.view("C").collect()}
    assert set(view) == {("a", None), ("b", None), ("g", "v"), ("g", "w"), (None, None)}
    assert view[None, None].coefficient == m.machines[0].beta[-1] and view["a", None].target_value == "1"
    assert view["a", None].coefficient > 0 > view["b", None].coefficient


def test_sigmoid_is_the_best_one(table):
    m = S.SVMClassifier("y", ["a", "b"], ["g"]).fit(table)
    y = np.array([r.y for r in table.orderBy("id").collect()])
    d = m.scorer().decisions(_x(m, table))[:, 0]
    a, b = m.sigmoids[0]
    t = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    p = 1 / (1 + np.exp(-(a * d + b)))
    assert abs(((p - t) * d).mean()) < 1e-8 and abs((p - t).mean()) < 1e-8
    scored = {r.id: r for r in m.score(table).collect()}
    for i, q in enumerate(p):
        r = scored[i]
        assert r.prediction == int(q > 0.5) and r.probability == pytest.approx(max(q, 1 - q))
        assert sum(s.probability for s in r.prediction_set) == pytest.approx(1.0)
        assert r.prediction_set[0].prediction == str(r.prediction)
    assert np.mean([scored[i].prediction == v for i, v in enumerate(y)]) > 0.85


def test_gaussian_kernel_learns_a_ring(table):
    linear = S.SVMClassifier("ring", ["a", "b"]).fit(table).score(table)
    gaussian = S.SVMClassifier("ring", ["a", "b"], kernel="gaussian", pivots=60).fit(table)
    share = {}
    for name, scored in (("linear", linear), ("gaussian", gaussian.score(table))):
        share[name] = scored.agg(F.avg((F.col("ring") == F.col("prediction")).cast("double"))).first()[0]
    assert share["gaussian"] > 0.93 > share["linear"]
    with pytest.raises(ValueError, match="kernel"):
        gaussian.coefficients_df(table.sparkSession)


def test_nystroem_is_exact_on_its_pivots():
    x = np.random.default_rng(0).normal(size=(30, 3))
    f = S.nystroem(x, 0.3)
    assert np.allclose(f(x) @ f(x).T, S._kernel(x, x, 0.3), atol=1e-6)


def test_more_classes(table):
    m = S.SVMClassifier("k", ["a", "b"], kernel="gaussian", pivots=50).fit(table)
    assert len(m.machines) == 3 and m.classes == ["x", "y", "z"]
    scored = m.score(table).collect()
    assert np.mean([r.k == r.prediction for r in scored]) > 0.9
    assert all(len(r.prediction_set) == 3 and sum(s.probability for s in r.prediction_set) == pytest.approx(1) for r in scored)


def test_odd_tables(spark, table):
    with pytest.raises(ValueError, match="classes"):
        S.SVMClassifier("y", ["a"]).fit(table.limit(0))
    with pytest.raises(ValueError, match="classes"):
        S.SVMClassifier("y", ["a"]).fit(table.filter("y = 1"))
    m = S.SVMClassifier("y", ["a", "b"], ["g"]).fit(table.unionAll(table.withColumn("y", F.lit(None).cast("int"))))
    new = spark.createDataFrame([(1, None, None, "never", None, 0, "x"), (2, 1e6, 0.0, None, 1, 0, "x")], SCHEMA)
    got = {r.id: r for r in m.score(new).collect()}
    assert got[2].prediction == 1 and 0.5 <= got[1].probability <= 1
    assert m.score(new.drop("a", "g")).count() == 2 and m.score(new.limit(0)).count() == 0
    apart = spark.createDataFrame([(i, float(i % 2), 0.0, "u", i % 2, 0, "x") for i in range(40)], SCHEMA)
    s = S.SVMClassifier("y", ["a", "b"]).fit(apart)  # separable, with a constant column
    assert s.score(apart).filter("y <> prediction").count() == 0 and np.isfinite(s.sigmoids[0]).all()
