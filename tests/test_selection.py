"""Feature selection against least squares on the collected rows."""

import math

import numpy as np
import pytest

from quarry.operators import selection as S
from quarry.operators.linear import _t_sf


def _data(n=300, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4))
    y = 3 + 2 * x[:, 0] - x[:, 1] + 0.8 * x[:, 0] * x[:, 1] + rng.normal(scale=0.5, size=n)
    return x, y


def _frame(spark, x, y, levels=None):
    rows = [tuple(map(float, r)) + (float(t), None if levels is None else levels[i])
            for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "a double, b double, c double, d double, y double, g string")


def _sse(columns, y):
    m = np.column_stack([np.ones(len(y))] + columns)
    beta = np.linalg.lstsq(m, y, rcond=None)[0]
    return float(((y - m @ beta) ** 2).sum()), beta, m


def test_sweep_is_its_own_inverse_and_gives_least_squares():
    x, y = _data()
    m = np.column_stack([np.ones(len(y)), x, y])
    a = m.T @ m
    before = a.copy()
    for k in range(5):
        S.sweep(a, k)
    sse, beta, design = _sse(list(x.T), y)
    assert np.allclose(a[:5, 5], beta) and a[5, 5] == pytest.approx(sse)
    assert np.allclose(a[:5, :5], np.linalg.inv(design.T @ design))
    for k in range(5):
        S.sweep(a, k)
    assert np.allclose(a, before)


@pytest.mark.parametrize("criterion", ["alpha", "sbic", "aic", "ric"])
def test_finds_the_true_features(spark, criterion):
    x, y = _data()
    m = S.SelectedGLM("y", ["a", "b", "c", "d"], quadratic=True, criterion=criterion, prune_level=0.001).fit(_frame(spark, x, y))
    assert m.design.expressions() == ["a", "b", "a*b"]
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    sse, beta, design = _sse([z[:, 0], z[:, 1], z[:, 0] * z[:, 1]], y)
    assert np.allclose(m.beta, beta) and m.stats["sse"] == pytest.approx(sse)
    rows = {r.feature_expression: r for r in m.view("D").collect()}
    cov = np.linalg.inv(design.T @ design) * sse / (len(y) - 4)
    for i, name in enumerate([None, "a", "b", "a*b"]):
        r, se = rows[name], math.sqrt(cov[i, i])
        assert r.std_error == pytest.approx(se) and r.test_statistic == pytest.approx(beta[i] / se)
        assert r.p_value == pytest.approx(_t_sf(beta[i] / se, len(y) - 4), abs=1e-12)
        assert r.lower_coeff_limit < r.coefficient < r.upper_coeff_limit
    assert rows["a"].std_coefficient == pytest.approx(beta[1] * z[:, 0].std() / y.std())
    scored = _frame(spark, x, y).select("y", m.prediction().alias("p")).toPandas()
    assert ((scored.y - scored.p) ** 2).sum() == pytest.approx(sse)


def test_steps_follow_nested_least_squares(spark):
    x, y = _data(seed=4)
    m = S.SelectedGLM("y", ["a", "b", "c", "d"], quadratic=True, force_in=["c"], prune_level=None).fit(_frame(spark, x, y))
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    every = dict(zip(m.design.candidates(), [*z.T, *[z[:, i] * z[:, j] for i in range(4) for j in range(i, 4)]]))
    named = {k: v for (k, _), v in every.items()}
    inside, wealth, tests = [], 0.5, 0
    for s in m.view("S").orderBy("step").collect():
        before, after = _sse(inside, y)[0], _sse(inside + [named[s.feature_expression]], y)[0]
        assert s.sse_before == pytest.approx(before)
        if s.action == "FORCED":
            assert s.feature_expression == "c"
        else:
            tests += 1
            level = wealth / (2 * tests)
            f = (before - after) / (after / (len(y) - len(inside) - 2))
            assert s.level == pytest.approx(level) and s.f_value == pytest.approx(f)
            assert (s.action == "ADDED") == (S.f_upper(f, 1, len(y) - len(inside) - 2) <= level)
            wealth += 0.5 - level if s.action == "ADDED" else -level
            assert s.wealth == pytest.approx(wealth)
        if s.action != "REJECTED":
            inside.append(named[s.feature_expression])
            assert s.sse_after == pytest.approx(after)
    assert m.design.expressions()[0:1] == ["a"] and "c" in m.design.expressions()


def test_collinear_candidates_alert_and_forced_ones_fail(spark):
    x, y = _data()
    x[:, 3] = 5 - 2 * x[:, 0]
    df = _frame(spark, x, y)
    m = S.SelectedGLM("y", ["a", "b", "c", "d"]).fit(df)
    assert [r.feature_expression for r in m.view("W").collect()] == ["d"] and "d" not in m.design.expressions()
    with pytest.raises(ValueError, match="collinear"):
        S.SelectedGLM("y", ["a", "b", "c", "d"], force_in=["a", "d"]).fit(df)
    with pytest.raises(ValueError, match="predictors"):
        S.SelectedGLM("y", ["a"], force_in=["zz"])


def test_pruning_keeps_forced_features(spark):
    x, y = _data(seed=7)
    m = S.SelectedGLM("y", ["a", "b", "c", "d"], force_in=["c"], wealth=50.0, prune_level=1e-6).fit(_frame(spark, x, y))
    assert m.design.expressions() == ["a", "b", "c"]
    pruned = [s for s in m.steps if s.action == "PRUNED"]
    assert all(s.p_value > 1e-6 and s.sse_after >= s.sse_before for s in pruned)


def test_odd_columns(spark):
    """NULLs, constants, levels, NULL targets; no rows."""
    x, y = _data(120)
    levels = [["u", "v", None][i % 3] for i in range(120)]
    y = y + np.array([4.0 if v == "v" else 0.0 for v in levels])
    rows = [(None if i % 10 == 0 else float(x[i, 0]), 7.0, None, None if i == 5 else float(y[i]), levels[i]) for i in range(120)]
    df = spark.createDataFrame(rows, "a double, k double, n double, y double, g string")
    m = S.SelectedGLM("y", ["a", "k", "n"], ["g"], quadratic=True).fit(df)
    assert {"a", "g_v"} <= set(m.design.expressions())
    assert not {"k", "n", "k*k", "n*n"} & set(m.design.expressions())
    assert m.stats["num_rows"] == 119
    g = {r.name: r for r in m.view("G").collect()}
    assert len(g) == 24 and g["CONVERGED"].string_value == "YES" and g["NUM_ROWS"].numeric_value == 119
    assert df.select(m.prediction(df).alias("p")).filter("p IS NULL").count() == 0
    assert df.drop("g").select(m.prediction(df.drop("g")).alias("p")).filter("p IS NULL").count() == 0
    with pytest.raises(ValueError, match="no rows"):
        S.SelectedGLM("y", ["a"]).fit(df.limit(0))


def test_f_tail():
    assert S.f_upper(4.0, 1, 50) == pytest.approx(_t_sf(2.0, 50))
    assert S.f_upper(0.0, 3, 10) == pytest.approx(1.0)
    assert S.f_upper(3.7082648, 3, 10) == pytest.approx(0.05, abs=1e-6)  # tabled 5 % point
