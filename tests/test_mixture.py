"""The mixture against one EM in plain Python loops, and the merging against its definition."""

import math

import numpy as np
import pytest

from quarry.operators import mixture as M


def _rows(n=240, seed=3):
    """Three planted groups; NULLs in both kinds of attributes."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        g = i % 3
        x = float(rng.normal([0, 8, -6][g], 1)), float(rng.normal([0, 1, 5][g], 0.5))
        c = "uvw"[g] if rng.random() < 0.85 else "uvw"[rng.integers(3)]
        rows.append((i, None if i % 31 == 4 else x[0], x[1], None if i % 29 == 7 else c, g))
    return rows


SCHEMA = "id long, a double, b double, c string, g int"


def _likelihoods(c: M.Components, levels, row):
    """prior times likelihood of every component for one row, in plain Python."""
    out = []
    for k in range(len(c.prior)):
        v = c.prior[k]
        for j, x in enumerate(row[1:3]):
            if x is not None:
                s2 = c.variance[k, j]
                v *= math.exp(-(x - c.mean[k, j]) ** 2 / (2 * s2)) / math.sqrt(2 * math.pi * s2)
        if row[3] in levels:
            v *= c.frequency[0][k][levels.index(row[3])]
        out.append(v)
    return out


def test_steps_equal_plain_loops(spark):
    rows = _rows(120)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    fits = [M.Mixture(components=4, clusters=2, max_iter=i, improvement=0.0).fit(df, ["a", "b"], ["c"]) for i in (1, 2)]
    before, after = fits[0].components, fits[1].components
    levels = fits[0].levels["c"]
    r = np.array([_likelihoods(before, levels, row) for row in rows])
    assert fits[1].history[1] == pytest.approx(float(np.log(r.sum(1)).sum()), rel=1e-9)
    r /= r.sum(1, keepdims=True)
    assert np.allclose(after.prior, r.mean(0))
    for j in range(2):
        known = np.array([row[1 + j] is not None for row in rows])
        x = np.array([row[1 + j] or 0.0 for row in rows])
        for k in range(4):
            w = r[known, k]
            mean = (w * x[known]).sum() / w.sum()
            assert after.mean[k, j] == pytest.approx(mean)
            assert after.variance[k, j] == pytest.approx(max((w * (x[known] - mean) ** 2).sum() / w.sum(), 0), rel=1e-6, abs=1e-4)
    for i, level in enumerate(levels):
        own = np.array([row[3] == level for row in rows])
        some = np.array([row[3] is not None for row in rows])
        assert np.allclose(after.frequency[0][:, i], r[own].sum(0) / r[some].sum(0))


def test_likelihood_never_falls_and_groups_are_found(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, SCHEMA)
    m = M.Mixture(components=6, clusters=3, linkage="average", improvement=1e-4).fit(df, ["a", "b"], ["c"])
    assert m.converged and all(b >= a - 1e-6 * abs(a) for a, b in zip(m.history, m.history[1:]))
    scored = m.score(df).collect()
    assert len(scored) == len(rows)
    groups = {}
    for r in scored:
        assert sum(s.probability for s in r.cluster_set) == pytest.approx(1.0)
        assert r.cluster_probability == max(s.probability for s in r.cluster_set) == r.cluster_set[0].probability
        groups.setdefault(r.g, []).append(r.cluster_id)
    tops = {g: max(set(ids), key=ids.count) for g, ids in groups.items()}
    assert len(set(tops.values())) == 3
    assert sum(i == tops[g] for g, ids in groups.items() for i in ids) >= 0.97 * len(rows)
    g = {r.name: r for r in m.view("G").collect()}
    assert g["NUM_COMPONENTS"].numeric_value == 6 and g["NUM_CLUSTERS"].numeric_value == 3
    assert m.view("M").count() == 12 and m.view("F").count() == 18 and m.view("T").count() == 3
    assert sum(r.prior_probability for r in m.view("O").collect()) == pytest.approx(1.0)


@pytest.mark.parametrize("linkage,link", [("single", min), ("complete", max), ("average", lambda v: sum(v) / len(v))])
def test_merging_follows_the_linkage(linkage, link):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(9, 2))
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    member, merges = M.agglomerate(d, 3, linkage)
    groups = [{i} for i in range(9)]
    for a, b, dist in merges:
        pairs = {(i, j): link([d[p, q] for p in groups[i] for q in groups[j]])
                 for i in range(len(groups)) for j in range(i + 1, len(groups))}
        best = min(pairs.values())
        ga, gb = (next(i for i, g in enumerate(groups) if x in g) for x in (a, b))
        assert dist == pytest.approx(best) == pytest.approx(pairs[min(ga, gb), max(ga, gb)])
        groups[ga] |= groups[gb]
        groups.pop(gb)
    assert {frozenset(np.flatnonzero(member == g)) for g in set(member)} == {frozenset(g) for g in groups}
    with pytest.raises(ValueError, match="linkage"):
        M.agglomerate(d, 2, "ward")


def test_distance_is_zero_for_equal_components_only():
    c = M.Components(np.ones(3) / 3, np.array([[0.0], [0.0], [2.0]]), np.ones((3, 1)), [np.array([[.5, .5], [.5, .5], [.1, .9]])])
    d = M.bhattacharyya(c)
    assert d[0, 1] == pytest.approx(0.0, abs=1e-12) and d[0, 2] > 0.4 and np.allclose(d, d.T)


def test_odd_tables(spark):
    """Constants, all-NULL columns, unseen levels, missing columns, fewer distinct rows than components, no rows."""
    df = spark.createDataFrame([(i, 1.0, None, "u" if i % 2 else None, 0) for i in range(20)], SCHEMA)
    m = M.Mixture(components=7, clusters=2).fit(df, ["a", "b"], ["c"])
    assert len(m.components.prior) == 2 and np.isfinite(m.history).all()
    new = spark.createDataFrame([(1, 99.0, 3.0, "never", 0), (2, None, None, None, 0), (3, float("nan"), None, "u", 0)], SCHEMA)
    assert all(0 <= r.cluster_probability <= 1 for r in m.score(new).collect())
    assert m.score(new.drop("a", "c")).count() == 3
    only = M.Mixture(components=3, clusters=2).fit(df, [], ["c"])
    assert only.score(df).count() == 20
    numeric = M.Mixture(components=3, clusters=2).fit(df, ["a"], [])
    assert numeric.score(df).count() == 20
    with pytest.raises(ValueError, match="no rows"):
        M.Mixture().fit(df.limit(0), ["a"], ["c"])
