"""Cluster rules and bag k-means against plain Python and dense numpy."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import cluster_rules as R
from quarry.operators import sparse_kmeans as K

SCHEMA = "id long, c int, x double, y double, flat double, g string"


def _rows(n=300, seed=4):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        c = rng.choice([1, 1, 1, 2, 5])
        out.append((i, c if i % 50 else None, rng.gauss(c, 0.4) if i % 13 else None, rng.uniform(0, 1), 2.0,
                    rng.choice("uvw" if c != 2 else "wz") if i % 17 else None))
    return out


def test_rules_equal_plain_python(spark):
    rows = _rows()
    got = R.cluster_rules(spark.createDataFrame(rows, SCHEMA).repartition(4), "c", ["x", "y", "flat"], ["g"]).collect()
    kept = [r for r in rows if r[1] is not None]
    column = {"x": 2, "y": 3, "flat": 4, "g": 5}

    def inside(side, row):
        v = row[column[side.attribute_name]]
        if v is None:
            return False
        if side.attribute_values is not None:
            return v in side.attribute_values
        known = [r[column[side.attribute_name]] for r in kept if r[column[side.attribute_name]] is not None]
        lo, hi = min(known), max(known)
        cell = 1 if lo == hi else min(max(int((v - lo) / (hi - lo) * 10) + 1, 1), 10)
        return side.lower_bin <= cell <= side.upper_bin

    by = {}
    for side in got:
        by.setdefault(side.cluster_id, []).append(side)
    assert set(by) == {1, 2, 5} and all(len(s) == 4 for s in by.values())
    for c, sides in by.items():
        own = [r for r in kept if r[1] == c]
        for s in sides:
            known = sum(r[column[s.attribute_name]] is not None for r in own)
            held = sum(inside(s, r) for r in own)
            share = sum(inside(s, r) for r in kept) / len(kept)
            assert s.support == held >= 0.8 * known
            assert s.confidence == pytest.approx(max(0, 1 - share / (held / len(own))))
            assert s.rule_support == sum(all(inside(t, r) for t in sides) for r in own)
            assert s.rule_confidence == pytest.approx(s.rule_support / len(own))
            if s.lower_bin is not None:  # no shorter run holds enough
                assert s.lower_bound <= s.upper_bound
    assert {s.attribute_name: s for s in by[5]}["x"].confidence > {s.attribute_name: s for s in by[5]}["y"].confidence


def test_shortest_run_and_ties():
    assert R.numeric_side("a", [0, 4, 0, 4, 1, 1], [9, 9, 9, 9, 9, 9], 0.8).bins == (2, 4)
    assert R.numeric_side("a", [3, 3, 3], [3, 3, 3], 0.6).bins == (1, 2)
    assert R.numeric_side("a", [0, 0], [1, 1], 0.8) is None
    side = R.categorical_side("g", {"b": 2, "a": 2, "c": 1}, {"a": 5, "b": 2, "c": 9}, 0.4)
    assert side.values == ["a"] and side.support == 2 and side.everywhere == 5


def test_rules_of_odd_tables(spark):
    df = spark.createDataFrame(_rows(), SCHEMA)
    assert R.cluster_rules(df.limit(0), "c", ["x"], ["g"]).count() == 0
    assert R.cluster_rules(df.withColumn("c", F.lit(None).cast("int")), "c", ["x"]).count() == 0
    empty = df.withColumn("x", F.lit(None).cast("double")).withColumn("g", F.lit(None).cast("string"))
    assert R.cluster_rules(empty, "c", ["x"], ["g"]).count() == 0
    clash = df.withColumn("bin", F.lit(1)).withColumn("attribute", F.lit("x")).withColumn("count", F.lit(9))
    assert R.cluster_rules(clash, "c", ["x", "bin"]).count() == 6


# --------------------------------------------------------------------- nested bag
def _bags(n=150, seed=6):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        g = i % 3
        bag = {k: rng.uniform(5, 9) for k in ("a", "b", "c", "d") if rng.random() < (0.9 if "abc"[g] == k else 0.15)}
        rows.append((i, rng.gauss(g * 4, 1) if i % 19 else None, bag if i % 23 else (None if i % 2 else {})))
    rows.append((n, 1.0, {"a": None, "e": 0.0, "d": 3.0}))
    return rows


def _dense(m, rows):
    r = m.reader
    out = np.zeros((len(rows), 1 + len(r.codes)))
    for i, (_, x, bag) in enumerate(rows):
        out[i, 0] = 0.0 if x is None else (x - r.mean[0]) / r.sd[0]
        for k, v in (bag or {}).items():
            out[i, 1 + r.codes[k]] = (v or 0.0) / r.scale[r.codes[k]]
    return out


def test_bag_kmeans_equals_dense_lloyd(spark):
    rows = _bags()
    df = spark.createDataFrame(rows, "id long, x double, bag map<string,double>").repartition(4)
    m = K.fit_bag_kmeans(df, ["x"], "bag", 3)
    z = _dense(m, rows)
    values = [[(b or {}).get(k) or 0.0 for k in sorted(m.reader.codes)] for _, _, b in rows]
    assert np.allclose(m.reader.scale, np.where((s := np.sqrt((np.array(values) ** 2).mean(0))) > 0, s, 1))
    start = K.fit_bag_kmeans(df, ["x"], "bag", 3, max_iter=1)
    centers = start.centers
    for _ in range(100):
        near = ((z[:, None] - centers[None]) ** 2).sum(2).argmin(1)
        new = np.array([z[near == j].mean(0) if (near == j).any() else centers[j] for j in range(3)])
        done = np.abs(new - centers).max() <= 1e-4
        centers = new
        if done:
            break
    assert m.converged and np.allclose(m.centers, centers, atol=1e-9)
    ids = {r.id: r for r in m.cluster_id(df).collect()}
    d = ((z[:, None] - m.centers[None]) ** 2).sum(2)
    for i in range(len(rows)):
        assert ids[i].cluster_id == d[i].argmin() + 1
        assert ids[i].cluster_distance == pytest.approx(np.sqrt(d[i].min()), abs=1e-6)
    view = m.centroids_df(spark).collect()
    assert len(view) == 3 * (1 + 5) and sum(r.record_count for r in view if r.attribute_name == "x") == len(rows)


def test_bag_kmeans_on_odd_tables(spark, monkeypatch):
    schema = "id long, x double, bag map<string,double>"
    same = spark.createDataFrame([(i, 1.0, {"a": 2.0}) for i in range(9)], schema)
    m = K.fit_bag_kmeans(same, ["x"], "bag", 4)
    assert len(m.centers) == 1 and m.converged and m.sizes.tolist() == [9]
    none = spark.createDataFrame([(i, None, None) for i in range(5)], schema)
    assert K.fit_bag_kmeans(none, ["x"], "bag", 2).cluster_id(none).filter("cluster_id = 1").count() == 5
    only_bag = K.fit_bag_kmeans(spark.createDataFrame(_bags(), schema), [], "bag", 2)
    new = spark.createDataFrame([(1, None, {"never": 3.0})], schema)
    assert only_bag.cluster_id(new).count() == 1
    with pytest.raises(ValueError, match="no rows"):
        K.fit_bag_kmeans(same.limit(0), ["x"], "bag", 2)
    monkeypatch.setattr(K, "MAX_NUMBERS", 3)
    with pytest.raises(ValueError, match="exceed"):
        K.fit_bag_kmeans(spark.createDataFrame(_bags(), schema), ["x"], "bag", 2)
