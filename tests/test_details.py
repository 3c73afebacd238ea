"""Row-wise explanations against plain Python and against the rules' own conditions."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quarry.operators import details as D
from quarry.operators import ml
from quarry.plans.user_algorithms import UserAlgorithm, fit_user_model, left_out_weights, ridge_algorithm


def _rows(n=400, seed=2):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        x, y, g = float(rng.normal()), float(rng.uniform(0, 10)), "uvw"[int(rng.integers(3))]
        label = int(x + (y > 6) + (g == "u") + rng.normal(0, 0.2) > 0.8)
        out.append((i, x if i % 19 else None, y, g if i % 23 else None, label))
    return out


SCHEMA = "id int, x double, y double, g string, label int"


def test_left_out_weights_of_a_formula(spark):
    """A score known in closed form, with an attribute in quotes, NULLs, ties and clashing names."""
    df = spark.createDataFrame([(1, 2.0, 3.0, "a"), (2, None, 3.0, "b"), (3, -4.0, None, None)],
                               "id int, x double, `weight` double, details_of string")

    def score(frame, name):
        return frame.withColumn(name, 2 * F.coalesce("x", F.lit(0.0)) + F.coalesce("weight", F.lit(0.0))
                                + F.when(F.col("details_of") == "a", 1.0).otherwise(0.0))

    out = D.leave_one_out(df, score, ["x", "weight", "details_of"])
    assert out.columns == df.columns + ["details"] and out.count() == 3
    got = {r.id: [(d.attribute_name, d.attribute_value, d.weight, d.rank) for d in r.details] for r in out.collect()}
    assert got[1] == [("x", "2.0", 4.0, 1), ("weight", "3.0", 3.0, 2), ("details_of", "a", 1.0, 3)]
    assert got[2] == [("weight", "3.0", 3.0, 1), ("details_of", "b", 0.0, 2), ("x", None, 0.0, 3)]
    assert got[3] == [("x", "-4.0", -8.0, 1), ("details_of", None, 0.0, 2), ("weight", None, 0.0, 3)]
    ratio = {r.id: {d.attribute_name: d.weight for d in r.details}
             for r in D.leave_one_out(df, score, ["x", "weight"], how="ratio").collect()}
    assert ratio[1] == {"x": 2.0, "weight": 1.6} and ratio[3] == {"x": None, "weight": 1.0}
    assert [d.attribute_name for d in D.leave_one_out(df, score, ["x", "weight"], top_n=1).first().details] == ["x"]
    assert D.leave_one_out(df, score, ["x"], blanks={"x": 1.0}).first().details[0].weight == 2.0
    assert D.leave_one_out(df.limit(0), score, ["x"]).count() == 0
    for bad in ({"how": "other"}, {"name": "x"}):
        with pytest.raises(ValueError):
            D.leave_one_out(df, score, ["x"], **bad)
    with pytest.raises(ValueError):
        D.leave_one_out(df, score, ["nowhere"])


def test_left_out_weights_shuffle_nothing(spark):
    df = spark.createDataFrame(_rows(), SCHEMA)
    m = ml.fit_classifier(df, "label", ["x", "y"], ["g"], ml.decision_tree(max_depth=4), "ALGO_DECISION_TREE")
    out = D.leave_one_out(df, D.class_score(m, 1), ["x", "y", "g"])
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    got = {r.id: {d.attribute_name: d.weight for d in r.details} for r in out.collect()}

    def prob(frame):
        return {r.id: r.p for r in D.class_score(m, 1)(frame, "p").select("id", "p").collect()}

    full = prob(df)
    for a, t in (("x", "double"), ("g", "string")):
        without = prob(df.withColumn(a, F.lit(None).cast(t)))
        assert all(abs(got[i][a] - (full[i] - without[i])) < 1e-12 for i in full)


@pytest.mark.parametrize("depth", [0, 5])
def test_tree_rules_describe_their_rows(spark, depth):
    rows = _rows()
    df = spark.createDataFrame(rows, SCHEMA)
    m = ml.fit_classifier(df, "label", ["x", "y"], ["g"], ml.decision_tree(max_depth=depth, min_rec_node=5), "ALGO_DECISION_TREE")
    out = D.tree_details(df, m).select("id", "details.*").toPandas()
    assert len(out) == len(rows)
    leaves = D.tree_leaves(m)
    if depth:
        assert len(leaves) > 3 and {a for v in leaves for a, _, _ in v["rule"]} == {"x", "y", "g"}
        nodes = {r[0]: r[5] for r in ml.tree_nodes(m)}
        assert all(nodes[v["node_id"]] == str(v["prediction"]) for v in leaves)
    else:
        assert [v["rule"] for v in leaves] == [[]] and set(out.rule) == {"TRUE"}
    mean = np.mean([r[1] for r in rows if r[1] is not None])
    filled = df.withColumn("x", F.coalesce("x", F.lit(float(mean)))).withColumn("g", F.coalesce("g", F.lit("")))
    for v in leaves:  # the rule as a condition finds the leaf's rows and no others
        inside = {r.id for r in filled.filter(D.rule_text(v["rule"])).select("id").collect()}
        assert inside == set(out.id[out.node_id == v["node_id"]]) and len(inside) == v["support"]
        labels = [rows[i][4] for i in inside]
        assert abs(v["confidence"] - max(np.mean(labels), 1 - np.mean(labels))) < 1e-12
        assert v["prediction"] == int(np.mean(labels) > 0.5)


def test_rule_bounds_are_merged():
    path = [("a", ">", 1.0), ("a", "<=", 9.0), ("a", "<=", 5.0), ("g", "<>", "u"), ("g", "<>", "v"), ("h", "<>", "x"),
            ("h", "=", "it's"), ("h", "<>", "y")]
    assert D.rule_text(D._merged(path)) == "a > 1.0 AND a <= 5.0 AND g <> 'u' AND g <> 'v' AND h = 'it''s'"


def test_user_weights_by_partition(spark):
    rows = [(i, "pq"[i % 2], float(i % 7), float((i * 5) % 11), 3.0 * (i % 7) + (2.0 if i % 2 else -1.0) * ((i * 5) % 11) + 4.0)
            for i in range(200)] + [(900, None, 1.0, 1.0, 0.0), (901, "p", 0.0, None, 0.0)]
    df = spark.createDataFrame(rows, "id int, part string, a double, b double, y double")
    train = df.filter("id < 900")
    m = fit_user_model(train, ridge_algorithm(["a", "b"], "y"), partition_col="part")
    w = {r.id: r for r in m.weights(df, ["id"], "prediction").collect()}
    assert len(w) == len(rows) and w[900].weight_a is None
    d = {r.id: r.details for r in m.prediction_details(df, ["id"], "prediction", top_n=1).collect()}
    for i, part, a, b, _ in rows[:200]:
        c = 2.0 if part == "q" else -1.0
        full = 3 * a + c * b + 4
        want = {"a": full / (full - 3 * a) if abs(full - 3 * a) > 1e-9 else None, "b": full / (3 * a + 4)}
        assert abs(w[i].weight_b - want["b"]) < 1e-6
        if want["a"] is not None:
            assert abs(w[i].weight_a - want["a"]) < 1e-5 * max(1, abs(want["a"]))
            best = max(("a", "b"), key=lambda k: want[k])
            assert abs(want["a"] - want["b"]) < 1e-6 or d[i][0].attribute_name == best
    assert abs(w[901].weight_a - 1) < 1e-9 and abs(w[901].weight_b - 1) < 1e-9


def test_weight_that_is_not_finite_is_null(spark):
    algo = UserAlgorithm("plain", partial=lambda pdf, p: {"n": np.array([len(pdf)])}, finalize=lambda st, p: {},
                         score=lambda m, pdf, p: pd.DataFrame({"s": pdf["a"].to_numpy()}), score_schema="s double")
    df = spark.createDataFrame([(1, 0.0, "k"), (2, 5.0, "k")], "id int, a double, c string")
    with pytest.raises(ValueError):
        fit_user_model(df, algo).weights(df, ["id"], "s")
    algo.weights, algo.attributes = left_out_weights(algo.score, ["a", "c"]), ["a", "c"]
    m = fit_user_model(df, algo)
    assert sorted(map(tuple, m.weights(df, ["id"], "s").collect())) == [(1, None, None), (2, None, 1.0)]
    details = {r.id: r.details for r in m.prediction_details(df, ["id"], "s").collect()}
    assert [(x.attribute_name, x.weight) for x in details[2]] == [("c", 1.0), ("a", None)]
