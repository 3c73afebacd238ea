"""Collision-counting search: recall against brute force, exact scores, edge cases."""

import numpy as np
from pyspark.sql import functions as F

from quarry.llm import ann

SCHEMA = "vec_id long, embedding array<float>"


def _brute(ids, x, query, k):
    score = x @ query
    order = np.lexsort((ids, -score))
    return ids[order][:k], score[order][:k]


def test_recall_and_scores(spark, monkeypatch):
    monkeypatch.setattr(ann, "DATA_BLOCK", 700)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 40)
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = ann.nearest(rows, F.col("vec_id") % 20 == 0).toPandas()
    p = rows.toPandas()
    x, ids = np.stack(p.embedding).astype(float), p.vec_id.to_numpy()
    hits = total = 0
    for q in ids[ids % 20 == 0]:
        own = got[got.query_id == q].sort_values("rank")
        others = ids != q
        near, _ = _brute(ids[others], x[others], x[ids == q][0], 20)
        hits, total = hits + len(set(near) & set(own.vec_id)), total + len(near)
        assert own["rank"].tolist() == list(range(1, 21)) and q not in set(own.vec_id)
        true = [float(sum(a * b for a, b in zip(x[ids == q][0], x[ids == v][0]))) for v in own.vec_id]
        assert np.allclose(own.score, true, rtol=0, atol=1e-12)
        assert sorted(zip(-own.score, own.vec_id)) == list(zip(-own.score, own.vec_id))
    assert hits / total >= 0.93


def test_different_norms_and_clusters(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((1200, 16)) * rng.uniform(0.1, 9, (1200, 1))
    x[300:600] = x[300] + rng.standard_normal((300, 16)) * 0.01
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = ann.nearest(rows, F.col("vec_id") % 20 == 0, 10).toPandas()
    ids = np.arange(1200)
    hits = sum(len(set(_brute(ids[ids != q], x[ids != q], x[q], 10)[0]) & set(got[got.query_id == q].vec_id))
               for q in range(0, 1200, 20))
    assert hits >= 0.93 * 600


def test_edge_cases(spark):
    """Unusable vectors, fewer candidates than k, ties, repeated rows, other lengths, empty tables."""
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [None, 1.0]), (8, []), (9, [0.5, 0.5]), (9, [0.5, 0.5]), (None, [1.0, 0.0]), (20, [1.0, 0.0, 0.0]), (40, [0.0, 0.0]), (60, [0.0, -2.0])]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS side", "2 AS db", "3 AS score", "4 AS q")
    got = [tuple(r) for r in ann.nearest(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 9, 0.5), (0, 4, 60, 0.0),
                   (60, 1, 0, 0.0), (60, 2, 1, 0.0), (60, 3, 2, 0.0), (60, 4, 9, -1.0)]
    assert ann.nearest(df.limit(0), F.lit(True)).count() == 0
    assert ann.nearest(df, F.lit(None).cast("boolean")).count() == 0


def test_many_equal_vectors(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(500)] + [(1000 + i, [3.0, float(i % 7), 1.0]) for i in range(500)]
    got = ann.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 0).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [1006 + 7 * i for i in range(20)]
    assert {r.score for r in got} == {18.0}
