"""Nearest neighbours by collision-counting hashing with query-aware windows.

Every hash is one random projection, kept as a sorted array.  A query opens a window around its
own projected value in each array; the windows grow with the search radius (virtual rehashing),
and a vector that falls into enough of them is verified by its true inner product.  The search of
a query ends when its k-th best verified distance lies within the radius: any vector as near
has then passed the collision threshold with probability ``RECALL`` at least.

Largest inner product becomes smallest distance by one extra coordinate, sqrt(M^2 - |x|^2) with M
the largest norm, and by scaling the query to norm M.
"""

from __future__ import annotations

from math import ceil, sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

PROJECTIONS = 64
WIDTH = 2.0          # window width in units of the radius
HIT = 0.6826894921   # chance that a vector at the radius falls into a window of that width
DEVIATIONS = 1.645   # the threshold lies so far below the mean count at the radius: RECALL
RECALL = 0.95
GROWTH = 1.3         # of the radius from round to round
DATA_BLOCK = 32_768
QUERY_BLOCK = 1_024


class CollisionIndex:
    """Sorted projections of one block of vectors."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, norm: float, seed: int = 3):
        n = len(ids)
        self.ids, self.norm = ids, norm
        self.rough, self.columns = vectors.astype(np.float32), vectors.T.copy()
        self.slack = 1e-5 * norm  # bounds the error of single precision, times the query's norm
        rest = np.sqrt(np.maximum(norm * norm - (vectors * vectors).sum(axis=1), 0))
        self.axes = np.random.default_rng(seed).standard_normal((vectors.shape[1] + 1, PROJECTIONS))
        projected = vectors @ self.axes[:-1] + rest[:, None] * self.axes[-1]
        order = np.argsort(projected, axis=0, kind="stable")
        # the sorted arrays one behind the other, each moved by its own offset, so that one search finds all ends
        self.step = 2 * np.abs(projected).max() + 16 * norm + 1
        self.offset = self.step * np.arange(PROJECTIONS)
        self.sorted = (np.take_along_axis(projected, order, axis=0) + self.offset).T.ravel()
        self.order = order.T.astype(np.intp).ravel()
        self.first, self.last = n * np.arange(PROJECTIONS), n * np.arange(1, PROJECTIONS + 1)
        self.threshold = ceil(PROJECTIONS * HIT - DEVIATIONS * sqrt(PROJECTIONS * HIT * (1 - HIT)))
        self.probe = vectors[np.linspace(0, n - 1, min(n, 256)).astype(int)]

    def search(self, queries: np.ndarray, own: np.ndarray, k: int):
        """Yields (query place, vec_ids, scores) of the k best found, without the query's own id."""
        scale = self.norm / np.sqrt((queries * queries).sum(axis=1))
        at = (queries * scale[:, None]) @ self.axes[:-1]
        # the first radius: half the distance to the nearest of some vectors spread over the block
        near = (self.probe @ queries.T).max(axis=0)
        start = np.maximum(np.sqrt(np.maximum(2 * self.norm ** 2 - 2 * near * scale, 0)) / 2, self.norm / 16)
        for place in range(len(queries)):
            yield place, *self._one(queries[place], scale[place], at[place], own[place], k, start[place])

    def _windows(self, at: np.ndarray, radius: float):
        half, moved = WIDTH * radius / 2, at + self.offset
        lo = np.searchsorted(self.sorted, moved - half)
        hi = np.searchsorted(self.sorted, moved + half, "right")
        return np.clip(lo, self.first, self.last), np.clip(hi, self.first, self.last)

    def _one(self, query, scale, at, own, k, radius):
        n = len(self.ids)
        counts, seen = np.zeros(n, np.int64), self.ids == own
        found, scores = np.zeros(0, np.int64), np.zeros(0, np.float32)
        rough, slack = query.astype(np.float32), self.slack * self.norm / scale
        old_lo = old_hi = None
        while True:
            widest = radius > 2 * self.norm  # the largest distance there is
            if widest:
                new = np.flatnonzero(~seen)  # what is left, so that no candidate is ever cut off
            else:
                lo, hi = self._windows(at, radius)
                if old_lo is None:
                    parts = [self.order[a:b] for a, b in zip(lo, hi)]
                else:
                    parts = [self.order[a:b] for a, b in zip(lo, old_lo)]
                    parts += [self.order[a:b] for a, b in zip(old_hi, hi)]
                counts += np.bincount(np.concatenate(parts), minlength=n)
                old_lo, old_hi = lo, hi
                new = np.flatnonzero((counts >= self.threshold) & ~seen)
            if len(new):
                seen[new] = True
                found = np.concatenate((found, new))
                scores = np.concatenate((scores, self.rough[new] @ rough))
            if widest:
                break
            searched, radius = radius, radius * GROWTH
            if len(found) >= k:
                kth = float(np.partition(scores, len(scores) - k)[len(scores) - k])
                keep = scores >= kth - 2 * slack  # can still be among the k best, ties included
                found, scores = found[keep], scores[keep]
                distance = sqrt(max(0.0, 2 * self.norm * self.norm - 2 * kth * scale))
                if distance <= searched * (1 + 1e-9):
                    break
                radius = min(radius, distance * (1 + 1e-9))  # a last window of that radius ends the search
        exact = np.zeros(len(found))  # in double precision, component by component
        for column, value in zip(self.columns, query):
            exact += column[found] * value
        ids = self.ids[found]
        best = np.lexsort((ids, -exact))
        best = best[np.sort(np.unique(ids[best], return_index=True)[1])]  # repeated rows count once
        return ids[best][:k], exact[best][:k]


def _cell(table: pa.Table, k: int, norm: float) -> pa.Table:
    """The k best of one block of vectors for one block of queries."""
    def part(side: int):
        own = table.filter(pc.equal(table.column("side"), side)).combine_chunks()
        ids = own.column("vec_id").to_numpy()
        flat = own.column("v").combine_chunks().flatten().to_numpy()
        order = np.argsort(ids, kind="stable")
        return ids[order], flat.reshape(len(ids), -1)[order] if len(ids) else np.zeros((0, 0))

    ids, vectors = part(1)
    own, queries = part(0)
    rows = ([], [], [])
    if len(ids) and len(own):
        for place, near, scores in CollisionIndex(vectors, ids, norm).search(queries, own, k):
            rows[0].append(np.full(len(near), own[place]))
            rows[1].append(near)
            rows[2].append(scores)
    return pa.table({n: np.concatenate(r) if r else np.zeros(0, t)
                     for n, r, t in zip(("query_id", "vec_id", "score"), rows, (np.int64, np.int64, float))})


def usable(embedding: Column) -> Column:
    """Not null or empty, no null or non-finite component, not all zero."""
    limit = F.lit(float("inf"))
    return F.coalesce((F.size(embedding) > 0)
                      & F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit))
                      & F.exists(embedding, lambda x: x != 0), F.lit(False))


def nearest(embeddings: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the k candidates of largest inner product of every query.

    ``is_query`` picks the query rows of ``embeddings(vec_id, embedding)``; candidates are all other
    ids.  Ties go to the smaller vec_id.  Null, zero, non-finite vectors and rows without vec_id take
    no part; vectors are compared with those of the same length only; a repeated vec_id counts
    once, with its best score, and as a query once per distinct vector.  Extra columns are ignored.

    Vectors are dealt by hash into blocks of about ``DATA_BLOCK``, queries into blocks of about
    ``QUERY_BLOCK``; one task searches one block for one block of queries, so memory is bounded
    and equal vectors spread over all blocks.  Every row is indexed and no candidate list is cut.
    """
    v = F.transform("embedding", lambda x: x.cast("double"))
    rows = embeddings.filter(F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding"), F.coalesce(is_query, F.lit(False)).alias("q"))
    rows = rows.filter(usable(F.col("embedding"))).select("vec_id", v.alias("v"), "q", F.size("embedding").alias("dim"))
    squares = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    total, queries, norm = rows.agg(F.count("*"), F.count(F.when(F.col("q"), 1)), F.max(F.sqrt(squares))).first()
    data_blocks, query_blocks = max(1, -(-total // DATA_BLOCK)), max(1, -(-queries // QUERY_BLOCK))
    db, qb = F.pmod(F.xxhash64("vec_id"), F.lit(data_blocks)), F.pmod(F.xxhash64(F.col("vec_id") + 1), F.lit(query_blocks))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    dealt = rows.select(F.lit(1).alias("side"), "vec_id", "v", "dim", db.alias("db"), every(query_blocks).alias("qb"))
    asked = rows.filter("q").dropDuplicates(["vec_id", "v"]).select(
        F.lit(0).alias("side"), "vec_id", "v", "dim", every(data_blocks).alias("db"), qb.alias("qb"))
    largest = float(norm or 1.0)

    def cell(table: pa.Table) -> pa.Table:
        return _cell(table, k, largest)

    found = dealt.unionByName(asked).groupBy("dim", "db", "qb").applyInArrow(
        cell, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
