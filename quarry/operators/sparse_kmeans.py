"""k-means on a case table with a nested bag: numeric columns and a map column (attribute -> value).

A missing key of the bag counts as 0, as in a star schema where a customer bought nothing of a
category; no dense row is ever made.  Numerics are standardized, bag values are divided by their root
mean square over all rows and not shifted, so that zeros stay zeros.  A Lloyd step is ONE pass: every
task finds its rows' nearest centres from sparse products, and adds up members, dense and sparse
sums; Spark adds the tasks' sums.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.linear import SMALL_BLOCK, sum_held
from quarry.session import hold

MAX_NUMBERS = 4_000_000  # clusters x attributes at the driver


def sum_batches(df: DataFrame, block: Callable, width: int) -> np.ndarray | None:
    """The sum of the flat arrays ``block(batch)`` of ``width`` over all Arrow batches of held rows; None without rows."""
    def total_of(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                own = block(batch)
                total = own if total is None else total + own
        return total

    if width <= SMALL_BLOCK:
        return sum_held(df, total_of)

    def run(batches):
        total = total_of(batches)
        if total is not None:
            at = np.flatnonzero(total)
            at = at if len(at) else np.zeros(1, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at]),
                                              pa.array(np.full(len(at), len(total), np.int32))], names=["pos", "v", "size"])

    rows = df.mapInArrow(run, "pos int, v double, size int").groupBy("pos", "size").agg(F.sum("v").alias("v")).collect()
    if not rows:
        return None
    out = np.zeros(rows[0]["size"])
    for r in rows:
        out[r["pos"]] = r["v"]
    return out


@dataclass
class BagReader:
    """Reads a batch of numerics, keys and values as standardized dense and sparse parts."""
    mean: np.ndarray
    sd: np.ndarray
    codes: dict            # key -> column
    scale: np.ndarray      # of each key

    def dense(self, batch: pa.RecordBatch) -> np.ndarray:
        p = len(self.mean)
        if not p:
            return np.zeros((batch.num_rows, 0))
        x = np.column_stack([c.fill_null(float("nan")).to_numpy(zero_copy_only=False) for c in batch.columns[:p]])
        z = (x - self.mean) / self.sd
        return np.where(np.isnan(z), 0.0, z)

    def sparse(self, batch: pa.RecordBatch):
        """(row, column, value) of all known keys; NULL maps, values and unknown keys are left out."""
        keys, values = batch.columns[len(self.mean):len(self.mean) + 2]
        lengths = np.diff(keys.offsets.to_numpy())
        row = np.repeat(np.arange(batch.num_rows), np.where(keys.is_valid().to_numpy(zero_copy_only=False), lengths, 0))
        coded = keys.flatten().dictionary_encode()
        column = np.array([self.codes.get(k, -1) for k in coded.dictionary.to_pylist()] + [-1], np.int64)[
            coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)]
        value = values.flatten().fill_null(0.0).to_numpy(zero_copy_only=False)
        good = (column >= 0) & (value != 0) & ~np.isnan(value)
        return row[good], column[good], value[good] / self.scale[column[good]]

    def distances(self, batch: pa.RecordBatch, centers: np.ndarray):
        """Squared distances, rows x centres, and the parts read."""
        p, z, (row, column, value) = len(self.mean), self.dense(batch), self.sparse(batch)
        n = batch.num_rows
        size = (z * z).sum(1) + np.bincount(row, value * value, minlength=n)
        cross = z @ centers[:, :p].T
        for j in range(len(centers)):
            cross[:, j] += np.bincount(row, value * centers[j, p + column], minlength=n)
        return np.maximum(size[:, None] - 2 * cross + (centers * centers).sum(1)[None], 0.0), z, row, column, value


@dataclass
class BagKMeans:
    numeric: list
    bag: str
    reader: BagReader
    centers: np.ndarray
    sizes: np.ndarray = field(default_factory=lambda: np.zeros(0))
    sse: float = 0.0
    iterations: int = 0
    converged: bool = False

    def cluster_id(self, df: DataFrame) -> DataFrame:
        """``df`` with cluster_id (from 1, ties to the smaller) and cluster_distance."""
        n, reader, centers = len(df.columns), self.reader, self.centers
        schema = T.StructType(df.schema.fields + [T.StructField("cluster_id", T.IntegerType()),
                                                  T.StructField("cluster_distance", T.DoubleType())])

        def run(batches):
            for batch in batches:
                if batch.num_rows:
                    d = reader.distances(pa.RecordBatch.from_arrays(batch.columns[n:], names=batch.schema.names[n:]), centers)[0]
                    near = d.argmin(1)
                    yield pa.RecordBatch.from_arrays(
                        list(batch.columns[:n]) + [pa.array(near + 1, pa.int32()), pa.array(np.sqrt(d[np.arange(len(d)), near]))],
                        names=schema.fieldNames())

        return df.select(*df.columns, *_inputs(self.numeric, self.bag)).mapInArrow(run, schema)

    def centroids_df(self, spark: SparkSession) -> DataFrame:
        """Cluster, rows, attribute, key of the bag (NULL for numerics) and mean in the attribute's own units."""
        p, r = len(self.numeric), self.reader
        rows = []
        for j, c in enumerate(self.centers):
            rows += [(j + 1, int(self.sizes[j]), a, None, float(c[i] * r.sd[i] + r.mean[i])) for i, a in enumerate(self.numeric)]
            rows += [(j + 1, int(self.sizes[j]), self.bag, k, float(c[p + i] * r.scale[i])) for k, i in r.codes.items()]
        return spark.createDataFrame(rows, "cluster_id int, record_count long, attribute_name string, "
                                           "attribute_subname string, mean double")


def _inputs(numeric: list[str], bag: str):
    keys = F.map_keys(bag)
    return [F.col(a).cast("double").alias(f"__n{i}") for i, a in enumerate(numeric)] + [
        keys.cast("array<string>").alias("__keys"), F.map_values(bag).cast("array<double>").alias("__values")]


def fit_bag_kmeans(df: DataFrame, numeric: list[str], bag: str, k: int, max_iter: int = 100, tol: float = 1e-4) -> BagKMeans:
    """k-means over ``numeric`` and the map column ``bag``; it ends when no centre moves by more than ``tol``.

    Centres start at ``k`` distinct rows of smallest hash; an empty cluster keeps its centre.  Fewer
    distinct rows give fewer clusters.
    """
    rows = hold(df.select(*_inputs(numeric, bag)))
    try:
        keys = [r.key for r in rows.select(F.explode("__keys").alias("key")).distinct()
                .limit(MAX_NUMBERS // max(k, 1) + 1).collect()]
        if (len(keys) + len(numeric)) * k > MAX_NUMBERS:
            raise ValueError(f"{k} clusters of {len(keys) + len(numeric)} attributes exceed {MAX_NUMBERS} numbers; hash the keys first")
        keys.sort()
        p, m = len(numeric), len(keys)
        raw = BagReader(np.zeros(p), np.ones(p), {key: i for i, key in enumerate(keys)}, np.ones(m))

        def moments(batch):
            x = (np.column_stack([c.fill_null(float("nan")).to_numpy(zero_copy_only=False) for c in batch.columns[:p]])
                 if p else np.zeros((batch.num_rows, 0)))
            known, x = ~np.isnan(x), np.where(np.isnan(x), 0.0, x)
            _, column, value = raw.sparse(batch)
            return np.concatenate(([batch.num_rows], known.sum(0), x.sum(0), (x * x).sum(0),
                                   np.bincount(column, value * value, minlength=m)))

        s = sum_batches(rows, moments, 1 + 3 * p + m)
        if s is None:
            raise ValueError("no rows")
        n, known = s[0], np.maximum(s[1:1 + p], 1)
        mean = s[1 + p:1 + 2 * p] / known
        sd = np.sqrt(np.maximum(s[1 + 2 * p:1 + 3 * p] / known - mean ** 2, 0.0))
        rms = np.sqrt(s[1 + 3 * p:] / n)
        reader = BagReader(mean, np.where(sd > 0, sd, 1.0), raw.codes, np.where(rms > 0, rms, 1.0))
        parts = rows.select(*[F.col(f"__n{i}") for i in range(p)],
                            F.array_sort(F.arrays_zip("__keys", "__values")).alias("bag")).distinct()
        seeds = parts.orderBy(F.xxhash64(*parts.columns), *parts.columns).limit(k).collect()
        centers = np.zeros((len(seeds), p + m))
        for j, r in enumerate(seeds):
            for i in range(p):
                centers[j, i] = 0.0 if r[i] is None or r[i] != r[i] else (r[i] - reader.mean[i]) / reader.sd[i]
            for entry in r["bag"] or []:
                if entry[1] is not None and entry[1] == entry[1]:
                    centers[j, p + reader.codes[entry[0]]] = entry[1] / reader.scale[reader.codes[entry[0]]]
        model = BagKMeans(list(numeric), bag, reader, centers)
        for _ in range(max_iter):
            def step(batch, centers=model.centers):
                d, z, row, column, value = reader.distances(batch, centers)
                near, kk = d.argmin(1), len(centers)
                member = np.zeros((len(near), kk))
                member[np.arange(len(near)), near] = 1.0
                sparse = np.bincount(near[row] * m + column, value, minlength=kk * m)
                return np.concatenate(([d[np.arange(len(near)), near].sum()], member.sum(0), (member.T @ z).ravel(), sparse))

            kk = len(model.centers)
            s = sum_batches(rows, step, 1 + kk + kk * (p + m))
            sizes = s[1:1 + kk]
            sums = np.concatenate((s[1 + kk:1 + kk + kk * p].reshape(kk, p), s[1 + kk + kk * p:].reshape(kk, m)), 1)
            new = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], model.centers)
            moved = float(np.abs(new - model.centers).max())
            model.centers, model.sizes, model.sse = new, sizes, float(s[0])
            model.iterations += 1
            if moved <= tol:
                model.converged = True
                break
    finally:
        rows.unpersist()
    return model
