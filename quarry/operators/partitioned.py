"""Models fitted for every partition value at once, and thrown away after scoring.

``PREDICTION(FOR y USING ..) OVER (PARTITION BY k)`` and its kin fit one model per value of k.  Here
no partition is ever gathered: every task adds up its own rows' statistics per key in numpy, the
tasks' blocks of a key are added by Spark, and one block per key reaches the driver.  A key that holds
most rows is spread over as many tasks as the rows are.  A fit step of ALL keys is one such pass:

* regression: one Gram matrix per key;
* features (PCA or SVD): one Gram matrix per key;
* clustering (k-means): centroid sums per key and step;
* anomaly (one-class SVM): gradient and Hessian of the smoothed objective per key and Newton step.

A NULL key is a partition of its own, NULL numerics count as the partition's mean.  The models take
``keys x block`` numbers at the driver; beyond ``MAX_BYTES`` the fit raises.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from quarry.session import hold

MAX_BYTES = 256 << 20


# --------------------------------------------------------------------- keyed sums
def _by_key(batch: pa.RecordBatch):
    """(key, row numbers) of every key in the batch's first column."""
    coded = batch.column(0).dictionary_encode()
    codes = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    order = np.argsort(codes, kind="stable")
    edges = np.flatnonzero(np.diff(codes[order])) + 1
    for rows in np.split(order, edges):
        code = codes[rows[0]]
        yield (None if code < 0 else coded.dictionary[int(code)].as_py()), rows


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """The columns after the first as floats; NULL is NaN."""
    return np.column_stack([c.fill_null(float("nan")).to_numpy(zero_copy_only=False) for c in batch.columns[1:]])


def keyed_sums(rows: DataFrame, block: Callable, width: int, keys: int | None = None) -> dict:
    """key -> sum of ``block(key, matrix)`` - flat arrays of ``width`` - over the key's rows.

    ``rows`` has the key as string and then doubles.  A block of None adds nothing.
    """
    if keys is not None and keys * width * 8 > MAX_BYTES:
        raise ValueError(f"{keys} partitions of {width} numbers exceed {MAX_BYTES >> 20} MB at the driver")

    def run(batches):
        totals: dict = {}
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch)
                for key, at in _by_key(batch):
                    own = block(key, x[at])
                    if own is not None:
                        totals[key] = totals[key] + own if key in totals else own
        names = list(totals)
        for i in range(0, len(names), 256):
            some = names[i:i + 256]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.string()), pa.array([totals[k].tobytes() for k in some],
                                                                                   pa.binary())], names=["key", "block"])

    def add(table: pa.Table) -> pa.Table:  # one row per task that met the key
        total = sum(np.frombuffer(b, np.float64) for b in table.column("block").to_pylist())
        return pa.table({"key": table.column("key").slice(0, 1), "block": pa.array([total.tobytes()], pa.binary())})

    parts = rows.mapInArrow(run, "key string, block binary").groupBy("key").applyInArrow(add, "key string, block binary")
    return {r["key"]: np.frombuffer(bytes(r["block"]), np.float64).copy() for r in parts.collect()}


@dataclass
class Scale:
    """Rows, mean and deviation of every column of one partition; a constant column has deviation 1."""
    n: float
    mean: np.ndarray
    sd: np.ndarray


def _prepared(df: DataFrame, key: str, cols: list[str]) -> DataFrame:
    return df.select(F.col(key).cast("string").alias("__key"), *[F.col(c).cast("double").alias(f"__x{i}")
                                                                 for i, c in enumerate(cols)])


def fit_scales(rows: DataFrame, p: int) -> dict[object, Scale]:
    """Means and deviations by key, around the overall means so that sums of squares stay accurate."""
    n_keys = rows.select("__key").distinct().count()
    r = rows.agg(*[F.avg(f"__x{i}").alias(f"m{i}") for i in range(p)]).first()
    about = np.array([float(r[f"m{i}"] or 0.0) for i in range(p)])

    def block(_, x):
        d = x - about
        known = ~np.isnan(d)
        d = np.where(known, d, 0.0)
        return np.concatenate(([len(x)], known.sum(0), d.sum(0), (d * d).sum(0))).astype(float)

    out = {}
    for key, s in keyed_sums(rows, block, 1 + 3 * p, n_keys).items():
        n, m, sq = s[1:1 + p], s[1 + p:1 + 2 * p], s[1 + 2 * p:]
        mean = np.divide(m, n, out=np.zeros(p), where=n > 0)
        var = np.divide(sq - n * mean * mean, n - 1, out=np.zeros(p), where=n > 1)
        sd = np.sqrt(np.maximum(var, 0.0))
        out[key] = Scale(float(s[0]), about + mean, np.where(sd > 1e-9 * np.maximum(np.abs(about + mean), 1e-300), sd, 1.0))
    return out


def _standard(x: np.ndarray, s: Scale) -> np.ndarray:
    z = (x - s.mean) / s.sd
    return np.where(np.isnan(z), 0.0, z)


def _scored(df: DataFrame, key: str, cols: list[str], score: Callable, schema: str) -> DataFrame:
    """``df`` with the columns of ``schema``, made by ``score(key, matrix) -> list of arrays`` for each key's rows."""
    added = T._parse_datatype_string(schema)
    out_schema = T.StructType(df.schema.fields + added.fields)
    n, names, types = len(df.columns), [f.name for f in added.fields], [to_arrow_type(f.dataType) for f in added.fields]

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            given = pa.RecordBatch.from_arrays(batch.columns[n:], names=batch.schema.names[n:])
            x, order, found = _matrix(given), [], None
            for k, at in _by_key(given):
                own = score(k, x[at])
                order.append(at)
                found = [[c] for c in own] if found is None else [f + [c] for f, c in zip(found, own)]
            back = np.argsort(np.concatenate(order), kind="stable")
            cols_out = [pa.array([v for part in f for v in part] if isinstance(f[0], list) else np.concatenate(f), t)
                        for f, t in zip(found, types)]
            yield pa.RecordBatch.from_arrays(list(batch.columns[:n]) + [c.take(pa.array(back)) for c in cols_out],
                                             names=list(batch.schema.names[:n]) + names)

    inputs = [F.col(key).cast("string").alias("__key")] + [F.col(c).cast("double").alias(f"__x{i}") for i, c in enumerate(cols)]
    return df.select(*df.columns, *inputs).mapInArrow(run, out_schema)


# --------------------------------------------------------------------- regression
def regression_over(df: DataFrame, key: str, target: str, cols: list[str], name: str = "prediction") -> DataFrame:
    """``df`` with the prediction of ``target`` by a linear model of its own partition.

    Rows with a NULL target are scored but not fitted; a partition without targets predicts NULL, one
    with a constant target or fewer rows than predictors gets the least-norm fit.
    """
    p = len(cols)
    rows = _prepared(df, key, [target] + cols).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        scales = fit_scales(rows, p + 1)

        def block(k, x):
            s = scales[k]
            z = _standard(x[~np.isnan(x[:, 0])], s)
            m = np.column_stack((np.ones(len(z)), z[:, 1:], z[:, 0]))
            return (m.T @ m).ravel()

        grams = keyed_sums(rows, block, (p + 2) ** 2, len(scales))
    finally:
        rows.unpersist()
    betas = {}
    for k, flat in grams.items():
        a = flat.reshape(p + 2, p + 2)
        if a[0, 0] > 0:
            betas[k] = np.linalg.lstsq(a[:-1, :-1], a[:-1, -1], rcond=1e-10)[0]

    def score(k, x):
        if k not in betas:
            return [np.full(len(x), np.nan)]
        s = scales[k]
        z = _standard(x, Scale(s.n, s.mean[1:], s.sd[1:]))
        return [(betas[k][0] + z @ betas[k][1:]) * s.sd[0] + s.mean[0]]

    out = _scored(df, key, cols, score, f"`{name}` double")
    return out.withColumn(name, F.nanvl(F.col(name), F.lit(None).cast("double")))


# --------------------------------------------------------------------- features
@dataclass
class PartitionFeatures:
    cols: list
    key: str
    scales: dict
    axes: dict    # key -> p x k, columns are features
    values: dict  # key -> variances of all features

    def variances(self, spark) -> DataFrame:
        """Partition, feature, variance, its share and the share of all features so far."""
        rows = []
        for k, v in self.values.items():
            total = float(v.sum())
            share = v / total if total > 0 else np.zeros(len(v))
            rows += [(k, i + 1, float(v[i]), float(share[i]), float(share[:i + 1].sum())) for i in range(len(v))]
        return spark.createDataFrame(rows, "partition_name string, feature_id int, variance double, share double, "
                                           "cumulative_share double")

    def loadings(self, spark) -> DataFrame:
        rows = [(k, i + 1, c, float(a[j, i])) for k, a in self.axes.items() for i in range(a.shape[1])
                for j, c in enumerate(self.cols)]
        return spark.createDataFrame(rows, "partition_name string, feature_id int, attribute_name string, value double")

    def feature_set(self, df: DataFrame, top_n: int, name: str = "features") -> DataFrame:
        """``df`` with the ``top_n`` features of largest absolute value: array of (feature_id, value)."""
        axes, scales = self.axes, self.scales

        def score(k, x):
            if k not in axes:
                return [[[] for _ in x]]
            f = _standard(x, scales[k]) @ axes[k]
            best = np.argsort(-np.abs(f), axis=1, kind="stable")[:, :top_n]
            return [[[{"feature_id": int(i) + 1, "value": float(row[i])} for i in top] for row, top in zip(f, best)]]

        return _scored(df, self.key, self.cols, score, f"`{name}` array<struct<feature_id:int,value:double>>")


def features_over(df: DataFrame, key: str, cols: list[str], k: int) -> PartitionFeatures:
    """PCA of the standardized columns of every partition; signs make each axis' largest loading positive."""
    p = len(cols)
    rows = _prepared(df, key, cols).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        scales = fit_scales(rows, p)

        def block(key, x):
            z = _standard(x, scales[key])
            return (z.T @ z).ravel()

        grams = keyed_sums(rows, block, p * p, len(scales))
    finally:
        rows.unpersist()
    axes, values = {}, {}
    for key_value, flat in grams.items():
        v, a = np.linalg.eigh(flat.reshape(p, p) / max(scales[key_value].n - 1, 1))
        v, a = np.maximum(v[::-1], 0.0), a[:, ::-1]
        a = a * np.where(a[np.abs(a).argmax(0), np.arange(p)] < 0, -1.0, 1.0)
        axes[key_value], values[key_value] = a[:, :k].copy(), v
    return PartitionFeatures(list(cols), key, scales, axes, values)


# --------------------------------------------------------------------- clustering
@dataclass
class PartitionClusters:
    cols: list
    key: str
    scales: dict
    centers: dict  # key -> clusters x p, standardized
    sizes: dict
    iterations: dict
    converged: dict

    def cluster_id(self, df: DataFrame, name: str = "cluster_id") -> DataFrame:
        """``df`` with the nearest cluster of its partition (from 1; ties to the smaller) and the distance."""
        centers, scales = self.centers, self.scales

        def score(k, x):
            if k not in centers:
                return [np.zeros(len(x), np.int32), np.full(len(x), np.nan)]
            d = _distances(_standard(x, scales[k]), centers[k])
            near = d.argmin(1)
            return [(near + 1).astype(np.int32), np.sqrt(d[np.arange(len(x)), near])]

        return _scored(df, self.key, self.cols, score, f"`{name}` int, `{name}_distance` double")


def _distances(z: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return ((z[:, None, :] - centers[None]) ** 2).sum(2)


def clusters_over(df: DataFrame, key: str, cols: list[str], k: int, max_iter: int = 100, tol: float = 1e-4) -> PartitionClusters:
    """k-means of the standardized columns of every partition, ``CLUSTER_ID(INTO k USING ..) OVER (PARTITION BY key)``.

    Centres start along the partition's first principal axis, at evenly spaced places of its spread.
    Every Lloyd step of all partitions is one pass; a partition is done when no centre moves by more
    than ``tol``.  An empty cluster keeps its centre.
    """
    p = len(cols)
    first = features_over(df, key, cols, 1)
    places = np.linspace(-1.5, 1.5, k) if k > 1 else np.zeros(1)
    centers = {key_value: places[:, None] * np.sqrt(first.values[key_value][0]) * a[:, 0][None, :]
               for key_value, a in first.axes.items()}
    scales = first.scales
    live, iterations, sizes = set(centers), dict.fromkeys(centers, 0), {}
    rows = hold(_prepared(df, key, cols))
    try:
        for _ in range(max_iter):
            def block(key_value, x, live=frozenset(live), centers=dict(centers)):
                if key_value not in live:
                    return None
                z = _standard(x, scales[key_value])
                member = np.zeros((len(z), k))
                member[np.arange(len(z)), _distances(z, centers[key_value]).argmin(1)] = 1.0
                return np.concatenate((member.sum(0), (member.T @ z).ravel()))

            for key_value, s in keyed_sums(rows, block, k * (p + 1), len(live)).items():
                n, sums = s[:k], s[k:].reshape(k, p)
                new = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centers[key_value])
                moved = np.abs(new - centers[key_value]).max()
                centers[key_value], sizes[key_value] = new, n
                iterations[key_value] += 1
                if moved <= tol:
                    live.discard(key_value)
            if not live:
                break
    finally:
        rows.unpersist()
    return PartitionClusters(list(cols), key, scales, centers, sizes, iterations, {x: x not in live for x in centers})


# --------------------------------------------------------------------- anomaly
@dataclass
class OneClassState:
    w: np.ndarray
    rho: float
    objective: float = float("inf")
    step: np.ndarray | None = None
    iterations: int = 0
    converged: bool = False
    scale: float = 1.0
    outliers: float = 0.0


@dataclass
class PartitionAnomalies:
    cols: list
    key: str
    scales: dict
    states: dict
    W: np.ndarray
    b: np.ndarray
    nu: float = 0.1
    details_n: int = 3
    settings: dict = field(default_factory=dict)

    def models(self, spark) -> DataFrame:
        """Partition, rows, iterations, convergence, threshold and the share of rows below it."""
        rows = [(k, int(self.scales[k].n), s.iterations, "YES" if s.converged else "NO", s.rho, s.outliers)
                for k, s in self.states.items()]
        return spark.createDataFrame(rows, "partition_name string, num_rows long, iterations int, converged string, "
                                           "rho double, outlier_share double")

    def score(self, df: DataFrame) -> DataFrame:
        """``df`` with anomaly_probability (of class 0) and details: the attributes that raise it most.

        An attribute's weight is how much the decision rises when the attribute is set to its mean.
        """
        states, scales, W, b, cols, top = self.states, self.scales, self.W, self.b, self.cols, self.details_n

        def score(k, x):
            s, z = states[k], _standard(x, scales[k])
            decision = _features(z, W, b) @ s.w - s.rho
            drop = np.empty_like(z)
            for j in range(z.shape[1]):
                masked = z.copy()
                masked[:, j] = 0.0
                drop[:, j] = _features(masked, W, b) @ s.w - s.rho - decision
            best = np.argsort(-drop, axis=1, kind="stable")[:, :top]
            details = [[{"attribute": cols[j], "actual_value": None if np.isnan(x[i, j]) else float(x[i, j]),
                         "weight": float(drop[i, j]), "rank": r + 1} for r, j in enumerate(js)] for i, js in enumerate(best)]
            return [1 / (1 + np.exp(np.clip(decision / s.scale, -500, 500))), details]

        return _scored(df, self.key, self.cols, score,
                       "anomaly_probability double, anomaly_details "
                       "array<struct<attribute:string,actual_value:double,weight:double,rank:int>>")


def _features(z: np.ndarray, W: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(2.0 / len(b)) * np.cos(z @ W.T + b)


SMOOTH = (0.05, 0.01, 0.002)  # widths over which the hinge turns from 0 to its slope, one after the other


def _one_class_block(phi: np.ndarray, w: np.ndarray, rho: float, smooth: float) -> np.ndarray:
    """Loss, slopes and curvature of the smoothed hinge over some rows, and moments of their scores."""
    score = phi @ w
    z = rho - score
    slope = np.clip(z / smooth, 0.0, 1.0)
    loss = np.where(z >= smooth, z - smooth / 2, np.maximum(z, 0.0) ** 2 / (2 * smooth))
    bent = phi[(z > 0) & (z < smooth)]
    return np.concatenate(([len(phi), loss.sum(), slope.sum(), len(bent), score.sum(), (score ** 2).sum(), (z > 0).sum()],
                           slope @ phi, bent.sum(0), (bent.T @ bent).ravel()))


def anomalies_over(df: DataFrame, key: str, cols: list[str], outlier_rate: float = 0.1, n_features: int = 64,
                   gamma: float | None = None, max_iter: int = 100, tol: float = 1e-6, seed: int = 0) -> PartitionAnomalies:
    """One-class SVM of every partition, ``PREDICTION(OF ANOMALY USING ..) OVER (PARTITION BY key)``.

    Minimizes nu/2 |w|^2 - nu rho + mean H(rho - w phi(x)) with random Fourier features phi of the
    Gaussian kernel and a hinge H smoothed over the widths ``SMOOTH``, each fit starting at the one
    before.  One pass gives every partition its value, gradient and Hessian; each takes its own Newton
    step, halved until the value falls, and stops when its gradient is below ``tol``.  ``max_iter``
    bounds the passes of one width; a partition that meets it is not CONVERGED.
    """
    if not 0.0 < outlier_rate < 1.0:
        raise ValueError("outlier_rate must be in (0, 1)")
    p, d, nu = len(cols), n_features, outlier_rate
    rng = np.random.default_rng(seed)
    W = rng.normal(0.0, np.sqrt(2.0 * (gamma or 1.0 / p)), size=(d, p))
    b = rng.uniform(0.0, 2 * np.pi, size=d)
    rows = hold(_prepared(df, key, cols))
    try:
        scales = fit_scales(rows, p)
        states = {}
        for k, s in keyed_sums(rows, lambda k, x: _features(_standard(x, scales[k]), W, b).sum(0), d, len(scales)).items():
            mean = s / scales[k].n
            states[k] = OneClassState(mean, float(mean @ mean))
        width = 7 + 2 * d + d * d
        for smooth in SMOOTH:
            trial = {k: (s.w, s.rho) for k, s in states.items()}
            for s in states.values():
                s.objective, s.step, s.converged = float("inf"), None, False
            for _ in range(max_iter):
                def block(k, x, at=dict(trial), smooth=smooth):
                    return None if k not in at else _one_class_block(_features(_standard(x, scales[k]), W, b), *at[k], smooth)

                sums, trial = keyed_sums(rows, block, width, len(states)), {}
                for k, s in sums.items():
                    own = _newton(states[k], s, nu, d, tol, smooth)
                    if own is not None:
                        trial[k] = own
                if not trial:
                    break

        def last(k, x):
            return _one_class_block(_features(_standard(x, scales[k]), W, b), states[k].w, states[k].rho, SMOOTH[-1])[:7]

        for k, s in keyed_sums(rows, last, 7, len(states)).items():
            n, mean = s[0], s[4] / s[0]
            states[k].scale = float(np.sqrt(max((s[5] - n * mean * mean) / max(n - 1, 1), 0.0))) or 1.0
            states[k].outliers = float(s[6] / n)
    finally:
        rows.unpersist()
    return PartitionAnomalies(list(cols), key, scales, states, W, b, nu)


def _newton(state: OneClassState, s: np.ndarray, nu: float, d: int, tol: float, smooth: float):
    """Judge the tried point by its sums and return the next point to try; None when done."""
    n = s[0]
    w, rho = (state.w, state.rho) if state.step is None else (state.w + state.step[:d], state.rho + float(state.step[d]))
    value = nu / 2 * w @ w - nu * rho + s[1] / n
    state.iterations += 1
    if state.step is not None and value > state.objective - 1e-14 * max(abs(value), 1.0):
        state.step = state.step / 2
        if np.abs(state.step).max() < 1e-10:  # no digit left to gain
            state.converged = True
            return None
        return state.w + state.step[:d], state.rho + float(state.step[d])
    state.w, state.rho, state.objective = w, rho, value
    gradient = np.append(nu * w - s[7:7 + d] / n, s[2] / n - nu)
    if np.abs(gradient).max() <= tol:
        state.converged = True
        return None
    hessian = np.zeros((d + 1, d + 1))
    hessian[:d, :d] = s[7 + 2 * d:].reshape(d, d) / (n * smooth) + nu * np.eye(d)
    hessian[:d, d] = hessian[d, :d] = -s[7 + d:7 + 2 * d] / (n * smooth)
    hessian[d, d] = s[3] / (n * smooth) + 1e-6
    step = -np.linalg.solve(hessian, gradient)
    state.step = step * min(1.0, 0.25 / max(abs(step[d]), 1e-300))
    return state.w + state.step[:d], state.rho + float(state.step[d])
