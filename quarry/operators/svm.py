"""Support vector classification with coefficients, a Gaussian kernel and calibrated probabilities.

The primal problem with squared hinge,

    min  reg/2 |w|^2 + 1/(2 sum c) sum c max(0, 1 - y (w phi(x) + b))^2,

is solved by Newton steps.  One step of all machines - one for two classes, one against the rest for
more - is ONE pass: every task adds up value, gradient and Hessian of its rows in numpy, Spark adds
the tasks' blocks.  phi are the standardized attributes and level indicators (linear), or the Nystroem
features of a Gaussian kernel on ``pivots`` rows of the table.  Sigmoids over the decision values
are then fitted by Newton steps of the same kind on Platt's smoothed targets.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.linear import sum_blocks
from quarry.operators.selection import TermDesign, fit_terms
from quarry.plans.model import MiningModel

MAX_CLASSES = 100


@dataclass
class Nystroem:
    """Features whose products approximate exp(-gamma |x - z|^2) through ``pivots``."""
    pivots: np.ndarray
    gamma: float
    root: np.ndarray  # pivots x features

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return _kernel(x, self.pivots, self.gamma) @ self.root


def _kernel(x: np.ndarray, z: np.ndarray, gamma: float) -> np.ndarray:
    d = (x * x).sum(1)[:, None] + (z * z).sum(1)[None] - 2 * x @ z.T
    return np.exp(-gamma * np.maximum(d, 0.0))


def nystroem(pivots: np.ndarray, gamma: float) -> Nystroem:
    v, a = np.linalg.eigh(_kernel(pivots, pivots, gamma))
    keep = v > 1e-8 * v.max()
    return Nystroem(pivots, gamma, a[:, keep] / np.sqrt(v[keep]))


def _same(x: np.ndarray) -> np.ndarray:
    return x


# --------------------------------------------------------------------- Newton steps over blocks
@dataclass
class Fit:
    beta: np.ndarray
    value: float = float("inf")
    step: np.ndarray | None = None
    iterations: int = 0
    converged: bool = False


def minimize(sums: Callable, fits: list[Fit], penalties: list[np.ndarray], max_iter: int, tol: float) -> None:
    """Newton steps of several smooth convex problems at once.

    ``sums(points)`` gives (value, gradient, Hessian) of each problem's data term at its point, all
    from one pass; ``penalties`` are the diagonals of the quadratic terms.  A step is halved until the
    value falls; a problem ends when its gradient is below ``tol``.
    """
    for _ in range(max_iter):
        live = [i for i, f in enumerate(fits) if not f.converged]
        if not live:
            return
        points = {i: fits[i].beta if fits[i].step is None else fits[i].beta + fits[i].step for i in live}
        for i, (value, gradient, hessian) in sums(points).items():
            f, p, x = fits[i], penalties[i], points[i]
            value += 0.5 * float(p @ (x * x))
            f.iterations += 1
            if f.step is not None and value > f.value + 1e-14 * max(abs(f.value), 1.0):
                f.step = f.step / 2
                f.converged = bool(np.abs(f.step).max() < 1e-12)
                continue
            f.beta, f.value = x, value
            gradient = gradient + p * x
            if np.abs(gradient).max() <= tol:
                f.converged, f.step = True, None
                continue
            f.step = -np.linalg.lstsq(hessian + np.diag(p), gradient, rcond=1e-12)[0]


# --------------------------------------------------------------------- model
@dataclass
class Scorer:
    """What a task needs to score rows."""
    features: Callable
    betas: list
    sigmoids: list
    classes: int

    def decisions(self, x: np.ndarray) -> np.ndarray:
        phi = self.features(x)
        return np.column_stack([phi @ b[:-1] + b[-1] for b in self.betas])

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """Rows x classes, calibrated; with two classes the machine speaks for the second."""
        d = self.decisions(x)
        p = np.column_stack([1 / (1 + np.exp(-np.clip(a * d[:, i] + b, -500, 500))) for i, (a, b) in enumerate(self.sigmoids)])
        if self.classes == 2:
            return np.column_stack((1 - p[:, 0], p[:, 0]))
        total = p.sum(1, keepdims=True)
        return np.where(total > 0, p / np.where(total > 0, total, 1.0), 1.0 / self.classes)


@dataclass
class SVMModel(MiningModel):
    design: TermDesign | None = None
    features: Callable = _same
    classes: list = field(default_factory=list)
    machines: list = field(default_factory=list)   # Fit per machine, the bias last
    sigmoids: list = field(default_factory=list)   # (slope, offset) per machine
    target_type: T.DataType | None = None

    def scorer(self) -> Scorer:
        return Scorer(self.features, [f.beta for f in self.machines], list(self.sigmoids), len(self.classes))

    def score(self, df: DataFrame) -> DataFrame:
        """``df`` with prediction (of the target's type), its probability, and prediction_set over all classes.

        The set is an array of (prediction, probability), most probable first; ties go to the smaller class.
        """
        names, n = [str(c) for c in self.classes], len(df.columns)
        inputs = [c.cast("double").alias(f"__x{i}") for i, c in enumerate(self.design.columns(df))]
        sets = pa.list_(pa.struct([("prediction", pa.string()), ("probability", pa.float64())]))
        schema = T.StructType(df.schema.fields + T._parse_datatype_string(
            "prediction string, probability double, prediction_set array<struct<prediction:string,probability:double>>").fields)
        scorer = self.scorer()

        def run(batches):
            for batch in batches:
                if not batch.num_rows:
                    continue
                p = scorer.probabilities(np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[n:]]))
                order = np.argsort(-p, axis=1, kind="stable")
                best = p[np.arange(len(p)), order[:, 0]]
                every = [[{"prediction": names[j], "probability": float(p[i, j])} for j in o] for i, o in enumerate(order)]
                yield pa.RecordBatch.from_arrays(
                    list(batch.columns[:n]) + [pa.array([names[j] for j in order[:, 0]], pa.string()), pa.array(best),
                                               pa.array(every, sets)], names=schema.fieldNames())

        out = df.select(*df.columns, *inputs).mapInArrow(run, schema)
        return out.withColumn("prediction", F.col("prediction").cast(self.target_type))

    def coefficients_df(self, spark: SparkSession) -> DataFrame:
        """Target value, attribute, its level and coefficient; the bias has a NULL attribute.  Linear models only."""
        if self.features is not _same:
            raise ValueError("a kernel model has no attribute coefficients")
        rows = []
        for f, c in zip(self.machines, self.classes[1:] if len(self.classes) == 2 else self.classes):
            rows += [(str(c), a, v, float(b)) for (a, v), b in zip(self.design.names() + [(None, None)], f.beta)]
        return spark.createDataFrame(rows, "target_value string, attribute_name string, attribute_value string, "
                                           "coefficient double")

    def global_df(self, spark: SparkSession) -> DataFrame:
        done = all(f.converged for f in self.machines)
        return spark.createDataFrame(
            [("CONVERGED", None, "YES" if done else "NO"),
             ("ITERATIONS", float(max(f.iterations for f in self.machines)), None),
             ("OBJECTIVE", float(sum(f.value for f in self.machines)), None)],
            "name string, numeric_value double, string_value string")


class SVMClassifier:
    """``kernel`` is 'linear' or 'gaussian'; ``class_weights`` maps a target value to the weight of its rows."""

    DEFAULTS = {"SVMS_KERNEL_FUNCTION": "SVMS_LINEAR", "SVMS_NUM_PIVOTS": "200", "PREP_AUTO": "ON"}

    def __init__(self, target: str, numeric: list[str], categorical: list[str] | None = None, kernel: str = "linear",
                 class_weights: dict | None = None, reg: float = 1e-3, pivots: int = 200, gamma: float | None = None,
                 max_iter: int = 50, tol: float = 1e-8, name: str = "svm_model"):
        if kernel not in ("linear", "gaussian"):
            raise ValueError("kernel must be 'linear' or 'gaussian'")
        self.target, self.numeric, self.categorical = target, list(numeric), list(categorical or [])
        self.kernel, self.class_weights, self.reg, self.pivots = kernel, class_weights or {}, reg, pivots
        self.gamma, self.max_iter, self.tol, self.name = gamma, max_iter, tol, name

    def fit(self, df: DataFrame) -> SVMModel:
        spark = df.sparkSession
        data = df.filter(F.col(self.target).isNotNull())
        found = data.select(F.col(self.target).alias("t")).distinct().limit(MAX_CLASSES + 1).collect()
        classes = sorted(r.t for r in found)
        if not 2 <= len(classes) <= MAX_CLASSES:
            raise ValueError(f"{self.target} has {len(classes)} classes; 2 to {MAX_CLASSES} are needed")
        design = fit_terms(data, self.numeric, self.categorical, False)
        p = len(design.names())
        code = F.coalesce(*[F.when(F.col(self.target) == F.lit(c), F.lit(float(i))) for i, c in enumerate(classes)])
        rows = data.select(*[c.cast("double").alias(f"x{i}") for i, c in enumerate(design.columns(data))],
                           code.alias("y")).persist(StorageLevel.MEMORY_AND_DISK)
        m = SVMModel(name=self.name, function="CLASSIFICATION", algorithm="ALGO_SUPPORT_VECTOR_MACHINES", design=design,
                     classes=classes, target=self.target, target_type=df.schema[self.target].dataType,
                     settings={"SVMS_KERNEL_FUNCTION": f"SVMS_{self.kernel.upper()}"}, default_settings=dict(self.DEFAULTS),
                     signature=[(a, "NUMBER") for a in self.numeric] + [(a, "VARCHAR2") for a in self.categorical])
        try:
            if self.kernel == "gaussian":
                xs = [f"x{i}" for i in range(p)]
                some = rows.select(*xs).distinct().orderBy(F.xxhash64(*xs), *xs).limit(self.pivots).collect()
                m.features = nystroem(np.array([list(r) for r in some], float), self.gamma or 1.0 / max(p, 1))
            self._machines(m, rows, p)
            self._sigmoids(m, rows)
        finally:
            rows.unpersist()
        if self.kernel == "linear":
            m.add_view("C", lambda: m.coefficients_df(spark), "SVM Linear Coefficients")
        m.add_view("G", lambda: m.global_df(spark), "Global Name-Value Pairs")
        return m

    def _signs(self, m: SVMModel):
        """The class that each machine takes for its positive side."""
        return [1] if len(m.classes) == 2 else list(range(len(m.classes)))

    def _machines(self, m: SVMModel, rows: DataFrame, p: int) -> None:
        weights = np.array([float(self.class_weights.get(c, 1.0)) for c in m.classes])
        features, sides = m.features, self._signs(m)
        d = (p if features is _same else features.root.shape[1]) + 1
        counts = {int(r["y"]): r["count"] for r in rows.groupBy("y").count().collect()}
        total = sum(weights[i] * n for i, n in counts.items())

        def sums(points):
            def block(cols):
                phi = features(np.column_stack(cols[:-1]))
                phi = np.column_stack((phi, np.ones(len(phi))))
                y = cols[-1].astype(int)
                out = []
                for i, beta in points.items():
                    sign = np.where(y == sides[i], 1.0, -1.0)
                    gap = 1 - sign * (phi @ beta)
                    at = gap > 0
                    c, g, a = weights[y][at], gap[at], phi[at]
                    out += [[0.5 * (c * g * g).sum()], -(c * g * sign[at]) @ a, ((a * c[:, None]).T @ a).ravel()]
                return np.concatenate(out) / total

            flat, out = sum_blocks(rows, block), {}
            for at, i in enumerate(points):
                s = flat[at * (1 + d + d * d):(at + 1) * (1 + d + d * d)]
                out[i] = float(s[0]), s[1:1 + d], s[1 + d:].reshape(d, d)
            return out

        m.machines = [Fit(np.zeros(d)) for _ in sides]
        minimize(sums, m.machines, [np.append(np.full(d - 1, self.reg), 0.0)] * len(sides), self.max_iter, self.tol)

    def _sigmoids(self, m: SVMModel, rows: DataFrame) -> None:
        sides, scorer = self._signs(m), m.scorer()
        counts = {int(r["y"]): r["count"] for r in rows.groupBy("y").count().collect()}
        n = sum(counts.values())
        high = [(counts[s] + 1) / (counts[s] + 2) for s in sides]
        low = [1 / (n - counts[s] + 2) for s in sides]

        def sums(points):
            def block(cols):
                every, y, out = scorer.decisions(np.column_stack(cols[:-1])), cols[-1].astype(int), []
                for i, (a, b) in points.items():
                    x = np.column_stack((every[:, i], np.ones(len(y))))
                    t = np.where(y == sides[i], high[i], low[i])
                    z = a * every[:, i] + b
                    q = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
                    out += [[(np.logaddexp(0, z) - t * z).sum()], (q - t) @ x, ((x * (q * (1 - q))[:, None]).T @ x).ravel()]
                return np.concatenate(out) / n

            flat, out = sum_blocks(rows, block), {}
            for at, i in enumerate(points):
                s = flat[at * 7:(at + 1) * 7]
                out[i] = float(s[0]), s[1:3], s[3:].reshape(2, 2)
            return out

        fits = [Fit(np.array([1.0, 0.0])) for _ in sides]
        minimize(sums, fits, [np.zeros(2)] * len(sides), self.max_iter, 1e-10)
        m.sigmoids = [(float(f.beta[0]), float(f.beta[1])) for f in fits]
