"""One-class SVM (anomaly detection, NULL target) on random Fourier features.

The Gaussian kernel exp(-gamma ||x - y||^2) is approximated by D random
Fourier features phi(x) = sqrt(2 / D) cos(W x + b), W ~ N(0, 2 gamma), b ~
U(0, 2 pi) (Rahimi and Recht, 2007), on standardized numeric attributes
(missing -> mean).  ``kernel='linear'`` uses phi(x) = x.

The nu-one-class problem (Schoelkopf et al., 2001), scaled by nu,

    min_w,rho  nu/2 ||w||^2 + 1/n sum_i max(0, rho - w.phi_i) - nu rho,

is solved by full-batch Pegasos steps (lambda = nu, step 1/(lambda t)).
With w fixed, the optimal rho is the nu-quantile of the scores w.phi_i, so
every iteration is ONE Spark aggregate over the persisted feature table:
the sum of phi over rows scoring below the current rho, plus
``percentile_approx(score, nu)`` for the next rho.  The driver holds w (D
numbers); the plan never grows.  nu is the outlier rate (default 0.1).

Scoring is a projection: decision = w.phi(x) - rho; PREDICTION is 1
(typical) when decision >= 0 else 0; the probability of class 1 is
sigmoid(decision / s) with s the standard deviation of the training
decisions [design]; PREDICTION_DETAILS ranks attributes by how much the
decision rises when the attribute is set to its mean.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.scalar import _sql_double
from quarry.operators.prep import Normalizer, fit_normalizer
from quarry.plans.model import MiningModel
from quarry.session import hold


@dataclass
class OneClassSVMModel(MiningModel):
    cols: list = field(default_factory=list)
    norm: Normalizer | None = None
    kernel: str = "gaussian"
    W: np.ndarray | None = None      # D x p (gaussian)
    b: np.ndarray | None = None      # D
    w: np.ndarray | None = None      # D (or p for linear)
    rho: float = 0.0
    scale: float = 1.0
    history: list = field(default_factory=list)

    # expressions are emitted as SQL text: one JVM call per expression, not one per term
    def _x_sql(self, df: DataFrame, drop: str | None = None) -> list[str]:
        xs = []
        for c in self.cols:
            if c == drop or c not in df.columns:
                xs.append("0D")
                continue
            sh, sc = _sql_double(self.norm.shift[c]), _sql_double(self.norm.scale[c])
            q = "`" + c.replace("`", "``") + "`"
            xs.append(f"((coalesce(CAST({q} AS DOUBLE), {sh}) - {sh}) / {sc})")
        return xs

    def features_sql(self, xs: list[str]) -> list[str]:
        if self.kernel == "linear":
            return xs
        amp = _sql_double(np.sqrt(2.0 / len(self.b)))
        return [f"{amp} * cos({_sql_double(self.b[d])} + " +
                " + ".join(f"{x} * {_sql_double(self.W[d, j])}" for j, x in enumerate(xs)) + ")"
                for d in range(len(self.b))]

    def score_sql(self, phi: list[str]) -> str:
        return " + ".join(f"({f}) * {_sql_double(wd)}" for f, wd in zip(phi, self.w))

    def decision(self, df: DataFrame, drop: str | None = None) -> Column:
        """w.phi(x) - rho: >= 0 typical, < 0 anomalous."""
        return F.expr(f"({self.score_sql(self.features_sql(self._x_sql(df, drop)))}) - {_sql_double(self.rho)}")

    def prediction(self, df: DataFrame) -> Column:
        """PREDICTION: 1 = typical, 0 = anomaly."""
        return F.when(self.decision(df) >= 0, F.lit(1)).otherwise(F.lit(0))

    def prediction_probability(self, df: DataFrame, cls: int = 1) -> Column:
        p1 = F.lit(1.0) / (F.lit(1.0) + F.exp(-self.decision(df) / F.lit(self.scale)))
        return p1 if cls == 1 else F.lit(1.0) - p1

    def prediction_details(self, df: DataFrame, top_n: int = 5) -> Column:
        """Top attributes pushing a row toward anomaly: decision(x with attribute at its mean) - decision(x).

        array<struct<attribute, actual_value, weight, rank>>, largest weight first.
        """
        full = self.decision(df)
        parts = [F.struct(F.lit(c).alias("attribute"),
                          F.col(c).cast("double").alias("actual_value") if c in df.columns
                          else F.lit(None).cast("double").alias("actual_value"),
                          (self.decision(df, drop=c) - full).alias("weight"))
                 for c in self.cols]
        arr = F.array_sort(F.array(*parts), lambda a, b: F.when(a["weight"] > b["weight"], -1)
                           .when(a["weight"] < b["weight"], 1)
                           .when(a["attribute"] < b["attribute"], -1)
                           .when(a["attribute"] > b["attribute"], 1).otherwise(0))
        ranked = F.transform(F.slice(arr, 1, top_n), lambda e, i: F.struct(
            e["attribute"].alias("attribute"), e["actual_value"].alias("actual_value"),
            e["weight"].alias("weight"), (i + 1).alias("rank")))
        return ranked


class OneClassSVM:
    DEFAULTS = {"SVMS_OUTLIER_RATE": "0.1", "SVMS_KERNEL_FUNCTION": "SVMS_GAUSSIAN", "PREP_AUTO": "ON"}

    def __init__(self, outlier_rate: float = 0.1, kernel: str = "gaussian", n_features: int = 64,
                 gamma: float | None = None, max_iter: int = 20, seed: int = 0, accuracy: int = 10000,
                 name: str = "svmo_model"):
        if not 0.0 < outlier_rate < 1.0:
            raise ValueError("outlier_rate must be in (0, 1)")
        if kernel not in ("gaussian", "linear"):
            raise ValueError("kernel must be 'gaussian' or 'linear'")
        self.nu, self.kernel, self.D, self.gamma = outlier_rate, kernel, n_features, gamma
        self.max_iter, self.seed, self.accuracy, self.name = max_iter, seed, accuracy, name

    def fit(self, df: DataFrame, cols: list[str]) -> OneClassSVMModel:
        p = len(cols)
        m = OneClassSVMModel(name=self.name, function="CLASSIFICATION", algorithm="ALGO_SUPPORT_VECTOR_MACHINES",
                             cols=list(cols), norm=fit_normalizer(df, cols, "mean", "stddev"), kernel=self.kernel,
                             settings={"SVMS_OUTLIER_RATE": str(self.nu),
                                       "SVMS_KERNEL_FUNCTION": "SVMS_GAUSSIAN" if self.kernel == "gaussian"
                                       else "SVMS_LINEAR"},
                             default_settings=dict(self.DEFAULTS), signature=[(c, "NUMBER") for c in cols])
        rng = np.random.default_rng(self.seed)
        if self.kernel == "gaussian":
            gamma = self.gamma or 1.0 / p  # standardized inputs
            m.W = rng.normal(0.0, np.sqrt(2.0 * gamma), size=(self.D, p))
            m.b = rng.uniform(0.0, 2 * np.pi, size=self.D)
        phi = m.features_sql(m._x_sql(df))
        D = len(phi)
        fnames = [f"f{d}" for d in range(D)]
        feats = hold(df.selectExpr(*[f"{f} AS f{d}" for d, f in enumerate(phi)]))
        q = f"percentile_approx(s, {_sql_double(self.nu)}, {int(self.accuracy)})"
        try:
            n = feats.count()
            # start: mean feature direction, rho from its scores
            mean = feats.selectExpr(*[f"avg({f})" for f in fnames]).collect()[0]
            w = np.array([float(v or 0.0) for v in mean])
            lam = self.nu
            w_avg = np.zeros(D)
            m.w = w
            rho = float(feats.selectExpr(f"{m.score_sql(fnames)} AS s").selectExpr(q).collect()[0][0])
            for t in range(1, self.max_iter + 1):
                m.w = w
                lo = _sql_double(rho)
                r = feats.selectExpr(f"{m.score_sql(fnames)} AS s", *fnames).selectExpr(
                    *[f"sum(CASE WHEN s < {lo} THEN {f} ELSE 0D END)" for f in fnames], q).collect()[0]
                g_hinge = np.array([float(r[d] or 0.0) for d in range(D)]) / n
                eta = 1.0 / (lam * t)
                w = (1.0 - eta * lam) * w + eta * g_hinge
                w_avg += (w - w_avg) / t
                rho = float(r[D])
                m.history.append(rho)
            m.w = w_avg  # averaged iterate
            r = feats.selectExpr(f"{m.score_sql(fnames)} AS s").selectExpr(
                f"{q} AS q", "stddev_samp(s) AS sd").collect()[0]
            m.rho = float(r["q"])
            m.scale = float(r["sd"]) if r["sd"] else 1.0
        finally:
            feats.unpersist()
        return m
