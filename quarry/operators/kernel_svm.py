"""Gaussian-kernel SVM regression on random Fourier features.

The Gaussian kernel is approximated by D random Fourier features of the
standardized inputs (as in ``oneclass``); the target is standardized.  The
regression is linear in those features with the squared epsilon-insensitive
loss (L2-SVR):

    1/(2n) sum max(0, |y_i - w.phi_i - c| - eps)^2 + lambda/2 ||w||^2.

The rows outside the tube form a ridge least squares problem, so the fit is a
few Newton steps; each is one pass in which every partition adds up the Gram
sums of those rows (``linear.sum_blocks``) and a (D + 2)^2 block reaches the
driver.  Scoring is one SQL expression.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.scalar import _sql_double
from quarry.operators.linear import sum_blocks
from quarry.operators.neural import _q
from quarry.operators.prep import Normalizer, fit_normalizer
from quarry.plans.model import MiningModel


@dataclass
class KernelSVRModel(MiningModel):
    cols: list = field(default_factory=list)
    norm: Normalizer | None = None
    t_mean: float = 0.0
    t_std: float = 1.0
    W: np.ndarray | None = None   # D x p
    b: np.ndarray | None = None   # D
    w: np.ndarray | None = None   # D
    c: float = 0.0
    losses: list = field(default_factory=list)

    def features_sql(self, df: DataFrame | None = None) -> list[str]:
        xs = []
        for col in self.cols:
            sh, sc = _sql_double(self.norm.shift[col]), _sql_double(self.norm.scale[col])
            src = f"CAST({_q(col)} AS DOUBLE)" if df is None or col in df.columns else "CAST(NULL AS DOUBLE)"
            xs.append(f"((coalesce({src}, {sh}) - {sh}) / {sc})")
        amp = _sql_double(np.sqrt(2.0 / len(self.b)))
        return [f"{amp} * cos({_sql_double(self.b[d])} + " +
                " + ".join(f"{x} * {_sql_double(self.W[d, j])}" for j, x in enumerate(xs)) + ")"
                for d in range(len(self.b))]

    def predicted_value(self, df: DataFrame) -> Column:
        """PREDICTION in target units."""
        y = _sql_double(self.c) + " + " + " + ".join(
            f"({f}) * {_sql_double(self.w[d])}" for d, f in enumerate(self.features_sql(df)))
        return F.expr(f"({y}) * {_sql_double(self.t_std)} + {_sql_double(self.t_mean)}")


class KernelSVR:
    DEFAULTS = {"SVMS_KERNEL_FUNCTION": "SVMS_GAUSSIAN", "SVMS_EPSILON": "0.1", "PREP_AUTO": "ON"}

    def __init__(self, target: str, epsilon: float = 0.1, n_features: int = 64, gamma: float | None = None,
                 reg_lambda: float = 1e-3, max_iter: int = 60, seed: int = 0, name: str = "svr_model"):
        self.target, self.eps, self.D, self.gamma = target, epsilon, n_features, gamma
        self.lam, self.max_iter, self.seed, self.name = reg_lambda, max_iter, seed, name

    def fit(self, df: DataFrame, cols: list[str]) -> KernelSVRModel:
        data = df.filter(F.col(self.target).isNotNull())
        norm = fit_normalizer(data, cols + [self.target], "mean", "stddev")
        m = KernelSVRModel(name=self.name, function="REGRESSION", algorithm="ALGO_SUPPORT_VECTOR_MACHINES",
                           cols=list(cols), norm=norm, target=self.target,
                           t_mean=norm.shift[self.target], t_std=norm.scale[self.target],
                           settings={"SVMS_KERNEL_FUNCTION": "SVMS_GAUSSIAN", "SVMS_EPSILON": str(self.eps)},
                           default_settings=dict(self.DEFAULTS), signature=[(c, "NUMBER") for c in cols])
        rng = np.random.default_rng(self.seed)
        p, D = len(cols), self.D
        gamma = self.gamma or 1.0 / p
        m.W = rng.normal(0.0, np.sqrt(2.0 * gamma), size=(D, p))
        m.b = rng.uniform(0.0, 2 * np.pi, size=D)
        fn = [f"f{d}" for d in range(D)]
        feats = data.selectExpr(*[f"{f} AS f{d}" for d, f in enumerate(m.features_sql(data))],
                                f"(CAST({_q(self.target)} AS DOUBLE) - {_sql_double(m.t_mean)}) / "
                                f"{_sql_double(m.t_std)} AS t").persist(StorageLevel.MEMORY_AND_DISK)
        eps = self.eps
        try:
            def sums(w):
                """Loss sum, row count, and the Gram sums of the rows outside the tube, in one pass."""
                def block(columns):
                    x = np.column_stack((*columns[:-1], np.ones(len(columns[0]))))
                    e = x @ w - columns[-1]
                    r = np.sign(e) * np.maximum(np.abs(e) - eps, 0.0)
                    out = r != 0
                    rows = np.column_stack((x[out], columns[-1][out] + np.sign(e[out]) * eps))
                    return np.concatenate(((rows.T @ rows).ravel(), [r @ r, len(r)]))
                flat = sum_blocks(feats, block)
                flat = np.zeros((D + 2) ** 2 + 2) if flat is None else flat
                return flat[:-2].reshape(D + 2, D + 2), float(flat[-2]), max(float(flat[-1]), 1.0)

            ridge = np.append(np.full(D, self.lam), 0.0)  # the intercept is free

            def loss(total, n, w):
                return 0.5 * total / n + 0.5 * float(ridge @ (w * w))

            # Newton steps: the rows outside the tube form a ridge least squares problem
            w = np.zeros(D + 1)
            gram, total, n = sums(w)
            m.losses = [loss(total, n, w)]
            converged = False
            for _ in range(self.max_iter):
                left = gram[:-1, :-1] / n + np.diag(ridge + 1e-10)
                step = np.linalg.solve(left, gram[:-1, -1] / n) - w
                for _ in range(20):  # halved while the loss does not fall
                    gram, total, n = sums(w + step)
                    now = loss(total, n, w + step)
                    if now <= m.losses[-1] + 1e-12:
                        break
                    step = step / 2
                w = w + step
                m.losses.append(now)
                converged = abs(m.losses[-2] - now) <= 1e-9 * max(1.0, abs(now))
                if converged:
                    break
            m.settings["CONVERGED"] = str(converged)
            m.w, m.c = w[:D], float(w[-1])
        finally:
            feats.unpersist()
        return m
