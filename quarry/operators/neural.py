"""Neural-network regression: one hidden layer, full-batch L-BFGS.

Spark ML's multilayer perceptron is a classifier only, so regression is
built here.  Inputs and target are standardized (mean / sample stddev, missing
input -> mean); the network is

    h_k = sigmoid(b_k + sum_j W_kj x_j),   y = c + sum_k v_k h_k

(logistic-sigmoid hidden units, linear output).  The loss is
1/(2n) sum (y - t)^2 + lambda/2 (||W||^2 + ||v||^2).  One loss-and-gradient
evaluation is one pass over the persisted prepared rows in which every partition
adds up its own block of H (p + 2) + 2 sums (``linear.sum_blocks``); the optimizer is a
small L-BFGS (two-loop recursion, Armijo backtracking) on the driver over
the H (p + 2) + 1 weights.  Initial weights are seeded (``seed``).
Scoring is one SQL expression (a projection).
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.scalar import _sql_double
from quarry.operators.linear import SMALL_BLOCK, sum_blocks
from quarry.operators.prep import Normalizer, fit_normalizer
from quarry.plans.model import MiningModel
from quarry.session import hold


def _q(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


@dataclass
class NeuralRegressionModel(MiningModel):
    cols: list = field(default_factory=list)
    norm: Normalizer | None = None
    t_mean: float = 0.0
    t_std: float = 1.0
    W: np.ndarray | None = None   # H x p
    b: np.ndarray | None = None   # H
    v: np.ndarray | None = None   # H
    c: float = 0.0
    losses: list = field(default_factory=list)

    def _x_sql(self, df: DataFrame | None = None) -> list[str]:
        out = []
        for col in self.cols:
            sh, sc = _sql_double(self.norm.shift[col]), _sql_double(self.norm.scale[col])
            src = f"CAST({_q(col)} AS DOUBLE)" if df is None or col in df.columns else "CAST(NULL AS DOUBLE)"
            out.append(f"((coalesce({src}, {sh}) - {sh}) / {sc})")
        return out

    def _hidden_sql(self, xs: list[str]) -> list[str]:
        return [f"(1D / (1D + exp(-({_sql_double(self.b[k])} + " +
                " + ".join(f"{x} * {_sql_double(self.W[k, j])}" for j, x in enumerate(xs)) + "))))"
                for k in range(len(self.b))]

    def predicted_value(self, df: DataFrame) -> Column:
        """PREDICTION in target units."""
        hs = self._hidden_sql(self._x_sql(df))
        y = _sql_double(self.c) + " + " + " + ".join(f"{h} * {_sql_double(self.v[k])}" for k, h in enumerate(hs))
        return F.expr(f"({y}) * {_sql_double(self.t_std)} + {_sql_double(self.t_mean)}")


def lbfgs(fg, w0: np.ndarray, max_iter: int = 100, history: int = 10, gtol: float = 1e-5):
    """Minimize f with gradient ``fg(w) -> (f, g)``; returns (w, [f per iteration])."""
    w = w0.copy()
    f, g = fg(w)
    S, Y, out = [], [], [f]
    for _ in range(max_iter):
        if np.linalg.norm(g) < gtol:
            break
        q = g.copy()
        alphas = []
        for s, y in reversed(list(zip(S, Y))):
            a = s.dot(q) / y.dot(s)
            alphas.append(a)
            q -= a * y
        if S:
            q *= S[-1].dot(Y[-1]) / Y[-1].dot(Y[-1])
        for (s, y), a in zip(zip(S, Y), reversed(alphas)):
            q += s * (a - y.dot(q) / y.dot(s))
        d = -q
        if d.dot(g) >= 0:  # not a descent direction: restart from steepest descent
            S, Y, d = [], [], -g
        step = 1.0
        while True:
            w_new = w + step * d
            f_new, g_new = fg(w_new)
            if f_new <= f + 1e-4 * step * d.dot(g) or step < 1e-10:
                break
            step *= 0.5
        s, y = w_new - w, g_new - g
        if y.dot(s) > 1e-12:
            S.append(s)
            Y.append(y)
            if len(S) > history:
                S.pop(0)
                Y.pop(0)
        converged = abs(f - f_new) <= 1e-9 * max(1.0, abs(f))
        w, f, g = w_new, f_new, g_new
        out.append(f)
        if converged:
            break
    return w, out


class NeuralRegression:
    DEFAULTS = {"NNET_HIDDEN_LAYERS": "1", "NNET_ACTIVATIONS": "NNET_ACTIVATIONS_LOG_SIG",
                "NNET_ITERATIONS": "100", "ODMS_RANDOM_SEED": "0", "PREP_AUTO": "ON"}

    def __init__(self, target: str, hidden: int = 10, max_iter: int = 100, reg_lambda: float = 1e-4,
                 seed: int = 0, name: str = "nn_model"):
        self.target, self.H, self.max_iter, self.lam, self.seed, self.name = \
            target, hidden, max_iter, reg_lambda, seed, name

    def fit(self, df: DataFrame, cols: list[str]) -> NeuralRegressionModel:
        data = df.filter(F.col(self.target).isNotNull())
        norm = fit_normalizer(data, cols + [self.target], "mean", "stddev")
        m = NeuralRegressionModel(name=self.name, function="REGRESSION", algorithm="ALGO_NEURAL_NETWORK",
                                  cols=list(cols), norm=norm, target=self.target,
                                  t_mean=norm.shift[self.target], t_std=norm.scale[self.target],
                                  settings={"NNET_NODES_PER_LAYER": str(self.H), "ODMS_RANDOM_SEED": str(self.seed)},
                                  default_settings=dict(self.DEFAULTS), signature=[(c, "NUMBER") for c in cols])
        p, H = len(cols), self.H
        xs = m._x_sql(data)
        prep = hold(data.selectExpr(*[f"{x} AS x{j}" for j, x in enumerate(xs)],
                                    f"(CAST({_q(self.target)} AS DOUBLE) - {_sql_double(m.t_mean)}) / "
                                    f"{_sql_double(m.t_std)} AS t"))
        try:
            n = prep.count()

            def unpack(w):
                W = w[:H * p].reshape(H, p)
                return W, w[H * p:H * p + H], w[H * p + H:H * p + 2 * H], float(w[-1])

            def fg(w):
                """Loss and gradient in one pass: every partition adds up its own block in numpy."""
                W, b, v, c = unpack(w)

                def block(columns):
                    x, t = np.column_stack(columns[:-1]), columns[-1]
                    h = 1 / (1 + np.exp(-np.clip(x @ W.T + b, -500, 500)))
                    e = h @ v + c - t
                    d = e[:, None] * v * h * (1 - h)
                    return np.concatenate(([e @ e], (d.T @ x).ravel(), d.sum(axis=0), e @ h, [e.sum()]))

                r = sum_blocks(prep, block, held=len(w) < SMALL_BLOCK)
                r = np.zeros(len(w) + 1) if r is None else r
                reg = 0.5 * self.lam * (np.sum(W ** 2) + np.sum(v ** 2))
                f = 0.5 * r[0] / max(n, 1) + reg
                g = r[1:] / max(n, 1)
                g[:H * p] += self.lam * W.ravel()
                g[H * p + H:H * p + 2 * H] += self.lam * v
                return f, g

            rng = np.random.default_rng(self.seed)
            w0 = np.concatenate([rng.uniform(-0.5, 0.5, H * p), rng.uniform(-0.5, 0.5, H),
                                 rng.uniform(-0.5, 0.5, H), [0.0]])
            w, m.losses = lbfgs(fg, w0, self.max_iter)
            m.settings["CONVERGED"] = str(len(m.losses) <= self.max_iter)
            m.W, m.b, m.v, m.c = unpack(w)
        finally:
            prep.unpersist()
        return m
