"""Accelerated failure time (AFT) regression with censoring.

log T = x'beta + sigma * Z, Z ~ normal | logistic | extreme (min-Gumbel),
with sigma fixed (``aft_loss_distribution_scale``) as in the reference.
Targets are interval bounds (lbound, rbound): exact when equal, right-censored when rbound is NULL
(infinity), left-censored when lbound is 0 or NULL, else interval-censored (the log of the difference
of two distribution values).  A row that says nothing (0 or NULL to infinity) counts, with likelihood 1.

Newton iterations on distributed sufficient statistics: each step is one pass in which every partition
adds up its block of gradient and Hessian sums in numpy (:func:`quarry.operators.linear.sum_blocks`), so
p x p numbers reach the driver and the plan does not grow.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.linear import Design, fit_design, gram_block, gram_parts, sum_blocks
from quarry.plans.model import MiningModel

EXACT, BETWEEN, RIGHT, SILENT = range(4)


def _normal_upper(z: np.ndarray) -> np.ndarray:
    """Upper tail of the standard normal distribution (rational approximation, error below 1e-7)."""
    a = np.minimum(np.abs(z), 38.0)
    t = 1 / (1 + 0.2316419 * a)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = np.exp(-a * a / 2) / math.sqrt(2 * math.pi) * poly
    return np.where(z >= 0, tail, 1 - tail)


def _distribution(dist: str, z: np.ndarray):
    """(upper tail, density, slope of the density, log density) of the standard distribution."""
    if dist == "normal":
        log = -z * z / 2 - 0.5 * math.log(2 * math.pi)
        f = np.exp(log)
        return _normal_upper(z), f, -z * f, log
    if dist == "logistic":
        up = 1 / (1 + np.exp(np.clip(z, -700, 700)))
        f = up * (1 - up)
        return up, f, f * (2 * up - 1), z - 2 * np.logaddexp(0, z)
    if dist == "extreme":
        ez = np.exp(np.minimum(z, 700.0))
        f = ez * np.exp(-ez)
        return np.exp(-ez), f, f * (1 - ez), z - ez
    raise ValueError(f"unknown distribution {dist}")


def _terms(dist: str, kind: np.ndarray, zl: np.ndarray, zr: np.ndarray, opened: np.ndarray):
    """(d ll/dz, -d2 ll/dz2, ll) of every row; z moves both bounds of an interval."""
    up, f, slope, log = _distribution(dist, zl)
    tiny = 1e-300
    if dist == "normal":
        e1, e2 = -zl, np.ones_like(zl)
        h = np.where(zl > 8, zl + 1 / np.maximum(zl, 1), f / np.maximum(up, tiny))  # far tail: asymptotic
        r1, r2 = -h, h * (h - zl)
        r3 = np.where(zl > 30, -zl * zl / 2 - np.log(np.maximum(zl, 1)) - 0.5 * math.log(2 * math.pi),
                      np.log(np.maximum(up, tiny)))
    elif dist == "logistic":
        e1, e2 = 2 * up - 1, 2 * f
        r1, r2, r3 = up - 1, f, -np.logaddexp(0, zl)
    else:
        ez = np.exp(np.minimum(zl, 700.0))
        e1, e2 = 1 - ez, ez
        r1, r2, r3 = -ez, ez, -ez
    upr, fr, sr, _ = _distribution(dist, zr)
    upl, fl, sl = np.where(opened, 1.0, up), np.where(opened, 0.0, f), np.where(opened, 0.0, slope)
    mass = np.maximum(upl - upr, tiny)
    b1 = (fr - fl) / mass
    b2, b3 = b1 * b1 - (sr - sl) / mass, np.log(mass)
    pick = lambda e, b, r: np.select([kind == EXACT, kind == BETWEEN, kind == RIGHT], [e, b, r], 0.0)
    return pick(e1, b1, r1), np.maximum(pick(e2, b2, r2), 1e-12), pick(log, b3, r3)


@dataclass
class AFTModel(MiningModel):
    design: Design | None = None
    beta: np.ndarray | None = None
    dist: str = "normal"
    sigma: float = 1.0
    stats: dict = field(default_factory=dict)

    def linear_predictor(self, df: DataFrame | None = None) -> Column:
        eta = F.lit(float(self.beta[0]))
        for c, b in zip(self.design.columns(df), self.beta[1:]):
            eta = eta + c * F.lit(float(b))
        return eta

    def prediction(self, df: DataFrame | None = None) -> Column:
        """Predicted time exp(x'beta)."""
        return F.exp(self.linear_predictor(df))


class AFT:
    def __init__(self, lbound: str, rbound: str, numeric: list[str], categorical: list[str] | None = None,
                 dist: str = "normal", scale: float = 1.0, max_iter: int = 50, tol: float = 1e-8,
                 resolution: float = 1.0, name: str = "aft_model"):
        """``resolution``: an exact time of 0 is only known to lie between 0 and this time."""
        if scale <= 0:
            raise ValueError("aft_loss_distribution_scale must be > 0")
        self.lbound, self.rbound = lbound, rbound
        self.numeric, self.categorical = list(numeric), list(categorical or [])
        self.dist, self.sigma = dist, float(scale)
        self.max_iter, self.tol, self.name, self.resolution = max_iter, tol, name, resolution

    def fit(self, df: DataFrame) -> AFTModel:
        lo = F.greatest(F.coalesce(F.col(self.lbound).cast("double"), F.lit(0.0)), F.lit(0.0))
        hi = F.col(self.rbound).cast("double")
        hi = F.when((hi <= 0) & (lo <= 0), F.lit(float(self.resolution))).otherwise(hi)
        data = df.withColumns({"__lo": lo, "__hi": hi})
        bad = data.filter("__hi < __lo").limit(1).count()
        if bad:
            raise ValueError("a right bound lies below its left bound")
        design = fit_design(data, self.numeric, self.categorical)
        xs = design.columns(data)
        kind = (F.when(F.col("__hi") == F.col("__lo"), float(EXACT)).when(F.col("__hi").isNotNull(), float(BETWEEN))
                .when(F.col("__lo") > 0, float(RIGHT)).otherwise(float(SILENT)))
        log = lambda c: F.log(F.when(c > 0, c).otherwise(1.0))
        left = F.when(F.col("__lo") > 0, F.col("__lo")).otherwise(F.coalesce("__hi", F.lit(1.0)))
        cached = data.select(*[c.cast("double").alias(f"__x{i}") for i, c in enumerate(xs)], kind.alias("__kind"),
                             (F.col("__lo") <= 0).cast("double").alias("__open"), log(left).alias("__lt"),
                             log(F.coalesce("__hi", left)).alias("__rt")).cache()
        p, s, dist = len(xs) + 1, self.sigma, self.dist
        beta = np.zeros(p)
        beta[0] = cached.agg(F.avg("__lt").alias("m")).collect()[0]["m"] or 0.0

        def evaluate(beta):
            """Gram sums of the Newton step, then log likelihood and the number of events."""
            def block(cols):
                x = np.column_stack([np.ones(len(cols[0])), *cols[:-4]])
                which, opened, lt, rt = cols[-4:]
                eta = x @ beta
                d1, d2, ll = _terms(dist, which, (lt - eta) / s, (rt - eta) / s, opened > 0)
                ll = ll - np.where(which == EXACT, math.log(s), 0.0)
                # z = (log t - x'beta) / s, so grad = -sum x d1 / s and -Hess = sum x x' d2 / s^2: the
                # Newton step is the weighted least squares fit of u = -d1 s / d2 with w = d2 / s^2
                return np.concatenate((gram_block(np.column_stack((x, -d1 * s / d2)), d2 / (s * s)),
                                       [ll.sum(), (which == EXACT).sum()]))
            flat = sum_blocks(cached, block)
            return np.zeros((p + 1) ** 2 + 4) if flat is None else flat

        it, converged = 0, False
        flat = evaluate(beta)
        for it in range(1, self.max_iter + 1):
            st = gram_parts(flat[:-2], p)
            step = np.linalg.lstsq(st["G"], st["b"], rcond=None)[0]
            for _ in range(30):  # a step that lowers the likelihood is halved
                after = evaluate(beta + step)
                if after[-2] >= flat[-2] - 1e-9 * abs(flat[-2]) or np.max(np.abs(step)) < self.tol:
                    break
                step = step / 2
            beta, flat = beta + step, after
            if np.max(np.abs(step)) < self.tol:
                converged = True
                break
        r = {"ll": float(flat[-2]), "n": int(flat[-3]), "events": int(flat[-1])}
        cached.unpersist()
        m = AFTModel(name=self.name, function="REGRESSION", algorithm="ALGO_AFT_SURVIVAL",
                     design=design, beta=beta, dist=self.dist, sigma=s,
                     stats={"iterations": it, "converged": converged, "log_likelihood": r["ll"], "num_rows": r["n"], "events": r["events"]},
                     settings={"aft_loss_distribution": self.dist, "aft_loss_distribution_scale": s,
                               "aft_right_bound_column_name": self.rbound})
        return m
