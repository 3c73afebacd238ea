"""Anomaly detection (one-class tasks: no target).

EM anomaly [design]: a Gaussian mixture (Spark ML ``GaussianMixture``, a
distributed EM) on standardized numerics.  The row log-density
``log sum_k pi_k N(x; mu_k, Sigma_k)`` is a native column expression
(quadratic forms with the k x p x p inverse covariances as literals), the
anomaly threshold is the ``outlier_rate`` quantile of the build
log-densities (``approxQuantile``).  Prediction 1 = normal, 0 = anomaly,
as in the reference.

Distance anomaly: distance of a row to its k-means centroid, ranked.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.clustering import GaussianMixture
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.prep import Normalizer, fit_normalizer
from quarry.plans.model import MiningModel


@dataclass
class MixtureAnomalyModel(MiningModel):
    cols: list = field(default_factory=list)
    norm: Normalizer | None = None
    weights: list = field(default_factory=list)
    means: list = field(default_factory=list)
    precisions: list = field(default_factory=list)
    logdets: list = field(default_factory=list)
    threshold: float = float("-inf")
    outlier_rate: float = 0.05

    def _z(self, df: DataFrame) -> list[Column]:
        out = []
        for c in self.cols:
            x = F.coalesce(F.col(c).cast("double"), F.lit(float(self.norm.shift[c])))
            out.append((x - F.lit(float(self.norm.shift[c]))) / F.lit(float(self.norm.scale[c])))
        return out

    def log_density(self, df: DataFrame) -> Column:
        z = self._z(df)
        p = len(z)
        comps = []
        for w, mu, P, ld in zip(self.weights, self.means, self.precisions, self.logdets):
            d = [zi - F.lit(float(m)) for zi, m in zip(z, mu)]
            q = None
            for i in range(p):
                for j in range(i, p):
                    coef = P[i][j] * (1.0 if i == j else 2.0)
                    t = d[i] * d[j] * F.lit(float(coef))
                    q = t if q is None else q + t
            comps.append(F.lit(math.log(max(w, 1e-300)) - 0.5 * (ld + p * math.log(2 * math.pi))) - 0.5 * q)
        m = F.greatest(*comps) if len(comps) > 1 else comps[0]
        s = None
        for c in comps:
            t = F.exp(c - m)
            s = t if s is None else s + t
        return m + F.log(s)

    def prediction(self, df: DataFrame) -> Column:
        """1 = normal, 0 = anomaly."""
        return F.when(self.log_density(df) < F.lit(self.threshold), 0).otherwise(1)

    def probability_normal(self, df: DataFrame) -> Column:
        """PREDICTION_PROBABILITY(model, 1) [design]: logistic in the log-density margin."""
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-(self.log_density(df) - F.lit(self.threshold))))


class MixtureAnomaly:
    def __init__(self, k: int = 3, outlier_rate: float = 0.05, seed: int = 0, max_iter: int = 100,
                 name: str = "em_anomaly"):
        self.k, self.outlier_rate, self.seed, self.max_iter, self.name = k, outlier_rate, seed, max_iter, name

    def fit(self, df: DataFrame, cols: list[str]) -> MixtureAnomalyModel:
        norm = fit_normalizer(df, cols)
        m = MixtureAnomalyModel(name=self.name, function="CLASSIFICATION", algorithm="ALGO_EXPECTATION_MAXIMIZATION",
                                cols=list(cols), norm=norm, outlier_rate=self.outlier_rate,
                                settings={"EMCS_OUTLIER_RATE": self.outlier_rate, "EMCS_NUM_COMPONENTS": self.k})
        z = df.select(*[x.alias(f"z{i}") for i, x in enumerate(m._z(df))])
        vec = VectorAssembler(inputCols=[f"z{i}" for i in range(len(cols))], outputCol="__v").transform(z)
        gm = GaussianMixture(k=self.k, featuresCol="__v", seed=self.seed, maxIter=self.max_iter).fit(vec)
        m.weights = list(gm.weights)
        for row in gm.gaussiansDF.collect():  # k rows
            mu = np.array(row["mean"].toArray())
            cov = np.array(row["cov"].toArray()) + 1e-9 * np.eye(len(cols))
            m.means.append(mu.tolist())
            m.precisions.append(np.linalg.inv(cov).tolist())
            m.logdets.append(float(np.linalg.slogdet(cov)[1]))
        ld = df.select(m.log_density(df).alias("ld"))
        m.threshold = ld.approxQuantile("ld", [self.outlier_rate], 1e-4)[0]
        return m
