"""Matrix factorization: SVD / PCA from one distributed Gram aggregate.

X (n x p, prepared: mean shift and optional std scale) has X'X computed by
a single Spark aggregate; its eigen-decomposition at the driver gives V and
the singular values S (p x p work only).  U = X V / S and feature values
are column expressions, so scoring and reconstruction are projections.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.linear import gram
from quarry.operators.prep import Normalizer, fit_normalizer
from quarry.operators.linear import sum_blocks
from quarry.plans.model import MiningModel


@dataclass
class SVDModel(MiningModel):
    cols: list = field(default_factory=list)
    norm: Normalizer | None = None
    V: np.ndarray | None = None   # p x k
    S: np.ndarray | None = None   # k
    n_rows: int = 0
    pca: bool = True

    def _x(self, df: DataFrame) -> list[Column]:
        out = []
        for c in self.cols:
            x = F.coalesce(F.col(c).cast("double"), F.lit(float(self.norm.shift[c])))
            out.append((x - F.lit(float(self.norm.shift[c]))) / F.lit(float(self.norm.scale[c])))
        return out

    def feature_values(self, df: DataFrame) -> list[Column]:
        """FEATURE_VALUE per feature: projection X V (PCA scoring) or X V / S (SVD scoring)."""
        xs = self._x(df)
        out = []
        for j in range(self.V.shape[1]):
            s = None
            for i, x in enumerate(xs):
                t = x * F.lit(float(self.V[i, j]))
                s = t if s is None else s + t
            out.append(s if self.pca else s / F.lit(float(self.S[j])))
        return out

    def feature_set(self, df: DataFrame, top_n: int | None = None, cutoff: float | None = None) -> Column:
        """FEATURE_SET(m, topN, cutoff): array<struct<feature_id, value>>, highest value first."""
        pairs = [F.struct(F.lit(j + 1).alias("feature_id"), v.alias("value"))
                 for j, v in enumerate(self.feature_values(df))]
        arr = F.array(*pairs)
        if cutoff is not None:
            arr = F.filter(arr, lambda e: e["value"] >= F.lit(float(cutoff)))
        arr = F.array_sort(arr, lambda a, b: F.when(a["value"] > b["value"], -1)
                           .when(a["value"] < b["value"], 1)
                           .otherwise(a["feature_id"] - b["feature_id"]))
        return F.slice(arr, 1, top_n) if top_n else arr

    def feature_id(self, df: DataFrame) -> Column:
        """FEATURE_ID: the feature of highest value (ties to the lower id)."""
        return F.element_at(self.feature_set(df, 1), 1)["feature_id"]

    def feature_details(self, df: DataFrame, feature: int, top_n: int = 5, by_abs: bool = False) -> Column:
        """FEATURE_DETAILS(m, feature, topN [ABS]): attributes that most raise the feature value.

        The contribution of attribute i is its prepared value times its loading
        V[i, feature] (divided by the singular value in SVD scoring mode), so the
        contributions sum to FEATURE_VALUE.  Sorted by contribution (or by its
        absolute value with ``by_abs``), largest first.
        """
        j = feature - 1
        div = 1.0 if self.pca else float(self.S[j])
        parts = [F.struct(F.lit(c).alias("attribute"), (x * F.lit(float(self.V[i, j]) / div)).alias("weight"))
                 for i, (c, x) in enumerate(zip(self.cols, self._x(df)))]

        def key(e):
            return F.abs(e["weight"]) if by_abs else e["weight"]
        arr = F.array_sort(F.array(*parts), lambda a, b: F.when(key(a) > key(b), -1)
                           .when(key(a) < key(b), 1)
                           .when(a["attribute"] < b["attribute"], -1)
                           .when(a["attribute"] > b["attribute"], 1).otherwise(0))
        return F.slice(arr, 1, top_n)

    def reconstruct(self, df: DataFrame, k: int) -> list[Column]:
        """Row reconstruction in original units from the top k features."""
        xs = self._x(df)
        proj = []
        for j in range(k):
            s = None
            for i, x in enumerate(xs):
                t = x * F.lit(float(self.V[i, j]))
                s = t if s is None else s + t
            proj.append(s)
        out = []
        for i, c in enumerate(self.cols):
            z = None
            for j in range(k):
                t = proj[j] * F.lit(float(self.V[i, j]))
                z = t if z is None else z + t
            out.append(z * F.lit(float(self.norm.scale[c])) + F.lit(float(self.norm.shift[c])))
        return out

    def singular_df(self, spark: SparkSession) -> DataFrame:
        """View E: feature_id, singular value, explained variance and cumulative percent."""
        ev = self.S ** 2 / max(self.n_rows - 1, 1)
        tot = ev.sum() if ev.sum() > 0 else 1.0
        cum = np.cumsum(ev) / tot * 100
        rows = [(j + 1, float(self.S[j]), float(ev[j]), float(ev[j] / tot * 100), float(cum[j]))
                for j in range(len(self.S))]
        return spark.createDataFrame(rows, "feature_id int, value double, variance double, "
                                           "pct_cum_variance_single double, pct_cum_variance double")

    def v_df(self, spark: SparkSession) -> DataFrame:
        """View V: attribute loadings per feature."""
        rows = [(j + 1, c, float(self.V[i, j])) for j in range(self.V.shape[1]) for i, c in enumerate(self.cols)]
        return spark.createDataFrame(rows, "feature_id int, attribute_name string, value double")


class SVD:
    DEFAULTS = {"SVDS_SCORING_MODE": "SVDS_SCORING_SVD", "PREP_SHIFT_2DNUM": "PREP_SHIFT_MEAN",
                "PREP_SCALE_2DNUM": "PREP_SCALE_STDDEV", "FEAT_NUM_FEATURES": "all"}

    def __init__(self, k: int | None = None, pca: bool = True, scale: bool = True, name: str = "svd_model"):
        self.k, self.pca, self.scale, self.name = k, pca, scale, name

    def fit(self, df: DataFrame, cols: list[str]) -> SVDModel:
        spark = df.sparkSession
        norm = fit_normalizer(df, cols, "mean", "stddev" if self.scale else "none")
        m = SVDModel(name=self.name, function="FEATURE_EXTRACTION", algorithm="ALGO_SINGULAR_VALUE_DECOMP",
                     cols=list(cols), norm=norm, pca=self.pca,
                     settings={"SVDS_SCORING_MODE": "SVDS_SCORING_PCA" if self.pca else "SVDS_SCORING_SVD"},
                     default_settings=dict(self.DEFAULTS))
        s = gram(df, m._x(df), F.lit(0.0))
        G = s["G"][1:, 1:]
        w, V = np.linalg.eigh(G)
        order = np.argsort(w)[::-1]
        w, V = np.clip(w[order], 0, None), V[:, order]
        # sign convention: largest |loading| of each vector positive
        for j in range(V.shape[1]):
            if V[np.argmax(np.abs(V[:, j])), j] < 0:
                V[:, j] = -V[:, j]
        k = self.k or len(cols)
        m.V, m.S, m.n_rows = V[:, :k], np.sqrt(w[:k]), s["n"]
        m.add_view("E", lambda: m.singular_df(spark), "Singular values / explained variance")
        m.add_view("V", lambda: m.v_df(spark), "Right-singular vectors")
        return m


@dataclass
class NMFModel(MiningModel):
    cols: list = field(default_factory=list)
    H: np.ndarray | None = None          # k x m, non-negative
    errors: list = field(default_factory=list)  # of the first H, then after every iteration
    converged: bool = False

    def feature_values(self, df: DataFrame) -> list[Column]:
        """W of a row: its non-negative least squares weights for H (NULL counts as 0)."""
        h = self.H

        @F.pandas_udf("array<double>")
        def weights(rows: pd.Series) -> pd.Series:
            return pd.Series(list(nnls_rows(np.stack(rows.to_numpy()), h)))

        row = weights(F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in self.cols]))
        return [row[j] for j in range(len(h))]

    def h_df(self, spark: SparkSession) -> DataFrame:
        """View H: non-negative loadings per feature and attribute."""
        rows = [(j + 1, c, float(self.H[j, i])) for j in range(self.H.shape[0]) for i, c in enumerate(self.cols)]
        return spark.createDataFrame(rows, "feature_id int, attribute_name string, coefficient double")


def nnls_rows(v: np.ndarray, h: np.ndarray, sweeps: int = 200) -> np.ndarray:
    """W >= 0 that minimises |v - W h| row by row, by coordinate descent over all rows at once."""
    return nnls_cross(h @ h.T, v @ h.T, sweeps)


def nnls_cross(gram: np.ndarray, cross: np.ndarray, sweeps: int = 200) -> np.ndarray:
    """The same from h h' and v h', so v may be sparse."""
    w = np.maximum(cross @ np.linalg.pinv(gram), 0.0)
    live, now = np.arange(len(w)), w.copy()  # rows that still move; a row is solved by itself
    for _ in range(sweeps):
        moved = np.zeros(len(live))
        for j in range(len(gram)):
            if gram[j, j] > 0:
                new = np.maximum(now[:, j] + (cross[:, j] - now @ gram[:, j]) / gram[j, j], 0.0)
                moved = np.maximum(moved, np.abs(new - now[:, j]))
                now[:, j] = new
        w[live] = now
        go = moved > 1e-12 * np.maximum(1.0, now.max(1, initial=0.0))
        if not go.any():
            break
        live, now, cross = live[go], now[go], cross[go]
    return w


def solve_h(h: np.ndarray, ww: np.ndarray, wv: np.ndarray) -> np.ndarray:
    """H >= 0 of least error for given W, from W'W and W'V, by coordinate descent on its rows from ``h``."""
    h = h.copy()
    for _ in range(200):
        before = h.copy()
        for j in range(len(h)):
            if ww[j, j] > 0:
                h[j] = np.maximum(h[j] + (wv[j] - ww[j] @ h) / ww[j, j], 0.0)
        if np.abs(h - before).max() <= 1e-12 * max(1.0, np.abs(h).max()):
            break
    return h


class NMF:
    """Non-negative matrix factorization V ~ W H by alternating non-negative least squares.

    W is never stored: given H it is a function of the row (:func:`nnls_rows`), so each iteration is
    one pass that adds up W'W (k x k), W'V (k x m) and the error in numpy blocks.  H then solves its own
    non-negative least squares problem from those sums.  Both halves lower the error, so the
    recorded errors never rise; the last one is that of the returned H.
    """

    def __init__(self, k: int = 3, max_iter: int = 50, tol: float = 1e-5, seed: int = 0, name: str = "nmf"):
        self.k, self.max_iter, self.tol, self.seed, self.name = k, max_iter, tol, seed, name

    def fit(self, df: DataFrame, cols: list[str]) -> NMFModel:
        m, k = len(cols), self.k
        means = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols]).first()
        rnd = np.random.default_rng(self.seed)
        h = np.abs(rnd.random((k, m))) * np.array([max(means[c] or 0.0, 1e-9) for c in cols])
        model = NMFModel(name=self.name, function="FEATURE_EXTRACTION", algorithm="ALGO_NONNEGATIVE_MATRIX_FACTOR",
                         cols=list(cols), H=h, settings={"FEAT_NUM_FEATURES": self.k,
                                                         "NMFS_NUM_ITERATIONS": self.max_iter,
                                                         "NMFS_CONV_TOLERANCE": self.tol})
        data = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).cache()

        def sums(h):
            def block(columns):
                v = np.column_stack(columns)
                w = nnls_rows(v, h)
                return np.concatenate(((w.T @ w).ravel(), (w.T @ v).ravel(), [((v - w @ h) ** 2).sum()]))
            flat = sum_blocks(data, block)
            flat = np.zeros(k * k + k * m + 1) if flat is None else flat
            return flat[:k * k].reshape(k, k), flat[k * k:-1].reshape(k, m), float(flat[-1])

        ww, wv, err = sums(h)
        model.errors.append(err)
        converged = False
        for _ in range(self.max_iter):
            h = solve_h(h, ww, wv)
            ww, wv, now = sums(h)
            model.errors.append(now)
            converged = err - now <= self.tol * max(err, 1e-12)
            err = now
            if converged:
                break
        model.H, model.converged = h, converged
        data.unpersist()
        model.add_view("H", lambda: model.h_df(df.sparkSession), "NMF H matrix")
        return model
