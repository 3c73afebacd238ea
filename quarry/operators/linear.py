"""Generalized linear models from distributed sufficient statistics.

One Spark aggregate computes the Gram matrix ``X'WX``, ``X'Wy`` and
``y'Wy`` (p (p+1) / 2 + p + 3 sums, map-side partial aggregation); the
driver then solves a p x p system with numpy.  The driver never holds
more than O(p^2) numbers, whatever the row count.

* linear regression (normal equations, optional ridge), with coefficient
  statistics, global statistics, prediction bounds and row diagnostics;
* logistic regression by iteratively reweighted least squares (IRLS):
  every Newton step is one more aggregate with the current coefficients
  as literals, so the plan never grows between iterations.

Categorical attributes are one-hot encoded with the first level (sorted)
as reference; levels come from a bounded distinct query.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.plans.model import MiningModel

MAX_LEVELS = 1000  # per categorical attribute; beyond this, bin or hash first
MAX_P = 2000       # driver solves p x p


# --------------------------------------------------------------------- design
@dataclass
class Design:
    numeric: list
    categorical: dict  # attribute -> [levels]  (first level is the reference)
    fill: dict = field(default_factory=dict)  # numeric mean imputation
    quadratic: bool = False

    def names(self) -> list[tuple[str, str | None]]:
        out = [(a, None) for a in self.numeric]
        for a, lv in self.categorical.items():
            out += [(a, v) for v in lv[1:]]
        if self.quadratic:
            base = list(self.numeric)
            out += [(f"{base[i]}*{base[j]}", None) for i in range(len(base)) for j in range(i, len(base))]
        return out

    def columns(self, df: DataFrame | None = None) -> list[Column]:
        present = set(df.columns) if df is not None else None
        cols = []
        num = {}
        for a in self.numeric:
            x = F.col(a).cast("double") if present is None or a in present else F.lit(None).cast("double")
            num[a] = F.coalesce(x, F.lit(float(self.fill.get(a, 0.0))))
            cols.append(num[a])
        for a, lv in self.categorical.items():
            x = F.col(a).cast("string") if present is None or a in present else F.lit(None).cast("string")
            for v in lv[1:]:
                cols.append(F.when(x == F.lit(v), 1.0).otherwise(0.0))
        if self.quadratic:
            base = list(self.numeric)
            for i in range(len(base)):
                for j in range(i, len(base)):
                    cols.append(num[base[i]] * num[base[j]])
        return cols


def fit_design(df: DataFrame, numeric: list[str], categorical: list[str], quadratic: bool = False) -> Design:
    """Mean fill for numerics (one aggregate) and sorted levels for categoricals."""
    fill = {}
    if numeric:
        r = df.agg(*[F.avg(F.col(a).cast("double")).alias(a) for a in numeric]).collect()[0]
        fill = {a: (r[a] if r[a] is not None else 0.0) for a in numeric}
    levels = {}
    for a in categorical:
        vals = df.select(F.col(a).cast("string").alias("v")).filter(F.col("v").isNotNull()).distinct() \
            .limit(MAX_LEVELS + 1).collect()
        if len(vals) > MAX_LEVELS:
            raise ValueError(f"{a}: more than {MAX_LEVELS} levels; bin or hash it first")
        levels[a] = sorted(r["v"] for r in vals)
    return Design(list(numeric), levels, fill, quadratic)


# --------------------------------------------------------------------- statistics
def sum_blocks(df: DataFrame, block, held: bool = False) -> np.ndarray | None:
    """The sum of ``block(columns)`` - a flat array - over all Arrow batches of ``df``.

    The one kernel of the iterative fits: every partition adds up its own blocks (matrix products
    in numpy) and Spark adds the partitions' blocks entry by entry, so only one block reaches the
    driver.  Nulls are 0.  None for a table without rows.

    ``held``: ``df`` comes from :func:`quarry.session.hold` and its block is small, so the driver adds
    the blocks of its few partitions and a pass is one stage.
    """
    def total_of(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                own = block([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in batch.columns])
                total = own if total is None else total + own
        return total

    if held:
        return sum_held(df, total_of)

    def run(batches):
        total = total_of(batches)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)],
                                             names=["pos", "v"])

    rows = df.mapInArrow(run, "pos int, v double").groupBy("pos").agg(F.sum("v").alias("v")).collect()
    if not rows:
        return None
    out = np.zeros(len(rows))
    for r in rows:
        out[r["pos"]] = r["v"]
    return out


SMALL_BLOCK = 4096  # numbers that every task of a held table may send the driver in each pass


def sum_held(df: DataFrame, total_of) -> np.ndarray | None:
    """The sum of ``total_of(batches)`` - a flat array or None - over the few partitions of held rows."""
    def run(batches):
        total = total_of(batches)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([np.asarray(total, np.float64).tobytes()], pa.binary())], names=["block"])

    blocks = [np.frombuffer(bytes(r["block"]), np.float64) for r in df.mapInArrow(run, "block binary").collect()]
    return np.sum(blocks, axis=0) if blocks else None


def gram_block(m: np.ndarray, w: np.ndarray) -> np.ndarray:
    """w m m' summed over the rows of m, flat, then the sum of w and the row count."""
    return np.concatenate((((m * w[:, None]).T @ m).ravel(), [w.sum(), len(w)]))


def gram_parts(flat: np.ndarray, p: int) -> dict:
    full = flat[:-2].reshape(p + 1, p + 1)
    return {"n": int(flat[-1]), "sw": float(flat[-2]), "G": full[:p, :p].copy(), "b": full[:p, p].copy(),
            "yy": float(full[p, p])}


def gram(df: DataFrame, xcols: list[Column], y: Column, w: Column | None = None) -> dict:
    """n, sum w, X'WX (with intercept column), X'Wy, y'Wy in one pass; (p + 1)^2 numbers reach the driver."""
    w = w if w is not None else F.lit(1.0)
    xs = [F.lit(1.0)] + xcols
    p = len(xs)
    named = df.select(*[x.cast("double").alias(f"x{i}") for i, x in enumerate(xs)], y.cast("double").alias("y"),
                      w.cast("double").alias("w")).filter(F.col("y").isNotNull())
    flat = sum_blocks(named, lambda cols: gram_block(np.column_stack(cols[:-1]), cols[-1]))
    return gram_parts(np.zeros((p + 1) ** 2 + 2) if flat is None else flat, p)


def gram_long(df: DataFrame, names: list[str], cast_double: bool = True) -> DataFrame:
    """Gram matrix as long rows (i, j, value) for i <= j - one aggregate.

    With ``cast_double=False`` the column types are kept, e.g. decimals for
    exact sums.
    """
    aggs = []
    cv = (lambda c: F.col(c).cast("double")) if cast_double else F.col
    for i, a in enumerate(names):
        for j in range(i, len(names)):
            aggs.append(F.sum(cv(a) * cv(names[j])).alias(f"g_{i}_{j}"))
    wide = df.agg(*aggs)
    entries = [F.struct(F.lit(names[i]).alias("attr_i"), F.lit(names[j]).alias("attr_j"),
                        F.col(f"g_{i}_{j}").alias("value"))
               for i in range(len(names)) for j in range(i, len(names))]
    return wide.select(F.inline(F.array(*entries)))


def _t_sf(t: float, dof: float) -> float:
    """Two-sided p-value of Student t via the regularized incomplete beta."""
    if dof <= 0 or math.isnan(t):
        return float("nan")
    x = dof / (dof + t * t)
    return _betainc(dof / 2.0, 0.5, x)


def _betainc(a: float, b: float, x: float) -> float:
    """Regularized incomplete beta I_x(a, b) by Lentz's continued fraction."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    lbeta = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
    front = math.exp(math.log(x) * a + math.log(1 - x) * b + lbeta)
    if x > (a + 1) / (a + b + 2):
        return 1.0 - _betainc(b, a, 1 - x)
    tiny = 1e-300
    f, c, d = 1.0, 1.0, 0.0
    for i in range(0, 400):
        m = i // 2
        if i == 0:
            num = 1.0
        elif i % 2 == 0:
            num = (m * (b - m) * x) / ((a + 2 * m - 1) * (a + 2 * m))
        else:
            num = -((a + m) * (a + b + m) * x) / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1.0 + num * d
        d = tiny if abs(d) < tiny else d
        d = 1.0 / d
        c = 1.0 + num / c
        c = tiny if abs(c) < tiny else c
        cd = c * d
        f *= cd
        if abs(1.0 - cd) < 1e-14:
            break
    return front * (f - 1.0) / a


def _t_quantile(p: float, dof: float) -> float:
    """Quantile of Student t by bisection on the CDF (dof > 0)."""
    if dof > 1e6:
        return NormalDist().inv_cdf(p)
    lo, hi = -1e3, 1e3
    for _ in range(200):
        mid = (lo + hi) / 2
        cdf = 1 - 0.5 * _t_sf(mid, dof) if mid >= 0 else 0.5 * _t_sf(mid, dof)
        if cdf < p:
            lo = mid
        else:
            hi = mid
    return (lo + hi) / 2


# --------------------------------------------------------------------- models
@dataclass
class LinearModel(MiningModel):
    design: Design | None = None
    beta: np.ndarray | None = None
    cov: np.ndarray | None = None     # (X'WX)^-1 * sigma^2 (None for ridge)
    xtx_inv: np.ndarray | None = None
    sigma2: float = float("nan")
    stats: dict = field(default_factory=dict)
    family: str = "gaussian"
    ridge: float = 0.0
    conf_level: float = 0.95

    def linear_predictor(self, df: DataFrame | None = None) -> Column:
        cols = self.design.columns(df)
        eta = F.lit(float(self.beta[0]))
        for c, b in zip(cols, self.beta[1:]):
            eta = eta + c * F.lit(float(b))
        return eta

    def prediction(self, df: DataFrame | None = None) -> Column:
        eta = self.linear_predictor(df)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-eta)) if self.family == "binomial" else eta

    # classifier surface for logistic models
    @property
    def classes(self):
        return [0, 1]

    def probability_columns(self, df: DataFrame) -> list[Column]:
        p1 = self.prediction(df)
        return [F.lit(1.0) - p1, p1]

    def leverage(self, df: DataFrame | None = None) -> Column:
        """x' (X'X)^-1 x as a column (p x p literal), the basis of bounds and hat values."""
        xs = [F.lit(1.0)] + self.design.columns(df)
        M = self.xtx_inv
        terms = []
        for i in range(len(xs)):
            for j in range(i, len(xs)):
                coef = M[i, j] * (1.0 if i == j else 2.0)
                if coef != 0.0:
                    terms.append(xs[i] * xs[j] * F.lit(float(coef)))
        s = terms[0]
        for t in terms[1:]:
            s = s + t
        return s

    def prediction_bounds(self, df: DataFrame | None = None, level: float | None = None) -> Column:
        """PREDICTION_BOUNDS: struct(lower, upper); NULL when the covariance is invalid (ridge)."""
        if self.cov is None:
            return F.struct(F.lit(None).cast("double").alias("lower"), F.lit(None).cast("double").alias("upper"))
        level = level or self.conf_level
        dof = self.stats.get("dof", 1e9)
        if self.family == "binomial":
            z = NormalDist().inv_cdf(0.5 + level / 2)
            se = F.sqrt(self.leverage(df))
            eta = self.linear_predictor(df)
            lo, hi = eta - z * se, eta + z * se
            return F.struct((1 / (1 + F.exp(-lo))).alias("lower"), (1 / (1 + F.exp(-hi))).alias("upper"))
        t = _t_quantile(0.5 + level / 2, dof)
        se = F.sqrt(F.lit(self.sigma2) * (F.lit(1.0) + self.leverage(df)))
        eta = self.linear_predictor(df)
        return F.struct((eta - t * se).alias("lower"), (eta + t * se).alias("upper"))

    def prediction_details(self, df: DataFrame | None = None, top_n: int = 5) -> Column:
        """PREDICTION_DETAILS: the top-N attribute contributions coef * value by |weight|.

        array<struct<attribute_name, attribute_value, weight, rank>>; one-hot
        members report their level as attribute_value.
        """
        cols = self.design.columns(df)
        names = self.design.names()
        items = [F.struct(F.lit(a).alias("attribute_name"), F.lit(v).cast("string").alias("attribute_value"),
                          (c * F.lit(float(b))).alias("weight"))
                 for (a, v), c, b in zip(names, cols, self.beta[1:])]
        ordered = F.array_sort(F.array(*items), lambda x, y: F.when(F.abs(x["weight"]) > F.abs(y["weight"]), -1)
                               .when(F.abs(x["weight"]) < F.abs(y["weight"]), 1).otherwise(0))
        top = F.slice(ordered, 1, top_n)
        return F.transform(top, lambda e, i: F.struct(e["attribute_name"].alias("attribute_name"),
                                                      e["attribute_value"].alias("attribute_value"),
                                                      e["weight"].alias("weight"), (i + 1).alias("rank")))

    def coefficients_df(self, spark: SparkSession) -> DataFrame:
        names = [("(intercept)", None)] + self.design.names()
        rows = []
        dof = self.stats.get("dof", float("nan"))
        for i, (a, v) in enumerate(names):
            b = float(self.beta[i])
            if self.cov is not None:
                se = math.sqrt(max(self.cov[i, i], 0.0))
                ts = b / se if se > 0 else float("nan")
                if self.family == "binomial":
                    pv = 2 * (1 - NormalDist().cdf(abs(ts))) if not math.isnan(ts) else float("nan")
                else:
                    pv = _t_sf(ts, dof)
            else:
                se = ts = pv = None
            rows.append((a if a != "(intercept)" else None, v, b, se, ts, pv,
                         math.exp(b) if self.family == "binomial" and b < 700 else None))
        return spark.createDataFrame(rows, "attribute_name string, attribute_value string, coefficient double, "
                                           "std_error double, test_statistic double, p_value double, "
                                           "exp_coefficient double")

    def global_df(self, spark: SparkSession) -> DataFrame:
        rows = [(k, float(v)) for k, v in sorted(self.stats.items()) if v is not None]
        return spark.createDataFrame(rows, "name string, numeric_value double")


class GLM:
    """GLM estimator: ``family='gaussian'`` (linear) or ``'binomial'`` (logistic)."""

    DEFAULTS = {"GLMS_CONF_LEVEL": 0.95, "GLMS_RIDGE_REGRESSION": "GLMS_RIDGE_REG_DISABLE",
                "GLMS_SOLVER": "GLMS_SOLVER_QR", "GLMS_FTR_GENERATION": "GLMS_FTR_GENERATION_DISABLE",
                "ODMS_MISSING_VALUE_TREATMENT": "ODMS_MISSING_VALUE_MEAN_MODE"}

    def __init__(self, target: str, numeric: list[str], categorical: list[str] | None = None,
                 family: str = "gaussian", ridge: float = 0.0, weight: str | None = None,
                 quadratic: bool = False, max_iter: int = 25, tol: float = 1e-8,
                 conf_level: float = 0.95, name: str = "glm_model"):
        self.target = target
        self.numeric = list(numeric)
        self.categorical = list(categorical or [])
        self.family = family
        self.ridge = ridge
        self.weight = weight
        self.quadratic = quadratic
        self.max_iter = max_iter
        self.tol = tol
        self.conf_level = conf_level
        self.name = name

    def fit(self, df: DataFrame) -> LinearModel:
        spark = df.sparkSession
        data = df.filter(F.col(self.target).isNotNull())
        design = fit_design(data, self.numeric, self.categorical, self.quadratic)
        p = len(design.names()) + 1
        if p > MAX_P:
            raise ValueError(f"{p} model columns exceed the driver-side limit {MAX_P}")
        xcols = design.columns(data)
        w = F.col(self.weight).cast("double") if self.weight else None
        y = F.col(self.target).cast("double")
        R = np.eye(p) * self.ridge
        R[0, 0] = 0.0
        if self.family == "gaussian":
            s = gram(data, xcols, y, w)
            A = s["G"] + R
            beta = np.linalg.lstsq(A, s["b"], rcond=None)[0]
            sse = s["yy"] - 2 * beta @ s["b"] + beta @ s["G"] @ beta
            n = s["n"]
            dof = n - p
            sigma2 = sse / dof if dof > 0 else float("nan")
            inv = np.linalg.pinv(A)
            ybar = s["b"][0] / s["sw"] if s["sw"] else 0.0
            sst = s["yy"] - s["sw"] * ybar * ybar
            r2 = 1 - sse / sst if sst > 0 else float("nan")
            stats = {"num_rows": n, "num_params": p, "dof": dof, "sse": sse, "mse": sigma2,
                     "root_mean_sq": math.sqrt(sigma2) if sigma2 == sigma2 and sigma2 >= 0 else None,
                     "r_square": r2,
                     "adjusted_r_square": 1 - (1 - r2) * (n - 1) / dof if dof > 0 else None,
                     "aic": n * math.log(sse / n) + 2 * p if sse > 0 else None,
                     "f_value": ((sst - sse) / (p - 1)) / sigma2 if p > 1 and sigma2 and sigma2 > 0 else None,
                     "ridge": self.ridge}
            cov = None if self.ridge > 0 else inv * sigma2
            m = LinearModel(name=self.name, function="REGRESSION", algorithm="ALGO_GENERALIZED_LINEAR_MODEL",
                            design=design, beta=beta, cov=cov, xtx_inv=inv * (1.0 if self.ridge == 0 else 1.0),
                            sigma2=sigma2, stats=stats, family="gaussian", ridge=self.ridge,
                            conf_level=self.conf_level, target=self.target)
        else:
            beta = np.zeros(p)
            cached = data.select(*[c.alias(f"__x{i}") for i, c in enumerate(xcols)], y.alias("__y"),
                                 (w if w is not None else F.lit(1.0)).alias("__w")).cache()
            xs = [F.col(f"__x{i}") for i in range(len(xcols))]
            it = 0
            for it in range(1, self.max_iter + 1):
                eta = F.lit(float(beta[0]))
                for c, b in zip(xs, beta[1:]):
                    eta = eta + c * F.lit(float(b))
                mu = F.lit(1.0) / (F.lit(1.0) + F.exp(-eta))
                vw = F.greatest(mu * (F.lit(1.0) - mu), F.lit(1e-10))
                z = eta + (F.col("__y") - mu) / vw
                s = gram(cached, xs, z, vw * F.col("__w"))
                new = np.linalg.solve(s["G"] + R, s["b"])
                delta = np.max(np.abs(new - beta))
                beta = new
                if delta < self.tol:
                    break
            inv = np.linalg.pinv(s["G"] + R)
            # deviance and log-likelihood with the final coefficients: one aggregate
            eta = F.lit(float(beta[0]))
            for c, b in zip(xs, beta[1:]):
                eta = eta + c * F.lit(float(b))
            mu = F.lit(1.0) / (F.lit(1.0) + F.exp(-eta))
            eps = 1e-15
            ll = cached.agg(F.sum(F.col("__w") * (F.col("__y") * F.log(F.greatest(mu, F.lit(eps))) +
                                                   (1 - F.col("__y")) * F.log(F.greatest(1 - mu, F.lit(eps)))))
                            .alias("ll"), F.count(F.lit(1)).alias("n")).collect()[0]
            cached.unpersist()
            n = int(ll["n"])
            stats = {"num_rows": n, "num_params": p, "iterations": it, "log_likelihood": ll["ll"],
                     "deviance": -2 * ll["ll"], "aic": -2 * ll["ll"] + 2 * p, "dof": n - p, "ridge": self.ridge}
            m = LinearModel(name=self.name, function="CLASSIFICATION", algorithm="ALGO_GENERALIZED_LINEAR_MODEL",
                            design=design, beta=beta, cov=None if self.ridge > 0 else inv, xtx_inv=inv,
                            sigma2=1.0, stats=stats, family="binomial", ridge=self.ridge,
                            conf_level=self.conf_level, target=self.target)
        m.settings = {"GLMS_RIDGE_REGRESSION": "GLMS_RIDGE_REG_ENABLE" if self.ridge else "GLMS_RIDGE_REG_DISABLE",
                      "GLMS_RIDGE_VALUE": self.ridge,
                      "GLMS_FTR_GENERATION": "GLMS_FTR_GENERATION_ENABLE" if self.quadratic else
                      "GLMS_FTR_GENERATION_DISABLE"}
        m.default_settings = dict(self.DEFAULTS)
        m.signature = [(a, "NUMBER") for a in self.numeric] + [(a, "VARCHAR2") for a in self.categorical]
        m.add_view("D", lambda: m.coefficients_df(spark), "GLM coefficients")
        m.add_view("G", lambda: m.global_df(spark), "GLM global statistics")
        return m


def row_diagnostics(model: LinearModel, df: DataFrame, case_id: str) -> DataFrame:
    """Per-row diagnostics (view A): hat, residual, studentized residual, Cook's D.

    Pure projection with the p x p inverse Gram as literals.
    """
    y = F.col(model.target).cast("double")
    pred = model.prediction(df)
    h = model.leverage(df)
    p = model.stats.get("num_params", 1)
    if model.family == "gaussian":
        s2 = F.lit(model.sigma2)
        res = y - pred
        stud = res / F.sqrt(s2 * (F.lit(1.0) - h))
        cook = res * res / (F.lit(float(p)) * s2) * h / ((F.lit(1.0) - h) * (F.lit(1.0) - h))
        return df.select(case_id, y.alias("target_value"), pred.alias("predicted_value"), h.alias("hat"),
                         res.alias("residual"), stud.alias("studentized_residual"), cook.alias("cooks_d"))
    mu = pred
    v = mu * (F.lit(1.0) - mu)
    hw = h * v
    pearson = (y - mu) / F.sqrt(v)
    dev = F.signum(y - mu) * F.sqrt(-2 * (y * F.log(F.greatest(mu, F.lit(1e-15))) +
                                          (1 - y) * F.log(F.greatest(1 - mu, F.lit(1e-15)))))
    return df.select(case_id, y.alias("target_value"), mu.alias("predicted_value"), hw.alias("hat"),
                     (y - mu).alias("residual"), pearson.alias("pearson_residual"),
                     dev.alias("deviance_residual"),
                     (pearson * pearson * hw / (F.lit(float(p)) * (1 - hw) * (1 - hw))).alias("cooks_d"))
