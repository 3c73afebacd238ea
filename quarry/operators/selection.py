"""GLM feature selection and generation on one distributed Gram matrix.

The candidates - numeric attributes, one column per level of a categorical one, and the squares and
products of numerics - are summed up in ONE Spark aggregate, the Gram matrix of all candidates and
the target.  Everything after that is the sweep operator on a p x p matrix at the driver: sweeping a
column in or out gives the coefficients, their covariance and the residual sum of squares of the new
model without touching a row again.

Candidates are tried in a stream, forced-in features first.  Criteria:

* ``alpha``: alpha investing.  A wealth pays ``wealth / (2 i)`` for the i-th test; a feature whose F
  test lies below that level enters and earns ``payout``, any other test costs its level;
* ``sbic``, ``aic``, ``ric``: a feature enters if ``n log(sse)`` falls by more than log n, 2, 2 log p.

A candidate that the model already explains is skipped with an alert; such a forced-in feature fails
the build.  Pruning then sweeps out, worst first, features whose p-value exceeds ``prune_level``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.linear import MAX_P, Design, LinearModel, _betainc, _t_quantile, _t_sf, fit_design, gram

COLLINEAR = 1e-8  # share of a candidate's variance that the model must leave unexplained


def f_upper(f: float, df1: float, df2: float) -> float:
    """P(F > f) for an F distribution."""
    if math.isinf(f):
        return 0.0
    if math.isnan(f) or df1 <= 0 or df2 <= 0:
        return float("nan")
    return _betainc(df2 / 2.0, df1 / 2.0, df2 / (df2 + df1 * max(f, 0.0)))


def sweep(a: np.ndarray, k: int) -> None:
    """Sweep column k of ``a`` in, or out again if it is in."""
    d = a[k, k]
    row = a[k] / d
    col = a[:, k].copy()
    a -= np.outer(col, row)
    a[k] = row
    a[:, k] = -col / d
    a[k, k] = 1.0 / d


# --------------------------------------------------------------------- candidates
@dataclass
class TermDesign(Design):
    """Standardized numerics (NULL is the mean), level indicators, and products of numerics.

    ``chosen`` are the positions of the model's features among all candidates; None for all.
    """
    shift: dict = field(default_factory=dict)
    scale: dict = field(default_factory=dict)
    chosen: list | None = None

    def candidates(self) -> list[tuple[str, str | None]]:
        return super().names()

    def names(self) -> list[tuple[str, str | None]]:
        every = self.candidates()
        return every if self.chosen is None else [every[i] for i in self.chosen]

    def columns(self, df: DataFrame | None = None) -> list[Column]:
        present = None if df is None else set(df.columns)

        def given(a, kind):
            return F.col(a).cast(kind) if present is None or a in present else F.lit(None).cast(kind)

        z = {a: F.coalesce((given(a, "double") - F.lit(self.shift[a])) / F.lit(self.scale[a]), F.lit(0.0))
             for a in self.numeric}
        out = [z[a] for a in self.numeric]
        for a, levels in self.categorical.items():
            out += [F.when(given(a, "string") == F.lit(v), 1.0).otherwise(0.0) for v in levels[1:]]
        if self.quadratic:
            out += [z[a] * z[b] for i, a in enumerate(self.numeric) for b in self.numeric[i:]]
        return out if self.chosen is None else [out[i] for i in self.chosen]

    def expressions(self) -> list[str]:
        return [a if v is None else f"{a}_{v}" for a, v in self.names()]


def fit_terms(df: DataFrame, numeric: list[str], categorical: list[str], quadratic: bool) -> TermDesign:
    """Means, deviations and levels; a column without deviation keeps scale 1."""
    base = fit_design(df, [], categorical)
    shift, scale = {}, {}
    if numeric:
        r = df.agg(*[f(F.col(a).cast("double")).alias(f"{n}{i}") for i, a in enumerate(numeric)
                     for n, f in (("m", F.avg), ("s", F.stddev_samp))]).first()
        shift = {a: float(r[f"m{i}"] or 0.0) for i, a in enumerate(numeric)}
        scale = {a: float(r[f"s{i}"] or 0.0) or 1.0 for i, a in enumerate(numeric)}
    return TermDesign(list(numeric), base.categorical, dict(shift), quadratic, shift, scale)


# --------------------------------------------------------------------- selection
@dataclass
class Step:
    feature: str
    action: str          # FORCED, ADDED, REJECTED, COLLINEAR, PRUNED
    sse_before: float
    sse_after: float
    f_value: float | None = None
    p_value: float | None = None
    level: float | None = None   # the test's level, or the fall of n log(sse) that was asked for
    wealth: float | None = None  # after the step


def select(a: np.ndarray, n: int, names: list[str], forced: list[int], criterion: str = "alpha", wealth: float = 0.5,
           payout: float = 0.5, prune_level: float | None = None) -> tuple[list[int], list[Step]]:
    """Sweep ``a`` - the Gram matrix of (1, candidates, target) - to the selected model.

    Returns the candidates' positions, in order of the stream, and the steps.
    """
    if criterion not in ("alpha", "aic", "sbic", "ric"):
        raise ValueError(f"unknown criterion {criterion!r}")
    y, steps, inside = a.shape[0] - 1, [], []
    sweep(a, 0)
    spread = np.maximum(np.diag(a).copy(), 0.0)

    def explained(k: int) -> bool:
        return a[k, k] <= COLLINEAR * max(spread[k], 1e-300)

    for i in forced:
        if explained(i + 1):
            raise ValueError(f"forced-in feature {names[i]} is collinear with the model")
        before = float(a[y, y])
        sweep(a, i + 1)
        inside.append(i)
        steps.append(Step(names[i], "FORCED", before, float(a[y, y])))
    tests = 0
    for i in (c for c in range(len(names)) if c not in set(forced)):
        k, sse = i + 1, float(a[y, y])
        if explained(k):
            steps.append(Step(names[i], "COLLINEAR", sse, sse, wealth=wealth if criterion == "alpha" else None))
            continue
        gain = float(a[k, y] ** 2 / a[k, k])
        dof = n - len(inside) - 2
        left = max(sse - gain, 0.0)
        f = gain / (left / dof) if dof > 0 and left > 0 else (math.inf if dof > 0 and gain > 0 else float("nan"))
        p = f_upper(f, 1, dof)
        tests += 1
        if criterion == "alpha":
            level = wealth / (2 * tests)
            enters = p <= level
            wealth += payout - level if enters else -level
        else:
            level = {"aic": 2.0, "sbic": math.log(n), "ric": 2 * math.log(max(len(names), 1))}[criterion]
            enters = dof > 0 and sse > 0 and (left == 0 or n * math.log(sse / left) > level)
        if enters:
            sweep(a, k)
            inside.append(i)
        steps.append(Step(names[i], "ADDED" if enters else "REJECTED", sse, float(a[y, y]), f, p, level,
                          wealth if criterion == "alpha" else None))
    while prune_level is not None:
        dof, sse = n - len(inside) - 1, float(a[y, y])
        worst = [(f_upper(a[i + 1, y] ** 2 / a[i + 1, i + 1] / (sse / dof), 1, dof), i)
                 for i in inside if i not in set(forced)] if dof > 0 and sse > 0 else []
        if not worst or max(worst)[0] <= prune_level:
            break
        p, i = max(worst)
        f = float(a[i + 1, y] ** 2 / a[i + 1, i + 1] / (sse / dof))
        sweep(a, i + 1)
        inside.remove(i)
        steps.append(Step(names[i], "PRUNED", sse, float(a[y, y]), f, p, prune_level))
    return inside, steps


# --------------------------------------------------------------------- statistics
def global_statistics(n: int, params: int, sse: float, sst: float, mean: float, valid: bool = True) -> list[tuple]:
    """(name, numeric_value, string_value): the global statistics of a linear model of ``params`` parameters."""
    error_df, model_df = n - params, params - 1

    def ratio(x, y):
        return x / y if y else None

    mse, ssr = ratio(sse, error_df if error_df > 0 else 0), sst - sse
    msr = ratio(ssr, model_df)
    f = ratio(msr, mse) if msr is not None and mse is not None else None
    r2 = 1 - sse / sst if sst else None
    fit = n * math.log(sse / n) if n and sse > 0 else None
    more = n - params - 1
    numbers = {
        "ADJUSTED_R_SQUARE": None if r2 is None or error_df <= 0 else 1 - (1 - r2) * (n - 1) / error_df,
        "AIC": None if fit is None else fit + 2 * params,
        "COEFF_VAR": None if mse is None or not mean else 100 * math.sqrt(max(mse, 0)) / mean,
        "CORRECTED_TOTAL_DF": n - 1, "CORRECTED_TOT_SS": sst, "DEPENDENT_MEAN": mean, "ERROR_DF": error_df,
        "ERROR_MEAN_SQUARE": mse, "ERROR_SUM_SQUARES": sse, "F_VALUE": f,
        "GMSEP": None if mse is None or more <= 0 else mse * (n + 1) * (n - 2) / (n * more),
        "HOCKING_SP": None if mse is None or more <= 0 else mse / more,
        "J_P": None if mse is None else mse * (n + params) / n,
        "MODEL_DF": model_df, "MODEL_F_P_VALUE": None if f is None else f_upper(f, model_df, error_df),
        "MODEL_MEAN_SQUARE": msr, "MODEL_SUM_SQUARES": ssr, "NUM_PARAMS": params, "NUM_ROWS": n,
        "ROOT_MEAN_SQ": None if mse is None else math.sqrt(max(mse, 0)), "R_SQ": r2,
        "SBIC": None if fit is None else fit + params * math.log(n),
    }
    rows = [(k, None if v is None else float(v), None) for k, v in numbers.items()]
    rows += [("CONVERGED", None, "YES"), ("VALID_COVARIANCE_MATRIX", None, "YES" if valid else "NO")]
    return sorted(rows)


GLOBAL_SCHEMA = "name string, numeric_value double, string_value string"
COEFFICIENT_SCHEMA = ("feature_expression string, coefficient double, std_error double, test_statistic double, "
                      "p_value double, std_coefficient double, lower_coeff_limit double, upper_coeff_limit double")


@dataclass
class SelectedModel(LinearModel):
    steps: list = field(default_factory=list)
    spreads: list = field(default_factory=list)  # standard deviation of each feature over that of the target
    totals: dict = field(default_factory=dict)

    def coefficient_rows(self) -> list[tuple]:
        dof = self.stats["dof"]
        t = _t_quantile(0.5 + self.conf_level / 2, dof) if dof > 0 else float("nan")
        rows = []
        for i, name in enumerate([None] + self.design.expressions()):
            b = float(self.beta[i])
            se = math.sqrt(max(float(self.cov[i, i]), 0.0))
            ts = b / se if se > 0 else float("nan")
            rows.append((name, b, se, ts, _t_sf(ts, dof), 0.0 if i == 0 else b * self.spreads[i - 1], b - t * se,
                         b + t * se))
        return rows


class SelectedGLM:
    """Linear GLM with feature selection, optional quadratic generation and forced-in attributes.

    ``force_in`` names attributes; a categorical one forces all its levels in.  Rows with a NULL
    target are left out; a NULL numeric counts as the mean, a NULL category as no level.  Views:
    D coefficients, G global statistics, S selection steps, W alerts, N normalization.
    """

    def __init__(self, target: str, numeric: list[str], categorical: list[str] | None = None, quadratic: bool = False,
                 force_in: list[str] | None = None, criterion: str = "alpha", prune_level: float | None = 0.05,
                 wealth: float = 0.5, payout: float = 0.5, conf_level: float = 0.95, name: str = "glm_selected"):
        self.target, self.numeric, self.categorical = target, list(numeric), list(categorical or [])
        self.quadratic, self.force_in, self.criterion = quadratic, list(force_in or []), criterion
        self.prune_level, self.wealth, self.payout = prune_level, wealth, payout
        self.conf_level, self.name = conf_level, name
        unknown = set(self.force_in) - set(self.numeric) - set(self.categorical)
        if unknown:
            raise ValueError(f"forced-in attributes are no predictors: {sorted(unknown)}")

    def fit(self, df: DataFrame) -> SelectedModel:
        spark = df.sparkSession
        data = df.filter(F.col(self.target).isNotNull())
        design = fit_terms(data, self.numeric, self.categorical, self.quadratic)
        candidates, names = design.candidates(), design.expressions()
        p = len(candidates)
        if p + 1 > MAX_P:
            raise ValueError(f"{p + 1} candidate columns exceed the driver-side limit {MAX_P}")
        s = gram(data, design.columns(data), F.col(self.target).cast("double"))
        n = s["n"]
        if n == 0:
            raise ValueError("no rows with a target")
        a = np.block([[s["G"], s["b"][:, None]], [s["b"][None, :], np.array([[s["yy"]]])]])
        mean = float(s["b"][0] / n)
        centred = a - np.outer(a[:, 0], a[0]) / n
        sst = float(centred[-1, -1])
        deviation = np.sqrt(np.maximum(np.diag(centred), 0.0))
        forced = [i for i, (attr, _) in enumerate(candidates) if attr in self.force_in]
        chosen, steps = select(a, n, names, forced, self.criterion, self.wealth, self.payout, self.prune_level)
        chosen = sorted(chosen)
        at = [0] + [i + 1 for i in chosen]
        inverse, beta, sse = a[np.ix_(at, at)], a[at, -1], float(max(a[-1, -1], 0.0))
        dof = n - len(at)
        sigma2 = sse / dof if dof > 0 else float("nan")
        design.chosen = chosen
        model = SelectedModel(
            name=self.name, function="REGRESSION", algorithm="ALGO_GENERALIZED_LINEAR_MODEL", target=self.target,
            design=design, beta=beta, cov=inverse * sigma2, xtx_inv=inverse, sigma2=sigma2, conf_level=self.conf_level,
            stats={"num_rows": n, "num_params": len(at), "dof": dof, "sse": sse}, steps=steps,
            spreads=[float(deviation[i + 1] / deviation[-1]) if deviation[-1] > 0 else 0.0 for i in chosen],
            totals={"sst": sst, "mean": mean})
        model.settings = {"GLMS_FTR_SELECTION": "GLMS_FTR_SELECTION_ENABLE", "GLMS_FTR_SEL_CRIT": self.criterion.upper(),
                          "GLMS_FTR_GENERATION": "GLMS_FTR_GENERATION_ENABLE" if self.quadratic
                          else "GLMS_FTR_GENERATION_DISABLE",
                          "GLMS_PRUNE_MODEL": "GLMS_PRUNE_MODEL_DISABLE" if self.prune_level is None
                          else "GLMS_PRUNE_MODEL_ENABLE"}
        model.default_settings = {"GLMS_CONF_LEVEL": self.conf_level, "ODMS_MISSING_VALUE_TREATMENT":
                                  "ODMS_MISSING_VALUE_MEAN_MODE"}
        model.signature = [(x, "NUMBER") for x in self.numeric] + [(x, "VARCHAR2") for x in self.categorical]
        model.add_view("D", lambda: spark.createDataFrame(model.coefficient_rows(), COEFFICIENT_SCHEMA),
                       "GLM Regression Attribute Diagnostics")
        model.add_view("G", lambda: spark.createDataFrame(global_statistics(n, len(at), sse, sst, mean), GLOBAL_SCHEMA),
                       "Global Name-Value Pairs")
        model.add_view("S", lambda: spark.createDataFrame(
            [(i, x.feature, x.action, x.sse_before, x.sse_after, x.f_value, x.p_value, x.level, x.wealth)
             for i, x in enumerate(steps, 1)],
            "step int, feature_expression string, action string, sse_before double, sse_after double, f_value double, "
            "p_value double, level double, wealth double"), "Feature Selection Steps")
        model.add_view("W", lambda: spark.createDataFrame(
            [(x.feature, f"{x.feature} is collinear with the model and was left out") for x in steps
             if x.action == "COLLINEAR"], "feature_expression string, alert string"), "Model Build Alerts")
        model.add_view("N", lambda: spark.createDataFrame(
            [(x, design.shift[x], design.scale[x]) for x in self.numeric],
            "attribute_name string, shift double, scale double"), "Normalization and Missing Value Handling")
        return model


# --------------------------------------------------------------------- row diagnostics
def regression_rows(model: LinearModel, df: DataFrame, case_id: str) -> DataFrame:
    """View A of a linear model: hat, residual, std_err_residual, studentized_residual, pred_res, cooks_d.

    ``studentized_residual`` leaves the row itself out of the variance; ``pred_res`` is the residual
    of a model without the row.  A projection with the p x p inverse as literals; rows with a NULL
    target have NULL residuals.
    """
    y, pred, h = F.col(model.target).cast("double"), model.prediction(df), model.leverage(df)
    p, dof = float(model.stats["num_params"]), float(model.stats["dof"])
    base = df.select(F.col(case_id).alias("case_id"), y.alias("target_value"), pred.alias("predicted_target_value"),
                     h.alias("hat"), (y - pred).alias("residual"))
    r, h, s2 = F.col("residual"), F.col("hat"), F.lit(float(model.sigma2))
    se = F.sqrt(s2 * (1 - h))
    without = F.sqrt((s2 * dof - r * r / (1 - h)) / (dof - 1) * (1 - h))
    return base.select("*", se.alias("std_err_residual"), (r / without).alias("studentized_residual"),
                       (r / (1 - h)).alias("pred_res"), (r * r * h / (s2 * p * (1 - h) * (1 - h))).alias("cooks_d"))


def classification_rows(model: LinearModel, df: DataFrame, case_id: str) -> DataFrame:
    """View A of a logistic model: hat, working, Pearson and deviance residuals, c, cbar, difdev, difchisq.

    ``c`` and ``cbar`` are the confidence-interval displacements, ``difdev`` and ``difchisq`` the
    changes of deviance and chi-squared when the row is left out.
    """
    y, mu = F.col(model.target).cast("double"), model.prediction(df)
    base = df.select(F.col(case_id).alias("case_id"), y.alias("target_value"), mu.alias("mu"),
                     model.leverage(df).alias("x_inverse_x"))
    y, mu = F.col("target_value"), F.col("mu")
    v = mu * (1 - mu)
    h = F.col("x_inverse_x") * v
    pearson = (y - mu) / F.sqrt(v)
    deviance = F.when(y == 1, F.sqrt(-2 * F.log(mu))).otherwise(-F.sqrt(-2 * F.log(1 - mu)))
    cbar = pearson * pearson * h / (1 - h)
    return base.select("case_id", "target_value", F.when(y == 1, mu).otherwise(1 - mu).alias("target_value_prob"),
                       h.alias("hat"), ((y - mu) / v).alias("working_residual"), pearson.alias("pearson_residual"),
                       deviance.alias("deviance_residual"), (cbar / (1 - h)).alias("c"), cbar.alias("cbar"),
                       (deviance * deviance + cbar).alias("difdev"), (cbar / h).alias("difchisq"))
