"""DuckDB SQL for ``quarry.catalog_selection``: residuals row by row instead of one swept Gram matrix."""

from __future__ import annotations

from quarry.oracle import CASE360

NUMERIC = ["n_orders", "acctbal", "avg_price"]
FORCED = "acctbal"


def _stream() -> list[tuple[str, str, bool]]:
    """(feature, SQL, forced) in the order in which the features are tried; forced ones first."""
    terms = [(a, f"z_{a}") for a in NUMERIC]
    terms += [(f"{a}*{b}", f"z_{a} * z_{b}") for i, a in enumerate(NUMERIC) for b in NUMERIC[i:]]
    return [(n, e, True) for n, e in terms if n == FORCED] + [(n, e, False) for n, e in terms if n != FORCED]


def _selection(enters: str) -> str:
    """Each step projects the target and the remaining features on the one that enters.

    ``enters`` is a condition on gain, sse, n, inside (features so far), tests and wealth.
    """
    terms = _stream()
    m = len(terms)
    z = ", ".join(f"coalesce((CAST({a} AS DOUBLE) - avg({a}) OVER ()) / stddev_samp({a}) OVER (), 0) AS z_{a}"
                  for a in NUMERIC)
    raw = ", ".join(f"{e} AS x{k}" for k, (_, e, _) in enumerate(terms))
    centred = ", ".join(f"x{k} - avg(x{k}) OVER () AS x{k}" for k in range(m))
    ctes = [CASE360.strip(), f"z AS (SELECT CAST(sum_qty AS DOUBLE) AS y, {z} FROM case360 WHERE sum_qty IS NOT NULL)",
            f"raw AS (SELECT y, {raw} FROM z)", f"r0 AS (SELECT y - avg(y) OVER () AS y, {centred} FROM raw)",
            "s0 AS (SELECT 0 AS inside, 0 AS tests, CAST(0.5 AS DOUBLE) AS wealth)"]
    for k, (_, _, forced) in enumerate(terms):
        slopes = ", ".join([f"sum(y * x{k}) / sum(x{k} * x{k}) AS b"] +
                           [f"sum(x{j} * x{k}) / sum(x{k} * x{k}) AS b{j}" for j in range(k + 1, m)])
        ctes.append(f"g{k} AS (SELECT count(*) AS n, sum(y * y) AS sse, power(sum(y * x{k}), 2) / sum(x{k} * x{k}) AS gain, "
                    f"{slopes} FROM r{k})")
        test = "TRUE" if forced else enters
        ctes.append(f"d{k} AS (SELECT g{k}.*, s.*, s.tests + {0 if forced else 1} AS test, "
                    f"s.wealth / (2 * (s.tests + 1)) AS level FROM g{k}, s{k} s)")
        ctes.append(f"e{k} AS (SELECT *, CASE WHEN {test} THEN 1 ELSE 0 END AS enters FROM d{k})")
        pay = "wealth" if forced else "wealth - level + 0.5 * enters"
        ctes.append(f"s{k + 1} AS (SELECT inside + enters AS inside, test AS tests, {pay} AS wealth FROM e{k})")
        kept = ", ".join([f"r.y - e.enters * e.b * r.x{k} AS y"] +
                         [f"r.x{j} - e.enters * e.b{j} * r.x{k} AS x{j}" for j in range(k + 1, m)])
        ctes.append(f"r{k + 1} AS (SELECT {kept} FROM r{k} r, e{k} e)")
    steps = " UNION ALL ".join(
        f"SELECT {k + 1} AS step, '{name}' AS feature_expression, "
        + ("'FORCED'" if forced else "CASE WHEN enters = 1 THEN 'ADDED' ELSE 'REJECTED' END")
        + f" AS action, round(sse, 2) AS sse_before, round(sse - enters * gain, 2) AS sse_after FROM e{k}"
        for k, (name, _, forced) in enumerate(terms))
    return "WITH " + ",\n".join(ctes) + "\n" + steps


#: F of the step, and the two-sided normal tail of its root (polynomial of the error function, error below 2e-7).
_F = "(gain / ((sse - gain) / (n - inside - 2)))"
_T = f"(1 / (1 + 0.3275911 * sqrt({_F} / 2)))"
_TAIL = (f"({_T} * (0.254829592 + {_T} * (-0.284496736 + {_T} * (1.421413741 + {_T} * (-1.453152027 + {_T} * 1.061405429)))) "
         f"* exp(-least({_F} / 2, 700)))")


def oracle_sql() -> dict[str, str]:
    q = {}
    q["glm_selection_alpha"] = _selection(f"{_TAIL} <= level")
    q["glm_selection_sbic"] = _selection("n * ln(sse / (sse - gain)) > ln(n)")
    line = f"""WITH {CASE360},
t AS (SELECT cust_id, CAST(sum_qty AS DOUBLE) AS y, CAST(n_orders AS DOUBLE) AS x FROM case360),
s AS (SELECT count(*) AS n, avg(y) AS my, avg(x) AS mx, regr_slope(y, x) AS b, regr_intercept(y, x) AS a,
             regr_sxx(y, x) AS sxx, regr_syy(y, x) AS sst FROM t),
e AS (SELECT sum(power(y - a - b * x, 2)) AS sse FROM t, s),
m AS (SELECT *, sst - sse AS ssr, sse / (n - 2) AS mse FROM s, e)"""
    numbers = {
        "ADJUSTED_R_SQUARE": "1 - (sse / (n - 2)) / (sst / (n - 1))", "AIC": "n * ln(sse / n) + 4",
        "COEFF_VAR": "100 * sqrt(mse) / my", "CORRECTED_TOTAL_DF": "n - 1", "CORRECTED_TOT_SS": "sst",
        "DEPENDENT_MEAN": "my", "ERROR_DF": "n - 2", "ERROR_MEAN_SQUARE": "mse", "ERROR_SUM_SQUARES": "sse",
        "F_VALUE": "ssr / mse", "GMSEP": "mse * (n + 1) * (n - 2) / (n * (n - 3.0))", "HOCKING_SP": "mse / (n - 3)",
        "J_P": "mse * (n + 2) / n", "MODEL_DF": "1", "MODEL_F_P_VALUE": "CASE WHEN ssr / mse > 100 THEN 0 END",
        "MODEL_MEAN_SQUARE": "ssr", "MODEL_SUM_SQUARES": "ssr", "NUM_PARAMS": "2", "NUM_ROWS": "n",
        "ROOT_MEAN_SQ": "sqrt(mse)", "R_SQ": "ssr / sst", "SBIC": "n * ln(sse / n) + 2 * ln(n)"}
    q["glm_global_statistics"] = line + "\n" + " UNION ALL ".join(
        f"SELECT '{k}' AS name, round(CAST({v} AS DOUBLE), 4) AS numeric_value, CAST(NULL AS VARCHAR) AS string_value FROM m"
        for k, v in numbers.items()) + """
UNION ALL SELECT 'CONVERGED', NULL, 'YES' UNION ALL SELECT 'VALID_COVARIANCE_MATRIX', NULL, 'YES'"""
    # a row's residual without the row, from the sums without it
    q["glm_regression_rows"] = line + """,
h AS (SELECT cust_id, y, a + b * x AS p, 1.0 / n + power(x - mx, 2) / sxx AS hat, y - a - b * x AS r, m.* FROM t, m),
w AS (SELECT *, r / (1 - hat) AS without, (sse - r * r / (1 - hat)) / (n - 3) AS v FROM h)
SELECT cust_id AS case_id, round(y, 5) AS target_value, round(p, 5) AS predicted_target_value, round(hat, 5) AS hat,
       round(r, 5) AS residual, round(sqrt(mse * (1 - hat)), 5) AS std_err_residual,
       round(r / sqrt(v * (1 - hat)), 5) AS studentized_residual, round(without, 5) AS pred_res,
       round(power(without, 2) * hat / (2 * mse), 5) AS cooks_d
FROM w"""
    # both groups are fitted by their own shares, so a row's hat value is one over its group's rows
    q["glm_classification_rows"] = f"""WITH {CASE360},
t AS (SELECT cust_id, CAST(affinity AS DOUBLE) AS y, n_orders >= 10 AS g FROM case360),
s AS (SELECT *, avg(y) OVER (PARTITION BY g) AS mu, 1.0 / count(*) OVER (PARTITION BY g) AS h FROM t),
r AS (SELECT *, (y - mu) / sqrt(mu * (1 - mu)) AS pearson,
             CASE WHEN y = 1 THEN sqrt(-2 * ln(mu)) ELSE -sqrt(-2 * ln(1 - mu)) END AS dev FROM s)
SELECT cust_id AS case_id, y AS target_value, round(CASE WHEN y = 1 THEN mu ELSE 1 - mu END, 5) AS target_value_prob,
       round(h, 5) AS hat, round((y - mu) / (mu * (1 - mu)), 5) AS working_residual, round(pearson, 5) AS pearson_residual,
       round(dev, 5) AS deviance_residual, round(pearson * pearson * h / power(1 - h, 2), 5) AS c,
       round(pearson * pearson * h / (1 - h), 5) AS cbar, round(dev * dev + pearson * pearson * h / (1 - h), 5) AS difdev,
       round(pearson * pearson / (1 - h), 5) AS difchisq
FROM r"""
    return q
