"""Closed forms in DuckDB SQL for ``quarry.catalog_closed``."""

from __future__ import annotations

from quarry.oracle import CASE360, R


def oracle_sql() -> dict[str, str]:
    q = {}
    q["glm_two_predictors"] = f"""WITH {CASE360},
s AS (SELECT avg(sum_qty) AS my, avg(n_orders) AS m1, avg(acctbal) AS m2, var_pop(n_orders) AS v1,
             var_pop(acctbal) AS v2, covar_pop(n_orders, acctbal) AS c12, covar_pop(sum_qty, n_orders) AS c1,
             covar_pop(sum_qty, acctbal) AS c2 FROM case360),
b AS (SELECT *, (c1 * v2 - c2 * c12) / (v1 * v2 - c12 * c12) AS b1, (c2 * v1 - c1 * c12) / (v1 * v2 - c12 * c12) AS b2 FROM s)
SELECT '(intercept)' AS attribute_name, round(my - b1 * m1 - b2 * m2, {R}) AS coefficient FROM b
UNION ALL SELECT 'n_orders', round(b1, {R}) FROM b
UNION ALL SELECT 'acctbal', round(b2, {R}) FROM b"""
    q["glm_logistic_groups"] = f"""WITH {CASE360},
g AS (SELECT avg(affinity) FILTER (WHERE n_orders < 10) AS p0, avg(affinity) FILTER (WHERE n_orders >= 10) AS p1
      FROM case360)
SELECT round(ln(p0 / (1 - p0)), 5) AS log_odds, round(ln(p1 / (1 - p1)) - ln(p0 / (1 - p0)), 5) AS difference FROM g"""
    q["pca_two_columns"] = f"""WITH {CASE360},
r AS (SELECT abs(corr(acctbal, sum_qty)) AS r FROM case360)
SELECT 1 AS feature_id, round((1 + r) / 2, {R}) AS variance_share FROM r
UNION ALL SELECT 2, round((1 - r) / 2, {R}) FROM r"""
    q["aft_exact"] = """WITH g AS (
  SELECT o_totalprice / 100000 AS price, date_diff('day', CAST(o_orderdate AS DATE), CAST(
           lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS DATE)) AS gap
  FROM orders)
SELECT round(regr_intercept(ln(gap), price), 5) AS intercept, round(regr_slope(ln(gap), price), 5) AS slope,
       count(*) AS events
FROM g WHERE gap > 0"""
    q["one_hot_names"] = f"""WITH {CASE360}
SELECT DISTINCT 'segment' AS attribute_name, segment AS attribute_value FROM case360 WHERE segment IS NOT NULL
UNION ALL SELECT DISTINCT 'region', region FROM case360 WHERE region IS NOT NULL"""
    q["normalization_view"] = f"""WITH {CASE360}
SELECT 'acctbal' AS attribute_name, round(avg(acctbal), {R}) AS shift, round(stddev_samp(acctbal), {R}) AS scale FROM case360
UNION ALL SELECT 'n_orders', round(avg(n_orders), {R}), round(stddev_samp(n_orders), {R}) FROM case360
UNION ALL SELECT 'sum_qty', round(avg(sum_qty), {R}), round(stddev_samp(sum_qty), {R}) FROM case360"""
    return q
