"""DuckDB SQL for the closed forms of ``quarry.catalog_partitioned``."""

from __future__ import annotations

from quarry.oracle import CASE360, R


def oracle_sql() -> dict[str, str]:
    q = {}
    q["transient_regression"] = f"""WITH {CASE360},
m AS (SELECT region, regr_slope(sum_qty, n_orders) AS b, regr_intercept(sum_qty, n_orders) AS a FROM case360 GROUP BY region)
SELECT cust_id, region, round(a + b * n_orders, 5) AS prediction FROM case360 JOIN m USING (region)"""
    q["partitioned_pca"] = f"""WITH {CASE360},
r AS (SELECT region, abs(corr(acctbal, sum_qty)) AS r FROM case360 WHERE acctbal IS NOT NULL AND sum_qty IS NOT NULL
      GROUP BY region)
SELECT region AS partition_name, 1 AS feature_id, round(1 + r, {R}) AS variance, round((1 + r) / 2, {R}) AS share,
       round((1 + r) / 2, {R}) AS cumulative_share FROM r
UNION ALL SELECT region, 2, round(1 - r, {R}), round((1 - r) / 2, {R}), 1.0 FROM r"""
    return q
