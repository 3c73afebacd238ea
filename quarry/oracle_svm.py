"""DuckDB SQL for ``quarry.catalog_svm``.

On one 0/1 attribute no decision value reaches 1 in size, so every row is a support vector and the
squared hinge is a ridge regression on -1 and 1; the sigmoid meets each group's mean target.
"""

from __future__ import annotations

from quarry.catalog_svm import REG
from quarry.oracle import CASE360, R


def oracle_sql() -> dict[str, str]:
    ctes = f"""WITH {CASE360},
g AS (SELECT cust_id, affinity, CASE WHEN n_orders >= 10 THEN 1.0 ELSE 0.0 END AS x FROM case360),
z AS (SELECT *, (x - avg(x) OVER ()) / stddev_samp(x) OVER () AS z, 2.0 * affinity - 1 AS y FROM g),
m AS (SELECT avg(y * z) / (avg(z * z) + {REG}) AS w, avg(y) AS b, sum(affinity) AS n1, sum(1 - affinity) AS n0 FROM z)"""
    return {
        "svm_group_coefficients": ctes + f"""
SELECT '1' AS target_value, 'frequent' AS attribute_name, CAST(NULL AS VARCHAR) AS attribute_value, round(w, {R}) AS coefficient
FROM m UNION ALL SELECT '1', NULL, NULL, round(b, {R}) FROM m""",
        "svm_group_probabilities": ctes + """,
p AS (SELECT cust_id, avg(CASE WHEN affinity = 1 THEN (n1 + 1) / (n1 + 2) ELSE 1 / (n0 + 2) END) OVER (PARTITION BY x) AS p1
      FROM z, m)
SELECT cust_id, CASE WHEN p1 > 0.5 THEN 1 ELSE 0 END AS prediction, round(greatest(p1, 1 - p1), 5) AS probability FROM p""",
    }
