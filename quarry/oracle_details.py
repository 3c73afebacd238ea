"""DuckDB oracle SQL for ``quarry.catalog_details``."""

from __future__ import annotations

from quarry.oracle import CASE360, NB_CATEGORICAL, NB_NUMERIC, R, _nb_ctes, _split


def oracle_sql() -> dict[str, str]:
    q = {}
    attrs = ", ".join(f"('{a}')" for a in NB_NUMERIC + NB_CATEGORICAL)
    q["nb_left_out_details"] = _nb_ctes() + f""",
term AS (SELECT l.cust_id, l.attr, x.t, ln(coalesce(cond.p, 1.0 / CAST(x.n_ac + x.V AS DOUBLE))) AS s
         FROM along l JOIN nac x ON x.attr = l.attr
         LEFT JOIN cond ON cond.attr = l.attr AND cond.val = l.val AND cond.t = x.t),
without AS (SELECT a.cust_id, v.attr, g.t, g.l - coalesce(term.s, 0) AS l
            FROM applyv a CROSS JOIN (VALUES {attrs}) v(attr) JOIN logit g ON g.cust_id = a.cust_id
            LEFT JOIN term ON term.cust_id = a.cust_id AND term.attr = v.attr AND term.t = g.t),
odds AS (SELECT cust_id, attr, max(CASE WHEN t = 1 THEN l END) - max(CASE WHEN t = 0 THEN l END) AS o
         FROM without GROUP BY cust_id, attr)
SELECT cust_id, attribute_name, CASE WHEN weight = 0 THEN 0.0 ELSE weight END AS weight  -- no negative zeros
FROM (SELECT o.cust_id, o.attr AS attribute_name, round(w.p1 - 1 / (1 + exp(-o.o)), {R}) AS weight
      FROM odds o JOIN wide w ON w.cust_id = o.cust_id)"""
    q["user_algorithm_weights"] = f"""WITH {CASE360},
b AS (SELECT region, CAST(n_orders AS DOUBLE) AS x, CAST(coalesce(acctbal, 0) AS DOUBLE) AS z, sum_qty AS y
      FROM case360 WHERE {_split(0)}),
m AS (SELECT region, avg(x) AS mx, avg(z) AS mz, avg(y) AS my, var_pop(x) AS xx, var_pop(z) AS zz,
             covar_pop(x, z) AS xz, covar_pop(x, y) AS xy, covar_pop(z, y) AS zy FROM b GROUP BY region),
f AS (SELECT region, (zz * xy - xz * zy) / (xx * zz - xz * xz) AS bx, (xx * zy - xz * xy) / (xx * zz - xz * xz) AS bz,
             mx, mz, my FROM m),
s AS (SELECT c.cust_id, c.region, my + bx * (c.n_orders - mx) + bz * (coalesce(c.acctbal, 0) - mz) AS p,
             bx * c.n_orders AS px, bz * coalesce(c.acctbal, 0) AS pz
      FROM case360 c JOIN f ON f.region = c.region WHERE {_split(2).replace('cust_id', 'c.cust_id')})
SELECT cust_id, region, 'n_orders' AS attribute_name, round(p / (p - px), {R}) AS weight FROM s
UNION ALL SELECT cust_id, region, 'acctbal', round(p / (p - pz), {R}) FROM s"""
    return q
