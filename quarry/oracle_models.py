"""DuckDB oracle SQL for the SQL-checkable pieces of the model queries."""

from __future__ import annotations

from quarry.oracle import CASE360, R, _split

KM_COLS = ["acctbal", "n_orders", "sum_qty"]
NUMERIC = ["acctbal", "n_orders", "avg_price", "sum_qty", "last_gap_days"]
OC_BINS = 10


def oracle_sql() -> dict[str, str]:
    q = {}
    cols = ["one", "acctbal", "n_orders", "sum_qty"]
    dec = """d AS (SELECT CAST(1 AS DECIMAL(12,2)) AS one, CAST(acctbal AS DECIMAL(12,2)) AS acctbal,
               CAST(n_orders AS DECIMAL(12,2)) AS n_orders, CAST(sum_qty AS DECIMAL(12,2)) AS sum_qty FROM case360)"""
    parts = " UNION ALL ".join(
        f"SELECT '{cols[i]}' AS attr_i, '{cols[j]}' AS attr_j, CAST(sum({cols[i]} * {cols[j]}) AS DOUBLE) AS value FROM d"
        for i in range(len(cols)) for j in range(i, len(cols)))
    q["gram_matrix"] = f"WITH {CASE360}, {dec}\n{parts}"
    fit = f"""WITH {CASE360},
b AS (SELECT * FROM case360 WHERE {_split(0)} AND sum_qty IS NOT NULL),
f AS (SELECT regr_intercept(sum_qty, CAST(n_orders AS DOUBLE)) AS a, regr_slope(sum_qty, CAST(n_orders AS DOUBLE)) AS s FROM b),
ap AS (SELECT cust_id, sum_qty AS actual, f.a + f.s * n_orders AS predicted FROM case360 CROSS JOIN f WHERE {_split(2)})"""
    q["glm_1d_coefficients"] = fit + f"\nSELECT round(a, {R}) AS intercept, round(s, {R}) AS slope FROM f"
    q["rmse_mae"] = fit + f"""
SELECT round(sqrt(avg((predicted - actual) * (predicted - actual))), {R}) AS rmse,
       round(avg(abs(predicted - actual)), {R}) AS mae FROM ap"""
    q["mape"] = fit + f"""
SELECT round(avg(abs((predicted - actual) / CASE WHEN actual = 0 THEN 1.0 ELSE actual END)), {R}) AS mape FROM ap"""
    st = ", ".join(f"avg(CAST({a} AS DOUBLE)) AS m_{a}, stddev_samp(CAST({a} AS DOUBLE)) AS s_{a}" for a in KM_COLS)
    z = ", ".join(f"(CAST({a} AS DOUBLE) - m_{a}) / s_{a} AS {a}" for a in KM_COLS)
    init = ", ".join(f"avg({a}) AS {a}" for a in KM_COLS)
    dist = lambda g: " + ".join(f"(z.{a} - c{g}.{a}) * (z.{a} - c{g}.{a})" for a in KM_COLS)
    q["kmeans_lloyd_step"] = f"""WITH {CASE360},
st AS (SELECT {st} FROM case360),
z AS (SELECT cust_id, {z} FROM case360 CROSS JOIN st),
init AS (SELECT ((cust_id % 4) + 4) % 4 AS g, {init} FROM z GROUP BY 1),
c0 AS (SELECT * FROM init WHERE g = 0), c1 AS (SELECT * FROM init WHERE g = 1),
c2 AS (SELECT * FROM init WHERE g = 2), c3 AS (SELECT * FROM init WHERE g = 3),
d AS (SELECT z.*, {dist(0)} AS d0, {dist(1)} AS d1, {dist(2)} AS d2, {dist(3)} AS d3
      FROM z CROSS JOIN c0 CROSS JOIN c1 CROSS JOIN c2 CROSS JOIN c3),
a AS (SELECT *, least(d0, d1, d2, d3) AS dm FROM d),
b AS (SELECT *, CASE WHEN d0 = dm THEN 0 WHEN d1 = dm THEN 1 WHEN d2 = dm THEN 2 ELSE 3 END AS cluster FROM a)
SELECT CAST(cluster AS INTEGER) AS cluster, count(*) AS n, """ + ", ".join(
        f"round(avg({a}), {R}) AS {a}" for a in KM_COLS) + ", round(sum(dm), 3) AS sse FROM b GROUP BY cluster"
    mm = ", ".join(f"min(CAST({a} AS DOUBLE)) AS lo_{a}, max(CAST({a} AS DOUBLE)) AS hi_{a}" for a in NUMERIC)
    bins = " UNION ALL ".join(
        f"SELECT '{a}' AS attribute_name, CAST(b AS INTEGER) AS bin_id, "
        f"round(lo_{a} + (b - 1) * ((hi_{a} - lo_{a}) / {OC_BINS}), {R}) AS lower_bin_boundary, "
        f"round(lo_{a} + b * ((hi_{a} - lo_{a}) / {OC_BINS}), {R}) AS upper_bin_boundary "
        f"FROM mm CROSS JOIN range(1, {OC_BINS + 1}) t(b) WHERE lo_{a} IS NOT NULL" for a in NUMERIC)
    q["ocluster_bins"] = f"WITH {CASE360},\nmm AS (SELECT {mm} FROM case360)\n{bins}"
    return q
