"""DuckDB oracle SQL for ``quarry.catalog_stream``."""

from __future__ import annotations

from quarry.oracle import CASE360, R, _split, nb_sql


def oracle_sql() -> dict[str, str]:
    q = {}
    q["stream_nb_apply"] = nb_sql()["nb_apply"]
    q["stream_accumulate"] = """
SELECT event_type, date_trunc('hour', ts) AS window_start, count(*) AS n, round(sum(value), 4) AS total
FROM events GROUP BY event_type, date_trunc('hour', ts)"""
    q["stream_sprt"] = """
WITH RECURSIVE h AS (SELECT event_type, date_trunc('hour', ts) AS w, count(*) AS n, sum(value) AS total
                     FROM events GROUP BY ALL),
cut AS (SELECT date_trunc('hour', min(ts)) + INTERVAL 20 DAYS AS t, max(ts) - INTERVAL 1 HOUR AS closed FROM events),
b AS (SELECT event_type, avg(n) AS mn, stddev_pop(n) AS sn, avg(total) AS mt, stddev_pop(total) AS st
      FROM h, cut WHERE w < t GROUP BY event_type),
z AS (SELECT event_type, w, coalesce((n - mn) / nullif(sn, 0), 0.5) AS a, coalesce((total - mt) / nullif(st, 0), 0.5) AS c,
             row_number() OVER (PARTITION BY event_type ORDER BY w) AS i
      FROM h JOIN b USING (event_type), cut WHERE w >= t AND w + INTERVAL 1 HOUR <= closed),
s(event_type, i, ah, al, ch, cl, alarm) AS (
  SELECT event_type, 0::BIGINT, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0 FROM z WHERE i = 1
  UNION ALL
  SELECT event_type, i,
         CASE WHEN abs(ah) >= ln(9) THEN 0.0 ELSE ah END, CASE WHEN abs(al) >= ln(9) THEN 0.0 ELSE al END,
         CASE WHEN abs(ch) >= ln(9) THEN 0.0 ELSE ch END, CASE WHEN abs(cl) >= ln(9) THEN 0.0 ELSE cl END,
         CASE WHEN greatest(ah, al, ch, cl) >= ln(9) THEN 1 ELSE 0 END
  FROM (SELECT z.event_type, z.i, s.ah + a - 0.5 AS ah, s.al - a - 0.5 AS al, s.ch + c - 0.5 AS ch, s.cl - c - 0.5 AS cl
        FROM s JOIN z ON z.event_type = s.event_type AND z.i = s.i + 1)),
j AS (SELECT event_type, w, alarm, CAST(sum(alarm) OVER (PARTITION BY event_type ORDER BY w
             ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS INTEGER) AS alerts
      FROM s JOIN z USING (event_type, i))
SELECT event_type, w AS window_start, alarm, alerts, CASE WHEN alerts >= 3 THEN 0 ELSE 1 END AS prediction FROM j"""
    fit = f"""WITH {CASE360},
b AS (SELECT * FROM case360 WHERE {_split(0)}),
f AS (SELECT region, regr_intercept(sum_qty, CAST(n_orders AS DOUBLE)) AS a,
             regr_slope(sum_qty, CAST(n_orders AS DOUBLE)) AS s FROM b GROUP BY region)"""
    q["user_algorithm_details"] = fit + f"""
SELECT region AS partition_name, '(intercept)' AS attribute_name, round(a, {R}) AS coefficient FROM f
UNION ALL SELECT region, 'n_orders', round(s, {R}) FROM f"""
    q["user_algorithm_apply"] = fit + f""",
ap AS (SELECT c.region, c.sum_qty AS actual, f.a + f.s * c.n_orders AS predicted
       FROM case360 c JOIN f ON f.region = c.region WHERE {_split(2).replace('cust_id', 'c.cust_id')})
SELECT region AS partition_name, round(sqrt(avg((predicted - actual) * (predicted - actual))), {R}) AS rmse,
       round(avg(abs(predicted - actual)), {R}) AS mae FROM ap GROUP BY region"""
    return q
