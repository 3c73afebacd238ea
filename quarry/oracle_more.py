"""DuckDB oracle SQL for ``quarry.catalog_more``."""

from __future__ import annotations

from quarry.oracle import CASE360, R, _split

NB_NUMERIC = ["acctbal", "n_orders", "avg_price", "sum_qty", "last_gap_days"]


def _bin(a: str, bins: int = 10) -> str:
    x = f"CAST({a} AS DOUBLE)"
    lo, hi = f"mm.lo_{a}", f"mm.hi_{a}"
    return (f"CASE WHEN {a} IS NULL THEN NULL WHEN {hi} = {lo} THEN '1' ELSE "
            f"CAST(CAST(least(greatest(floor(({x} - {lo}) / ({hi} - {lo}) * {bins}) + 1, 1), "
            f"{bins}) AS BIGINT) AS VARCHAR) END")


def nb_generic(numeric: list[str], categorical: list[str], part: str | None = None,
               build: str = "build", apply: str = "applyv") -> str:
    """CTEs (appended to an open WITH) ending in ``nb(cust_id, prediction, probability)`` and ``wide``.

    Data priors; equi-width bins on the build range (per partition when
    ``part`` is given); Laplace-smoothed conditionals; unseen value
    1 / (n_ac + V); NULL attributes skipped.
    """
    P = f"{part}, " if part else ""
    pk = "'all'" if not part else part
    on_p = lambda a, b: f" AND {a}.pk = {b}.pk"
    mm = ", ".join(f"min(CAST({a} AS DOUBLE)) AS lo_{a}, max(CAST({a} AS DOUBLE)) AS hi_{a}" for a in numeric)
    keys = ", ".join([f"{_bin(a)} AS {a}" for a in numeric] + [f"CAST({a} AS VARCHAR) AS {a}" for a in categorical])
    attrs = numeric + categorical
    blong = " UNION ALL ".join(
        f"SELECT pk, affinity AS t, '{a}' AS attr, {a} AS val FROM bk WHERE {a} IS NOT NULL" for a in attrs)
    along = " UNION ALL ".join(
        f"SELECT pk, cust_id, '{a}' AS attr, {a} AS val FROM ak WHERE {a} IS NOT NULL" for a in attrs)
    return f"""
mm AS (SELECT {pk} AS pk, {mm} FROM {build} {'GROUP BY ' + part if part else ''}),
bk AS (SELECT mm.pk, affinity, {keys} FROM {build} b JOIN mm ON mm.pk = {('b.' + part) if part else "'all'"}),
ak AS (SELECT mm.pk, cust_id, {keys} FROM {apply} a JOIN mm ON mm.pk = {('a.' + part) if part else "'all'"}),
bl AS ({blong}),
counts AS (SELECT pk, attr, val, t, count(*) AS n FROM bl GROUP BY pk, attr, val, t),
allc AS (SELECT DISTINCT affinity AS t FROM {build}),
pks AS (SELECT DISTINCT pk FROM mm),
cls0 AS (SELECT {pk} AS pk, affinity AS t, count(*) AS n_c FROM {build} GROUP BY {P}affinity),
cls AS (SELECT p.pk, c.t, coalesce(x.n_c, 0) AS n_c FROM pks p CROSS JOIN allc c
        LEFT JOIN cls0 x ON x.pk = p.pk AND x.t = c.t),
ptot AS (SELECT pk, sum(n_c) AS n FROM cls GROUP BY pk),
vals AS (SELECT pk, attr, count(DISTINCT val) AS vv FROM counts GROUP BY pk, attr),
nac0 AS (SELECT pk, attr, t, sum(n) AS n_ac FROM counts GROUP BY pk, attr, t),
nac AS (SELECT v.pk, v.attr, c.t, coalesce(n.n_ac, 0) AS n_ac, v.vv FROM vals v
        JOIN cls c ON c.pk = v.pk LEFT JOIN nac0 n ON n.pk = v.pk AND n.attr = v.attr AND n.t = c.t),
cond AS (SELECT d.pk, d.attr, d.val, x.t,
                (CAST(coalesce(cn.n, 0) AS DOUBLE) + 1) / CAST(x.n_ac + x.vv AS DOUBLE) AS p
         FROM (SELECT DISTINCT pk, attr, val FROM counts) d
         JOIN nac x ON x.pk = d.pk AND x.attr = d.attr
         LEFT JOIN counts cn ON cn.pk = d.pk AND cn.attr = d.attr AND cn.val = d.val AND cn.t = x.t),
al AS ({along}),
sc AS (SELECT l.cust_id, x.t, sum(ln(coalesce(cond.p, 1.0 / CAST(x.n_ac + x.vv AS DOUBLE)))) AS s
       FROM al l JOIN nac x ON x.pk = l.pk AND x.attr = l.attr
       LEFT JOIN cond ON cond.pk = l.pk AND cond.attr = l.attr AND cond.val = l.val AND cond.t = x.t
       GROUP BY l.cust_id, x.t),
ap AS (SELECT DISTINCT pk, cust_id FROM ak),
logit AS (SELECT a.cust_id, c.t,
                 CASE WHEN c.n_c > 0 THEN ln(CAST(c.n_c AS DOUBLE) / pt.n) ELSE -1e9 END + coalesce(sc.s, 0) AS l
          FROM ap a JOIN cls c ON c.pk = a.pk JOIN ptot pt ON pt.pk = a.pk
          LEFT JOIN sc ON sc.cust_id = a.cust_id AND sc.t = c.t),
lmax AS (SELECT cust_id, t, exp(l - max(l) OVER (PARTITION BY cust_id)) AS e FROM logit),
nb AS (SELECT cust_id, CAST(t AS INTEGER) AS prediction, e / sum(e) OVER (PARTITION BY cust_id) AS probability
       FROM lmax),
top AS (SELECT cust_id, prediction FROM (
          SELECT cust_id, prediction,
                 row_number() OVER (PARTITION BY cust_id ORDER BY probability DESC, prediction) AS rn FROM nb)
        WHERE rn = 1),
wide AS (SELECT cust_id, max(CASE WHEN prediction = 0 THEN probability END) AS p0,
                max(CASE WHEN prediction = 1 THEN probability END) AS p1 FROM nb GROUP BY cust_id)"""


def oracle_sql() -> dict[str, str]:
    q = {}
    daily = """days AS (SELECT CAST(o_orderdate AS DATE) AS day, sum(o_totalprice) AS value FROM orders GROUP BY 1),
cal AS (SELECT CAST(range AS DATE) AS day FROM range((SELECT min(day) FROM days),
        (SELECT max(day) FROM days) + INTERVAL 1 DAY, INTERVAL 1 DAY)),
filled AS (SELECT cal.day, coalesce(days.value, 0.0) AS value FROM cal LEFT JOIN days USING (day))"""
    q["series_accumulate"] = f"""WITH {daily}
SELECT day, round(value, 2) AS value FROM filled"""
    q["esm_simple_fixed"] = f"""WITH RECURSIVE {daily},
ser AS (SELECT row_number() OVER (ORDER BY day) AS i, day, round(value, 2) AS y FROM filled),
sm(i, day, s) AS (
  SELECT i, day, y FROM ser WHERE i = 1
  UNION ALL
  SELECT ser.i, ser.day, CAST(0.3 AS DOUBLE) * ser.y + (1 - CAST(0.3 AS DOUBLE)) * sm.s
  FROM sm JOIN ser ON ser.i = sm.i + 1)
SELECT day, round(s, 4) AS smoothed FROM sm"""
    part = f"""WITH {CASE360},
build AS (SELECT * FROM case360 WHERE {_split(0)} AND affinity IS NOT NULL AND region IS NOT NULL),
applyv AS (SELECT * FROM case360 WHERE {_split(2)} AND region IN (SELECT DISTINCT region FROM build)),
{nb_generic(NB_NUMERIC, ["segment", "nation"], part="region")}"""
    q["partitioned_nb_apply"] = part + f"""
SELECT a.cust_id, a.region AS partition_name, t.prediction, round(w.p1, {R}) AS prob_1
FROM applyv a JOIN top t ON t.cust_id = a.cust_id JOIN wide w ON w.cust_id = a.cust_id"""
    q["partitioned_accuracy"] = part + """
SELECT a.region AS partition_name, count(*) AS n,
       round(100.0 * avg(CASE WHEN a.affinity IS NOT DISTINCT FROM t.prediction THEN 1.0 ELSE 0.0 END), 2) AS accuracy_pct
FROM applyv a JOIN top t ON t.cust_id = a.cust_id GROUP BY a.region"""
    q["transient_nb"] = f"""WITH {CASE360},
build AS (SELECT cust_id, affinity, acctbal, segment, n_orders FROM case360 WHERE {_split(0)} AND affinity IS NOT NULL),
applyv AS (SELECT * FROM build),
{nb_generic(["acctbal", "n_orders"], ["segment"])}
SELECT b.cust_id, round(w.p1, 2) AS pred_prob
FROM build b JOIN top t ON t.cust_id = b.cust_id JOIN wide w ON w.cust_id = b.cust_id
WHERE b.affinity = 0 AND t.prediction = 1"""
    return q
