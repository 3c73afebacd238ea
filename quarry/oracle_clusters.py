"""DuckDB SQL for ``quarry.catalog_clusters``."""

from __future__ import annotations

from quarry import oracle_models
from quarry.oracle import CASE360, R

NUMERIC = ["acctbal", "n_orders", "sum_qty", "avg_price"]
CATEGORICAL = ["segment", "region"]
BINS, COVERAGE = 10, 0.8


def oracle_sql() -> dict[str, str]:
    clustered = oracle_models.oracle_sql()["kmeans_lloyd_step"].split("SELECT CAST(cluster")[0].rstrip()
    numbers = " UNION ALL ".join(f"SELECT cust_id, c, '{a}' AS a, CAST({a} AS DOUBLE) AS x FROM t WHERE {a} IS NOT NULL" for a in NUMERIC)
    levels = " UNION ALL ".join(f"SELECT cust_id, c, '{a}' AS a, {a} AS v FROM t WHERE {a} IS NOT NULL" for a in CATEGORICAL)
    rules = clustered + f""",
t AS (SELECT case360.*, CAST(b.cluster AS INTEGER) AS c FROM case360 JOIN b USING (cust_id)),
sizes AS (SELECT c, count(*) AS n FROM t GROUP BY c),
l AS ({numbers}),
binned AS (SELECT cust_id, c, l.a, least(greatest(floor((x - lo) / (hi - lo) * {BINS}) + 1, 1), {BINS})::INT AS bin
           FROM l JOIN (SELECT a, min(x) AS lo, max(x) AS hi FROM l GROUP BY a) r USING (a)),
runs AS (SELECT c, a, s::INT AS s, e::INT AS e, count(*) FILTER (WHERE bin BETWEEN s AND e) AS held, count(*) AS known
         FROM binned, range(1, {BINS + 1}) p(s), range(1, {BINS + 1}) q(e) WHERE s <= e GROUP BY ALL),
box AS (SELECT c, a, s, e, held FROM runs WHERE held >= {COVERAGE} * known
        QUALIFY row_number() OVER (PARTITION BY c, a ORDER BY e - s, held DESC, s) = 1),
lv AS ({levels}),
vc AS (SELECT c, a, v, count(*) AS n FROM lv GROUP BY ALL),
ranked AS (SELECT *, sum(n) OVER (PARTITION BY c, a) AS known,
                  sum(n) OVER (PARTITION BY c, a ORDER BY n DESC, v ROWS UNBOUNDED PRECEDING) - n AS before FROM vc),
chosen AS (SELECT c, a, v, n FROM ranked WHERE before < {COVERAGE} * known),
hits AS (SELECT binned.c, binned.cust_id FROM binned JOIN box USING (c, a) WHERE bin BETWEEN s AND e
         UNION ALL SELECT lv.c, lv.cust_id FROM lv JOIN chosen USING (c, a, v)),
boxed AS (SELECT c, count(*) AS m FROM (SELECT c, cust_id FROM hits GROUP BY ALL HAVING count(*) = {len(NUMERIC) + len(CATEGORICAL)})
          GROUP BY c),
sides AS (
  SELECT box.c, box.a, s, e, CAST(NULL AS VARCHAR) AS vs, held,
         (SELECT count(*) FROM binned o WHERE o.a = box.a AND o.bin BETWEEN box.s AND box.e) AS everywhere FROM box
  UNION ALL
  SELECT c, a, NULL, NULL, string_agg(v, ',' ORDER BY v), sum(n),
         sum((SELECT count(*) FROM lv o WHERE o.a = chosen.a AND o.v = chosen.v)) FROM chosen GROUP BY c, a)
SELECT sides.c AS cluster_id, a AS attribute_name, s AS lower_bin, e AS upper_bin, vs AS attribute_values, held::BIGINT AS support,
       round(greatest(0.0, 1 - (everywhere / (SELECT sum(n) FROM sizes)) / (held / sizes.n)), {R}) AS confidence,
       coalesce(m, 0) AS rule_support, round(coalesce(m, 0) / sizes.n, {R}) AS rule_confidence
FROM sides JOIN sizes USING (c) LEFT JOIN boxed USING (c)"""
    means = f"""WITH {CASE360},
s AS (SELECT p_type, sum(l_extendedprice) AS amount FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
      JOIN case360 ON o_custkey = cust_id GROUP BY p_type),
n AS (SELECT count(*) AS n FROM case360)
SELECT 'type_sums' AS attribute_name, p_type AS attribute_subname, round(amount / n, 3) AS mean, n FROM s, n
UNION ALL SELECT 'acctbal', NULL, round(avg(acctbal), 3), count(*) FROM case360
UNION ALL SELECT 'n_orders', NULL, round(avg(n_orders), 3), count(*) FROM case360"""
    return {"cluster_rules": rules, "star_kmeans_means": means}
