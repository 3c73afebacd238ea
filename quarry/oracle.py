"""Independent ANSI-SQL (DuckDB) formulations of the registered queries.

These strings are the correctness oracle: the driver runs them on the same
Parquet tables and compares row counts, schemas and value hashes with the
Spark results.  They follow the textbook/SQL formulation (per-row windows,
NTILE with tie smearing, LAG trapezoids) rather than our distributed plans,
so a match checks the plans, not just the code path.
"""

from __future__ import annotations

R = 6

NUM_BINS = 10
NB_NUMERIC = ["acctbal", "n_orders", "avg_price", "sum_qty", "last_gap_days"]
NB_CATEGORICAL = ["segment", "nation", "region"]

CASE360 = """
qty AS (SELECT l_orderkey, sum(l_quantity) AS qty FROM lineitem GROUP BY l_orderkey),
md AS (SELECT max(o_orderdate) AS max_date FROM orders),
per_cust AS (
  SELECT o_custkey, count(*) AS n_orders,
         sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS price_cents,
         sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS n_urgent,
         sum(qty) AS sum_qty, max(o_orderdate) AS last_order
  FROM orders LEFT JOIN qty ON o_orderkey = l_orderkey
  GROUP BY o_custkey),
case360 AS (
  SELECT c_custkey AS cust_id, c_mktsegment AS segment, n_name AS nation, r_name AS region,
         c_acctbal AS acctbal,
         CAST(coalesce(n_orders, 0) AS BIGINT) AS n_orders,
         CAST(price_cents AS DOUBLE) / CAST(n_orders AS DOUBLE) / 100.0 AS avg_price,
         CAST(coalesce(sum_qty, 0.0) AS DOUBLE) AS sum_qty,
         CAST(date_diff('day', CAST(last_order AS DATE), CAST(md.max_date AS DATE)) AS BIGINT) AS last_gap_days,
         CAST(CASE WHEN coalesce(n_urgent, 0) >= 2 THEN 1 ELSE 0 END AS INTEGER) AS affinity
  FROM customer
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN per_cust ON c_custkey = o_custkey
  CROSS JOIN md)
"""


def _split(n: int) -> str:
    return f"(((cust_id % 3) + 3) % 3) = {n}"


def _bin(a: str) -> str:
    x = f"CAST({a} AS DOUBLE)"
    lo, hi = f"mm.lo_{a}", f"mm.hi_{a}"
    return (f"CASE WHEN {a} IS NULL THEN NULL WHEN {hi} = {lo} THEN '1' ELSE "
            f"CAST(CAST(least(greatest(floor(({x} - {lo}) / ({hi} - {lo}) * {NUM_BINS}) + 1, 1), "
            f"{NUM_BINS}) AS BIGINT) AS VARCHAR) END")


def _nb_ctes(priors: bool = True) -> str:
    mm = ", ".join([f"min(CAST({a} AS DOUBLE)) AS lo_{a}, max(CAST({a} AS DOUBLE)) AS hi_{a}"
                    for a in NB_NUMERIC])
    keys = ", ".join([f"{_bin(a)} AS {a}" for a in NB_NUMERIC] +
                     [f"CAST({a} AS VARCHAR) AS {a}" for a in NB_CATEGORICAL])
    attrs = NB_NUMERIC + NB_CATEGORICAL
    blong = " UNION ALL ".join(
        [f"SELECT affinity AS t, '{a}' AS attr, {a} AS val FROM bkeyed WHERE {a} IS NOT NULL" for a in attrs])
    along = " UNION ALL ".join(
        [f"SELECT cust_id, '{a}' AS attr, {a} AS val FROM akeyed WHERE {a} IS NOT NULL" for a in attrs])
    prior = ("SELECT * FROM (VALUES (0, 0.65), (1, 0.35)) v(t, pr)" if priors else
             "SELECT t, CAST(n_c AS DOUBLE) / (SELECT sum(n_c) FROM classes) AS pr FROM classes")
    return f"""WITH {CASE360},
build AS (SELECT * FROM case360 WHERE {_split(0)}),
applyv AS (SELECT * FROM case360 WHERE {_split(2)}),
mm AS (SELECT {mm} FROM build),
bkeyed AS (SELECT affinity, {keys} FROM build CROSS JOIN mm),
akeyed AS (SELECT cust_id, {keys} FROM applyv CROSS JOIN mm),
blong AS ({blong}),
counts AS (SELECT attr, val, t, count(*) AS n FROM blong GROUP BY attr, val, t),
classes AS (SELECT affinity AS t, count(*) AS n_c FROM build GROUP BY affinity),
vals AS (SELECT attr, count(DISTINCT val) AS V FROM counts GROUP BY attr),
nac0 AS (SELECT attr, t, sum(n) AS n_ac FROM counts GROUP BY attr, t),
nac AS (SELECT v.attr, c.t, coalesce(n.n_ac, 0) AS n_ac, v.V
        FROM vals v CROSS JOIN classes c LEFT JOIN nac0 n ON n.attr = v.attr AND n.t = c.t),
cond AS (SELECT d.attr, d.val, x.t, coalesce(cn.n, 0) AS n,
                (CAST(coalesce(cn.n, 0) AS DOUBLE) + 1) / CAST(x.n_ac + x.V AS DOUBLE) AS p
         FROM (SELECT DISTINCT attr, val FROM counts) d
         JOIN nac x ON x.attr = d.attr
         LEFT JOIN counts cn ON cn.attr = d.attr AND cn.val = d.val AND cn.t = x.t),
priors0 AS ({prior}),
priors AS (SELECT t, CAST(pr AS DOUBLE) / (SELECT sum(CAST(pr AS DOUBLE)) FROM priors0) AS pr FROM priors0),
along AS ({along}),
sc AS (SELECT l.cust_id, x.t, sum(ln(coalesce(cond.p, 1.0 / CAST(x.n_ac + x.V AS DOUBLE)))) AS s
       FROM along l JOIN nac x ON x.attr = l.attr
       LEFT JOIN cond ON cond.attr = l.attr AND cond.val = l.val AND cond.t = x.t
       GROUP BY l.cust_id, x.t),
logit AS (SELECT a.cust_id, p.t, ln(p.pr) + coalesce(sc.s, 0) AS l
          FROM applyv a CROSS JOIN priors p LEFT JOIN sc ON sc.cust_id = a.cust_id AND sc.t = p.t),
lmax AS (SELECT cust_id, t, exp(l - max(l) OVER (PARTITION BY cust_id)) AS e FROM logit),
nb AS (SELECT cust_id, CAST(t AS INTEGER) AS prediction,
              e / sum(e) OVER (PARTITION BY cust_id) AS probability
       FROM lmax),
top AS (SELECT cust_id, prediction FROM (
          SELECT cust_id, prediction, row_number() OVER (PARTITION BY cust_id ORDER BY probability DESC, prediction) rn
          FROM nb) WHERE rn = 1),
wide AS (SELECT cust_id, max(CASE WHEN prediction = 0 THEN probability END) AS p0,
                max(CASE WHEN prediction = 1 THEN probability END) AS p1 FROM nb GROUP BY cust_id),
scored AS (SELECT a.cust_id, round(w.p1, {R}) AS score, coalesce(a.affinity = 1, FALSE) AS hit
           FROM wide w JOIN applyv a ON a.cust_id = w.cust_id),
size AS (SELECT count(*) AS n, count(*) FILTER (WHERE hit) AS hits, count(*) FILTER (WHERE NOT hit) AS others
         FROM scored),
cuts AS (SELECT c.score AS cut, count(*) FILTER (WHERE s.hit) AS caught, count(*) FILTER (WHERE NOT s.hit) AS wrong
         FROM (SELECT DISTINCT score FROM scored) c JOIN scored s ON s.score >= c.score
         GROUP BY c.score),
priced AS (SELECT cut, caught, wrong, hits - caught AS missed, others - wrong AS spared,
                  0.35::DOUBLE * wrong + 0.65::DOUBLE * (hits - caught) AS price
           FROM cuts CROSS JOIN size),
cheapest AS (SELECT min(cut) AS cut FROM priced WHERE price = (SELECT min(price) FROM priced)),
even AS (SELECT a.v AS actual, p.v AS said,
                CASE WHEN a.v = p.v THEN 0.0 WHEN a.v = 1 THEN 1 / cut - 1 ELSE 1.0 END AS price
         FROM (VALUES (0), (1)) a(v) CROSS JOIN (VALUES (0), (1)) p(v) CROSS JOIN cheapest)
"""


def nb_sql() -> dict[str, str]:
    base = _nb_ctes()
    q = {}
    q["case_view"] = f"""WITH {CASE360}
SELECT cust_id, segment, nation, region, acctbal, n_orders, avg_price, sum_qty, last_gap_days, affinity,
       ((cust_id % 3) + 3) % 3 AS split FROM case360"""
    q["nb_priors"] = base + f"""
SELECT CAST(p.t AS INTEGER) AS target_value, round(p.pr, {R}) AS prior_probability,
       CAST(c.n_c AS BIGINT) AS count
FROM priors p JOIN classes c ON c.t = p.t"""
    q["nb_conditionals"] = base + f"""
SELECT attr AS attribute_name, val AS attribute_value, CAST(t AS INTEGER) AS target_value,
       round(p, {R}) AS conditional_probability, CAST(n AS BIGINT) AS count FROM cond"""
    q["nb_apply"] = base + f"""
SELECT cust_id, prediction, round(probability, {R}) AS probability FROM nb"""
    q["nb_predict_cost"] = base + f"""
SELECT w.cust_id, t.prediction,
       CASE WHEN w.p1 * 0.65 <= w.p0 * 0.35 THEN 0 ELSE 1 END AS cost_prediction,
       round(w.p1, {R}) AS prob_1,
       round(w.p1 * CAST(0.65 AS DOUBLE), {R}) AS cost_0,
       round(w.p0 * CAST(0.35 AS DOUBLE), {R}) AS cost_1
FROM wide w JOIN top t ON t.cust_id = w.cust_id"""
    q["confusion_matrix"] = base + """
SELECT a.affinity AS actual_target_value, t.prediction AS predicted_target_value, count(*) AS value
FROM top t JOIN applyv a ON a.cust_id = t.cust_id GROUP BY 1, 2"""
    q["confusion_matrix_cost"] = base + """
SELECT a.affinity AS actual_target_value,
       CASE WHEN w.p1 * CAST(0.65 AS DOUBLE) <= w.p0 * CAST(0.35 AS DOUBLE) THEN 0 ELSE 1 END AS predicted_target_value,
       count(*) AS value
FROM wide w JOIN applyv a ON a.cust_id = w.cust_id GROUP BY 1, 2"""
    q["accuracy"] = base + f"""
SELECT round(avg(CASE WHEN a.affinity IS NOT DISTINCT FROM t.prediction THEN 1.0 ELSE 0.0 END), {R}) AS accuracy
FROM top t JOIN applyv a ON a.cust_id = t.cust_id"""
    q["lift"] = base + f""",
placed AS (SELECT score, row_number() OVER (ORDER BY score DESC) AS place, n, hits,
                  avg(hit::INT) OVER (PARTITION BY score) AS share
           FROM scored CROSS JOIN size),
dealt AS (SELECT *, CASE WHEN place <= (n % 10) * (n // 10 + 1) THEN (place - 1) // (n // 10 + 1) + 1
                         ELSE n % 10 + (place - 1 - (n % 10) * (n // 10 + 1)) // (n // 10) + 1 END AS tenth
          FROM placed),
tenths AS (SELECT tenth, min(score) AS least, count(*) AS k, sum(share) AS found, any_value(n) AS n,
                  any_value(hits) AS hits FROM dealt GROUP BY tenth),
upto AS (SELECT t.tenth, t.least, t.k, t.found, t.n, t.hits, sum(u.k) AS ks, sum(u.found) AS founds
         FROM tenths t JOIN tenths u ON u.tenth <= t.tenth GROUP BY ALL)
SELECT tenth::INT AS quantile_number, round(least, {R}) AS probability_threshold, k::BIGINT AS quantile_total_count,
       round(founds, {R}) AS targets_cumulative, round(ks - founds, {R}) AS non_targets_cumulative,
       round(ks::DOUBLE / n, {R}) AS percentage_records_cumulative, round(founds / hits, {R}) AS gain_cumulative,
       round(founds * n / (hits * ks::DOUBLE), {R}) AS lift_cumulative,
       round(found * n / (hits * k::DOUBLE), {R}) AS lift_quantile,
       round(founds / ks, {R}) AS target_density_cumulative, round(found / k, {R}) AS target_density
FROM upto"""
    q["roc"] = base + f"""
SELECT round(cut, {R}) AS probability, caught AS true_positives, missed AS false_negatives,
       wrong AS false_positives, spared AS true_negatives, round(caught::DOUBLE / hits, {R}) AS true_positive_fraction,
       round(wrong::DOUBLE / others, {R}) AS false_positive_fraction
FROM priced CROSS JOIN size"""
    # of the cuts that a hit lies on, and the last, the highest point for each count of wrong ones
    q["roc_corners"] = base + f"""
SELECT round(min(cut), {R}) AS prob, round(max(caught)::DOUBLE / any_value(hits), {R}) AS tpf,
       round(wrong::DOUBLE / any_value(others), {R}) AS fpf, max(caught) AS tp, min(missed) AS fn,
       wrong AS fp, min(spared) AS tn
FROM priced CROSS JOIN size
WHERE cut IN (SELECT score FROM scored WHERE hit) OR cut = (SELECT min(score) FROM scored)
GROUP BY wrong"""
    # the rank-sum statistic with mid-ranks for ties
    q["auc"] = base + f""",
ranked AS (SELECT s.hit, (count(*) FILTER (WHERE o.score < s.score)) + (count(*) FILTER (WHERE o.score = s.score) + 1) / 2.0
                  AS midrank
           FROM scored s CROSS JOIN scored o GROUP BY s.cust_id, s.hit, s.score)
SELECT round((sum(midrank) FILTER (WHERE hit) - any_value(hits) * (any_value(hits) + 1) / 2.0)
             / (any_value(hits)::DOUBLE * any_value(others)), {R}) AS auc
FROM ranked CROSS JOIN size"""
    q["threshold_cost"] = base + f"""
SELECT round(cut, {R}) AS threshold, caught AS hits, missed AS misses, wrong AS false_alarms,
       spared AS correct_rejections, round(price, {R}) AS total_cost
FROM priced ORDER BY price, cut LIMIT 10"""
    q["cost_from_threshold"] = base + f"""
SELECT actual AS actual_target_value, said AS predicted_target_value, round(price, {R})::DOUBLE AS cost FROM even"""
    q["rank_apply"] = base + f""",
ec AS (SELECT w.cust_id, k.p AS score,
              CASE WHEN k.p = 0 THEN w.p0 ELSE w.p1 END AS chance,
              w.p0 * (SELECT price FROM even WHERE actual = 0 AND said = k.p)
            + w.p1 * (SELECT price FROM even WHERE actual = 1 AND said = k.p) AS cost
       FROM wide w CROSS JOIN (VALUES (0), (1)) k(p)),
rk AS (SELECT *, row_number() OVER (PARTITION BY cust_id ORDER BY cost, chance DESC, score) AS rnk FROM ec)
SELECT cust_id AS customer_id, CAST(score AS INTEGER) AS score, round(chance, {R}) AS chance,
       round(cost, {R}) AS cost, CAST(rnk AS BIGINT) AS rank
FROM rk WHERE rnk <= 2"""
    return q


def oracle_sql() -> dict[str, str]:
    out = {}
    out.update(nb_sql())
    return out
