"""DuckDB oracle SQL for the queries in ``quarry.catalog_ops``."""

from __future__ import annotations

from quarry.oracle import CASE360, R, _bin, _split

NUMERIC = ["acctbal", "n_orders", "avg_price", "sum_qty", "last_gap_days"]
CATEGORICAL = ["segment", "nation", "region"]
AR_MIN_SUPPORT = 0.02
CV_FOLDS = 10


def _mm(src: str, cols=NUMERIC) -> str:
    return "SELECT " + ", ".join(
        f"min(CAST({a} AS DOUBLE)) AS lo_{a}, max(CAST({a} AS DOUBLE)) AS hi_{a}" for a in cols) + f" FROM {src}"


def _fold(key: str, target: str, k: int) -> str:
    """Row numbers within the class, in the order of a fixed integer mix of the key."""
    mixed = f"(((({key} % 2147483648) + 2147483648) % 2147483648) * 1103515245 + 12345) % 2147483648"
    return f"CAST((row_number() OVER (PARTITION BY {target} ORDER BY {mixed}, {key}) - 1) % {k} AS INTEGER)"


BASKETS = """b AS (SELECT l_orderkey AS txn, p_brand AS item, sum(l_extendedprice) AS v
       FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey, p_brand)"""


def _apriori_ctes() -> str:
    return f"""WITH {BASKETS},
nt AS (SELECT count(DISTINCT txn) AS n FROM b),
mc AS (SELECT greatest(1, CAST(ceil(CAST({AR_MIN_SUPPORT} AS DOUBLE) * n - 1e-9) AS BIGINT)) AS c FROM nt),
s1 AS (SELECT item AS i1, count(*) AS cnt, sum(v) AS v1 FROM b GROUP BY item
       HAVING count(*) >= (SELECT c FROM mc)),
s2 AS (SELECT x.item AS i1, y.item AS i2, count(*) AS cnt, sum(x.v) AS v1, sum(y.v) AS v2
       FROM b x JOIN b y ON x.txn = y.txn AND x.item < y.item
       GROUP BY x.item, y.item HAVING count(*) >= (SELECT c FROM mc)),
s3 AS (SELECT x.item AS i1, y.item AS i2, z.item AS i3, count(*) AS cnt,
              sum(x.v) AS v1, sum(y.v) AS v2, sum(z.v) AS v3
       FROM b x JOIN b y ON x.txn = y.txn AND x.item < y.item
                JOIN b z ON z.txn = x.txn AND y.item < z.item
       GROUP BY x.item, y.item, z.item HAVING count(*) >= (SELECT c FROM mc)),
isets AS (SELECT i1 AS itemset, 1 AS k, cnt FROM s1
          UNION ALL SELECT i1 || ',' || i2, 2, cnt FROM s2
          UNION ALL SELECT i1 || ',' || i2 || ',' || i3, 3, cnt FROM s3),
rules0 AS (
  SELECT i1 AS antecedent, i2 AS consequent, i1 || ',' || i2 AS itemset, cnt, v2 AS cv FROM s2
  UNION ALL SELECT i2, i1, i1 || ',' || i2, cnt, v1 FROM s2
  UNION ALL SELECT i1 || ',' || i2, i3, i1 || ',' || i2 || ',' || i3, cnt, v3 FROM s3
  UNION ALL SELECT i1 || ',' || i3, i2, i1 || ',' || i2 || ',' || i3, cnt, v2 FROM s3
  UNION ALL SELECT i2 || ',' || i3, i1, i1 || ',' || i2 || ',' || i3, cnt, v1 FROM s3),
rules AS (
  SELECT r.antecedent, r.consequent, r.cnt, r.cv,
         CAST(r.cnt AS DOUBLE) / nt.n AS support,
         (CAST(r.cnt AS DOUBLE) / nt.n) / (CAST(a.cnt AS DOUBLE) / nt.n) AS confidence,
         (CAST(r.cnt AS DOUBLE) / nt.n) / (CAST(a.cnt AS DOUBLE) / nt.n) / (CAST(c.cnt AS DOUBLE) / nt.n) AS lift,
         CAST(a.cnt AS DOUBLE) / nt.n AS coverage,
         (CAST(r.cnt AS DOUBLE) / nt.n) / (CAST(c.cnt AS DOUBLE) / nt.n) AS reverse_confidence
  FROM rules0 r JOIN isets a ON a.itemset = r.antecedent JOIN isets c ON c.itemset = r.consequent
  CROSS JOIN nt)
"""


def ops_sql() -> dict[str, str]:
    q = {}
    q["star_nested_sums"] = """
WITH bo AS (SELECT l_orderkey, p_type, sum(l_extendedprice) AS amount
            FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey, p_type)
SELECT o_custkey AS cust_id, p_type, round(sum(amount), 2) AS amount
FROM bo JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, p_type"""
    q["txn_density"] = f"""WITH {BASKETS}
SELECT count(DISTINCT txn) AS n_txn, count(DISTINCT item) AS n_items, count(*) AS n_rows,
       round(100.0 * count(*) / (CAST(count(DISTINCT txn) AS DOUBLE) * count(DISTINCT item)), 4) AS density
FROM b"""
    q["avg_items_per_txn"] = f"""WITH {BASKETS}
SELECT round(avg(cp), {R}) AS avg_items FROM (SELECT txn, count(item) AS cp FROM b GROUP BY txn)"""
    q["topn_by_group"] = f"""WITH {CASE360}
SELECT nation, cust_id, acctbal, CAST(rnk AS BIGINT) AS rnk FROM (
  SELECT nation, cust_id, acctbal, rank() OVER (PARTITION BY nation ORDER BY acctbal DESC, cust_id) AS rnk
  FROM case360) WHERE rnk <= 3"""
    q["union_distinct"] = """
SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier"""
    q["text_dedup"] = """
SELECT min(doc_id) AS doc_id, count(*) AS copies FROM documents WHERE length(text) >= 70 GROUP BY text"""
    q["width_bucket_hist"] = f"""WITH {CASE360}
SELECT CAST(CASE WHEN acctbal < 0.0 THEN 0 WHEN acctbal >= 10000.0 THEN 11
            ELSE floor((acctbal - 0.0) / ((10000.0 - 0.0) / 10)) + 1 END AS BIGINT) AS bucket,
       count(*) AS n
FROM case360 GROUP BY 1"""
    q["unpivot"] = f"""WITH {CASE360}
""" + " UNION ALL ".join(
        f"SELECT cust_id, '{a}' AS attribute_name, CAST({a} AS DOUBLE) AS value FROM case360 WHERE {a} IS NOT NULL"
        for a in NUMERIC)
    stats = ", ".join(f"avg(CAST({a} AS DOUBLE)) AS m_{a}, stddev_samp(CAST({a} AS DOUBLE)) AS s_{a}" for a in NUMERIC)
    q["standardize"] = f"""WITH {CASE360}, st AS (SELECT {stats} FROM case360)
SELECT cust_id, """ + ", ".join(
        f"round((CAST({a} AS DOUBLE) - m_{a}) / CASE WHEN s_{a} IS NULL OR s_{a} = 0 THEN 1.0 ELSE s_{a} END, 5) AS {a}"
        for a in NUMERIC) + " FROM case360 CROSS JOIN st"
    imp_num = ["acctbal", "n_orders", "sum_qty", "last_gap_days"]
    means = ", ".join(f"avg(CAST({a} AS DOUBLE)) AS m_{a}" for a in imp_num)
    mode_parts = " UNION ALL ".join(
        f"SELECT '{a}' AS attribute_name, CAST({a} AS VARCHAR) AS v FROM case360 WHERE {a} IS NOT NULL"
        for a in CATEGORICAL)
    modes = f"""modes AS (SELECT attribute_name, v AS mode_value, n AS mode_count FROM (
  SELECT attribute_name, v, n, row_number() OVER (PARTITION BY attribute_name ORDER BY n DESC, v) AS r
  FROM (SELECT attribute_name, v, count(*) AS n FROM ({mode_parts}) GROUP BY attribute_name, v)) WHERE r = 1)"""
    q["impute_mean_mode"] = f"""WITH {CASE360}, mv AS (SELECT {means} FROM case360), {modes}
SELECT cust_id, """ + ", ".join(
        f"round(coalesce(CAST({a} AS DOUBLE), m_{a}), {R}) AS {a}" for a in imp_num) + ", " + ", ".join(
        f"coalesce({a}, (SELECT mode_value FROM modes WHERE attribute_name = '{a}')) AS {a}" for a in CATEGORICAL) + \
        " FROM case360 CROSS JOIN mv"
    q["mode_table"] = f"""WITH {CASE360}, {modes}
SELECT attribute_name, mode_value, CAST(mode_count AS BIGINT) AS mode_count FROM modes"""
    q["equi_width_bins"] = f"""WITH {CASE360}, mm AS ({_mm('case360')})
SELECT cust_id, """ + ", ".join(f"CAST({_bin(a)} AS INTEGER) AS {a}" for a in NUMERIC) + \
        " FROM case360 CROSS JOIN mm"
    q["class_weights"] = f"""WITH {CASE360}, c AS (SELECT affinity AS target_value, count(*) AS n_c FROM case360 GROUP BY affinity)
SELECT target_value, n_c,
       round(CAST(sum(n_c) OVER () AS DOUBLE) / (count(*) OVER () * n_c), {R}) AS class_weight FROM c"""
    q["fold_assign"] = f"""WITH {CASE360}
SELECT cust_id, affinity, {_fold('cust_id', 'affinity', CV_FOLDS)} AS fold FROM case360 WHERE {_split(0)}"""
    q["mdl_importance"] = _mdl_sql()
    q["pairwise_kl"] = _kl_sql()
    ap = _apriori_ctes()
    q["apriori_itemsets"] = ap + f"""
SELECT itemset, CAST(k AS INTEGER) AS number_of_items, CAST(cnt AS BIGINT) AS count,
       round(CAST(cnt AS DOUBLE) / (SELECT n FROM nt), {R}) AS support FROM isets"""
    q["apriori_top_itemsets"] = ap + f"""
SELECT itemset, CAST(k AS INTEGER) AS number_of_items,
       round(CAST(cnt AS DOUBLE) / (SELECT n FROM nt), {R}) AS support
FROM isets ORDER BY k, CAST(cnt AS DOUBLE) / (SELECT n FROM nt), itemset LIMIT 10"""
    q["apriori_rules"] = ap + f"""
SELECT antecedent, consequent, CAST(cnt AS BIGINT) AS rule_count, round(support, {R}) AS support,
       round(confidence, {R}) AS confidence, round(lift, {R}) AS lift, round(coverage, {R}) AS coverage,
       round(reverse_confidence, {R}) AS reverse_confidence
FROM rules WHERE confidence >= 0.1"""
    q["rule_aggregates"] = ap + """
SELECT antecedent, consequent, round(cv, 2) AS con_rule_amount FROM rules WHERE confidence >= 0.1"""
    q["itemset_aggregates"] = ap + """
SELECT i1 AS itemset, i1 AS item, round(v1, 2) AS value_sum FROM s1
UNION ALL SELECT i1 || ',' || i2, i1, round(v1, 2) FROM s2
UNION ALL SELECT i1 || ',' || i2, i2, round(v2, 2) FROM s2
UNION ALL SELECT i1 || ',' || i2 || ',' || i3, i1, round(v1, 2) FROM s3
UNION ALL SELECT i1 || ',' || i2 || ',' || i3, i2, round(v2, 2) FROM s3
UNION ALL SELECT i1 || ',' || i2 || ',' || i3, i3, round(v3, 2) FROM s3"""
    cv = _cv_ctes()
    q["cv_accuracy"] = cv + f""",
per AS (SELECT fold, sum(CASE WHEN actual = predicted THEN cnt ELSE 0 END) AS correct, sum(cnt) AS total
        FROM cm GROUP BY fold)
SELECT fold, round(avg(round(CAST(correct AS DOUBLE) / total, 4)), {R}) AS accuracy
FROM per GROUP BY ROLLUP (fold)"""
    q["cv_confusion"] = cv + """
SELECT actual, predicted, fold, CAST(count AS BIGINT) AS count FROM (
  SELECT actual, predicted, fold, sum(cnt) AS count FROM cm GROUP BY ROLLUP (actual, predicted, fold))
WHERE predicted IS NOT NULL"""
    from quarry.oracle import _nb_ctes
    q["accuracy_by_segment"] = _nb_ctes() + """
SELECT a.segment, count(*) AS n,
       round(100.0 * avg(CASE WHEN a.affinity IS NOT DISTINCT FROM t.prediction THEN 1.0 ELSE 0.0 END), 2) AS accuracy_pct
FROM top t JOIN applyv a ON a.cust_id = t.cust_id GROUP BY a.segment"""
    return q


def _keys(cols_num, cols_cat) -> str:
    return ", ".join([f"{_bin(a)} AS {a}" for a in cols_num] + [f"CAST({a} AS VARCHAR) AS {a}" for a in cols_cat])


def _mdl_sql() -> str:
    attrs = NUMERIC + CATEGORICAL
    long = " UNION ALL ".join(
        f"SELECT '{a}' AS attr, {a} AS val, t FROM k WHERE {a} IS NOT NULL" for a in attrs)
    return f"""WITH {CASE360},
build AS (SELECT * FROM case360 WHERE {_split(0)} AND affinity IS NOT NULL),
mm AS ({_mm('build')}),
k AS (SELECT CAST(affinity AS VARCHAR) AS t, {_keys(NUMERIC, CATEGORICAL)} FROM build CROSS JOIN mm),
h AS (SELECT attr, val, t, count(*) AS n FROM ({long}) GROUP BY attr, val, t),
x AS (SELECT attr, val, t, n, sum(n) OVER (PARTITION BY attr) AS nn,
             sum(n) OVER (PARTITION BY attr, val) AS n_v, sum(n) OVER (PARTITION BY attr, t) AS n_t FROM h),
pa AS (SELECT attr, max(nn) AS nn, -sum(n * ln(n / n_v)) AS hc, count(DISTINCT val) AS vv,
              count(DISTINCT t) AS kk FROM x GROUP BY attr),
ht AS (SELECT attr, -sum(n_t * ln(n_t / nn)) AS hh FROM (SELECT DISTINCT attr, t, n_t, nn FROM x) GROUP BY attr),
v AS (SELECT pa.attr,
             CASE WHEN hh / nn / ln(2) <= 0 THEN 0.0 ELSE greatest(0.0,
               ((hh - hc) / nn / ln(2) - (vv - 1) * (kk - 1) * (ln(CAST(nn AS DOUBLE)) / ln(2)) / (2.0 * nn))
               / (hh / nn / ln(2))) END AS value
      FROM pa JOIN ht ON pa.attr = ht.attr)
SELECT attr AS attribute_name, round(value, {R}) AS explanatory_value,
       dense_rank() OVER (ORDER BY value DESC) AS rank FROM v"""


def _kl_sql() -> str:
    attrs = NUMERIC + CATEGORICAL
    pairs = [(a, b) for i, a in enumerate(attrs) for b in attrs[i + 1:]]
    joint = " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, {a} AS va, {b} AS vb FROM k WHERE {a} IS NOT NULL AND {b} IS NOT NULL"
        for a, b in pairs)
    return f"""WITH {CASE360},
mm AS ({_mm('case360')}),
k AS (SELECT {_keys(NUMERIC, CATEGORICAL)} FROM case360 CROSS JOIN mm),
j AS (SELECT a, b, va, vb, count(*) AS n FROM ({joint}) GROUP BY a, b, va, vb),
x AS (SELECT a, b, n, sum(n) OVER (PARTITION BY a, b) AS nn, sum(n) OVER (PARTITION BY a, b, va) AS na,
             sum(n) OVER (PARTITION BY a, b, vb) AS nb FROM j)
SELECT least(a, b) AS attribute_1, greatest(a, b) AS attribute_2,
       round(sum((CAST(n AS DOUBLE) / nn) * ln(CAST(n AS DOUBLE) * nn / (CAST(na AS DOUBLE) * nb))), {R}) AS kl
FROM x GROUP BY a, b"""


def _cv_ctes() -> str:
    attrs = NUMERIC + CATEGORICAL
    cl = " UNION ALL ".join(
        f"SELECT cust_id, fold, t, '{a}' AS attr, {a} AS val FROM ck WHERE {a} IS NOT NULL" for a in attrs)
    return f"""WITH {CASE360},
cvb AS (SELECT *, {_fold('cust_id', 'affinity', CV_FOLDS)} AS fold FROM case360 WHERE {_split(0)} AND affinity IS NOT NULL),
mm AS ({_mm('cvb')}),
ck AS (SELECT cust_id, fold, affinity AS t, {_keys(NUMERIC, CATEGORICAL)} FROM cvb CROSS JOIN mm),
cl AS ({cl}),
fc AS (SELECT fold, attr, val, t, count(*) AS n FROM cl GROUP BY fold, attr, val, t),
fl AS (SELECT DISTINCT fold AS m FROM cvb),
tr AS (SELECT fl.m, fc.attr, fc.val, fc.t, sum(fc.n) AS n FROM fc JOIN fl ON fc.fold <> fl.m
       GROUP BY fl.m, fc.attr, fc.val, fc.t),
cc AS (SELECT fl.m, c.affinity AS t, count(*) AS n_c FROM cvb c JOIN fl ON c.fold <> fl.m GROUP BY fl.m, c.affinity),
ntr AS (SELECT m, sum(n_c) AS n_tr FROM cc GROUP BY m),
vals AS (SELECT m, attr, count(DISTINCT val) AS vv FROM tr GROUP BY m, attr),
nac0 AS (SELECT m, attr, t, sum(n) AS n_ac FROM tr GROUP BY m, attr, t),
nac AS (SELECT v.m, v.attr, c.t, coalesce(n.n_ac, 0) AS n_ac, v.vv
        FROM vals v JOIN cc c ON c.m = v.m LEFT JOIN nac0 n ON n.m = v.m AND n.attr = v.attr AND n.t = c.t),
cond AS (SELECT x.m, x.attr, d.val, x.t,
                (CAST(coalesce(tr.n, 0) AS DOUBLE) + 1) / CAST(x.n_ac + x.vv AS DOUBLE) AS p
         FROM (SELECT DISTINCT m, attr, val FROM tr) d JOIN nac x ON x.m = d.m AND x.attr = d.attr
         LEFT JOIN tr ON tr.m = d.m AND tr.attr = d.attr AND tr.val = d.val AND tr.t = x.t),
sc AS (SELECT l.cust_id, x.t, sum(ln(coalesce(cond.p, 1.0 / CAST(x.n_ac + x.vv AS DOUBLE)))) AS s
       FROM cl l JOIN nac x ON x.m = l.fold AND x.attr = l.attr
       LEFT JOIN cond ON cond.m = l.fold AND cond.attr = l.attr AND cond.val = l.val AND cond.t = x.t
       GROUP BY l.cust_id, x.t),
lg AS (SELECT c.cust_id, c.fold, c.affinity AS actual, k.t,
              ln(CAST(k.n_c AS DOUBLE) / ntr.n_tr) + coalesce(sc.s, 0) AS l
       FROM cvb c JOIN cc k ON k.m = c.fold JOIN ntr ON ntr.m = c.fold
       LEFT JOIN sc ON sc.cust_id = c.cust_id AND sc.t = k.t),
pr AS (SELECT cust_id, fold, actual, t, row_number() OVER (PARTITION BY cust_id ORDER BY l DESC, t) AS r FROM lg),
cm AS (SELECT fold, actual, t AS predicted, count(*) AS cnt FROM pr WHERE r = 1 GROUP BY fold, actual, t)"""


def oracle_sql() -> dict[str, str]:
    return ops_sql()
