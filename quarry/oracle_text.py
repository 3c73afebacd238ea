"""DuckDB oracle SQL for the text queries."""

from __future__ import annotations

from quarry.oracle import R

SPLIT = r"'[^\p{L}\p{N}]+'"


def _tc(src: str, id_col: str, text_col: str, name: str) -> str:
    return f"""{name} AS (SELECT doc_id, term, count(*) AS tf FROM (
    SELECT {id_col} AS doc_id, unnest(regexp_split_to_array(lower({text_col}), {SPLIT})) AS term FROM {src})
  WHERE term <> '' GROUP BY doc_id, term)"""


ESA = f"""{_tc('benchmark', 'item_id', 'text', 'btc0')},
btr AS (SELECT doc_id FROM btc0 GROUP BY doc_id HAVING count(*) >= 5),
btc AS (SELECT btc0.* FROM btc0 JOIN btr USING (doc_id)),
bn AS (SELECT count(DISTINCT doc_id) AS n FROM btc),
voc AS (SELECT term, count(*) AS df, ln(CAST((SELECT n FROM bn) AS DOUBLE) / count(*)) AS idf
        FROM btc GROUP BY term HAVING count(*) >= 2),
braw AS (SELECT doc_id, term, tf * idf AS raw FROM btc JOIN voc USING (term) WHERE tf * idf > 0),
bnorm AS (SELECT doc_id, sqrt(sum(raw * raw)) AS nrm FROM braw GROUP BY doc_id),
idx AS (SELECT doc_id AS feature_id, term, raw / nrm AS weight FROM braw JOIN bnorm USING (doc_id)
        WHERE raw / nrm >= 1e-8)"""


def _esa_vec(src: str, id_col: str, text_col: str, name: str) -> str:
    return f"""{_tc(src, id_col, text_col, name + '_tc')},
{name}_raw AS (SELECT doc_id, term, tf * idf AS raw FROM {name}_tc JOIN voc USING (term) WHERE tf * idf > 0),
{name}_w AS (SELECT r.doc_id, r.term, r.raw / n.nrm AS w FROM {name}_raw r
             JOIN (SELECT doc_id, sqrt(sum(raw * raw)) AS nrm FROM {name}_raw GROUP BY doc_id) n USING (doc_id)),
{name} AS (SELECT w.doc_id AS id, i.feature_id, sum(w.w * i.weight) AS value
           FROM {name}_w w JOIN idx i USING (term) GROUP BY w.doc_id, i.feature_id)"""


def oracle_sql() -> dict[str, str]:
    q = {}
    q["term_extract"] = f"""WITH {_tc('documents', 'doc_id', 'text', 'tc')},
nm AS (SELECT doc_id, sqrt(sum(tf * tf)) AS nrm FROM tc GROUP BY doc_id)
SELECT doc_id, term, round(tf / nrm, {R}) AS value FROM tc JOIN nm USING (doc_id)"""
    q["tfidf"] = f"""WITH {_tc('documents', 'doc_id', 'text', 'tc')},
nd AS (SELECT count(DISTINCT doc_id) AS n FROM tc),
voc AS (SELECT term, count(*) AS df FROM tc GROUP BY term HAVING count(*) >= 2),
w AS (SELECT tc.doc_id, tc.term, tc.tf * ln(CAST(nd.n AS DOUBLE) / voc.df) AS raw
      FROM tc JOIN voc USING (term) CROSS JOIN nd),
w2 AS (SELECT * FROM w WHERE raw > 0),
nm AS (SELECT doc_id, sqrt(sum(raw * raw)) AS nrm FROM w2 GROUP BY doc_id)
SELECT doc_id, term, round(raw / nrm, {R}) AS weight FROM w2 JOIN nm USING (doc_id)"""
    q["text_vocabulary"] = f"""WITH {_tc('documents', 'doc_id', 'text', 'tc')},
nd AS (SELECT count(DISTINCT doc_id) AS n FROM tc)
SELECT term, df, round(ln(CAST((SELECT n FROM nd) AS DOUBLE) / df), {R}) AS idf FROM (
  SELECT term, count(*) AS df FROM tc GROUP BY term ORDER BY count(*) DESC, term LIMIT 3000)"""
    q["esa_index"] = f"""WITH {ESA}
SELECT feature_id, term, round(weight, {R}) AS weight FROM idx"""
    q["esa_top_features"] = f"""WITH {ESA},
{_esa_vec('documents', 'doc_id', 'text', 'dv')}
SELECT id AS doc_id, feature_id, round(value, {R}) AS value, CAST(rnk AS BIGINT) AS rank FROM (
  SELECT id, feature_id, value, row_number() OVER (PARTITION BY id ORDER BY value DESC, feature_id) AS rnk
  FROM dv) WHERE rnk <= 5"""
    q["feature_compare"] = f"""WITH {ESA},
pairs AS (SELECT a.conv_id, a.turn, a.text AS text_a, b.text AS text_b,
                 a.conv_id * 1000000 + a.turn AS pk
          FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1),
{_esa_vec('pairs', 'pk', 'text_a', 'va')},
{_esa_vec('pairs', 'pk', 'text_b', 'vb')},
dot AS (SELECT va.id, sum(va.value * vb.value) AS dot FROM va JOIN vb ON va.id = vb.id AND va.feature_id = vb.feature_id
        GROUP BY va.id),
na AS (SELECT id, sqrt(sum(value * value)) AS na FROM va GROUP BY id),
nb AS (SELECT id, sqrt(sum(value * value)) AS nb FROM vb GROUP BY id)
SELECT p.conv_id, p.turn, round(1.0 - coalesce(dot.dot / (na.na * nb.nb), 0.0), {R}) AS compare
FROM pairs p LEFT JOIN dot ON dot.id = p.pk LEFT JOIN na ON na.id = p.pk LEFT JOIN nb ON nb.id = p.pk"""
    return q
