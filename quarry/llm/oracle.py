"""DuckDB SQL of the corpus queries that SQL can express on whole tables."""

SQL = {
    "op3_url_filter": r"""
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r
  FROM pages),
parts AS (
  SELECT page_id, row_number() OVER () AS n,
         translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest),
rules(verdict, h, p) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
         ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
fits AS (
  SELECT n, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY n)
SELECT page_id, host, path, rule,
       coalesce(fits.verdict, CASE WHEN host LIKE '%spam%' AND (path = '' OR starts_with(path, '/')) THEN 'block'
                                   ELSE 'allow' END) AS verdict
FROM parts LEFT JOIN fits USING (n)
""",
    "op9_warc": r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (
  SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS hex FROM p),
w AS (
  SELECT *, max(page_id) OVER (PARTITION BY hex) AS winner FROM d),
digits AS (
  SELECT page_id, payload_bytes, winner,
         list_transform(range(0, 8), lambda k: ('0x' || substr(hex, k * 5 + 1, 5))::BIGINT) AS q FROM w)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(q, lambda x: array_to_string(list_transform([15, 10, 5, 0], lambda s:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((x >> s) & 31)::INT + 1, 1)), '')), '') AS payload_digest,
       CASE WHEN page_id = winner THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> winner THEN winner END AS refers_to
FROM digits
""",
    "op11_filter_audit": r"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
flags AS (
  SELECT doc_id, part,
         len(words) < 200 AS a,
         100 * coalesce(list_unique(words), 0) < 50 * len(words) AS b,
         100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 3 * length(t) AS c,
         regexp_matches(t, '[#$%&*|]') AS d,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e
  FROM texts),
marks AS (
  SELECT doc_id, coalesce(max((quality = 1)::INT), 0) AS good, coalesce(max((toxic = 1)::INT), 0) AS toxic
  FROM labels GROUP BY doc_id),
cells AS (
  SELECT part, CASE WHEN a THEN 'A' ELSE '' END || CASE WHEN b THEN 'B' ELSE '' END || CASE WHEN c THEN 'C' ELSE '' END
         || CASE WHEN d THEN 'D' ELSE '' END || CASE WHEN e THEN 'E' ELSE '' END AS fails,
         count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM flags LEFT JOIN marks USING (doc_id) GROUP BY ALL),
letters(f) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
  SELECT p.f || q.f || r.f || s.f || t.f AS filter_order
  FROM letters p, letters q, letters r, letters s, letters t
  WHERE len(list_distinct([p.f, q.f, r.f, s.f, t.f])) = 5),
steps AS (
  SELECT filter_order, step::INT AS step, substr(filter_order, step::INT, 1) AS f,
         substr(filter_order, 1, step::INT - 1) AS earlier
  FROM orders, range(1, 6) AS x(step)),
hits AS (
  SELECT part, filter_order, step, f, n, good, toxic, fails,
         contains(fails, f) AS failing,
         earlier <> '' AND length(translate(fails, earlier, '')) < length(fails) AS gone
  FROM steps, cells),
sums AS (
  SELECT part, filter_order, step, f,
         sum(CASE WHEN NOT gone AND NOT failing THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN NOT gone AND failing THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN gone AND failing THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN fails = f THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN NOT gone AND failing THEN good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN NOT gone AND failing THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM hits GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM sums
""",
}
