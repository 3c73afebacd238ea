"""DuckDB SQL for ``quarry.catalog_bins``: the gain of every cut of every interval, level by level."""

from __future__ import annotations

from quarry.oracle import CASE360, R

COLS = ["acctbal", "n_orders", "avg_price", "sum_qty", "last_gap_days"]
GRID, LEVELS = 64, 4


def _h(*counts: str) -> str:
    n = "(" + " + ".join(counts) + ")"
    return " + ".join(f"CASE WHEN {c} > 0 THEN -({c}::DOUBLE / {n}) * log2({c}::DOUBLE / {n}) ELSE 0 END" for c in counts)


def _kinds(*counts: str) -> str:
    return " + ".join(f"({c} > 0)::INT" for c in counts)


def oracle_sql() -> dict[str, str]:
    long = " UNION ALL ".join(f"SELECT '{a}' AS a, CAST({a} AS DOUBLE) AS x, affinity AS t FROM case360 WHERE {a} IS NOT NULL"
                              for a in COLS)
    ctes = [CASE360.strip(), f"l AS ({long})",
            "r AS (SELECT a, min(x) AS lo, (max(x) - min(x)) / {g} AS w FROM l GROUP BY a)".format(g=GRID),
            f"""c AS (SELECT a, least({GRID - 1}, floor((x - lo) / w))::INT AS cell, count(*) FILTER (WHERE t = 0) AS n0,
  count(*) FILTER (WHERE t = 1) AS n1 FROM l JOIN r USING (a) GROUP BY ALL)""",
            f"i1 AS (SELECT a, 0 AS low, {GRID} AS high FROM r)"]
    for k in range(1, LEVELS + 1):
        ctes.append(f"""g{k} AS (
  SELECT i.a, low, high, cut, sum(CASE WHEN cell < cut THEN n0 ELSE 0 END) AS b0, sum(CASE WHEN cell < cut THEN n1 ELSE 0 END) AS b1,
         sum(CASE WHEN cell >= cut THEN n0 ELSE 0 END) AS u0, sum(CASE WHEN cell >= cut THEN n1 ELSE 0 END) AS u1
  FROM i{k} i JOIN c ON c.a = i.a AND cell >= low AND cell < high, range(1, {GRID}) AS q(cut)
  WHERE cut > low AND cut < high GROUP BY ALL)""")
        ctes.append(f"""e{k} AS (
  SELECT *, b0 + b1 + u0 + u1 AS n, {_h('(b0 + u0)', '(b1 + u1)')} AS e, {_h('b0', 'b1')} AS eb, {_h('u0', 'u1')} AS eu,
         {_kinds('(b0 + u0)', '(b1 + u1)')} AS k, {_kinds('b0', 'b1')} AS kb, {_kinds('u0', 'u1')} AS ku
  FROM g{k} WHERE b0 + b1 > 0 AND u0 + u1 > 0)""")
        ctes.append(f"""f{k} AS (
  SELECT *, e - ((b0 + b1) * eb + (u0 + u1) * eu) / n AS gain,
         (log2(n - 1) + log2(power(3, k) - 2) - (k * e - kb * eb - ku * eu)) / n AS price FROM e{k})""")
        ctes.append(f"""s{k} AS (
  SELECT a, low, high, cut, gain FROM f{k} WHERE gain > price
  AND (a, low, cut) IN (SELECT (a, low, min(cut)) FROM f{k} JOIN (SELECT a, low, max(gain) AS top FROM f{k} GROUP BY a, low)
                        USING (a, low) WHERE gain >= top - 1e-12 GROUP BY a, low))""")
        ctes.append(f"i{k + 1} AS (SELECT a, low, cut AS high FROM s{k} UNION ALL SELECT a, cut, high FROM s{k})")
    out = " UNION ALL ".join(
        f"SELECT a AS attribute_name, {k} AS level, low::INT AS low_cell, high::INT AS high_cell, cut::INT AS cut_cell, "
        f"round(gain, {R}) AS gain FROM s{k}" for k in range(1, LEVELS + 1))
    cuts = " UNION ALL ".join(f"SELECT a, cut FROM s{k}" for k in range(1, LEVELS + 1))
    counts = f""",
cuts AS (SELECT a, lo + cut * w AS bound FROM ({cuts}) JOIN r USING (a)),
binned AS (SELECT l.a, l.x, l.t, (SELECT count(*) FROM cuts WHERE cuts.a = l.a AND l.x >= bound) + 1 AS bin FROM l)
SELECT a AS attribute_name, CAST(bin AS VARCHAR) AS bin, count(*) AS n, round(avg(t), {R}) AS share
FROM binned WHERE a IN ('sum_qty', 'n_orders') GROUP BY a, bin"""
    return {"supervised_splits": "WITH " + ",\n".join(ctes) + "\n" + out,
            "supervised_bin_counts": "WITH " + ",\n".join(ctes) + counts}
