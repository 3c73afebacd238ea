"""DuckDB SQL for ``quarry.catalog_mixture``: a fitted mixture has the table's own moments and shares."""

from __future__ import annotations

from quarry.oracle import CASE360, R


def oracle_sql() -> dict[str, str]:
    moments = " UNION ALL ".join(
        f"SELECT '{a}' AS attribute_name, round(avg({a}), 4) AS mean, round(sqrt(avg({a} * {a})), 4) AS root_mean_square FROM t"
        for a in ("acctbal", "n_orders", "sum_qty"))
    shares = " UNION ALL ".join(
        f"SELECT '{a}' AS attribute_name, {a} AS attribute_value, round(count(*) / (SELECT count(*) FROM case360), {R}) AS share "
        f"FROM case360 GROUP BY {a}" for a in ("segment", "region"))
    return {
        "em_gaussian_moments": f"""WITH {CASE360},
t AS (SELECT acctbal, CAST(n_orders AS DOUBLE) AS n_orders, sum_qty FROM case360)
{moments}""",
        "em_frequency_shares": f"WITH {CASE360}\n{shares}",
    }
