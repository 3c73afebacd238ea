"""DuckDB SQL for ``quarry.catalog_forecast``."""

from __future__ import annotations

from quarry.oracle import R
from quarry.oracle_text import ESA, _esa_vec


def oracle_sql() -> dict[str, str]:
    return {"esa_dense_places": f"""WITH {ESA},
{_esa_vec('documents', 'doc_id', 'text', 'dv')},
h AS (SELECT id, value, md5(CAST(feature_id AS VARCHAR)) AS m FROM dv)
SELECT id AS doc_id, ('0x' || substr(m, 1, 6))::INT % 1024 AS place,
       round(sum(CASE WHEN ('0x' || substr(m, 9, 1))::INT % 2 = 0 THEN value ELSE -value END), {R}) AS value
FROM h GROUP BY 1, 2"""}
