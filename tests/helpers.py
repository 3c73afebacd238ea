"""Order-insensitive comparison of a Spark result with a DuckDB query."""

import math


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


def assert_same(df, con, sql):
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    a, b = rows_of(df.columns, srows), rows_of(dcols, drows)
    assert len(a) == len(b)
    diff = sorted(set(a) ^ set(b))[:5]
    assert a == b, diff
