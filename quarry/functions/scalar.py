"""Column-expression helpers (all JVM-side, whole-stage-codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_safe_eq(a, b) -> Column:
    """``DECODE(a, b, 1, 0)``: NULL equals NULL."""
    return col(a).eqNullSafe(col(b))


def decode_flag(a, b) -> Column:
    """1 when a <=> b else 0 (int)."""
    return F.when(null_safe_eq(a, b), F.lit(1)).otherwise(F.lit(0))


def equi_width_bin(c, lo: float, hi: float, n: int) -> Column:
    """Bin id 1..n of ``c`` on [lo, hi]; values outside are clamped; NULL stays NULL.

    A constant column (hi == lo) maps to bin 1.  For a column name the
    expression is emitted as one SQL string (a single driver->JVM call).
    """
    if isinstance(c, str) and lo is not None and hi is not None:
        q = "`" + c.replace("`", "``") + "`"
        if hi == lo:
            return F.expr(f"CAST(CASE WHEN {q} IS NULL THEN NULL ELSE 1 END AS INT)")
        return F.expr(
            f"CAST(CASE WHEN {q} IS NULL THEN NULL ELSE least(greatest(floor((CAST({q} AS DOUBLE) - "
            f"{_sql_double(float(lo))}) / {_sql_double(float(hi) - float(lo))} * {int(n)}) + 1, 1), {int(n)}) "
            f"END AS INT)")
    x = col(c).cast("double")
    if hi is None or lo is None:
        return F.lit(None).cast("int")
    if hi == lo:
        return F.when(x.isNull(), F.lit(None)).otherwise(F.lit(1)).cast("int")
    raw = F.floor((x - F.lit(float(lo))) / F.lit(float(hi) - float(lo)) * F.lit(n)) + 1
    return F.when(x.isNull(), F.lit(None)).otherwise(
        F.least(F.greatest(raw, F.lit(1)), F.lit(n))).cast("int")


def width_bucket(c, lo: float, hi: float, n: int) -> Column:
    """SQL ``WIDTH_BUCKET``: 0 below ``lo``, n+1 at/above ``hi``."""
    return F.width_bucket(col(c).cast("double"), F.lit(float(lo)), F.lit(float(hi)), F.lit(n))


def safe_div(a, b, default: float = 1.0) -> Column:
    """a / b with b replaced by ``default`` where it is 0 (the MAPE guard)."""
    return col(a) / F.when(col(b) == 0, F.lit(default)).otherwise(col(b))


def tokenize(c) -> Column:
    """Case-folded word tokens: split on anything that is not a letter or digit.

    Letters include accented ones (``\\p{L}``); empty tokens are removed.
    Case folding uses lower case: upper-casing is not one-to-one across
    engines (German sharp s becomes "SS" in the JVM), lower-casing is.
    """
    parts = F.split(F.lower(col(c)), r"[^\p{L}\p{N}]+")
    return F.filter(parts, lambda t: F.length(t) > 0)


def _sql_str(s: str) -> str:
    return "'" + str(s).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _sql_double(x: float) -> str:
    import math
    if x != x:
        return "CAST('NaN' AS DOUBLE)"
    if math.isinf(x):
        return "CAST('Infinity' AS DOUBLE)" if x > 0 else "CAST('-Infinity' AS DOUBLE)"
    return repr(float(x)) + "D"


def literal_array(values) -> Column:
    """array<double> literal built from one SQL expression (a single driver->JVM call)."""
    return F.expr("array(" + ", ".join(_sql_double(v) for v in values) + ")") if values else \
        F.array().cast("array<double>")


def literal_map_of_arrays(table: dict) -> Column:
    """map<string, array<double>> literal from one SQL expression.

    Building big lookup tables literal by literal costs one JVM round trip
    per value; a single parsed expression keeps plan construction O(1) calls.
    Doubles use the ``D`` suffix so they stay exact IEEE doubles.
    """
    parts = []
    for k, vals in sorted(table.items()):
        parts.append(_sql_str(k))
        parts.append("array(" + ", ".join(_sql_double(v) for v in vals) + ")")
    return F.expr("map(" + ", ".join(parts) + ")")


def with_totals(df, totals) -> "DataFrame":  # noqa: F821
    """Attach the columns of a one-row aggregate ``totals`` to every row of ``df``.

    Expressed as one scalar subquery over a struct (not a join), so the
    aggregate runs once and its row is read by every task.
    """
    t = totals.select(F.struct(*totals.columns).alias("__t")).scalar()
    return df.withColumns({c: t.getField(c) for c in totals.columns})


def class_index_rows(k: int) -> Column:
    """``explode(0..k-1)``: repeat a row once per class of a k-class model."""
    return F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
