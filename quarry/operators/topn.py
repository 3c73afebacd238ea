"""Top-N per group without funnelling a hot group through one task.

``rank() OVER (PARTITION BY g ORDER BY ...) <= n`` puts every row of a
group into one task.  Here the rows are first ranked inside
(group, salt) sub-groups (salt = hash of the row key), keeping at most n
rows per sub-group; the final window then sees at most n * salts rows
per group.  With a total order (a unique tie-break key in ``order``) the
result equals the single-window result exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_n_by_group(df: DataFrame, group_cols: list[str], order: list, n: int,
                   salt_cols: list[str] | None = None, salts: int = 64,
                   rank_col: str = "rnk") -> DataFrame:
    """Rows ranked 1..n within each group (row_number semantics on a total order)."""
    salt_src = salt_cols or [c for c in df.columns if c not in group_cols]
    salted = df.withColumn("__salt", F.pmod(F.xxhash64(*salt_src), F.lit(salts)))
    w1 = Window.partitionBy(*group_cols, "__salt").orderBy(*order)
    pre = salted.withColumn("__r1", F.row_number().over(w1)).filter(F.col("__r1") <= n)
    w2 = Window.partitionBy(*group_cols).orderBy(*order)
    return pre.withColumn(rank_col, F.row_number().over(w2)).filter(F.col(rank_col) <= n) \
        .drop("__salt", "__r1")


def top_n(df: DataFrame, order: list, n: int) -> DataFrame:
    """Global top-N: ``orderBy(...).limit(n)`` (Spark plans TakeOrderedAndProject:
    a per-partition top-n followed by a merge of n rows per partition)."""
    return df.orderBy(*order).limit(n)
