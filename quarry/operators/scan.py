"""Ordered prefix scans without a single-partition window.

A window with ``ORDER BY`` and no ``PARTITION BY`` (ROC, lift, AUC,
cumulative gains) makes Spark move every row into one task.  The scan
here keeps the work distributed:

1. the input is first reduced to *distinct* order keys (callers
   pre-aggregate), so ties are a single row and a ROWS frame over it is
   the SQL RANGE frame (peers share the value);
2. ``approxQuantile`` picks up to ``buckets - 1`` split points (driver
   holds only those numbers);
3. each row gets its bucket id as a pure function of its key, the
   window runs per bucket (one task per bucket, in parallel);
4. bucket totals (``buckets`` rows) get exclusive prefix sums and are
   broadcast back as offsets - their size is the bucket count, not the
   data size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_BUCKET = "__scan_bucket"


def _bucket_expr(key: str, bounds: list[float], ascending: bool):
    arr = F.array(*[F.lit(float(b)) for b in bounds]) if bounds else F.array().cast("array<double>")
    k = F.col(key).cast("double")
    if ascending:
        return F.size(F.filter(arr, lambda b: b < k))
    return F.size(F.filter(arr, lambda b: b > k))


def prefix_sums(df: DataFrame, key: str, sum_cols: list[str], ascending: bool = True,
                buckets: int | None = None, prefix: str = "cum_",
                max_cols: list[str] | None = None, exclusive_max: bool = False) -> DataFrame:
    """Inclusive running sums (and optional running max) of ``sum_cols`` ordered by ``key``.

    ``df`` must hold one row per distinct, non-NULL ``key``.  Adds columns
    ``{prefix}{c}`` for each c in sum_cols and ``{prefix}max_{c}`` for
    each c in max_cols (running max, NULLs ignored; with
    ``exclusive_max`` the current row is left out, NULL before any value).
    """
    spark = df.sparkSession
    max_cols = max_cols or []
    if buckets is None:
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(1, buckets)
    bounds: list[float] = []
    if buckets > 1:
        probs = [i / buckets for i in range(1, buckets)]
        qs = df.select(F.col(key).cast("double").alias(key)).approxQuantile(key, probs, 0.001)
        bounds = sorted(set(q for q in qs if q is not None))
        if not ascending:
            bounds = sorted(bounds, reverse=True)
    b = df.withColumn(_BUCKET, _bucket_expr(key, bounds, ascending))
    order = F.col(key).asc() if ascending else F.col(key).desc()
    w = Window.partitionBy(_BUCKET).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    wm = Window.partitionBy(_BUCKET).orderBy(order).rowsBetween(
        Window.unboundedPreceding, -1 if exclusive_max else 0)
    local = b.select(
        "*",
        *[F.sum(c).over(w).alias(f"__loc_{c}") for c in sum_cols],
        *[F.max(c).over(wm).alias(f"__locmax_{c}") for c in max_cols],
    )
    totals = b.groupBy(_BUCKET).agg(
        *[F.sum(c).alias(f"__tot_{c}") for c in sum_cols],
        *[F.max(c).alias(f"__totmax_{c}") for c in max_cols],
    )
    prev = Window.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        _BUCKET,
        *[F.coalesce(F.sum(f"__tot_{c}").over(prev), F.lit(0)).alias(f"__off_{c}") for c in sum_cols],
        *[F.max(f"__totmax_{c}").over(prev).alias(f"__offmax_{c}") for c in max_cols],
    )
    # offsets has exactly one row per bucket (<= ``buckets`` rows): safe to broadcast.
    out = local.join(F.broadcast(offsets), _BUCKET)
    cols = [c for c in df.columns]
    return out.select(
        *cols,
        *[(F.col(f"__loc_{c}") + F.col(f"__off_{c}")).alias(f"{prefix}{c}") for c in sum_cols],
        *[F.greatest(F.col(f"__locmax_{c}"), F.col(f"__offmax_{c}")).alias(f"{prefix}max_{c}")
          for c in max_cols],
    )


def next_in_group(df: DataFrame, group_col: str, order_cols: list[str], value_col: str,
                  out_col: str = "next_value", partitions: int | None = None) -> DataFrame:
    """``lead(value) OVER (PARTITION BY group ORDER BY order_cols)`` without one task per group.

    The rows are range-partitioned on (group, order_cols), so a group holding a
    large share of the rows spans many partitions, and sorted inside each
    partition.  The result is checkpointed (``spark.checkpoint.dir``) so the
    partition boundaries are fixed even if tasks are re-run.  Each partition
    computes the lead of its own rows; its last row takes the first row of the
    next non-empty partition when that row belongs to the same group.  Only one
    row per partition (its first key) reaches the driver.
    """
    import pandas as pd

    spark = df.sparkSession
    from quarry.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [group_col] + list(order_cols)
    ranged = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).checkpoint(eager=True)
    tagged = ranged.withColumn("__pid", F.spark_partition_id())
    firsts = tagged.groupBy("__pid").agg(F.min(F.struct(*keys, F.col(value_col).alias("__v"))).alias("f")) \
        .collect()  # one row per non-empty partition
    first_of = {int(r["__pid"]): (r["f"][group_col], r["f"]["__v"]) for r in firsts}
    pids = sorted(first_of)
    follower = {p: first_of[q] for p, q in zip(pids, pids[1:])}
    schema = tagged.drop("__pid").schema.add(out_col, tagged.schema[value_col].dataType, True)

    def lead(batches):
        frames = [b for b in batches if len(b)]
        if not frames:
            return
        pdf = pd.concat(frames, ignore_index=True)  # one partition, already sorted by keys
        pid = int(pdf["__pid"].iloc[0])
        pdf = pdf.drop(columns="__pid")
        g = pdf[group_col]
        nxt = pdf[value_col].shift(-1)
        same = g.eq(g.shift(-1))
        nxt = nxt.where(same, None)
        if pid in follower and follower[pid][0] == g.iloc[-1]:
            nxt.iloc[-1] = follower[pid][1]
        pdf[out_col] = nxt
        yield pdf

    return tagged.mapInPandas(lead, schema)
