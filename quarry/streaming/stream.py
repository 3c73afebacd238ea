"""Structured Streaming extensions (the reference has no streams; see SURVEY 2.19).

* stateless scoring of a streaming DataFrame with a fitted model: the
  scorers are projections, so the same expressions run on a stream;
* tumbling-window accumulation with a watermark (late rows within the
  delay are still counted), feeding the time-series operators.

Runs are finite here: ``trigger(availableNow=True)`` processes what the
source holds and stops.  Sinks and checkpoints live in a fresh folder under
the session's ``spark.checkpoint.dir`` (a shared folder on a cluster), so a
restarted query resumes exactly once from its checkpoint.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.plans import scoring
from quarry.session import ensure_checkpoint_dir


def _scratch(spark: SparkSession, tag: str) -> str:
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/quarry-stream-{tag}-{uuid.uuid4().hex}"


def score_stream(stream: DataFrame, model, case_id: str) -> DataFrame:
    """APPLY on a stream: (case_id, prediction, probability) per class, append-only."""
    return scoring.apply(stream, model, case_id)


def windowed_accumulate(stream: DataFrame, ts_col: str, value_col: str, window: str,
                        watermark: str, series_cols: list[str] | None = None) -> DataFrame:
    """Tumbling-window (count, sum) per series with a watermark on ``ts_col``."""
    series_cols = list(series_cols or [])
    # watermarks need a session-zone TIMESTAMP; wall-clock (NTZ) inputs are read in the
    # session time zone and the window bounds are handed back as wall-clock values
    src_type = dict(stream.dtypes)[ts_col]
    s = stream.withColumn(ts_col, F.col(ts_col).cast("timestamp"))
    back = (lambda c: c.cast("timestamp_ntz")) if src_type == "timestamp_ntz" else (lambda c: c)
    return (s.withWatermark(ts_col, watermark)
            .groupBy(F.window(ts_col, window).alias("w"), *series_cols)
            .agg(F.count(F.lit(1)).alias("n"), F.sum(value_col).alias("total"))
            .select(*series_cols, back(F.col("w.start")).alias("window_start"),
                    back(F.col("w.end")).alias("window_end"), "n", "total"))


def run_to_path(result: DataFrame, tag: str = "out", root: str | None = None) -> str:
    """Append what a streaming result holds to Parquet and return its folder.

    ``root`` named again by a later run goes on from the checkpoint it holds; a fresh folder by default.
    """
    root = root or _scratch(result.sparkSession, tag)
    q = (result.writeStream.format("parquet").option("path", f"{root}/data")
         .option("checkpointLocation", f"{root}/checkpoint").outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return f"{root}/data"


def run_to_table(result: DataFrame, output_mode: str = "append", tag: str = "out") -> DataFrame:
    """Run a streaming result to completion into Parquet and return it as a batch DataFrame.

    ``update`` mode goes through ``foreachBatch`` (each micro-batch's changed
    rows are appended with the batch id); the last version of each key is
    what the caller keeps.
    """
    spark = result.sparkSession
    if output_mode == "append":
        return spark.read.schema(result.schema).parquet(run_to_path(result, tag))
    root = _scratch(spark, tag)
    out, ckpt = f"{root}/data", f"{root}/checkpoint"

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("__batch", F.lit(batch_id)).write.mode("append").parquet(out)
    q = (result.writeStream.foreachBatch(write).option("checkpointLocation", ckpt)
         .outputMode(output_mode).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out)


def latest_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Last emitted version of each key from an update-mode sink."""
    return df.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in df.columns if c not in keys + ["__batch"]]),
                                          F.col("__batch")).alias("__v")).select(*keys, "__v.*")
