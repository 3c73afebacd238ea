"""Registered queries: streaming extensions and user-defined algorithms
(sections 2.18, 2.19)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.catalog import _apply_view, nb_model, rnd
from quarry.operators.evaluation import regression_errors
from quarry.plans.user_algorithms import fit_user_model, ridge_algorithm
from quarry.sources import cases
from quarry.sources.tables import load, table_path
from quarry.streaming.sprt import baseline, closed_intervals, residuals, sprt_alerts
from quarry.streaming.stream import (_scratch, latest_per_key, run_to_table, score_stream,
                                     windowed_accumulate)


def q_stream_nb_apply(spark, sf_dir):
    """The flagship model scoring a *stream* of apply-split cases (file source, availableNow).

    The apply split is written once as Parquet under the checkpoint folder and
    read back as a stream; the result must equal the batch APPLY.
    """
    m = nb_model(spark, sf_dir)
    src = _scratch(spark, "cases")
    a = _apply_view(spark, sf_dir)
    a.write.mode("overwrite").parquet(src)
    stream = spark.readStream.schema(a.schema).parquet(src)
    out = run_to_table(score_stream(stream, m, "cust_id"), "append", "nbapply")
    return out.select("cust_id", "prediction", rnd("probability").alias("probability"))


def q_stream_accumulate(spark, sf_dir):
    """Hourly event count and total per type from a streaming read of the events table
    (1-hour tumbling windows, 1-hour watermark, update mode)."""
    schema = load(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1) \
        .parquet(table_path(sf_dir, "events") + "*")
    res = windowed_accumulate(stream, "ts", "value", "1 hour", "1 hour", ["event_type"])
    out = latest_per_key(run_to_table(res, "update", "events"), ["event_type", "window_start"])
    return out.select("event_type", "window_start", "n", rnd("total", 4).alias("total"))


SPRT_TRAIN_DAYS, SPRT_SHIFT = 20, 1.0


def q_stream_sprt(spark, sf_dir):
    """Alerts on a stream of events: hourly count and total by type, tested against the first 20 days' mean.

    The hours' aggregate (watermark of one hour) hands on closed hours; the test keeps its state by type.
    Hours that the watermark has not passed by the end of the table are not judged.
    """
    events = load(spark, sf_dir, "events")
    hour, cols = F.date_trunc("hour", "ts").cast("timestamp_ntz"), ["n", "total"]
    first = events.agg(F.date_trunc("hour", F.min("ts")).cast("timestamp_ntz")).first()[0]
    cut = F.lit(first).cast("timestamp_ntz") + F.expr(f"INTERVAL {SPRT_TRAIN_DAYS} DAYS")
    trained = events.groupBy("event_type", hour.alias("h")).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    usual = baseline(trained.filter(F.col("h") < cut), ["event_type"], cols)
    stream = spark.readStream.schema(events.schema).parquet(table_path(sf_dir, "events") + "*")
    hours = windowed_accumulate(stream, "ts", "value", "1 hour", "1 hour", ["event_type"]).filter(
        F.col("window_start").cast("timestamp_ntz") >= cut)
    closed = closed_intervals(hours.select("event_type", "window_start", *cols))
    z = residuals(closed, usual, ["event_type"], cols)
    return run_to_table(sprt_alerts(z, ["event_type"], "window_start", cols, shift=SPRT_SHIFT), "append", "sprt")


def _user_models(spark, sf_dir):
    b = cases.split(cases.case_table(spark, sf_dir), cases.SPLIT_BUILD)
    return fit_user_model(b, ridge_algorithm(["n_orders"], "sum_qty"), {"lambda": 0.0},
                          partition_col="region", name="USER_RIDGE_BY_REGION")


def q_user_algorithm_details(spark, sf_dir):
    """User-defined (sufficient-statistics) ridge, one model per region: coefficients view."""
    m = _user_models(spark, sf_dir)
    return m.details_df().select("partition_name", "attribute_name", rnd("coefficient").alias("coefficient"))


def q_user_algorithm_apply(spark, sf_dir):
    """Scores of the user-defined models on the apply split: RMSE / MAE per region."""
    m = _user_models(spark, sf_dir)
    a = _apply_view(spark, sf_dir).select("cust_id", "region", "n_orders", "sum_qty")
    s = m.apply(a, ["cust_id", "region", "sum_qty"])
    e = s.groupBy("region").agg(F.sqrt(F.avg((F.col("prediction") - F.col("sum_qty")) ** 2)).alias("rmse"),
                                F.avg(F.abs(F.col("prediction") - F.col("sum_qty"))).alias("mae"))
    return e.select(F.col("region").alias("partition_name"), rnd("rmse").alias("rmse"), rnd("mae").alias("mae"))


QUERIES = {
    "stream_nb_apply": q_stream_nb_apply,
    "stream_accumulate": q_stream_accumulate,
    "stream_sprt": q_stream_sprt,
    "user_algorithm_details": q_user_algorithm_details,
    "user_algorithm_apply": q_user_algorithm_apply,
}
