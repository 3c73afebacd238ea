"""Registered queries: time series, survival, anomaly detection, partitioned
and transient models, Gaussian mixtures, CUR (sections 2.8-2.15)."""

from __future__ import annotations

from pyspark.ml.clustering import GaussianMixture
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from quarry.catalog import R, _apply_view, rnd
from quarry.functions.scalar import with_totals
from quarry.operators import evaluation as ev
from quarry.operators.anomaly import MixtureAnomaly
from quarry.operators.decomposition import SVD
from quarry.operators.naive_bayes import NaiveBayes, fit_partitioned
from quarry.operators.survival import AFT
from quarry.operators.timeseries import accumulate, mset_sprt, simple_smoothing_fixed, smooth
from quarry.plans import scoring
from quarry.session import session_key
from quarry.sources import cases
from quarry.sources.tables import load

ESM_ALPHA = 0.3
AFT_SCALE = 1.2
NUMERIC = ["acctbal", "n_orders", "avg_price", "sum_qty", "last_gap_days"]

_CACHE: dict = {}


def _memo(key, build):
    if key not in _CACHE:
        _CACHE[key] = build()
    return _CACHE[key]


# ------------------------------------------------------------ time series
def _daily(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    return accumulate(o, "o_orderdate", "o_totalprice", "day")


def q_series_accumulate(spark, sf_dir):
    """Daily order totals with every calendar day present (gaps = 0)."""
    return _daily(spark, sf_dir).select(F.to_date("period").alias("day"), rnd("value", 2).alias("value"))


def q_esm_simple_fixed(spark, sf_dir):
    """Simple exponential smoothing (alpha .3) of the daily totals (rounded to cents)."""
    d = _daily(spark, sf_dir).select(F.lit("orders").alias("series"), F.to_date("period").alias("day"),
                                     F.round("value", 2).alias("value"))
    s = simple_smoothing_fixed(d, "series", "day", "value", ESM_ALPHA)
    return s.select("day", rnd("smoothed", 4).alias("smoothed"))


def q_esm_forecast(spark, sf_dir):
    """Holt-Winters multiplicative, quarterly accumulation, season 4, 4 steps ahead, 95% bounds."""
    q = accumulate(load(spark, sf_dir, "orders"), "o_orderdate", "o_totalprice", "quarter") \
        .withColumn("series", F.lit("orders"))
    out = smooth(q, "series", "period", "value", form="winters_mul", season=4, horizon=4)
    return out.filter(F.col("kind") != "stat").select("series", "step", "kind", "value", "prediction",
                                                      "lower", "upper")


def q_esm_auto_search(spark, sf_dir):
    """Model search on the daily series (season 7): statistics of the lowest-AIC form."""
    d = _daily(spark, sf_dir).withColumn("series", F.lit("orders"))
    out = smooth(d, "series", "period", "value", form="auto", season=7, horizon=1, backcast=False)
    return out.filter(F.col("kind") == "stat").select("series", "form", "name", "numeric_value")


def q_esm_multi_series(spark, sf_dir):
    """Damped additive Winters per event type on hourly totals (season 24), 24 steps: all series in parallel."""
    e = load(spark, sf_dir, "events")
    h = accumulate(e, "ts", "value", "hour", series_cols=["event_type"])
    out = smooth(h, "event_type", "period", "value", form="winters_damped", season=24, horizon=24,
                 backcast=False)
    return out.filter(F.col("kind") == "forecast").select(F.col("series").alias("event_type"), "step",
                                                          "prediction", "lower", "upper")


def q_mset_sprt(spark, sf_dir):
    """MSET-SPRT per event type on hourly (count, total): build on the first 20 days, test the rest."""
    e = load(spark, sf_dir, "events")
    cnt = accumulate(e.withColumn("one", F.lit(1.0)), "ts", "one", "hour", ["event_type"]).withColumnRenamed("value", "n")
    tot = accumulate(e, "ts", "value", "hour", ["event_type"]).withColumnRenamed("value", "total")
    h = cnt.join(tot, ["event_type", "period"])
    start = h.agg(F.min("period").alias("t0"))
    h = with_totals(h, start)
    cut = F.col("period") < F.col("t0") + F.expr("INTERVAL 20 DAYS")
    train = h.filter(cut).drop("t0")
    test = h.filter(~cut).drop("t0")
    out = mset_sprt(train, test, "event_type", "period", ["n", "total"], memory_vectors=100, alpha=0.1,
                    alert_count=3, alert_window=5)
    return out.groupBy("event_type", "prediction").agg(F.count(F.lit(1)).alias("n"),
                                                       F.min("residual_norm").alias("min_residual"),
                                                       F.max("residual_norm").alias("max_residual"))


# ------------------------------------------------------------ survival
def q_aft_survival(spark, sf_dir):
    """AFT (normal loss, scale 1.2) on days to the next order; right-censored last orders."""
    g = cases.order_gaps(spark, sf_dir)
    m = AFT("lbound", "rbound", numeric=["o_totalprice"], categorical=["o_orderpriority"],
            dist="normal", scale=AFT_SCALE, name="AFT_ORDERS").fit(g)
    p = g.select(F.when(F.col("rbound").isNull(), "censored").otherwise("exact").alias("kind"),
                 m.prediction(g).alias("pred"))
    return p.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.avg("pred").alias("avg_prediction"))


# ------------------------------------------------------------ anomaly / mixtures
def q_em_anomaly(spark, sf_dir):
    """EM anomaly on the case table (outlier rate .05): count and probability range per label."""
    c = cases.case_table(spark, sf_dir)
    m = MixtureAnomaly(k=3, outlier_rate=0.05).fit(c, NUMERIC)
    s = c.select(m.prediction(c).alias("pred"), m.probability_normal(c).alias("prob"))
    return s.groupBy("pred").agg(F.count(F.lit(1)).alias("n"), F.min("prob").alias("min_prob"),
                                 F.max("prob").alias("max_prob"))


def q_em_clusters(spark, sf_dir):
    """Gaussian mixture (10 components) on the 64-d embeddings: component x label counts."""
    e = load(spark, sf_dir, "embeddings").select("vec_id", "label", array_to_vector("embedding").alias("v"))
    gm = GaussianMixture(k=10, featuresCol="v", seed=0, maxIter=50).fit(e)
    return gm.transform(e).groupBy(F.col("prediction").alias("component"), "label") \
        .agg(F.count(F.lit(1)).alias("n"))


def q_cur_leverage(spark, sf_dir):
    """CUR column leverage of the case numerics from the rank-3 SVD: (1/k) sum of squared loadings."""
    m = SVD(pca=True).fit(cases.case_table(spark, sf_dir), NUMERIC)
    k = 3
    rows = [(c, float((m.V[i, :k] ** 2).sum() / k)) for i, c in enumerate(m.cols)]
    df = spark.createDataFrame(rows, "attribute_name string, leverage double")
    from pyspark.sql import Window
    return df.withColumn("rank", F.row_number().over(Window.orderBy(F.col("leverage").desc(), "attribute_name")))


# ------------------------------------------------------------ partitioned / transient
def _pnb(spark, sf_dir):
    return _memo(("pnb", session_key(spark), sf_dir), lambda: fit_partitioned(
        cases.split(cases.case_table(spark, sf_dir), cases.SPLIT_BUILD),
        NaiveBayes(target="affinity", case_id="cust_id", name="PART_NB"), "region"))


def q_partitioned_nb_apply(spark, sf_dir):
    """One Naive Bayes per region; every apply row scored by its own region's model."""
    m = _pnb(spark, sf_dir)
    s = scoring.with_probabilities(_apply_view(spark, sf_dir), m)
    return s.select("cust_id", m.partition_name().alias("partition_name"),
                    scoring.prediction(m).alias("prediction"),
                    rnd(scoring.prediction_probability(m, 1)).alias("prob_1"))


def q_partitioned_accuracy(spark, sf_dir):
    m = _pnb(spark, sf_dir)
    s = scoring.with_probabilities(_apply_view(spark, sf_dir), m)
    p = s.select(m.partition_name().alias("partition_name"), "affinity", scoring.prediction(m).alias("p"))
    return p.groupBy("partition_name").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(100.0 * F.avg(F.when(F.col("affinity").eqNullSafe(F.col("p")), 1.0).otherwise(0.0)), 2)
        .alias("accuracy_pct"))


def q_transient_nb(spark, sf_dir):
    """Transient model: fit on the build rows and score the same rows in one call (nothing kept);
    customers without the card predicted to have one, most likely first."""
    b = cases.split(cases.case_table(spark, sf_dir), cases.SPLIT_BUILD).select(
        "cust_id", "affinity", "acctbal", "segment", "n_orders")
    m = NaiveBayes(target="affinity", case_id="cust_id").fit(b)
    s = scoring.with_probabilities(b, m)
    return s.select("cust_id", "affinity", scoring.prediction(m).alias("pred"),
                    rnd(scoring.prediction_probability(m, 1), 2).alias("pred_prob")) \
        .filter((F.col("affinity") == 0) & (F.col("pred") == 1)).drop("affinity", "pred")


QUERIES = {
    "series_accumulate": q_series_accumulate,
    "esm_simple_fixed": q_esm_simple_fixed,
    "esm_forecast": q_esm_forecast,
    "esm_auto_search": q_esm_auto_search,
    "esm_multi_series": q_esm_multi_series,
    "mset_sprt": q_mset_sprt,
    "aft_survival": q_aft_survival,
    "em_anomaly": q_em_anomaly,
    "em_clusters": q_em_clusters,
    "cur_leverage": q_cur_leverage,
    "partitioned_nb_apply": q_partitioned_nb_apply,
    "partitioned_accuracy": q_partitioned_accuracy,
    "transient_nb": q_transient_nb,
}
