"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Each query reads the whole driver tables (or data Spark derives from
them).  Float outputs are rounded to a fixed number of decimals so that the
independent DuckDB oracle (``quarry.oracle``) can match them by value.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import evaluation as ev
from quarry.operators.naive_bayes import NaiveBayes
from quarry.plans import scoring
from quarry.session import session_key
from quarry.sources import cases
from quarry.sources.tables import load

R = 6  # decimals kept in checked float outputs

# Fixed values of the reference demo (priors and cost matrices of its
# Naive Bayes and decision-tree scripts).
NB_PRIORS = {0: 0.65, 1: 0.35}
NB_COST = [(0, 0, 0.0), (0, 1, 0.35), (1, 0, 0.65), (1, 1, 0.0)]
FP_COST, FN_COST = 0.35, 0.65
DT_COST = [(0, 0, 0.0), (0, 1, 1.0), (1, 0, 8.0), (1, 1, 0.0)]


def rnd(c, d: int = R):
    return F.round(F.col(c) if isinstance(c, str) else c, d)


# --------------------------------------------------------------------------
# shared fixtures (per session + sf_dir, so a query set reuses one fit)
# --------------------------------------------------------------------------
_CACHE: dict = {}


def _memo(key, build):
    if key not in _CACHE:
        _CACHE[key] = build()
    return _CACHE[key]


def nb_model(spark: SparkSession, sf_dir: str):
    """Flagship model: Naive Bayes with user priors on the build split."""
    def build():
        build_df = cases.split(cases.case_table(spark, sf_dir), cases.SPLIT_BUILD)
        return NaiveBayes(target="affinity", case_id="cust_id", num_bins=10,
                          priors=NB_PRIORS, name="affinity_bayes").fit(build_df)
    return _memo(("nb", session_key(spark), sf_dir), build)


def _apply_view(spark, sf_dir):
    return cases.split(cases.case_table(spark, sf_dir), cases.SPLIT_APPLY)


def nb_scored(spark, sf_dir) -> DataFrame:
    """Apply view with the class-probability array attached (a projection)."""
    return scoring.with_probabilities(_apply_view(spark, sf_dir), nb_model(spark, sf_dir))


# --------------------------------------------------------------------------
# Naive Bayes + evaluation (flagship slice)
# --------------------------------------------------------------------------
def q_case_view(spark, sf_dir):
    return cases.case_table(spark, sf_dir).select(
        "cust_id", "segment", "nation", "region", "acctbal", "n_orders", "avg_price",
        "sum_qty", "last_gap_days", "affinity",
        F.pmod(F.col("cust_id"), F.lit(3)).alias("split"))


def q_nb_priors(spark, sf_dir):
    m = nb_model(spark, sf_dir)
    return m.view("P").select("target_value", rnd("prior_probability").alias("prior_probability"), "count")


def q_nb_conditionals(spark, sf_dir):
    m = nb_model(spark, sf_dir)
    return m.view("V").select("attribute_name", "attribute_value", "target_value",
                              rnd("conditional_probability").alias("conditional_probability"), "count")


def q_nb_apply(spark, sf_dir):
    m = nb_model(spark, sf_dir)
    a = scoring.apply(_apply_view(spark, sf_dir), m, "cust_id")
    return a.select("cust_id", "prediction", rnd("probability").alias("probability"))


def _nb_apply_long(spark, sf_dir):
    m = nb_model(spark, sf_dir)
    return scoring.apply(_apply_view(spark, sf_dir), m, "cust_id")


def _targets(spark, sf_dir):
    return _apply_view(spark, sf_dir).select("cust_id", "affinity")


def q_confusion_matrix(spark, sf_dir):
    return ev.confusion_matrix(_nb_apply_long(spark, sf_dir), _targets(spark, sf_dir),
                               "cust_id", "affinity")


def q_confusion_matrix_cost(spark, sf_dir):
    return ev.confusion_matrix(_nb_apply_long(spark, sf_dir), _targets(spark, sf_dir),
                               "cust_id", "affinity", cost_rows=NB_COST)


def q_accuracy(spark, sf_dir):
    cm = q_confusion_matrix(spark, sf_dir)
    return ev.accuracy_from_confusion(cm).select(rnd("accuracy").alias("accuracy"))


def q_nb_predict_cost(spark, sf_dir):
    """Cost-aware PREDICTION and PREDICTION_COST as in-row expressions."""
    m = nb_model(spark, sf_dir)
    cm = scoring.cost_matrix_from_rows(NB_COST)
    s = nb_scored(spark, sf_dir)
    return s.select(
        "cust_id",
        scoring.prediction(m).alias("prediction"),
        scoring.prediction_with_cost(m, cm).alias("cost_prediction"),
        rnd(scoring.prediction_probability(m, 1)).alias("prob_1"),
        rnd(scoring.prediction_cost(m, cm, 0)).alias("cost_0"),
        rnd(scoring.prediction_cost(m, cm, 1)).alias("cost_1"))


def _nb_pos_scored(spark, sf_dir):
    m = nb_model(spark, sf_dir)
    s = nb_scored(spark, sf_dir)
    # probabilities are rounded before ranking so both engines see identical ties
    return ev.scored_table(s, F.round(scoring.prediction_probability(m, 1), R), F.col("affinity"), 1)


def q_lift(spark, sf_dir):
    l = ev.lift(_nb_pos_scored(spark, sf_dir), 10)
    return l.select("quantile_number", rnd("probability_threshold").alias("probability_threshold"),
                    "quantile_total_count",
                    *[rnd(c).alias(c) for c in ("targets_cumulative", "non_targets_cumulative",
                                                "percentage_records_cumulative", "gain_cumulative",
                                                "lift_cumulative", "lift_quantile",
                                                "target_density_cumulative", "target_density")])


def q_roc(spark, sf_dir):
    r = ev.roc(_nb_pos_scored(spark, sf_dir))
    return r.select(rnd("probability").alias("probability"), "true_positives", "false_negatives",
                    "false_positives", "true_negatives",
                    rnd("true_positive_fraction").alias("true_positive_fraction"),
                    rnd("false_positive_fraction").alias("false_positive_fraction"))


def q_roc_corners(spark, sf_dir):
    r = ev.roc_corners(_nb_pos_scored(spark, sf_dir))
    return r.select(rnd("prob").alias("prob"), rnd("tpf").alias("tpf"), rnd("fpf").alias("fpf"),
                    "tp", "fn", "fp", "tn")


def q_auc(spark, sf_dir):
    return ev.auc(_nb_pos_scored(spark, sf_dir)).select(rnd("auc").alias("auc"))


def q_threshold_cost(spark, sf_dir):
    """ROC thresholds with their action cost .35*FP + .65*FN, cheapest 10 first."""
    c = ev.threshold_costs(ev.roc(_nb_pos_scored(spark, sf_dir)), FP_COST, FN_COST)
    return c.orderBy(F.col("cost").asc(), F.col("probability").asc()).limit(10).select(
        rnd("probability").alias("threshold"), F.col("true_positives").alias("hits"),
        F.col("false_negatives").alias("misses"), F.col("false_positives").alias("false_alarms"),
        F.col("true_negatives").alias("correct_rejections"), rnd("cost").alias("total_cost"))


def _break_even_cost(spark, sf_dir):
    return ev.cost_matrix_from_threshold(ev.roc(_nb_pos_scored(spark, sf_dir)), FP_COST, FN_COST)


def q_cost_from_threshold(spark, sf_dir):
    return _break_even_cost(spark, sf_dir).select("actual_target_value", "predicted_target_value",
                                             rnd("cost").alias("cost"))


def q_rank_apply(spark, sf_dir):
    """RANK_APPLY top 2 with the break-even cost matrix, on renamed apply columns."""
    cost_rows = [tuple(r) for r in _break_even_cost(spark, sf_dir).collect()]  # 4 rows
    a = _nb_apply_long(spark, sf_dir).withColumnRenamed("cust_id", "customer_id") \
        .withColumnRenamed("prediction", "score").withColumnRenamed("probability", "chance")
    r = ev.rank_apply(a, "customer_id", "score", "chance", 2, cost_rows)
    return r.select("customer_id", "score", rnd("chance").alias("chance"), rnd("cost").alias("cost"),
                    F.col("rank").cast("long").alias("rank"))


FLAGSHIP = "nb_apply"

QUERIES = {
    "case_view": q_case_view,
    "nb_priors": q_nb_priors,
    "nb_conditionals": q_nb_conditionals,
    "nb_apply": q_nb_apply,
    "nb_predict_cost": q_nb_predict_cost,
    "confusion_matrix": q_confusion_matrix,
    "confusion_matrix_cost": q_confusion_matrix_cost,
    "accuracy": q_accuracy,
    "lift": q_lift,
    "roc": q_roc,
    "roc_corners": q_roc_corners,
    "auc": q_auc,
    "threshold_cost": q_threshold_cost,
    "cost_from_threshold": q_cost_from_threshold,
    "rank_apply": q_rank_apply,
}
