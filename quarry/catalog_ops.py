"""Registered queries: association, attribute importance, preparation,
cross-validation and the relational building blocks (section 2.1-2.7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.catalog import R, _apply_view, nb_model, rnd
from quarry.operators import association as asso
from quarry.operators import importance as imp
from quarry.operators import prep
from quarry.operators.naive_bayes import cross_validate, cv_accuracy_rollup, cv_confusion_rollup
from quarry.operators.topn import top_n_by_group
from quarry.plans import scoring
from quarry.session import session_key
from quarry.sources import cases
from quarry.sources.tables import load

# Fixed parameters of our fixtures.
AR_MIN_SUPPORT = 0.02
AR_MIN_CONFIDENCE = 0.1
AR_MAX_LENGTH = 3
CV_FOLDS = 10
NUMERIC = ["acctbal", "n_orders", "avg_price", "sum_qty", "last_gap_days"]
CATEGORICAL = ["segment", "nation", "region"]
WB_LO, WB_HI, WB_N = 0.0, 10000.0, 10

_CACHE: dict = {}


def ar_model(spark, sf_dir):
    key = ("ar", session_key(spark), sf_dir)
    if key not in _CACHE:
        _CACHE[key] = asso.Apriori(min_support=AR_MIN_SUPPORT, min_confidence=AR_MIN_CONFIDENCE,
                                   max_rule_length=AR_MAX_LENGTH, name="brand_rules").fit(
            cases.basket_table(spark, sf_dir), "txn_id", "item", "amount")
    return _CACHE[key]


# ----------------------------------------------------------------- relational
def q_star_nested_sums(spark, sf_dir):
    """Star schema -> nested map per customer, read back as long rows."""
    m = cases.cust_type_map(spark, sf_dir)
    return m.select("cust_id", F.explode("type_sums").alias("p_type", "amount")) \
        .select("cust_id", "p_type", rnd("amount", 2).alias("amount"))


def q_txn_density(spark, sf_dir):
    b = cases.basket_table(spark, sf_dir)
    return asso.basket_stats(b, "txn_id", "item").select(
        "n_txn", "n_items", "n_rows", rnd("density", 4).alias("density"))


def q_avg_items_per_txn(spark, sf_dir):
    b = cases.basket_table(spark, sf_dir)
    return asso.avg_items_per_txn(b, "txn_id", "item").select(rnd("avg_items").alias("avg_items"))


def q_topn_by_group(spark, sf_dir):
    """Top 3 customers by account balance in every nation (ties by key)."""
    c = cases.case_table(spark, sf_dir).select("nation", "cust_id", "acctbal")
    t = top_n_by_group(c, ["nation"], [F.col("acctbal").desc(), F.col("cust_id").asc()], 3,
                       salt_cols=["cust_id"])
    return t.select("nation", "cust_id", "acctbal", F.col("rnk").cast("long").alias("rnk"))


def q_union_distinct(spark, sf_dir):
    c = load(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nationkey"))
    s = load(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nationkey"))
    return c.union(s).distinct()


def q_text_dedup(spark, sf_dir):
    """Deduplicate texts of length >= 70, keeping the minimum id."""
    d = load(spark, sf_dir, "documents").select("doc_id", "text").filter(F.length("text") >= 70)
    return d.groupBy("text").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies")) \
        .select("doc_id", "copies")


def q_width_bucket_hist(spark, sf_dir):
    c = cases.case_table(spark, sf_dir)
    return c.groupBy(F.width_bucket(F.col("acctbal"), F.lit(WB_LO), F.lit(WB_HI), F.lit(WB_N)).alias("bucket")) \
        .agg(F.count(F.lit(1)).alias("n"))


def q_unpivot(spark, sf_dir):
    c = cases.case_table(spark, sf_dir).select("cust_id", *[F.col(a).cast("double").alias(a) for a in NUMERIC])
    return c.unpivot("cust_id", NUMERIC, "attribute_name", "value").filter(F.col("value").isNotNull())


# ----------------------------------------------------------------- prep
def q_standardize(spark, sf_dir):
    c = cases.case_table(spark, sf_dir)
    n = prep.fit_normalizer(c, NUMERIC, "mean", "stddev")
    z = n.transform(c.select("cust_id", *NUMERIC))
    return z.select("cust_id", *[rnd(a, 5).alias(a) for a in NUMERIC])


# columns whose means are exact in any engine (integer-valued sums)
IMPUTE_NUMERIC = ["acctbal", "n_orders", "sum_qty", "last_gap_days"]


def q_impute_mean_mode(spark, sf_dir):
    """Mean (numeric) / mode (categorical) fill fitted on all rows, replayed as a projection."""
    c = cases.case_table(spark, sf_dir).select("cust_id", *IMPUTE_NUMERIC, *CATEGORICAL)
    im = prep.fit_imputer(c, exclude=["cust_id"])
    out = im.transform(c)
    return out.select("cust_id", *[rnd(a).alias(a) for a in IMPUTE_NUMERIC], *CATEGORICAL)


def q_mode_table(spark, sf_dir):
    return prep.mode_table(cases.case_table(spark, sf_dir), CATEGORICAL)


def q_equi_width_bins(spark, sf_dir):
    c = cases.case_table(spark, sf_dir).select("cust_id", *NUMERIC)
    binned, _ = prep.equi_width_binning(c, NUMERIC, 10)
    return binned


def q_class_weights(spark, sf_dir):
    w = prep.class_weights_balanced(cases.case_table(spark, sf_dir), "affinity")
    return w.select("target_value", "n_c", rnd("class_weight").alias("class_weight"))


def q_fold_assign(spark, sf_dir):
    b = cases.split(cases.case_table(spark, sf_dir), cases.SPLIT_BUILD)
    return prep.stratified_folds(b, "cust_id", "affinity", CV_FOLDS).select("cust_id", "affinity", "fold")


# ----------------------------------------------------------------- importance
def q_mdl_importance(spark, sf_dir):
    b = cases.split(cases.case_table(spark, sf_dir), cases.SPLIT_BUILD)
    e = imp.explain(b, "affinity", exclude=["cust_id"])
    return e.select("attribute_name", rnd("explanatory_value").alias("explanatory_value"),
                    F.col("rank").cast("long").alias("rank"))


def q_pairwise_kl(spark, sf_dir):
    c = cases.case_table(spark, sf_dir).drop("cust_id", "affinity")
    k = imp.pairwise_kl(c)
    return k.select(F.least("attribute_1", "attribute_2").alias("attribute_1"),
                    F.greatest("attribute_1", "attribute_2").alias("attribute_2"),
                    rnd("kl").alias("kl"))


# ----------------------------------------------------------------- association
def q_apriori_itemsets(spark, sf_dir):
    m = ar_model(spark, sf_dir)
    return m.itemsets.select("itemset", "number_of_items", "count", rnd("support").alias("support"))


def q_apriori_top_itemsets(spark, sf_dir):
    """Top 10 itemsets ordered by size then support ascending (as in the demo)."""
    m = ar_model(spark, sf_dir)
    return m.top_itemsets(10).select("itemset", "number_of_items", rnd("support").alias("support"))


def q_apriori_rules(spark, sf_dir):
    m = ar_model(spark, sf_dir)
    return m.rules.select("antecedent", "consequent", F.col("rule_count").alias("rule_count"),
                          rnd("support").alias("support"), rnd("confidence").alias("confidence"),
                          rnd("lift").alias("lift"), rnd("coverage").alias("coverage"),
                          rnd("reverse_confidence").alias("reverse_confidence"))


def q_rule_aggregates(spark, sf_dir):
    m = ar_model(spark, sf_dir)
    return m.rules.select("antecedent", "consequent", rnd("consequent_value", 2).alias("con_rule_amount"))


def q_itemset_aggregates(spark, sf_dir):
    m = ar_model(spark, sf_dir)
    return m.itemset_values.select("itemset", "item", rnd("value_sum", 2).alias("value_sum"))


# ----------------------------------------------------------------- cross-validation
def _cv(spark, sf_dir):
    key = ("cv", session_key(spark), sf_dir)
    if key not in _CACHE:
        b = cases.split(cases.case_table(spark, sf_dir), cases.SPLIT_BUILD)
        _CACHE[key] = cross_validate(b, "affinity", "cust_id", folds=CV_FOLDS).cache()
    return _CACHE[key]


def q_cv_accuracy(spark, sf_dir):
    return cv_accuracy_rollup(_cv(spark, sf_dir)).select("fold", rnd("accuracy").alias("accuracy"))


def q_cv_confusion(spark, sf_dir):
    return cv_confusion_rollup(_cv(spark, sf_dir)).select("actual", "predicted", "fold", "count")


def q_accuracy_by_segment(spark, sf_dir):
    """Accuracy (percent) of the flagship predictions per market segment."""
    m = nb_model(spark, sf_dir)
    s = scoring.with_probabilities(_apply_view(spark, sf_dir), m)
    p = s.select("segment", "affinity", scoring.prediction(m).alias("pred"))
    return p.groupBy("segment").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(100.0 * F.avg(F.when(F.col("affinity").eqNullSafe(F.col("pred")), 1.0).otherwise(0.0)), 2)
        .alias("accuracy_pct"))


QUERIES = {
    "star_nested_sums": q_star_nested_sums,
    "txn_density": q_txn_density,
    "avg_items_per_txn": q_avg_items_per_txn,
    "topn_by_group": q_topn_by_group,
    "union_distinct": q_union_distinct,
    "text_dedup": q_text_dedup,
    "width_bucket_hist": q_width_bucket_hist,
    "unpivot": q_unpivot,
    "standardize": q_standardize,
    "impute_mean_mode": q_impute_mean_mode,
    "mode_table": q_mode_table,
    "equi_width_bins": q_equi_width_bins,
    "class_weights": q_class_weights,
    "fold_assign": q_fold_assign,
    "mdl_importance": q_mdl_importance,
    "pairwise_kl": q_pairwise_kl,
    "apriori_itemsets": q_apriori_itemsets,
    "apriori_top_itemsets": q_apriori_top_itemsets,
    "apriori_rules": q_apriori_rules,
    "rule_aggregates": q_rule_aggregates,
    "itemset_aggregates": q_itemset_aggregates,
    "cv_accuracy": q_cv_accuracy,
    "cv_confusion": q_cv_confusion,
    "accuracy_by_segment": q_accuracy_by_segment,
}
