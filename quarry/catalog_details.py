"""Queries of row-wise explanations: attributes left out one by one, user weights, tree paths."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.catalog import _apply_view, nb_model, rnd
from quarry.catalog_models import _dt
from quarry.operators import details as D
from quarry.plans.user_algorithms import fit_user_model, ridge_algorithm
from quarry.sources import cases

NB_ATTRIBUTES = ["acctbal", "n_orders", "avg_price", "sum_qty", "last_gap_days", "segment", "nation", "region"]
USER_FEATURES = ["n_orders", "acctbal"]


def q_nb_left_out_details(spark, sf_dir):
    """What each attribute adds to every apply customer's probability of the card, by leaving it out."""
    out = D.leave_one_out(_apply_view(spark, sf_dir), D.class_score(nb_model(spark, sf_dir), 1), NB_ATTRIBUTES)
    return out.select("cust_id", F.inline("details")).select("cust_id", "attribute_name", rnd("weight").alias("weight"))


def q_tree_left_out_details(spark, sf_dir):
    """Top 3 attributes of every apply customer's probability in the decision tree, by leaving each out."""
    m = _dt(spark, sf_dir)
    out = D.leave_one_out(_apply_view(spark, sf_dir), D.class_score(m, 1), m.numeric + m.categorical, top_n=3)
    return out.select("cust_id", F.inline("details"))


def q_tree_details(spark, sf_dir):
    """Segmentation of the apply customers: leaf, prediction, support, confidence and rule."""
    out = D.tree_details(_apply_view(spark, sf_dir), _dt(spark, sf_dir))
    return out.select("cust_id", "details.*")


def q_user_algorithm_weights(spark, sf_dir):
    """Weight function of a user-defined regression, one model per region: score over score without the attribute."""
    b = cases.split(cases.case_table(spark, sf_dir), cases.SPLIT_BUILD)
    m = fit_user_model(b, ridge_algorithm(USER_FEATURES, "sum_qty"), {"lambda": 0.0}, partition_col="region",
                       name="USER_RIDGE_WEIGHTS")
    out = m.prediction_details(_apply_view(spark, sf_dir), ["cust_id", "region"], "prediction")
    return out.select("cust_id", "region", F.inline("details")).select(
        "cust_id", "region", "attribute_name", rnd("weight").alias("weight"))


QUERIES = {
    "nb_left_out_details": q_nb_left_out_details,
    "tree_left_out_details": q_tree_left_out_details,
    "tree_details": q_tree_details,
    "user_algorithm_weights": q_user_algorithm_weights,
}
