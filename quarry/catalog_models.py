"""Registered model queries: linear models, Spark ML classifiers, clustering,
factorization (sections 2.8-2.10, 2.12, 2.15-2.17).

Iterative fits (trees, IRLS, k-means, MLP, ...) have no closed-form SQL; the
SQL-checkable pieces (Gram sums, the one-feature least-squares fit and its
errors, one Lloyd step from data-derived centers) are registered separately.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.catalog import DT_COST, R, _apply_view, rnd
from quarry.operators import evaluation as ev
from quarry.operators import ml
from quarry.operators.clustering import HierarchicalKMeans, cluster_histograms, lloyd_step
from quarry.operators.decomposition import SVD
from quarry.operators.linear import GLM, gram_long, row_diagnostics
from quarry.operators.prep import fit_normalizer
from quarry.plans import scoring
from quarry.session import session_key
from quarry.sources import cases
from quarry.sources.tables import load

NUMERIC = ["acctbal", "n_orders", "avg_price", "sum_qty", "last_gap_days"]
CLS_NUMERIC = ["acctbal", "n_orders", "avg_price", "sum_qty", "last_gap_days"]
CLS_CATEGORICAL = ["segment", "region"]
REG_TARGET = "sum_qty"
REG_NUMERIC = ["n_orders", "acctbal", "avg_price", "last_gap_days"]
KM_COLS = ["acctbal", "n_orders", "sum_qty"]

_CACHE: dict = {}


def _memo(key, build):
    if key not in _CACHE:
        _CACHE[key] = build()
    return _CACHE[key]


def _build(spark, sf_dir):
    return cases.split(cases.case_table(spark, sf_dir), cases.SPLIT_BUILD)


# ------------------------------------------------------------ SQL-checkable pieces
def q_gram_matrix(spark, sf_dir):
    """X'X of (1, acctbal, n_orders, sum_qty) in exact decimal arithmetic."""
    c = cases.case_table(spark, sf_dir).select(
        F.lit(1).cast("decimal(12,2)").alias("one"),
        F.col("acctbal").cast("decimal(12,2)").alias("acctbal"),
        F.col("n_orders").cast("decimal(12,2)").alias("n_orders"),
        F.col("sum_qty").cast("decimal(12,2)").alias("sum_qty"))
    g = gram_long(c, ["one", "acctbal", "n_orders", "sum_qty"], cast_double=False)
    return g.select("attr_i", "attr_j", F.col("value").cast("double").alias("value"))


def _glm_1d(spark, sf_dir):
    return _memo(("glm1", session_key(spark), sf_dir), lambda: GLM(
        target=REG_TARGET, numeric=["n_orders"], name="GLM_1D").fit(_build(spark, sf_dir)))


def q_glm_1d_coefficients(spark, sf_dir):
    m = _glm_1d(spark, sf_dir)
    return spark.createDataFrame([(float(m.beta[0]), float(m.beta[1]))], "intercept double, slope double") \
        .select(rnd("intercept").alias("intercept"), rnd("slope").alias("slope"))


def _reg_scored(spark, sf_dir):
    m = _glm_1d(spark, sf_dir)
    a = _apply_view(spark, sf_dir)
    return a.select("cust_id", F.col(REG_TARGET).alias("actual"), m.prediction(a).alias("predicted"))


def q_rmse_mae(spark, sf_dir):
    e = ev.regression_errors(_reg_scored(spark, sf_dir), "actual", "predicted")
    return e.select(rnd("rmse").alias("rmse"), rnd("mae").alias("mae"))


def q_mape(spark, sf_dir):
    return ev.mape(_reg_scored(spark, sf_dir), "actual", "predicted").select(rnd("mape").alias("mape"))


def _km_start(spark, sf_dir):
    c = cases.case_table(spark, sf_dir)
    norm = fit_normalizer(c, KM_COLS)
    z = norm.transform(c.select("cust_id", *KM_COLS))
    # data-derived initial centers: means of the four key residue classes
    init = z.groupBy(F.pmod("cust_id", F.lit(4)).alias("g")).agg(*[F.avg(a).alias(a) for a in KM_COLS]) \
        .orderBy("g").collect()  # 4 rows
    return z, [[r[a] for a in KM_COLS] for r in init]


def q_kmeans_lloyd_step(spark, sf_dir):
    z, centers = _km_start(spark, sf_dir)
    s = lloyd_step(z, KM_COLS, centers)
    return s.select(F.col("cluster").cast("int").alias("cluster"), "n",
                    *[rnd(a).alias(a) for a in KM_COLS], rnd("sse", 3).alias("sse"))


# ------------------------------------------------------------ GLM (rows-only)
def _glm_reg(spark, sf_dir):
    return _memo(("glmr", session_key(spark), sf_dir), lambda: GLM(
        target=REG_TARGET, numeric=REG_NUMERIC, categorical=["segment"], name="customer_quantity_glm")
        .fit(_build(spark, sf_dir)))


def _glm_log(spark, sf_dir):
    return _memo(("glmc", session_key(spark), sf_dir), lambda: GLM(
        target="affinity", numeric=CLS_NUMERIC, categorical=CLS_CATEGORICAL, family="binomial",
        name="affinity_logit").fit(_build(spark, sf_dir)))


def q_glm_regression(spark, sf_dir):
    """Linear GLM coefficients with std errors, t statistics and p-values (view D)."""
    return _glm_reg(spark, sf_dir).view("D")


def q_glm_global(spark, sf_dir):
    return _glm_reg(spark, sf_dir).view("G")


def q_glm_ridge(spark, sf_dir):
    """Ridge GLM (lambda .01): coefficients; standard errors are NULL (invalid covariance)."""
    m = GLM(target=REG_TARGET, numeric=REG_NUMERIC, categorical=["segment"], ridge=0.01,
            name="GLMR_RIDGE").fit(_build(spark, sf_dir))
    return m.view("D")


def q_glm_logistic(spark, sf_dir):
    return _glm_log(spark, sf_dir).view("D")


def q_glm_bounds(spark, sf_dir):
    """PREDICTION and PREDICTION_BOUNDS of the linear GLM on the apply split."""
    m = _glm_reg(spark, sf_dir)
    a = _apply_view(spark, sf_dir)
    b = m.prediction_bounds(a)
    return a.select("cust_id", m.prediction(a).alias("prediction"), b["lower"].alias("lower"),
                    b["upper"].alias("upper"))


def q_glm_diagnostics(spark, sf_dir):
    m = _glm_reg(spark, sf_dir)
    return row_diagnostics(m, _build(spark, sf_dir), "cust_id")


def q_glm_logistic_eval(spark, sf_dir):
    """Logistic GLM confusion matrix on the apply split (scores as a projection)."""
    m = _glm_log(spark, sf_dir)
    s = scoring.with_probabilities(_apply_view(spark, sf_dir), m)
    return ev.confusion_from_pairs(s.select("affinity", scoring.prediction(m).alias("p")), "affinity", "p")


# ------------------------------------------------------------ Spark ML classifiers
def _dt(spark, sf_dir):
    return _memo(("dt", session_key(spark), sf_dir), lambda: ml.fit_classifier(
        _build(spark, sf_dir), "affinity", CLS_NUMERIC, CLS_CATEGORICAL, ml.decision_tree(),
        "ALGO_DECISION_TREE", name="affinity_tree"))


def q_decision_tree_cost(spark, sf_dir):
    """Decision tree with the 8:1 cost matrix: costed predictions' confusion on apply rows."""
    m = _dt(spark, sf_dir)
    cm = scoring.cost_matrix_from_rows(DT_COST)
    s = scoring.with_probabilities(_apply_view(spark, sf_dir), m)
    return ev.confusion_from_pairs(
        s.select("affinity", scoring.prediction_with_cost(m, cm).alias("p")), "affinity", "p")


def q_decision_tree_apply(spark, sf_dir):
    m = _dt(spark, sf_dir)
    return scoring.apply(_apply_view(spark, sf_dir), m, "cust_id")


def q_random_forest_importance(spark, sf_dir):
    m = ml.fit_classifier(_build(spark, sf_dir), "affinity", CLS_NUMERIC, CLS_CATEGORICAL,
                          ml.random_forest(), "ALGO_RANDOM_FOREST", name="affinity_forest")
    return m.feature_importance(spark)


def q_boosted_classifier(spark, sf_dir):
    m = ml.fit_classifier(_build(spark, sf_dir), "affinity", CLS_NUMERIC, CLS_CATEGORICAL,
                          ml.boosted_trees(), "ALGO_XGBOOST", name="affinity_boosted")
    s = scoring.with_probabilities(_apply_view(spark, sf_dir), m)
    return ev.auc(ev.scored_table(s, scoring.prediction_probability(m, 1), F.col("affinity"), 1))


def q_svm_linear(spark, sf_dir):
    """Linear SVM with class weights .35/.65 (weight column)."""
    b = _build(spark, sf_dir).withColumn("__w", F.when(F.col("affinity") == 1, 0.65).otherwise(0.35))
    total = b.agg(F.sum("__w")).first()[0]
    m = ml.fit_classifier(b, "affinity", CLS_NUMERIC, CLS_CATEGORICAL, ml.linear_svm(total),
                          "ALGO_SUPPORT_VECTOR_MACHINES", weight_col="__w", scale=True, name="affinity_svm")
    out = m.transform(_apply_view(spark, sf_dir))
    return ev.confusion_from_pairs(out.select("affinity", F.col("prediction").cast("int").alias("p")),
                                   "affinity", "p")


def q_mlp_classifier(spark, sf_dir):
    b = _build(spark, sf_dir)
    m = ml.fit_classifier(b, "affinity", CLS_NUMERIC, CLS_CATEGORICAL, ml.mlp(hidden=(10,)),
                          "ALGO_NEURAL_NETWORK", scale=True, name="affinity_mlp")
    s = scoring.with_probabilities(_apply_view(spark, sf_dir), m)
    return ev.auc(ev.scored_table(s, scoring.prediction_probability(m, 1), F.col("affinity"), 1))


# ------------------------------------------------------------ clustering / factorization
def _km(spark, sf_dir):
    return _memo(("km", session_key(spark), sf_dir), lambda: HierarchicalKMeans(k=10, name="customer_kmeans")
                 .fit(cases.case_table(spark, sf_dir), KM_COLS))


def q_kmeans_tree(spark, sf_dir):
    return _km(spark, sf_dir).view("D")


def q_kmeans_assign(spark, sf_dir):
    """CLUSTER_ID, CLUSTER_DISTANCE and CLUSTER_PROBABILITY for every customer."""
    m = _km(spark, sf_dir)
    c = cases.case_table(spark, sf_dir)
    s = scoring.with_probabilities(c, m)
    return s.select("cust_id", m.cluster_id(c).alias("cluster_id"), m.cluster_distance(c).alias("distance"),
                    F.array_max("__probs").alias("probability"))


def q_kmeans_histograms(spark, sf_dir):
    m = _km(spark, sf_dir)
    c = cases.case_table(spark, sf_dir)
    return cluster_histograms(c, m.cluster_id(c), KM_COLS)


def q_svd_pca(spark, sf_dir):
    """PCA scoring mode: singular values and explained variance (view E)."""
    m = SVD(pca=True).fit(cases.case_table(spark, sf_dir), NUMERIC)
    return m.view("E")


def q_svd_reconstruction(spark, sf_dir):
    """Reconstruction error of the case table from the top 3 of 5 features: MAE and MAPE."""
    c = cases.case_table(spark, sf_dir)
    m = SVD(pca=True).fit(c, NUMERIC)
    rec = m.reconstruct(c, 3)
    long = c.select(F.inline(F.array(*[F.struct(F.lit(a).alias("attribute_name"),
                                                F.col(a).cast("double").alias("actual"),
                                                r.alias("predicted")) for a, r in zip(NUMERIC, rec)])))
    long = long.filter(F.col("actual").isNotNull())
    return long.groupBy("attribute_name").agg(
        F.avg(F.abs(F.col("actual") - F.col("predicted"))).alias("mae"),
        F.avg(F.abs((F.col("actual") - F.col("predicted")) /
                    F.when(F.col("actual") == 0, 1.0).otherwise(F.col("actual")))).alias("mape"))


QUERIES = {
    "gram_matrix": q_gram_matrix,
    "glm_1d_coefficients": q_glm_1d_coefficients,
    "rmse_mae": q_rmse_mae,
    "mape": q_mape,
    "kmeans_lloyd_step": q_kmeans_lloyd_step,
    "glm_regression": q_glm_regression,
    "glm_global": q_glm_global,
    "glm_ridge": q_glm_ridge,
    "glm_logistic": q_glm_logistic,
    "glm_bounds": q_glm_bounds,
    "glm_diagnostics": q_glm_diagnostics,
    "glm_logistic_eval": q_glm_logistic_eval,
    "decision_tree_cost": q_decision_tree_cost,
    "decision_tree_apply": q_decision_tree_apply,
    "random_forest_importance": q_random_forest_importance,
    "boosted_classifier": q_boosted_classifier,
    "svm_linear": q_svm_linear,
    "mlp_classifier": q_mlp_classifier,
    "kmeans_tree": q_kmeans_tree,
    "kmeans_assign": q_kmeans_assign,
    "kmeans_histograms": q_kmeans_histograms,
    "svd_pca": q_svd_pca,
    "svd_reconstruction": q_svd_reconstruction,
}


# ------------------------------------------------------------ more scoring / models
def q_glm_prediction_details(spark, sf_dir):
    """PREDICTION_DETAILS of the logistic GLM: top 3 attribute contributions for likely card holders."""
    m = _glm_log(spark, sf_dir)
    a = _apply_view(spark, sf_dir)
    s = scoring.with_probabilities(a, m)
    return s.filter(scoring.prediction_probability(m, 1) > 0.6).select(
        "cust_id", F.inline(m.prediction_details(a, 3)))


def q_kmeans_outliers(spark, sf_dir):
    """Distance-to-centroid anomalies: the 11 customers farthest from their leaf centroid."""
    m = _km(spark, sf_dir)
    c = cases.case_table(spark, sf_dir)
    d = c.select("cust_id", m.cluster_id(c).alias("cluster_id"), m.cluster_distance(c).alias("distance"))
    return d.orderBy(F.col("distance").desc(), F.col("cust_id").asc()).limit(11)


def q_regression_models(spark, sf_dir):
    """Spark ML regressors on the case table (target sum_qty): RMSE / MAE on the apply split.

    Regression tree, random forest, boosted trees (tree booster) and the linear
    booster (elastic net, alpha = L1, lambda = L2).
    """
    from pyspark.ml import regression as Rg
    b = _build(spark, sf_dir)
    a = _apply_view(spark, sf_dir)
    specs = [("regression_tree", Rg.DecisionTreeRegressor(maxDepth=6, seed=0)),
             ("random_forest", Rg.RandomForestRegressor(numTrees=25, subsamplingRate=0.5, seed=0)),
             ("boosted_trees", Rg.GBTRegressor(maxDepth=3, maxIter=10, stepSize=0.3, seed=0)),
             ("linear_booster", Rg.LinearRegression(regParam=1.0001, elasticNetParam=0.0001 / 1.0001))]
    out = None
    for label, est in specs:
        m = ml.fit_regressor(b, REG_TARGET, REG_NUMERIC, ["segment"], est, label.upper(), name=label)
        e = ev.regression_errors(m.predicted_value(a), REG_TARGET, "prediction") \
            .select(F.lit(label).alias("model"), "rmse", "mae")
        out = e if out is None else out.unionByName(e)
    return out


def q_text_svm(spark, sf_dir):
    """Text classification: TF-IDF over the 3000 most frequent terms (ODMS_TEXT_MAX_FEATURES)
    of whole documents + linear SVM, target labels.quality.

    Split by document key (pmod 3: 0 build, 2 test); confusion matrix of the test documents.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LinearSVC
    from pyspark.ml.feature import IDF, CountVectorizer
    from quarry.functions.scalar import tokenize
    d = load(spark, sf_dir, "documents").select("doc_id", "text")
    lab = load(spark, sf_dir, "labels").select("doc_id", "quality")
    data = d.join(lab, "doc_id").select("doc_id", tokenize("text").alias("tokens"),
                                        F.col("quality").cast("double").alias("label"))
    pipe = Pipeline(stages=[CountVectorizer(inputCol="tokens", outputCol="tf", vocabSize=3000, minDF=1.0),
                            IDF(inputCol="tf", outputCol="features", minDocFreq=1),
                            LinearSVC(featuresCol="features", labelCol="label", regParam=0.01, maxIter=50)])
    build = data.filter(F.pmod("doc_id", F.lit(3)) == 0).cache()  # every stage and iteration rescans it
    test = data.filter(F.pmod("doc_id", F.lit(3)) == 2)
    model = pipe.fit(build)
    out = model.transform(test)
    return ev.confusion_from_pairs(out.select(F.col("label").cast("int").alias("a"),
                                              F.col("prediction").cast("int").alias("p")), "a", "p")


def q_nmf(spark, sf_dir):
    """NMF (3 features) of the customer x part-type spend matrix: H view plus the final error."""
    from quarry.operators.decomposition import NMF
    long = cases.cust_type_sums(spark, sf_dir)
    types = sorted(r[0] for r in long.select("p_type").distinct().collect())  # part types: bounded
    wide = long.groupBy("cust_id").pivot("p_type", types).agg(F.first("amount")).na.fill(0.0)
    m = NMF(k=3).fit(wide, types)
    err = float(m.errors[-1])
    return m.view("H").withColumn("final_sq_error", F.lit(err)).withColumn("iterations", F.lit(len(m.errors)))


QUERIES.update({
    "glm_prediction_details": q_glm_prediction_details,
    "kmeans_outliers": q_kmeans_outliers,
    "regression_models": q_regression_models,
    "text_svm": q_text_svm,
    "nmf": q_nmf,
})


def q_decision_tree_rules(spark, sf_dir):
    """Tree hierarchy / node view of the decision tree: split and edge predicates by attribute,
    leaf predictions and leaf record counts on the build rows."""
    m = _dt(spark, sf_dir)
    return ml.tree_view(m, _build(spark, sf_dir))


QUERIES["decision_tree_rules"] = q_decision_tree_rules


def q_kmeans_cluster_counts(spark, sf_dir):
    """Customers per CLUSTER_ID (leaf of the k-means tree)."""
    m = _km(spark, sf_dir)
    c = cases.case_table(spark, sf_dir)
    return c.groupBy(m.cluster_id(c).alias("cluster_id")).agg(F.count(F.lit(1)).alias("cnt"))


def q_kmeans_representatives(spark, sf_dir):
    """The 10 customers most likely to belong to node 2 (CLUSTER_PROBABILITY(m, 2), ties by cust_id).

    Node 2 is the first child of the root; its probability is the sum over its leaves.
    """
    m = _km(spark, sf_dir)
    c = cases.case_table(spark, sf_dir)
    p = c.select("cust_id", m.cluster_probability(c, 2).alias("prob"))
    return p.orderBy(F.col("prob").desc(), F.col("cust_id").asc()).limit(10)


def q_kmeans_cluster_details(spark, sf_dir):
    """CLUSTER_SET(m, NULL, 0.2) per customer, with CLUSTER_DETAILS(m, cluster, 5) of each member:
    one row per (customer, likely cluster, attribute) with the attribute's weight and rank."""
    m = _km(spark, sf_dir)
    c = cases.case_table(spark, sf_dir)
    s = scoring.with_probabilities(c, m)
    likely = s.select("*", F.inline(m.cluster_set(F.col("__probs"), None, 0.2)))
    d = m.with_cluster_details(likely, F.col("cluster_id"), 5, "det")
    return d.select("cust_id", "cluster_id", "probability",
                    F.posexplode("det").alias("pos", "d")).select(
        "cust_id", "cluster_id", "probability", (F.col("pos") + 1).alias("rank"),
        F.col("d.attribute").alias("attribute"), F.col("d.weight").alias("weight"))


QUERIES.update({
    "kmeans_cluster_counts": q_kmeans_cluster_counts,
    "kmeans_representatives": q_kmeans_representatives,
    "kmeans_cluster_details": q_kmeans_cluster_details,
})


def _svd(spark, sf_dir):
    return _memo(("svd", session_key(spark), sf_dir), lambda: SVD(pca=True, name="customer_svd")
                 .fit(cases.case_table(spark, sf_dir), NUMERIC))


def q_svd_feature_values(spark, sf_dir):
    """FEATURE_VALUE of the top two PCA projections and FEATURE_ID for every customer."""
    m = _svd(spark, sf_dir)
    c = cases.case_table(spark, sf_dir)
    v = m.feature_values(c)
    return c.select("cust_id", v[0].alias("proj1"), v[1].alias("proj2"), m.feature_id(c).alias("feature_id"))


def q_svd_feature_details(spark, sf_dir):
    """FEATURE_DETAILS(m, 1, 3): the three attributes contributing most to projection 1, per customer."""
    m = _svd(spark, sf_dir)
    c = cases.case_table(spark, sf_dir)
    return c.select("cust_id", F.posexplode(m.feature_details(c, 1, 3)).alias("pos", "d")).select(
        "cust_id", (F.col("pos") + 1).alias("rank"), F.col("d.attribute").alias("attribute"),
        F.col("d.weight").alias("weight"))


def q_svd_feature_set(spark, sf_dir):
    """FEATURE_SET(m, 3): the three highest features per customer, as (feature_id, value) rows."""
    m = _svd(spark, sf_dir)
    c = cases.case_table(spark, sf_dir)
    return c.select("cust_id", F.inline(m.feature_set(c, 3)))


QUERIES.update({
    "svd_feature_values": q_svd_feature_values,
    "svd_feature_details": q_svd_feature_details,
    "svd_feature_set": q_svd_feature_set,
})


def _oc(spark, sf_dir):
    from quarry.operators.ocluster import OCluster
    return _memo(("oc", session_key(spark), sf_dir), lambda: OCluster(k=10, sensitivity=0.5, name="customer_ocluster")
                 .fit(cases.case_table(spark, sf_dir), NUMERIC))


def q_ocluster_tree(spark, sf_dir):
    """O-Cluster hierarchy (view D): size, parent, level, children and split predicate of every cluster."""
    return _oc(spark, sf_dir).view("D")


def q_ocluster_bins(spark, sf_dir):
    """O-Cluster binning (view B): 10 equi-width bins per numeric attribute."""
    v = _oc(spark, sf_dir).view("B")
    return v.select("attribute_name", "bin_id", F.round("lower_bin_boundary", R).alias("lower_bin_boundary"),
                    F.round("upper_bin_boundary", R).alias("upper_bin_boundary"))


def q_ocluster_assign(spark, sf_dir):
    """Customers per O-Cluster CLUSTER_ID."""
    m = _oc(spark, sf_dir)
    c = cases.case_table(spark, sf_dir)
    return c.groupBy(m.cluster_id(c).alias("cluster_id")).agg(F.count(F.lit(1)).alias("cnt"))


QUERIES.update({
    "ocluster_tree": q_ocluster_tree,
    "ocluster_bins": q_ocluster_bins,
    "ocluster_assign": q_ocluster_assign,
})


def _svmo(spark, sf_dir):
    from quarry.operators.oneclass import OneClassSVM
    return _memo(("svmo", session_key(spark), sf_dir), lambda: OneClassSVM(outlier_rate=0.1, name="customer_outliers")
                 .fit(cases.case_table(spark, sf_dir), NUMERIC))


def q_oneclass_svm_outliers(spark, sf_dir):
    """Top 5 outliers by PREDICTION_PROBABILITY(m, 0) (ties by cust_id), with PREDICTION_DETAILS(m, 0)."""
    m = _svmo(spark, sf_dir)
    c = cases.case_table(spark, sf_dir)
    top = c.select("cust_id", *NUMERIC, m.prediction_probability(c, 0).alias("prob")) \
        .orderBy(F.col("prob").desc(), F.col("cust_id").asc()).limit(5)
    return top.select("cust_id", "prob", F.inline(m.prediction_details(top, 3)))


def q_oneclass_svm_typical(spark, sf_dir):
    """Profile of typical customers (PREDICTION = 1) per market segment, and the anomaly count."""
    m = _svmo(spark, sf_dir)
    c = cases.case_table(spark, sf_dir)
    pred = m.prediction(c)
    return c.groupBy("segment").agg(
        F.sum(pred).alias("n_typical"), F.count(F.lit(1)).alias("n"),
        F.round(F.avg(F.when(pred == 1, F.col("acctbal"))), 2).alias("avg_acctbal_typical"),
        F.round(F.avg(F.when(pred == 1, F.col("n_orders"))), 2).alias("avg_orders_typical"))


QUERIES.update({
    "oneclass_svm_outliers": q_oneclass_svm_outliers,
    "oneclass_svm_typical": q_oneclass_svm_typical,
})


def q_boosted_importance(spark, sf_dir):
    """Boosted trees (depth 3, 10 rounds): relative gain, cover and frequency per attribute slot."""
    m = ml.fit_classifier(_build(spark, sf_dir), "affinity", CLS_NUMERIC, CLS_CATEGORICAL,
                          ml.boosted_trees(), "ALGO_XGBOOST", name="affinity_boosted")
    return ml.boosted_importance(m, spark)


QUERIES["boosted_importance"] = q_boosted_importance


def q_nn_regression(spark, sf_dir):
    """Neural-network regression (1 hidden layer of 10 sigmoid units, seed 12) of sum_qty:
    RMSE / MAE on the apply split."""
    from quarry.operators.neural import NeuralRegression
    m = NeuralRegression(REG_TARGET, hidden=10, seed=12, name="quantity_network") \
        .fit(_build(spark, sf_dir), REG_NUMERIC)
    a = _apply_view(spark, sf_dir).filter(F.col(REG_TARGET).isNotNull())
    return ev.regression_errors(a.select(REG_TARGET, m.predicted_value(a).alias("prediction")),
                                REG_TARGET, "prediction")


QUERIES["nn_regression"] = q_nn_regression


def q_svm_gaussian_regression(spark, sf_dir):
    """Gaussian-kernel SVM regression (epsilon .1, random Fourier features) of sum_qty:
    RMSE / MAE on the apply split."""
    from quarry.operators.kernel_svm import KernelSVR
    m = KernelSVR(REG_TARGET, epsilon=0.1, name="quantity_svr").fit(_build(spark, sf_dir), REG_NUMERIC)
    a = _apply_view(spark, sf_dir).filter(F.col(REG_TARGET).isNotNull())
    return ev.regression_errors(a.select(REG_TARGET, m.predicted_value(a).alias("prediction")),
                                REG_TARGET, "prediction")


QUERIES["svm_gaussian_regression"] = q_svm_gaussian_regression
