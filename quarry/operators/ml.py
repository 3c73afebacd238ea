"""Spark ML estimators behind the model / scoring surface of this library.

A shared feature pipeline does the automatic data preparation
(``PREP_AUTO``): mean imputation of numerics, indexing + one-hot of
categoricals (unseen values go to an extra bucket), vector assembly.
The fitted pipeline travels with the model, so scoring replays it.

Fitting and scoring are Spark ML jobs (distributed histogram aggregation
for trees, treeAggregate gradients for linear models and MLP).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml import classification as C
from pyspark.ml import clustering as K
from pyspark.ml import regression as Rg
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.plans.model import MiningModel

FEATURES = "__features"


def feature_stages(numeric: list[str], categorical: list[str], scale: bool = False) -> list:
    stages = []
    num_out = [f"__n_{a}" for a in numeric]
    if numeric:
        stages.append(Imputer(inputCols=numeric, outputCols=num_out, strategy="mean"))
    cat_idx = [f"__i_{a}" for a in categorical]
    cat_vec = [f"__v_{a}" for a in categorical]
    if categorical:
        stages.append(StringIndexer(inputCols=categorical, outputCols=cat_idx, handleInvalid="keep",
                                    stringOrderType="alphabetAsc"))
        stages.append(OneHotEncoder(inputCols=cat_idx, outputCols=cat_vec, dropLast=False, handleInvalid="keep"))
    assembled = FEATURES + ("_raw" if scale else "")
    stages.append(VectorAssembler(inputCols=num_out + cat_vec, outputCol=assembled, handleInvalid="keep"))
    if scale:
        from pyspark.ml.feature import StandardScaler
        stages.append(StandardScaler(inputCol=assembled, outputCol=FEATURES, withMean=True, withStd=True))
    return stages


def feature_names(pm: PipelineModel, numeric: list[str], categorical: list[str]) -> list[tuple[str, str | None]]:
    """(attribute, value) for every slot of the assembled vector (one-hot keeps names)."""
    names = [(a, None) for a in numeric]
    labels = {}
    for st in pm.stages:
        if st.__class__.__name__ == "StringIndexerModel":
            # handleInvalid='keep': unseen values take the index after the labels
            labels = {a: list(ls) + ["__unseen__"] for a, ls in zip(categorical, st.labelsArray)}
        if st.__class__.__name__ == "OneHotEncoderModel":
            keep = st.getHandleInvalid() == "keep"
            drop = st.getDropLast()
            for a, size in zip(categorical, st.categorySizes):
                # Spark's slot count per attribute: keep adds an invalid slot, dropLast removes one
                n = size + (1 if keep else 0) - (1 if drop else 0)
                slot_names = (labels.get(a, []) + ["__invalid__"] * n)[:n]
                names += [(a, v) for v in slot_names]
    return names


def _cast_numeric(df: DataFrame, numeric: list[str]) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) if c in numeric else F.col(c) for c in df.columns])


@dataclass
class SparkMLModel(MiningModel):
    pipeline: PipelineModel | None = None
    numeric: list = field(default_factory=list)
    categorical: list = field(default_factory=list)
    classes: list = field(default_factory=list)
    label_map: dict = field(default_factory=dict)

    def _input(self, df: DataFrame) -> DataFrame:
        missing = [a for a in self.numeric + self.categorical if a not in df.columns]
        for a in missing:  # USING a subset: absent attributes are NULL
            df = df.withColumn(a, F.lit(None).cast("double" if a in self.numeric else "string"))
        return _cast_numeric(df, self.numeric)

    def transform(self, df: DataFrame) -> DataFrame:
        return self.pipeline.transform(self._input(df))

    def with_probabilities(self, df: DataFrame, name: str = "__probs") -> DataFrame:
        out = self.transform(df)
        probs = vector_to_array(F.col("probability"))
        keep = [c for c in df.columns]
        return out.select(*keep, probs.alias(name))

    def predicted_value(self, df: DataFrame) -> DataFrame:
        """Regression prediction column ``prediction`` next to the input columns."""
        out = self.transform(df)
        return out.select(*df.columns, F.col("prediction").alias("prediction"))

    def feature_importance(self, spark) -> DataFrame:
        """Importance per attribute: one-hot members summed back to their attribute."""
        est = self.pipeline.stages[-1]
        imp = est.featureImportances.toArray().tolist()
        names = feature_names(self.pipeline, self.numeric, self.categorical)
        agg: dict = {}
        for (a, _), v in zip(names, imp):
            agg[a] = agg.get(a, 0.0) + float(v)
        rows = sorted(agg.items(), key=lambda kv: (-kv[1], kv[0]))
        return spark.createDataFrame([(a, v, i + 1) for i, (a, v) in enumerate(rows)],
                                     "attribute_name string, importance double, rank int")


def _fit_pipeline(data, numeric, categorical, scale, estimator, weight_col, n_classes) -> PipelineModel:
    """Fit the feature stages, then the estimator; ``estimator`` may be a
    callable ``(n_features, n_classes) -> estimator`` when it needs the
    assembled width (MLP layers)."""
    feats = Pipeline(stages=feature_stages(numeric, categorical, scale)).fit(data)
    prepared = feats.transform(data)
    if callable(estimator) and not hasattr(estimator, "fit"):
        width = prepared.schema[FEATURES].metadata.get("ml_attr", {}).get("num_attrs")
        if width is None:
            width = len(prepared.select(FEATURES).first()[0])
        estimator = estimator(int(width), n_classes)
    estimator = estimator.setFeaturesCol(FEATURES).setLabelCol("__label")
    if weight_col and estimator.hasParam("weightCol"):
        estimator = estimator.setWeightCol(weight_col)
    fitted = estimator.fit(prepared)
    return PipelineModel(stages=list(feats.stages) + [fitted])


def _label(df: DataFrame, target: str, classes: list) -> Column:
    expr = None
    for i, c in enumerate(classes):
        hit = F.col(target) == F.lit(c)
        expr = F.when(hit, float(i)) if expr is None else expr.when(hit, float(i))
    return expr


def fit_classifier(df: DataFrame, target: str, numeric: list[str], categorical: list[str], estimator,
                   algorithm: str, weight_col: str | None = None, scale: bool = False,
                   name: str = "clas_model", settings: dict | None = None) -> SparkMLModel:
    """Fit any Spark ML probabilistic classifier on (numeric, categorical) attributes."""
    data = df.filter(F.col(target).isNotNull())
    classes = sorted(r[0] for r in data.select(target).distinct().collect())  # k rows
    data = _cast_numeric(data, numeric).withColumn("__label", _label(data, target, classes))
    pm = _fit_pipeline(data, numeric, categorical, scale, estimator, weight_col, len(classes))
    m = SparkMLModel(name=name, function="CLASSIFICATION", algorithm=algorithm, pipeline=pm,
                     numeric=list(numeric), categorical=list(categorical), classes=classes,
                     target=target, settings=dict(settings or {}))
    m.signature = [(a, "NUMBER") for a in numeric] + [(a, "VARCHAR2") for a in categorical]
    return m


def fit_regressor(df: DataFrame, target: str, numeric: list[str], categorical: list[str], estimator,
                  algorithm: str, weight_col: str | None = None, scale: bool = False,
                  name: str = "regr_model", settings: dict | None = None) -> SparkMLModel:
    data = _cast_numeric(df.filter(F.col(target).isNotNull()), numeric) \
        .withColumn("__label", F.col(target).cast("double"))
    pm = _fit_pipeline(data, numeric, categorical, scale, estimator, weight_col, 0)
    m = SparkMLModel(name=name, function="REGRESSION", algorithm=algorithm, pipeline=pm,
                     numeric=list(numeric), categorical=list(categorical), target=target,
                     settings=dict(settings or {}))
    m.signature = [(a, "NUMBER") for a in numeric] + [(a, "VARCHAR2") for a in categorical]
    return m


# ---------------------------------------------------------------- estimators
def decision_tree(max_depth=7, impurity="gini", min_rec_node=10, min_info_gain=0.0, max_bins=32, seed=0):
    """TREE_TERM_MAX_DEPTH / TREE_IMPURITY_METRIC / TREE_TERM_MINREC_NODE / CLAS_MAX_SUP_BINS."""
    return C.DecisionTreeClassifier(maxDepth=max_depth, impurity=impurity, minInstancesPerNode=min_rec_node,
                                    minInfoGain=min_info_gain, maxBins=max_bins, seed=seed)


def random_forest(num_trees=25, mtry="sqrt", sampling_ratio=0.5, max_depth=16, seed=0):
    """RFOR_NUM_TREES / RFOR_MTRY / RFOR_SAMPLING_RATIO."""
    return C.RandomForestClassifier(numTrees=num_trees, featureSubsetStrategy=str(mtry),
                                    subsamplingRate=sampling_ratio, maxDepth=max_depth, seed=seed)


def boosted_trees(max_depth=3, eta=1.0, rounds=10, seed=0):
    """objective binary:logistic, max_depth, eta, num_round."""
    return C.GBTClassifier(maxDepth=max_depth, stepSize=eta, maxIter=rounds, seed=seed)


def mlp(hidden=(10,), max_iter=100, tol=1e-6, seed=0):
    """NNET_NODES_PER_LAYER / NNET_ITERATIONS / NNET_TOLERANCE (L-BFGS).

    Returns a factory: the input width is known only after feature assembly.
    """
    def make(n_features: int, n_classes: int):
        layers = [n_features] + list(hidden) + [max(n_classes, 2)]
        return C.MultilayerPerceptronClassifier(layers=layers, maxIter=max_iter, tol=tol, seed=seed,
                                                solver="l-bfgs")
    return make


def linear_svm(total_weight: float, complexity=1.0, max_iter=100, tol=1e-4):
    """SVMS_COMPLEXITY_FACTOR C over rows of ``total_weight`` (their count without weights).

    The machine minimises |b|^2 / 2 + C * sum of weighted hinge losses; the estimator's loss is the
    weighted mean, so its regParam is 1 / (C total_weight).
    """
    return C.LinearSVC(regParam=1.0 / max(complexity * total_weight, 1e-12), maxIter=max_iter, tol=tol)


# ---------------------------------------------------------------- tree views
def _feature_label(names, idx: int):
    a, v = names[idx] if idx < len(names) else (f"feature {idx}", None)
    return a, v


def _readable(cond: str, names) -> str:
    """'feature 5 in {1.0}' / 'feature 0 <= 6372.87' -> attribute predicates."""
    import re
    m = re.match(r"feature (\d+) (<=|>|in|not in) (.*)", cond)
    if not m:
        return cond
    a, v = _feature_label(names, int(m.group(1)))
    op, rhs = m.group(2), m.group(3)
    if v is not None:  # a one-hot slot: 1.0 means "a = v"
        hit = (op == "in" and "1.0" in rhs) or (op == "not in" and "1.0" not in rhs) or op == ">"
        return f"{a} = '{v}'" if hit else f"{a} <> '{v}'"
    if op in ("in", "not in"):
        return f"{a} {op.upper()} {rhs}"
    return f"{a} {op} {rhs}"


def tree_nodes(model: "SparkMLModel") -> list[tuple]:
    """Parse the fitted tree into (node_id, parent_id, depth, predicate, split, prediction, leaf_ordinal).

    node ids follow preorder from 1; ``predicate`` is the condition on the edge
    from the parent, ``split`` the node's own test (internal nodes), leaves carry
    the predicted class and their preorder ordinal among leaves.
    """
    est = model.pipeline.stages[-1]
    names = feature_names(model.pipeline, model.numeric, model.categorical)
    lines = [ln for ln in est.toDebugString.splitlines()[1:] if ln.strip()]
    pos = 0
    rows: list = []
    counter = {"node": 0, "leaf": 0}

    def parse(parent, depth, edge):
        nonlocal pos
        counter["node"] += 1
        nid = counter["node"]
        text = lines[pos].strip()
        if text.startswith("Predict:"):
            pos += 1
            pred = float(text.split(":", 1)[1])
            label = model.classes[int(pred)] if model.classes else pred
            rows.append((nid, parent, depth, edge, None, str(label), counter["leaf"]))
            counter["leaf"] += 1
            return
        cond_if = text[len("If ("):-1]
        pos += 1
        rows.append((nid, parent, depth, edge, _readable(cond_if, names), None, None))
        parse(nid, depth + 1, _readable(cond_if, names))
        cond_else = lines[pos].strip()[len("Else ("):-1]
        pos += 1
        parse(nid, depth + 1, _readable(cond_else, names))

    parse(None, 0, None)
    return rows


def tree_view(model: "SparkMLModel", df: DataFrame) -> DataFrame:
    """Tree nodes with leaf record counts (Spark's preorder leaf index on the scored rows)."""
    spark = df.sparkSession
    rows = tree_nodes(model)
    nodes = spark.createDataFrame(rows, "node_id int, parent_id int, tree_level int, predicate string, "
                                        "split string, prediction string, leaf_ordinal int")
    est = model.pipeline.stages[-1]
    est.setLeafCol("__leaf")
    try:
        counts = model.transform(df).groupBy(F.col("__leaf").cast("int").alias("leaf_ordinal")) \
            .agg(F.count(F.lit(1)).alias("record_count"))
    finally:
        est.setLeafCol("")
    return nodes.join(counts, "leaf_ordinal", "left").drop("leaf_ordinal")


def boosted_importance(model: "SparkMLModel", spark) -> DataFrame:
    """Boosted-tree attribute importance: relative gain, cover and frequency.

    Walks every tree of the fitted ensemble (model-sized: trees x nodes).  For
    each (attribute, one-hot value) slot: gain = sum of the split gains of the
    nodes splitting on it, cover = sum of the training rows reaching those
    nodes (Spark keeps row counts, not hessian sums), frequency = number of
    such splits; each is divided by its total over all slots.
    """
    est = model.pipeline.stages[-1]
    names = feature_names(model.pipeline, model.numeric, model.categorical)
    acc: dict = {}
    for tree in est._java_obj.trees():
        stack = [tree.rootNode()]
        while stack:
            node = stack.pop()
            if node.getClass().getSimpleName() != "InternalNode":
                continue
            slot = int(node.split().featureIndex())
            g, c, f = acc.get(slot, (0.0, 0.0, 0))
            acc[slot] = (g + float(node.gain()), c + float(node.impurityStats().count()), f + 1)
            stack += [node.leftChild(), node.rightChild()]
    tg = sum(v[0] for v in acc.values()) or 1.0
    tc = sum(v[1] for v in acc.values()) or 1.0
    tf = sum(v[2] for v in acc.values()) or 1
    rows = [(names[s][0], names[s][1], g / tg, c / tc, f / tf) for s, (g, c, f) in sorted(acc.items())]
    return spark.createDataFrame(rows, "attribute_name string, attribute_value string, gain double, "
                                       "cover double, frequency double")
