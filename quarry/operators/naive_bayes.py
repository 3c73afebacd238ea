"""Naive Bayes classifier with priors, binning and detail views.

Fit (two small-output Spark jobs):
  1. numeric ranges: one ``agg(min, max)`` row for all numeric attributes;
  2. counts: the build rows are unpivoted to (attribute, value, class) and
     counted with ``groupBy`` - partial aggregation runs map-side, the
     shuffled data is (#attributes x #values x #classes), independent of
     the row count.

Numeric attributes are equi-width binned on the build range
(``num_bins`` bins, out-of-range values clamped); categorical values are
used as they are.  Conditional probabilities use Laplace smoothing
``(n_avc + 1) / (n_ac + V_a)``; an unseen value gets ``1 / (n_ac + V_a)``
and a NULL attribute is skipped.  Class priors come from the build data
or from a user priors table.

Score: ``log prior + sum of log conditionals`` per class, normalised with
a log-sum-exp.  When the model is small (the usual case: bins x classes)
the lookups are literal maps inside one projection - no join, no shuffle.
A model with more than ``max_inline_entries`` (attribute, value) pairs is
kept as a table and scored with one join per attribute; its views,
thresholds and results are the same.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.scalar import class_index_rows, equi_width_bin, literal_array, literal_map_of_arrays
from quarry.plans.model import MiningModel, attribute_roles

MAX_INLINE_ENTRIES = 20000


def _keyed(df: DataFrame, numeric: list[str], categorical: list[str], ranges: dict, bins: int):
    """Project every attribute to its string key (bin id or category)."""
    cols = []
    for a in numeric:
        lo, hi = ranges[a]
        cols.append(equi_width_bin(a, lo, hi, bins).cast("string").alias(a))
    for a in categorical:
        cols.append(F.col(a).cast("string").alias(a))
    return cols


@dataclass
class NaiveBayesModel(MiningModel):
    classes: list = field(default_factory=list)
    numeric: list = field(default_factory=list)
    categorical: list = field(default_factory=list)
    ranges: dict = field(default_factory=dict)
    num_bins: int = 10
    log_prior: dict = field(default_factory=dict)
    class_counts: dict = field(default_factory=dict)
    # attribute -> {value: [log p per class]}
    log_cond: dict = field(default_factory=dict)
    # attribute -> [log p of an unseen value per class]
    log_unseen: dict = field(default_factory=dict)
    cond_counts: list = field(default_factory=list)  # (attr, value, class, count)
    large_table: DataFrame | None = None  # (attr, value, class_idx, logp) when not inlined

    def attributes(self) -> list[str]:
        return list(self.numeric) + list(self.categorical)

    def _key_columns(self, df: DataFrame) -> dict[str, Column]:
        present = set(df.columns)
        keys = {}
        for a in self.numeric:
            lo, hi = self.ranges[a]
            keys[a] = (equi_width_bin(a, lo, hi, self.num_bins).cast("string") if a in present
                       else F.lit(None).cast("string"))
        for a in self.categorical:
            keys[a] = F.col(a).cast("string") if a in present else F.lit(None).cast("string")
        return keys

    def key_column(self, df: DataFrame, a: str) -> Column:
        """Key (bin id or category) of one attribute."""
        if a not in df.columns:
            return F.lit(None).cast("string")
        if a in self.numeric:
            lo, hi = self.ranges[a]
            return equi_width_bin(a, lo, hi, self.num_bins).cast("string")
        return F.col(a).cast("string")

    def log_score_columns(self, df: DataFrame) -> list[Column]:
        """Unnormalised log posterior per class (inline path)."""
        keys = self._key_columns(df)
        k = len(self.classes)
        totals = [F.lit(self.log_prior[c]) for c in self.classes]
        for a, key in keys.items():
            table = self.log_cond.get(a)
            if not table:
                continue
            m = literal_map_of_arrays(table)
            looked = F.element_at(m, key)
            unseen = literal_array(self.log_unseen[a])
            term = F.when(key.isNull(), F.array_repeat(F.lit(0.0), k)).otherwise(
                F.coalesce(looked, unseen))
            totals = [t + F.element_at(term, i + 1) for i, t in enumerate(totals)]
        return totals

    def log_score_array(self, df: DataFrame) -> Column:
        """Unnormalised log posteriors as one array column (each lookup appears once)."""
        return multi_model_log_scores({None: self}, None, df)

    def with_probabilities(self, df: DataFrame, name: str = "__probs") -> DataFrame:
        """Class probabilities as an array column, log scores computed once.

        The per-class log scores are materialized in their own projection so
        the normalisation below references them instead of repeating the
        whole lookup expression for every class.
        """
        logs = (df.withColumn("__nb_l", self.log_score_array(df)) if self.large_table is None
                else self._joined_log_scores(df))
        k = len(self.classes)
        ls = [F.element_at(F.col("__nb_l"), i + 1) for i in range(k)]
        mx = F.array_max(F.col("__nb_l"))
        exps = [F.exp(l - mx) for l in ls]
        tot = exps[0]
        for e in exps[1:]:
            tot = tot + e
        return logs.withColumn(name, F.array(*[e / tot for e in exps])).drop("__nb_l")

    def _joined_log_scores(self, df: DataFrame) -> DataFrame:
        """Adds the log scores of a model kept as a table: one left join per attribute on its value."""
        k = len(self.classes)
        zeros = F.array_repeat(F.lit(0.0), k)
        out = df.withColumn("__nb_l", literal_array([self.log_prior[c] for c in self.classes]))
        for a in self.numeric + self.categorical:
            if a not in self.log_unseen:
                continue
            values = (self.large_table.filter(F.col("attr") == a).groupBy(F.col("val").alias("__nb_v"))
                      .agg(F.transform(F.array_sort(F.collect_list(F.struct("class_idx", "logp"))),
                                       lambda x: x["logp"]).alias("__nb_t")))  # k entries a value
            out = out.withColumn("__nb_k", self.key_column(df, a)).join(
                values, F.col("__nb_k") == F.col("__nb_v"), "left")
            term = F.when(F.col("__nb_k").isNull(), zeros).otherwise(
                F.coalesce("__nb_t", literal_array(self.log_unseen[a])))
            out = out.withColumn("__nb_l", F.zip_with("__nb_l", term, lambda x, y: x + y)).drop(
                "__nb_k", "__nb_v", "__nb_t")
        return out

    def probability_columns(self, df: DataFrame) -> list[Column]:
        """The probabilities as plain columns; a model kept as a table has only :meth:`with_probabilities`."""
        if self.large_table is not None:
            raise ValueError("a model kept as a table is scored by with_probabilities()")
        logs = self.log_score_columns(df)
        mx = F.greatest(*logs) if len(logs) > 1 else logs[0]
        exps = [F.exp(l - mx) for l in logs]
        tot = exps[0]
        for e in exps[1:]:
            tot = tot + e
        return [e / tot for e in exps]

    def score_by_join(self, df: DataFrame, case_id: str) -> DataFrame:
        """Long (case_id, prediction, probability) via a join on (attribute, value).

        For models whose value tables are too large for a literal map.  The
        case rows are unpivoted, joined to the conditional table (shuffle on
        (attribute, value)), and summed per (case, class).
        """
        spark = df.sparkSession
        keys = self._key_columns(df)
        long = df.select(case_id, F.explode(F.array(*[
            F.struct(F.lit(a).alias("attr"), k.alias("val")) for a, k in keys.items()])).alias("kv")) \
            .select(case_id, "kv.attr", "kv.val").filter(F.col("val").isNotNull())
        k = len(self.classes)
        unseen = spark.createDataFrame(
            [(a, i, float(v[i])) for a, v in self.log_unseen.items() for i in range(k)],
            "attr string, class_idx int, unseen double")
        cls = spark.createDataFrame([(i, float(self.log_prior[c])) for i, c in enumerate(self.classes)],
                                    "class_idx int, lp double")
        per = (long.withColumn("class_idx", class_index_rows(k))
               .join(self.large_table, ["attr", "val", "class_idx"], "left")
               .join(F.broadcast(unseen), ["attr", "class_idx"], "left")
               .groupBy(case_id, "class_idx")
               .agg(F.sum(F.coalesce("logp", "unseen")).alias("s")))
        base = df.select(case_id).withColumn("class_idx", class_index_rows(k)).join(F.broadcast(cls), "class_idx")
        scored = base.join(per, [case_id, "class_idx"], "left").select(
            case_id, "class_idx", (F.col("lp") + F.coalesce("s", F.lit(0.0))).alias("l"))
        from pyspark.sql import Window
        w = Window.partitionBy(case_id)  # one group per case: k rows, bounded
        norm = scored.withColumn("m", F.max("l").over(w)) \
            .withColumn("e", F.exp(F.col("l") - F.col("m"))) \
            .withColumn("probability", F.col("e") / F.sum("e").over(w))
        labels = spark.createDataFrame([(i, c) for i, c in enumerate(self.classes)],
                                       "class_idx int, prediction " + _class_type(self.classes))
        return norm.join(F.broadcast(labels), "class_idx").select(case_id, "prediction", "probability")

    # -- detail views ------------------------------------------------------
    def priors_df(self, spark: SparkSession) -> DataFrame:
        rows = [(self.target, c, float(math.exp(self.log_prior[c])), int(self.class_counts.get(c, 0)))
                for c in self.classes]
        return spark.createDataFrame(
            rows, f"target_name string, target_value {_class_type(self.classes)}, "
                  "prior_probability double, count long")

    def conditionals_df(self, spark: SparkSession) -> DataFrame:
        if self.large_table is not None:
            labels = spark.createDataFrame(list(enumerate(self.classes)),
                                           f"class_idx int, target_value {_class_type(self.classes)}")
            return self.large_table.join(F.broadcast(labels), "class_idx").select(
                F.col("attr").alias("attribute_name"), F.col("val").alias("attribute_value"), "target_value",
                F.exp("logp").alias("conditional_probability"), F.col("n").alias("count"))
        idx = {c: i for i, c in enumerate(self.classes)}
        counts = {(a, v, c): n for a, v, c, n in self.cond_counts}
        rows = []
        for a, table in self.log_cond.items():
            for v, lps in table.items():
                for c in self.classes:
                    rows.append((a, v, c, float(math.exp(lps[idx[c]])), int(counts.get((a, v, c), 0))))
        return spark.createDataFrame(
            rows, f"attribute_name string, attribute_value string, target_value {_class_type(self.classes)}, "
                  "conditional_probability double, count long")

    def bins_df(self, spark: SparkSession) -> DataFrame:
        rows = []
        for a in self.numeric:
            lo, hi = self.ranges[a]
            if lo is None:
                continue
            width = (hi - lo) / self.num_bins if hi != lo else 0.0
            for b in range(1, (self.num_bins if hi != lo else 1) + 1):
                rows.append((a, b, float(lo + (b - 1) * width), float(lo + b * width if hi != lo else hi)))
        return spark.createDataFrame(rows, "attribute_name string, bin_id int, lower_bound double, upper_bound double")


def _class_type(classes: list) -> str:
    if all(isinstance(c, bool) for c in classes):
        return "boolean"
    if all(isinstance(c, int) for c in classes):
        return "int" if all(-2**31 <= c < 2**31 for c in classes) else "long"
    if all(isinstance(c, (int, float)) for c in classes):
        return "double"
    return "string"


class NaiveBayes:
    """Estimator.  ``NaiveBayes(target='affinity', case_id='cust_id').fit(build_df)``."""

    DEFAULTS = {"NABS_PAIRWISE_THRESHOLD": 0.0, "NABS_SINGLETON_THRESHOLD": 0.0,
                "PREP_AUTO": "ON", "NUM_BINS": 10}

    def __init__(self, target: str, case_id: str | None = None, num_bins: int = 10,
                 priors: dict | None = None, pairwise_threshold: float = 0.0,
                 singleton_threshold: float = 0.0, name: str = "nb_model",
                 max_inline_entries: int = MAX_INLINE_ENTRIES):
        self.target = target
        self.case_id = case_id
        self.num_bins = num_bins
        self.priors = priors
        self.pairwise_threshold = pairwise_threshold
        self.singleton_threshold = singleton_threshold
        self.name = name
        self.max_inline_entries = max_inline_entries

    def fit(self, df: DataFrame) -> NaiveBayesModel:
        spark = df.sparkSession
        exclude = [c for c in (self.case_id, self.target) if c]
        numeric, categorical = attribute_roles(df, exclude)
        data = df.filter(F.col(self.target).isNotNull())

        ranges = {}
        if numeric:
            row = data.agg(*[F.min(F.col(a).cast("double")).alias(f"lo_{i}") for i, a in enumerate(numeric)],
                           *[F.max(F.col(a).cast("double")).alias(f"hi_{i}") for i, a in enumerate(numeric)]
                           ).collect()[0]
            ranges = {a: (row[f"lo_{i}"], row[f"hi_{i}"]) for i, a in enumerate(numeric)}

        class_rows = data.groupBy(self.target).count().collect()
        class_counts = {r[0]: int(r[1]) for r in class_rows}
        classes = sorted(class_counts)
        n = sum(class_counts.values())

        keyed = data.select(F.col(self.target).alias("__t"),
                            *_keyed(data, numeric, categorical, ranges, self.num_bins))
        attrs = numeric + categorical
        long = keyed.unpivot("__t", attrs, "attr", "val").filter(F.col("val").isNotNull())
        counts_df = long.groupBy("attr", "val", "__t").agg(F.count(F.lit(1)).alias("n"))

        limit = self.max_inline_entries
        probe = counts_df.limit(limit * max(1, len(classes)) + 1).collect()
        large = len(probe) > limit * max(1, len(classes))

        if self.priors:
            tot = sum(self.priors.get(c, 0.0) for c in classes)
            log_prior = {c: math.log(self.priors[c] / tot) for c in classes}
        else:
            log_prior = {c: math.log(class_counts[c] / n) for c in classes}

        model = NaiveBayesModel(
            name=self.name, function="CLASSIFICATION", algorithm="ALGO_NAIVE_BAYES",
            settings={"CLAS_PRIORS_TABLE_NAME": "user priors" if self.priors else None,
                      "NABS_PAIRWISE_THRESHOLD": self.pairwise_threshold,
                      "NABS_SINGLETON_THRESHOLD": self.singleton_threshold,
                      "PREP_AUTO": "ON"},
            default_settings=dict(self.DEFAULTS),
            signature=[(a, "NUMBER") for a in numeric] + [(a, "VARCHAR2") for a in categorical],
            case_id=self.case_id, target=self.target, classes=classes, numeric=numeric,
            categorical=categorical, ranges=ranges, num_bins=self.num_bins,
            log_prior=log_prior, class_counts=class_counts)
        model.settings = {k: v for k, v in model.settings.items() if v is not None}

        if large:  # the same model, kept as a table
            self._fill_table(model, counts_df, classes, n, class_counts)
        else:
            self._fill_inline(model, probe, classes, n, class_counts)
        model.add_view("P", lambda: model.priors_df(spark), "Naive Bayes Target Priors")
        model.add_view("V", lambda: model.conditionals_df(spark), "Naive Bayes Conditional Probabilities")
        model.add_view("B", lambda: model.bins_df(spark), "Binning")
        return model

    # thresholds: a value whose overall share is below the singleton threshold
    # is treated as unseen; an (attribute, value, class) pair whose share of the
    # class is below the pairwise threshold counts as 0.
    def _fill_inline(self, model, rows, classes, n, class_counts):
        idx = {c: i for i, c in enumerate(classes)}
        per_value: dict = {}
        value_tot: dict = {}
        for a, v, c, cnt in rows:
            per_value.setdefault(a, {}).setdefault(v, [0] * len(classes))[idx[c]] = int(cnt)
            value_tot[(a, v)] = value_tot.get((a, v), 0) + int(cnt)
            model.cond_counts.append((a, v, c, int(cnt)))
        for a, vals in per_value.items():
            if self.singleton_threshold > 0:
                vals = {v: cs for v, cs in vals.items() if value_tot[(a, v)] / n >= self.singleton_threshold}
            if self.pairwise_threshold > 0:
                vals = {v: [x if x / class_counts[classes[i]] >= self.pairwise_threshold else 0
                            for i, x in enumerate(cs)] for v, cs in vals.items()}
            V = len(vals)
            if V == 0:
                continue
            n_ac = [sum(cs[i] for cs in vals.values()) for i in range(len(classes))]
            model.log_cond[a] = {v: [math.log((cs[i] + 1.0) / (n_ac[i] + V)) for i in range(len(classes))]
                                 for v, cs in vals.items()}
            model.log_unseen[a] = [math.log(1.0 / (n_ac[i] + V)) for i in range(len(classes))]

    def _fill_table(self, model, counts_df, classes, n, class_counts):
        """What :meth:`_fill_inline` does, on a table (attr, val, class_idx, n, logp)."""
        spark = counts_df.sparkSession
        k = len(classes)
        idx = spark.createDataFrame([(c, i, int(class_counts[c])) for i, c in enumerate(classes)],
                                    f"__t {_class_type(classes)}, class_idx int, n_c long")
        c = counts_df.join(F.broadcast(idx), "__t").select("attr", "val", "class_idx", "n", "n_c")
        values = c.groupBy("attr", "val").agg(F.sum("n").alias("total"))
        if self.singleton_threshold > 0:
            values = values.filter(F.col("total") / n >= self.singleton_threshold)
        used = c
        if self.pairwise_threshold > 0:
            used = c.withColumn("n", F.when(F.col("n") / F.col("n_c") >= self.pairwise_threshold,
                                            F.col("n")).otherwise(0))
        full = (values.select("attr", "val").withColumn("class_idx", class_index_rows(k))
                .join(used.select("attr", "val", "class_idx", "n"), ["attr", "val", "class_idx"], "left")
                .join(c.select("attr", "val", "class_idx", F.col("n").alias("seen")), ["attr", "val", "class_idx"], "left")
                .fillna(0, ["n", "seen"]))
        sums = full.groupBy("attr", "class_idx").agg(F.sum("n").alias("n_ac"), F.count(F.lit(1)).alias("V")).collect()
        for r in sums:  # attributes x classes
            model.log_unseen.setdefault(r["attr"], [0.0] * k)[r["class_idx"]] = math.log(1.0 / (r["n_ac"] + r["V"]))
        totals = spark.createDataFrame([(r["attr"], r["class_idx"], float(r["n_ac"] + r["V"])) for r in sums],
                                       "attr string, class_idx int, __total double")
        model.large_table = full.join(F.broadcast(totals), ["attr", "class_idx"]).select(
            "attr", "val", "class_idx", F.col("seen").alias("n"),
            F.log((F.col("n") + 1.0) / F.col("__total")).alias("logp")).persist()


def cross_validate(df: DataFrame, target: str, case_id: str, folds: int = 10, num_bins: int = 10,
                   fold_col: str = "fold") -> DataFrame:
    """k-fold cross-validation of Naive Bayes in two aggregate jobs.

    Binning is fitted once on all rows (a fixed preparation step).  Counts
    per (fold, attribute, value, class) come from one ``groupBy``; the model
    for fold f is ``total - counts of f`` (driver-side arithmetic on a table
    of k x attributes x values x classes rows).  Each row is scored by its
    own fold's model inside one projection.  Returns
    (fold, actual, predicted, count).
    """
    from quarry.operators.prep import stratified_folds
    exclude = [case_id, target, fold_col]
    numeric, categorical = attribute_roles(df, exclude)
    data = df.filter(F.col(target).isNotNull())
    if fold_col not in data.columns:
        data = stratified_folds(data, case_id, target, folds, fold_col).persist()
    ranges = {}
    if numeric:
        row = data.agg(*[F.min(F.col(a).cast("double")).alias(f"lo_{i}") for i, a in enumerate(numeric)],
                       *[F.max(F.col(a).cast("double")).alias(f"hi_{i}") for i, a in enumerate(numeric)]
                       ).collect()[0]
        ranges = {a: (row[f"lo_{i}"], row[f"hi_{i}"]) for i, a in enumerate(numeric)}
    attrs = numeric + categorical
    keyed = data.select(F.col(fold_col).alias("__f"), F.col(target).alias("__t"),
                        *_keyed(data, numeric, categorical, ranges, num_bins))
    counts = (keyed.unpivot(["__f", "__t"], attrs, "attr", "val").filter(F.col("val").isNotNull())
              .groupBy("__f", "attr", "val", "__t").agg(F.count(F.lit(1)).alias("n")).collect())
    cls = {(r[0], r[1]): int(r[2]) for r in data.groupBy(fold_col, target).count().collect()}
    classes = sorted({t for _, t in cls})
    fold_ids = sorted({f for f, _ in cls})
    tot: dict = {}
    for f, a, v, t, n in counts:
        tot[(a, v, t)] = tot.get((a, v, t), 0) + int(n)
    own: dict = {}
    for f, a, v, t, n in counts:
        own[(f, a, v, t)] = int(n)
    est = NaiveBayes(target=target, case_id=case_id, num_bins=num_bins)
    models = {}
    for f in fold_ids:
        cc = {c: sum(n for (ff, t), n in cls.items() if t == c and ff != f) for c in classes}
        n_tr = sum(cc.values())
        rows = [(a, v, t, n - own.get((f, a, v, t), 0)) for (a, v, t), n in tot.items()
                if n - own.get((f, a, v, t), 0) > 0]
        m = NaiveBayesModel(name=f"cv{f}", function="CLASSIFICATION", algorithm="ALGO_NAIVE_BAYES",
                            classes=classes, numeric=numeric, categorical=categorical, ranges=ranges,
                            num_bins=num_bins, class_counts=cc,
                            log_prior={c: math.log(cc[c] / n_tr) for c in classes})
        est._fill_inline(m, rows, classes, n_tr, cc)
        models[f] = m
    # each row is scored by its own fold's model: per attribute one lookup in
    # the map literal selected by fold; the argmax of the log scores is the
    # prediction, no normalisation needed
    from quarry.plans.scoring import _argbest
    logs = multi_model_log_scores(models, F.col(fold_col), data)
    scored = data.select(fold_col, F.col(target).alias("actual"), logs.alias("__l"))
    return scored.select(fold_col, "actual", _argbest(F.col("__l"), classes).alias("predicted")) \
        .groupBy(fold_col, "actual", "predicted").agg(F.count(F.lit(1)).alias("count"))


def multi_model_log_scores(models: dict, selector: Column | None, df: DataFrame) -> Column:
    """Log-score array of the model chosen per row by ``selector`` (fold / partition).

    Per attribute: one key expression (shared when every model bins alike),
    one map literal chosen by a CASE on the selector, one lookup; class sums
    are folded with ``zip_with`` so nothing is repeated per class.  Rows whose
    selector matches no model get NULL.
    """
    ms = list(models.items())
    first = ms[0][1]
    classes = first.classes
    k = len(classes)

    def pick(values: list[Column]) -> Column:
        if selector is None or len(values) == 1 and len(ms) == 1:
            return values[0]
        expr = None
        for (key, _), v in zip(ms, values):
            hit = selector == F.lit(key)
            expr = F.when(hit, v) if expr is None else expr.when(hit, v)
        return expr

    total = pick([literal_array([m.log_prior[c] for c in classes]) for _, m in ms])
    zeros = F.array_repeat(F.lit(0.0), k)
    first_keys = first._key_columns(df)
    for a in first.numeric + first.categorical:
        if not any(m.log_cond.get(a) for _, m in ms):
            continue
        same_bins = a not in first.numeric or all(m.ranges.get(a) == first.ranges.get(a) for _, m in ms)
        if same_bins:
            key = first_keys[a]
        else:
            key = pick([m.key_column(df, a) for _, m in ms])
        empty = F.create_map().cast("map<string,array<double>>")
        table = pick([literal_map_of_arrays(m.log_cond[a]) if m.log_cond.get(a) else empty for _, m in ms])
        unseen = pick([literal_array(m.log_unseen[a]) if m.log_cond.get(a) else zeros for _, m in ms])
        term = F.when(key.isNull(), zeros).otherwise(F.coalesce(F.element_at(table, key), unseen))
        total = F.zip_with(total, term, lambda x, y: x + y)
    return total


def cv_accuracy_rollup(cm: DataFrame, fold_col: str = "fold") -> DataFrame:
    """Per-fold accuracy (rounded to 4 places) and, via ROLLUP, the mean of those."""
    per = cm.groupBy(fold_col).agg(
        F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("count")).otherwise(0)).alias("correct"),
        F.sum("count").alias("total"))
    return per.rollup(fold_col).agg(F.avg(F.round(F.col("correct") / F.col("total"), 4)).alias("accuracy"))


def cv_confusion_rollup(cm: DataFrame, fold_col: str = "fold") -> DataFrame:
    """Confusion by fold and rolled up over folds: ROLLUP(actual, predicted, fold)."""
    r = cm.rollup("actual", "predicted", fold_col).agg(F.sum("count").alias("count"))
    return r.filter(F.col("predicted").isNotNull())


@dataclass
class PartitionedModel(MiningModel):
    """One model per value of the partition columns (ODMS_PARTITION_COLUMNS)."""

    partition_col: str = ""
    models: dict = field(default_factory=dict)
    classes: list = field(default_factory=list)

    def partitions_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(str(k), m.class_counts and sum(m.class_counts.values())) for k, m in
                                      sorted(self.models.items(), key=lambda kv: str(kv[0]))],
                                     "partition_name string, num_rows long")

    def partition_name(self) -> Column:
        """ORA_DM_PARTITION_NAME: the partition a row is scored by (NULL if unknown)."""
        known = F.array(*[F.lit(str(k)) for k in self.models])
        v = F.col(self.partition_col).cast("string")
        return F.when(F.array_contains(known, v), v)

    def with_probabilities(self, df: DataFrame, name: str = "__probs") -> DataFrame:
        """Each row's own partition model: one CASE picks the log-score array,
        then a single normalisation (rows of unknown partitions get NULL)."""
        logs = multi_model_log_scores(self.models, F.col(self.partition_col), df)
        x = df.withColumn("__pl", logs)
        n = len(self.classes)
        ls = [F.element_at(F.col("__pl"), i + 1) for i in range(n)]
        mx = F.array_max(F.col("__pl"))
        exps = [F.exp(l - mx) for l in ls]
        tot = exps[0]
        for e in exps[1:]:
            tot = tot + e
        return x.withColumn(name, F.when(F.col("__pl").isNotNull(), F.array(*[e / tot for e in exps]))) \
            .drop("__pl")

    def add_partition(self, df: DataFrame, estimator: "NaiveBayes") -> None:
        """Fit the rows of new partition values; an existing value is an error."""
        fresh = fit_partitioned(df, estimator, self.partition_col)
        clash = set(fresh.models) & set(self.models)
        if clash:
            raise ValueError(f"partition(s) already in the model: {sorted(map(str, clash))}")
        self.models.update(fresh.models)


def fit_partitioned(df: DataFrame, estimator: NaiveBayes, partition_col: str) -> PartitionedModel:
    """Partitioned Naive Bayes: one count aggregate keyed by the partition too.

    Each partition's binning is fitted on its own rows (per-partition prep);
    the per-partition models are assembled on the driver from
    (partition, attribute, value, class) counts - a table bounded by
    partitions x attributes x values x classes.
    """
    target, case_id, bins = estimator.target, estimator.case_id, estimator.num_bins
    exclude = [c for c in (case_id, target, partition_col) if c]
    numeric, categorical = attribute_roles(df, exclude)
    data = df.filter(F.col(target).isNotNull() & F.col(partition_col).isNotNull())
    rng = data.groupBy(partition_col).agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.min(F.col(a).cast("double")).alias(f"lo_{i}") for i, a in enumerate(numeric)],
        *[F.max(F.col(a).cast("double")).alias(f"hi_{i}") for i, a in enumerate(numeric)]).collect()
    ranges = {r[partition_col]: {a: (r[f"lo_{i}"], r[f"hi_{i}"]) for i, a in enumerate(numeric)} for r in rng}
    parts = sorted(ranges)
    # bin ids per partition: a CASE over partitions (partition count is bounded by the model)
    cols = []
    for a in numeric:  # (no numeric attributes: no bins)
        expr = None
        for pv in parts:
            lo, hi = ranges[pv][a]
            b = equi_width_bin(a, lo, hi, bins).cast("string")
            hit = F.col(partition_col) == F.lit(pv)
            expr = F.when(hit, b) if expr is None else expr.when(hit, b)
        cols.append(expr.alias(a))
    cols += [F.col(a).cast("string").alias(a) for a in categorical]
    keyed = data.select(F.col(partition_col).alias("__p"), F.col(target).alias("__t"), *cols)
    counts = (keyed.unpivot(["__p", "__t"], numeric + categorical, "attr", "val")
              .filter(F.col("val").isNotNull())
              .groupBy("__p", "attr", "val", "__t").agg(F.count(F.lit(1)).alias("n")).collect())
    cls = {(r[0], r[1]): int(r[2]) for r in data.groupBy(partition_col, target).count().collect()}
    classes = sorted({t for _, t in cls})
    out = PartitionedModel(name=estimator.name, function="CLASSIFICATION", algorithm="ALGO_NAIVE_BAYES",
                           partition_col=partition_col, classes=classes,
                           settings={"ODMS_PARTITION_COLUMNS": partition_col})
    for pv in parts:
        cc = {c: cls.get((pv, c), 0) for c in classes}
        n = sum(cc.values())
        present = [c for c in classes if cc[c] > 0]
        if estimator.priors:
            tot = sum(estimator.priors.get(c, 0.0) for c in classes)
            lp = {c: math.log(estimator.priors[c] / tot) for c in classes}
        else:
            lp = {c: (math.log(cc[c] / n) if cc[c] > 0 else -1e9) for c in classes}
        m = NaiveBayesModel(name=f"{estimator.name}:{pv}", function="CLASSIFICATION",
                            algorithm="ALGO_NAIVE_BAYES", classes=classes, numeric=numeric,
                            categorical=categorical, ranges=ranges[pv], num_bins=bins,
                            class_counts=cc, log_prior=lp)
        rows = [(a, v, t, k) for (p_, a, v, t, k) in counts if p_ == pv]
        estimator._fill_inline(m, rows, classes, n, {c: max(cc[c], 1) for c in classes})
        del present
        out.models[pv] = m
    return out
