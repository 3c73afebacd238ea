"""Model evaluation over apply-shaped tables.

Inputs are plain DataFrames, so any scorer's output works:

* a long *apply table* ``(case_id, prediction, probability)`` with one row
  per (case, class) - as written by APPLY or by another tool;
* a *scored table* ``(prob, pos)``: probability of the positive class and
  a 0/1 hit flag.

Global-order metrics (lift, ROC, AUC) first reduce the rows to one row per
distinct probability, then use :func:`quarry.operators.scan.prefix_sums`
so no step funnels all rows through one task.  Only tables whose size is
bounded by the number of quantiles / classes are ever windowed globally.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.scalar import decode_flag, null_safe_eq, with_totals
from quarry.operators.scan import prefix_sums


# --------------------------------------------------------------------------
# predictions from an apply table
# --------------------------------------------------------------------------
def _cost_classes(cost_rows) -> list:
    return sorted({r[1] for r in cost_rows})


def top_prediction(apply_df: DataFrame, case_id: str, score_col: str = "prediction",
                   criterion_col: str = "probability", cost_rows=None) -> DataFrame:
    """(case_id, prediction): most probable class, or least expected cost.

    Without costs: max probability, ties to the smallest class.  With a cost
    matrix ``[(actual, predicted, cost)]`` (k x k rows, collected - bounded by
    the class count) each predicted class p gets sum_a P(a) * cost(a, p) as a
    conditional sum in a single ``groupBy(case)``.
    """
    if not cost_rows:
        best = apply_df.groupBy(case_id).agg(
            F.min(F.struct((-F.col(criterion_col)).alias("k"), F.col(score_col).alias("p"))).alias("b"))
        return best.select(case_id, F.col("b.p").alias("prediction"))
    preds = _cost_classes(cost_rows)
    sums = []
    for i, p in enumerate(preds):
        expr = None
        for a, pp, c in cost_rows:
            if pp != p:
                continue
            term = F.when(F.col(score_col) == F.lit(a), F.col(criterion_col) * F.lit(float(c)))
            expr = term if expr is None else F.coalesce(expr, term)
        sums.append(F.sum(F.coalesce(expr, F.lit(0.0))).alias(f"__c{i}"))
    agg = apply_df.groupBy(case_id).agg(*sums)
    cells = [F.struct(F.col(f"__c{i}").alias("c"), F.lit(i).alias("i")) for i in range(len(preds))]
    best = F.least(*cells) if len(cells) > 1 else cells[0]
    pick = None
    for i, p in reversed(list(enumerate(preds))):
        hit = best["i"] == i
        pick = F.when(hit, F.lit(p)) if pick is None else F.when(hit, F.lit(p)).otherwise(pick)
    return agg.select(case_id, pick.alias("prediction"))


def confusion_matrix(apply_df: DataFrame, targets_df: DataFrame, case_id: str, target: str,
                     score_col: str = "prediction", criterion_col: str = "probability",
                     cost_rows=None) -> DataFrame:
    """COMPUTE_CONFUSION_MATRIX: (actual_target_value, predicted_target_value, value)."""
    preds = top_prediction(apply_df, case_id, score_col, criterion_col, cost_rows)
    return confusion_from_pairs(targets_df.join(preds, case_id), target, "prediction")


def confusion_from_pairs(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Confusion matrix (SQL form): groupBy(actual, predicted).count."""
    return df.groupBy(F.col(actual).alias("actual_target_value"),
                      F.col(predicted).alias("predicted_target_value")) \
        .agg(F.count(F.lit(1)).alias("value"))


def accuracy_from_confusion(cm: DataFrame) -> DataFrame:
    """Accuracy = matching cells / all cells (NULL-safe equality)."""
    return cm.agg((F.sum(F.when(null_safe_eq("actual_target_value", "predicted_target_value"),
                                F.col("value")).otherwise(0)) / F.sum("value")).alias("accuracy"))


def accuracy(df: DataFrame, actual: str, predicted: str, by: list[str] | None = None) -> DataFrame:
    """avg(DECODE(actual, predicted, 1, 0)), optionally per segment."""
    acc = F.avg(decode_flag(actual, predicted)).alias("accuracy")
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), acc) if by else df.agg(acc)


# --------------------------------------------------------------------------
# ranking metrics over (prob, pos)
# --------------------------------------------------------------------------
def scored_table(df: DataFrame, prob: Column, actual, positive) -> DataFrame:
    """(prob, pos) with pos = DECODE(actual, positive, 1, 0)."""
    return df.select(prob.cast("double").alias("prob"),
                     decode_flag(actual, F.lit(positive)).alias("pos"))


def _by_prob(scored: DataFrame) -> DataFrame:
    return scored.groupBy("prob").agg(F.count(F.lit(1)).alias("n"), F.sum("pos").alias("npos")) \
        .withColumn("nneg", F.col("n") - F.col("npos"))


def _totals(grouped: DataFrame) -> DataFrame:
    return grouped.agg(F.sum("n").alias("tot_n"), F.sum("npos").alias("tot_pos"),
                       F.sum("nneg").alias("tot_neg"))


def roc(scored: DataFrame) -> DataFrame:
    """COMPUTE_ROC table: one row per distinct threshold p, counting score >= p.

    A fraction of a class without rows is NULL.
    """
    g = _by_prob(scored)
    cum = prefix_sums(g, "prob", ["npos", "nneg"], ascending=False)
    return with_totals(cum, _totals(g)).select(
        F.col("prob").alias("probability"),
        F.col("cum_npos").alias("true_positives"),
        (F.col("tot_pos") - F.col("cum_npos")).alias("false_negatives"),
        F.col("cum_nneg").alias("false_positives"),
        (F.col("tot_neg") - F.col("cum_nneg")).alias("true_negatives"),
        F.try_divide("cum_npos", "tot_pos").alias("true_positive_fraction"),
        F.try_divide("cum_nneg", "tot_neg").alias("false_positive_fraction"),
    )


def roc_corners(scored: DataFrame) -> DataFrame:
    """ROC corner points: tpf switch points plus the top-right point, one per fpf."""
    g = _by_prob(scored)
    cum = with_totals(prefix_sums(g, "prob", ["npos", "nneg"], ascending=False), _totals(g))
    kept = cum.filter((F.col("npos") > 0) | ((F.col("cum_npos") == F.col("tot_pos")) &
                                              (F.col("cum_nneg") == F.col("tot_neg"))))
    c = kept.groupBy("cum_nneg").agg(F.min("prob").alias("prob"), F.max("cum_npos").alias("cum_npos"),
                                     F.max("tot_pos").alias("tot_pos"), F.max("tot_neg").alias("tot_neg"))
    return c.select(
        "prob",
        F.try_divide("cum_npos", "tot_pos").alias("tpf"),
        F.try_divide("cum_nneg", "tot_neg").alias("fpf"),
        F.col("cum_npos").alias("tp"),
        (F.col("tot_pos") - F.col("cum_npos")).alias("fn"),
        F.col("cum_nneg").alias("fp"),
        (F.col("tot_neg") - F.col("cum_nneg")).alias("tn"))


def auc(scored: DataFrame) -> DataFrame:
    """Area under the ROC curve: how often a positive scores above a negative, a tie counting half.

    For every distinct threshold its negatives lose against all positives above it and against
    half of the positives at it.  NULL if one class has no rows.
    """
    g = _by_prob(scored)
    cum = with_totals(prefix_sums(g, "prob", ["npos"], ascending=False), _totals(g))
    wins = F.sum(F.col("nneg") * (F.col("cum_npos") - F.col("npos") / 2))
    return cum.agg(F.try_divide(wins, F.max("tot_pos").cast("double") * F.max("tot_neg")).alias("auc"))


def lift(scored: DataFrame, num_quantiles: int = 10) -> DataFrame:
    """COMPUTE_LIFT with NTILE quantiles and tie smearing.

    Rows are ranked by probability descending into ``num_quantiles`` NTILE
    buckets; hits of tied rows are averaged over the tie group, so the
    result does not depend on how ties are ordered.  Computed on distinct
    probabilities: each tie group covers row positions [start, end] and
    contributes its overlap with every NTILE bucket it spans.
    """
    q = num_quantiles
    g = _by_prob(scored)
    cum = with_totals(prefix_sums(g, "prob", ["n"], ascending=False), _totals(g))
    N = F.col("tot_n")
    base = F.floor(N / q)            # rows per bucket
    rem = N - base * q               # first ``rem`` buckets get one extra row
    big = rem * (base + 1)

    def bucket_of(i: Column) -> Column:  # NTILE bucket of 1-based row i
        return F.when(base == 0, i).when(i <= big, F.ceil(i / (base + 1))) \
            .otherwise(rem + F.ceil((i - big) / base))

    start = F.col("cum_n") - F.col("n") + 1
    end = F.col("cum_n")
    spans = cum.select("prob", "n", "npos", "tot_n", "tot_pos", start.alias("s"), end.alias("e"),
                       F.explode(F.sequence(bucket_of(start), bucket_of(end))).alias("b"),
                       base.alias("base"), rem.alias("rem"), big.alias("big"))
    lo = F.when(F.col("b") <= F.col("rem"), (F.col("b") - 1) * (F.col("base") + 1) + 1) \
        .otherwise(F.col("big") + (F.col("b") - 1 - F.col("rem")) * F.col("base") + 1)
    size = F.when(F.col("b") <= F.col("rem"), F.col("base") + 1).otherwise(F.col("base"))
    hi = lo + size - 1
    overlap = F.least(F.col("e"), hi) - F.greatest(F.col("s"), lo) + 1
    per_bucket = spans.withColumn("rows", overlap).groupBy("b").agg(
        F.min("prob").alias("probability_threshold"),
        F.sum("rows").alias("quantile_total_count"),
        F.sum(F.col("rows") * F.col("npos") / F.col("n")).alias("quantile_targets"),
        F.max("tot_n").alias("tot_n"), F.max("tot_pos").alias("tot_pos"))
    # at most ``num_quantiles`` rows: a global window is fine here
    w = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
    r = per_bucket.select(
        "*", F.sum("quantile_total_count").over(w).alias("records_cumulative"),
        F.sum("quantile_targets").over(w).alias("targets_cumulative"))
    return r.select(
        F.col("b").cast("int").alias("quantile_number"),
        "probability_threshold",
        F.col("quantile_total_count").cast("long").alias("quantile_total_count"),
        "quantile_targets",
        "targets_cumulative",
        (F.col("records_cumulative") - F.col("targets_cumulative")).alias("non_targets_cumulative"),
        (F.col("records_cumulative") / F.col("tot_n")).alias("percentage_records_cumulative"),
        F.try_divide("targets_cumulative", "tot_pos").alias("gain_cumulative"),
        (F.try_divide("targets_cumulative", "tot_pos") /
         (F.col("records_cumulative") / F.col("tot_n"))).alias("lift_cumulative"),
        (F.try_divide("quantile_targets", "tot_pos") /
         (F.col("quantile_total_count") / F.col("tot_n"))).alias("lift_quantile"),
        (F.col("targets_cumulative") / F.col("records_cumulative")).alias("target_density_cumulative"),
        (F.col("quantile_targets") / F.col("quantile_total_count")).alias("target_density"),
    )


# --------------------------------------------------------------------------
# costs
# --------------------------------------------------------------------------
def threshold_costs(roc_df: DataFrame, fp_cost: float, fn_cost: float) -> DataFrame:
    """Cost of acting at each ROC threshold: fp_cost * FP + fn_cost * FN."""
    return roc_df.withColumn("cost", F.lit(fp_cost) * F.col("false_positives") +
                             F.lit(fn_cost) * F.col("false_negatives"))


def cost_matrix_from_threshold(roc_df: DataFrame, fp_cost: float, fn_cost: float,
                               positive=1, negative=0) -> DataFrame:
    """Break-even cost matrix from the minimum-cost threshold p: cost(1->0) = (1-p)/p.

    p is the smallest probability among thresholds of minimum cost.  At p = 0 the cost is NULL.
    """
    c = threshold_costs(roc_df, fp_cost, fn_cost)
    best = c.agg(F.min(F.struct("cost", "probability")).alias("m")).select(F.col("m.probability").alias("p"))
    best = best.select(F.try_divide(1.0 - F.col("p"), F.col("p")).alias("c10"))

    def cell(a, p, c):
        return F.struct(F.lit(a).alias("actual_target_value"), F.lit(p).alias("predicted_target_value"),
                        c.cast("double").alias("cost"))

    return best.select(F.inline(F.array(
        cell(positive, negative, F.col("c10")), cell(negative, positive, F.lit(1.0)),
        cell(negative, negative, F.lit(0.0)), cell(positive, positive, F.lit(0.0)))))


def rank_apply(apply_df: DataFrame, case_id: str, score_col: str, criterion_col: str,
               top_n: int, cost_rows=None) -> DataFrame:
    """RANK_APPLY: per case, classes ranked 1..top_n.

    With a cost matrix the rank is by expected cost ascending (rank 1 =
    cheapest action), else by probability descending; ties by class.  The
    per-case window holds at most k rows (k = number of classes).
    """
    df = apply_df
    if cost_rows:
        preds = _cost_classes(cost_rows)
        per_case = apply_df.groupBy(case_id).agg(
            F.map_from_entries(F.collect_list(F.struct(score_col, criterion_col))).alias("__pm"))
        exploded = per_case.select(case_id, "__pm", F.explode(F.array(*[F.lit(p) for p in preds])).alias(score_col))
        cost_expr = F.lit(0.0)
        for p in reversed(preds):
            s_p = F.lit(0.0)
            for a, pp, c in cost_rows:
                if pp == p:
                    s_p = s_p + F.coalesce(F.element_at(F.col("__pm"), F.lit(a)), F.lit(0.0)) * F.lit(float(c))
            cost_expr = F.when(F.col(score_col) == F.lit(p), s_p).otherwise(cost_expr)
        df = exploded.select(case_id, score_col,
                             F.element_at(F.col("__pm"), F.col(score_col)).alias(criterion_col),
                             cost_expr.alias("cost"))
        order = [F.col("cost").asc(), F.col(criterion_col).desc(), F.col(score_col).asc()]
    else:
        order = [F.col(criterion_col).desc(), F.col(score_col).asc()]
    w = Window.partitionBy(case_id).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top_n)


# --------------------------------------------------------------------------
# regression
# --------------------------------------------------------------------------
def regression_errors(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """RMSE = sqrt(avg(e^2)) (divisor n) and MAE = avg(|e|)."""
    e = F.col(predicted) - F.col(actual)
    return df.agg(F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"))


def mape(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Mean absolute percentage error; an actual of 0 divides by 1 instead."""
    a = F.col(actual)
    den = F.when(a == 0, F.lit(1.0)).otherwise(a)
    return df.agg(F.avg(F.abs((F.col(predicted) - a) / den)).alias("mape"))
