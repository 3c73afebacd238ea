"""Scoring functions over classifier models (the SQL surface as columns).

Any classifier exposes ``classes`` (a Python list) and
``probability_columns(df)`` - one Column per class with P(class | row).
From those the functions below build PREDICTION, PREDICTION_PROBABILITY,
PREDICTION_SET, PREDICTION_COST and cost-aware PREDICTION as *native column
expressions*: scoring a table is a projection, no shuffle, and stays
inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PROBS = "__probs"


def with_probabilities(df: DataFrame, model, name: str = PROBS) -> DataFrame:
    """Add an array<double> column of class probabilities (model.classes order).

    Closed-form models give column expressions (a projection); Spark ML
    models run their fitted pipeline (``model.with_probabilities``).
    """
    if hasattr(model, "with_probabilities"):
        return model.with_probabilities(df, name)
    return df.withColumn(name, F.array(*model.probability_columns(df)))


def _argbest(values: Column, classes: list, maximize: bool = True) -> Column:
    """Class of the best array element; ties go to the earlier class."""
    best = F.array_max(values) if maximize else F.array_min(values)
    expr = None
    for i in reversed(range(len(classes))):
        hit = F.element_at(values, i + 1) == best
        expr = F.when(hit, F.lit(classes[i])) if expr is None else F.when(hit, F.lit(classes[i])).otherwise(expr)
    return expr


def prediction(model, probs: str = PROBS) -> Column:
    """PREDICTION(model USING *): most probable class."""
    return _argbest(F.col(probs), model.classes, maximize=True)


def prediction_probability(model, cls=None, probs: str = PROBS) -> Column:
    """PREDICTION_PROBABILITY(model[, class]): of ``cls``, or of the prediction."""
    if cls is None:
        return F.array_max(F.col(probs))
    return F.element_at(F.col(probs), model.classes.index(cls) + 1)


def expected_costs(model, cost_matrix: dict, probs: str = PROBS) -> Column:
    """array of sum_a P(a) * cost(a, p) for each predicted class p."""
    out = []
    for p in model.classes:
        terms = [F.element_at(F.col(probs), i + 1) * F.lit(float(cost_matrix.get((a, p), 0.0)))
                 for i, a in enumerate(model.classes)]
        s = terms[0]
        for t in terms[1:]:
            s = s + t
        out.append(s)
    return F.array(*out)


def prediction_with_cost(model, cost_matrix: dict, probs: str = PROBS) -> Column:
    """PREDICTION(model COST MODEL USING *): class of minimum expected cost."""
    return _argbest(expected_costs(model, cost_matrix, probs), model.classes, maximize=False)


def prediction_cost(model, cost_matrix: dict, cls, probs: str = PROBS) -> Column:
    """PREDICTION_COST(model, class COST MODEL)."""
    return F.element_at(expected_costs(model, cost_matrix, probs), model.classes.index(cls) + 1)


def prediction_set(model, probs: str = PROBS, cost_matrix: dict | None = None) -> Column:
    """PREDICTION_SET: array<struct<prediction, probability[, cost]>> sorted by probability desc."""
    fields = []
    costs = expected_costs(model, cost_matrix, probs) if cost_matrix else None
    for i, c in enumerate(model.classes):
        parts = [F.lit(c).alias("prediction"), F.element_at(F.col(probs), i + 1).alias("probability")]
        if costs is not None:
            parts.append(F.element_at(costs, i + 1).alias("cost"))
        fields.append(F.struct(*parts))
    return F.array_sort(
        F.array(*fields),
        lambda a, b: F.when(a["probability"] > b["probability"], -1)
        .when(a["probability"] < b["probability"], 1).otherwise(0))


def cost_matrix_from_rows(rows) -> dict:
    """{(actual, predicted): cost} from (actual, predicted, cost) rows."""
    return {(r[0], r[1]): float(r[2]) for r in rows}


def apply(df: DataFrame, model, case_id: str) -> DataFrame:
    """Batch APPLY: one row per (case, class) with the class probability."""
    scored = with_probabilities(df.select(*df.columns), model)
    return scored.select(
        case_id,
        F.inline(F.arrays_zip(F.array(*[F.lit(c) for c in model.classes]).alias("prediction"),
                              F.col(PROBS).alias("probability"))),
    )
