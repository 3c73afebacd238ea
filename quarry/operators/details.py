"""PREDICTION_DETAILS for any model: leave-one-attribute-out weights, and the path of a tree.

An attribute's weight is what the score loses without it: the score of the row against the score of
the same row with the attribute blank.  The copies are scored as projections one after the other, so
rows are neither multiplied nor shuffled; the plan grows with the number of attributes.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.scalar import _sql_double, _sql_str
from quarry.operators.ml import SparkMLModel, feature_names
from quarry.plans import scoring

HOW = ("difference", "ratio")


def class_score(model, cls) -> Callable[[DataFrame, str], DataFrame]:
    """Scores a frame with a classifier's probability of ``cls``, for :func:`leave_one_out`."""
    place = model.classes.index(cls)

    def score(df: DataFrame, name: str) -> DataFrame:
        probs = f"{name}_p"
        return scoring.with_probabilities(df, model, probs).withColumn(name, F.col(probs)[place]).drop(probs)

    return score


def value_score(model: SparkMLModel) -> Callable[[DataFrame, str], DataFrame]:
    """Scores a frame with a regressor's prediction, for :func:`leave_one_out`."""
    def score(df: DataFrame, name: str) -> DataFrame:
        return model.transform(df).select(*df.columns, F.col("prediction").alias(name))

    return score


def details_array(items: list[tuple[str, Column, Column]], top_n: int | None = None, by_abs: bool = True) -> Column:
    """array<struct<attribute_name, attribute_value, weight, rank>> of (name, value, weight) items.

    Largest weight first (by size with ``by_abs``), NULL and NaN weights last, ties by name.
    """
    known = [F.struct(F.lit(a).alias("attribute_name"), v.cast("string").alias("attribute_value"),
                      F.nanvl(w, F.lit(None).cast("double")).alias("weight")) for a, v, w in items]

    def size(x: Column) -> Column:
        return F.coalesce(F.abs(x["weight"]) if by_abs else x["weight"], F.lit(float("-inf")))

    ordered = F.array_sort(F.array(*known), lambda x, y: F.when(size(x) > size(y), -1).when(size(x) < size(y), 1)
                           .when(x["attribute_name"] < y["attribute_name"], -1).otherwise(1))
    top = ordered if top_n is None else F.slice(ordered, 1, top_n)
    return F.transform(top, lambda e, i: F.struct(e["attribute_name"].alias("attribute_name"),
                                                  e["attribute_value"].alias("attribute_value"),
                                                  e["weight"].alias("weight"), (i + 1).alias("rank")))


def leave_one_out(df: DataFrame, score: Callable[[DataFrame, str], DataFrame], attributes: list[str], top_n: int | None = None,
                  how: str = "difference", blanks: dict | None = None, by_abs: bool = True, name: str = "details") -> DataFrame:
    """``df`` with column ``name``: the weights of ``attributes`` in every row's score, as in :func:`details_array`.

    ``score(frame, column)`` adds a double column to a frame and keeps the others.  A blank attribute is
    NULL, or the value named in ``blanks``.  ``how`` is ``difference`` (score less the score without) or
    ``ratio`` (score over the score without; NULL where that is 0).  A NULL attribute has difference 0.
    """
    if how not in HOW:
        raise ValueError(f"how must be one of {HOW}")
    if name in df.columns:
        raise ValueError(f"the frame already has a column {name}")
    types = dict(df.dtypes)
    unknown = [a for a in attributes if a not in types]
    if unknown:
        raise ValueError(f"no attributes {unknown}")
    tag = f"__loo{uuid.uuid4().hex[:8]}"
    full, held = f"{tag}_full", f"{tag}_held"
    out = score(df, full)
    for i, a in enumerate(attributes):
        blank = F.lit((blanks or {}).get(a)).cast(types[a])
        masked = out.withColumns({held: F.col(a), a: blank})
        out = score(masked, f"{tag}_{i}").drop(a).withColumnRenamed(held, a)

    def weight(i: int) -> Column:
        without = F.col(f"{tag}_{i}")
        return F.col(full) - without if how == "difference" else F.when(without != 0, F.col(full) / without)

    items = [(a, F.col(a), weight(i)) for i, a in enumerate(attributes)]
    return out.select(*df.columns, details_array(items, top_n, by_abs).alias(name))


# ---------------------------------------------------------------- tree paths
def tree_leaves(model: SparkMLModel) -> list[dict]:
    """The leaves of a fitted tree in preorder: node id (preorder from 1), prediction, training rows, share
    of the predicted class (None for a regression) and the path as (attribute, operator, value) tests.

    Bounds of one attribute are merged, and ``=`` replaces what other levels were ruled out before.
    """
    est = model.pipeline.stages[-1]
    names = feature_names(model.pipeline, model.numeric, model.categorical)
    leaves, nodes = [], 0
    stack = [(est._java_obj.rootNode(), [])]
    while stack:
        node, path = stack.pop()
        nodes += 1
        if node.getClass().getSimpleName() != "InternalNode":
            stats = node.impurityStats()
            total = float(stats.count())
            value, share = float(node.prediction()), None
            if model.classes:
                share = max(list(stats.stats())) / total if total else None
                value = model.classes[int(value)]
            leaves.append({"node_id": nodes, "prediction": value, "support": int(total), "confidence": share,
                           "rule": _merged(path)})
            continue
        split = node.split()
        attribute, level = names[int(split.featureIndex())]
        if split.getClass().getSimpleName() == "ContinuousSplit":
            bound = float(split.threshold())
            sides = [(attribute, "<=", bound), (attribute, ">", bound)] if level is None else [
                (attribute, "<>", level), (attribute, "=", level)]  # a slot of 0 or 1
        else:
            hit = 1.0 in list(split.leftCategories())
            sides = [(attribute, "=" if hit else "<>", level), (attribute, "<>" if hit else "=", level)]
        stack.append((node.rightChild(), path + [sides[1]]))
        stack.append((node.leftChild(), path + [sides[0]]))
    return leaves


def _merged(path: list[tuple]) -> list[tuple]:
    out: dict = {}
    for attribute, op, value in path:
        tests = out.setdefault(attribute, {})
        if op == "<=":
            tests[op] = min(value, tests.get(op, value))
        elif op == ">":
            tests[op] = max(value, tests.get(op, value))
        elif op == "=":
            out[attribute] = {op: value}
        elif "=" not in tests:
            tests[op, value] = value
    return [(a, op if isinstance(op, str) else op[0], v) for a, tests in out.items() for op, v in tests.items()]


def rule_text(rule: list[tuple]) -> str:
    """The tests as one SQL condition; an empty path is ``TRUE``."""
    def quoted(v):
        return repr(v) if isinstance(v, float) else "'" + str(v).replace("'", "''") + "'"

    return " AND ".join(f"{a} {op} {quoted(v)}" for a, op, v in rule) or "TRUE"


def tree_details(df: DataFrame, model: SparkMLModel, name: str = "details") -> DataFrame:
    """``df`` with column ``name``: the leaf each row falls into.

    struct<node_id, prediction, support, confidence, rule>; ``rule`` is the path as an SQL condition.  A
    missing number takes the training mean and a missing level no level (``=`` fails, ``<>`` holds), as
    in the build.  The leaves are a literal of the plan (2^depth of them), found by the tree's own index.
    """
    if name in df.columns:
        raise ValueError(f"the frame already has a column {name}")
    est = model.pipeline.stages[-1]
    leaf = f"__leaf{uuid.uuid4().hex[:8]}"
    est.setLeafCol(leaf)
    try:
        found = model.transform(df)
    finally:
        est.setLeafCol("")
    rows = [f"named_struct('node_id', {v['node_id']}, 'prediction', {_sql_str(v['prediction'])}, "
            f"'support', {v['support']}L, 'confidence', "
            f"{'CAST(NULL AS DOUBLE)' if v['confidence'] is None else _sql_double(v['confidence'])}, "
            f"'rule', {_sql_str(rule_text(v['rule']))})" for v in tree_leaves(model)]
    table = F.expr(f"array({', '.join(rows)})")
    return found.select(*df.columns, F.element_at(table, F.col(leaf).cast("int") + 1).alias(name))
