"""User-defined algorithms (the reference registers R build/score/details
functions; here they are Python callables).

A user algorithm is written in *sufficient-statistics* form so Spark can
distribute it whatever the data size:

* ``partial(pdf, params) -> {name: np.ndarray}``: statistics of one Arrow
  batch (runs inside ``mapInPandas`` tasks);
* ``finalize(stats, params) -> model``: the summed statistics -> a small model
  (runs on the driver, once per partition key);
* ``score(model, pdf, params) -> pd.DataFrame``: vectorised scoring of a batch
  (``mapInPandas`` with the models shipped in the task closure);
* ``details(model, params) -> pd.DataFrame`` (optional): the model view,
  with a declared output schema;
* ``weights(model, pdf, params, column) -> pd.DataFrame`` (optional): the weight of every attribute in
  score ``column`` of each row, one column per entry of ``attributes``; it feeds prediction details.
  :func:`left_out_weights` makes one of any score function.

Partitioned builds (one model per partition value) add the partition key to
the statistics ``groupBy``; no group of rows is ever gathered in one task.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.plans.model import MiningModel


@dataclass
class UserAlgorithm:
    name: str
    partial: Callable
    finalize: Callable
    score: Callable
    score_schema: str
    details: Callable | None = None
    details_schema: str | None = None
    settings_schema: dict = field(default_factory=dict)  # setting -> (type, default, (lo, hi) or None)
    weights: Callable | None = None
    attributes: list = field(default_factory=list)  # the columns of ``weights``

    def validate(self, params: dict) -> dict:
        out = {}
        for k, (typ, default, bounds) in self.settings_schema.items():
            v = typ(params.get(k, default))
            if bounds is not None and not (bounds[0] <= v <= bounds[1]):
                raise ValueError(f"{self.name}: setting {k}={v} outside {bounds}")
            out[k] = v
        unknown = set(params) - set(self.settings_schema)
        if unknown:
            raise ValueError(f"{self.name}: unknown settings {sorted(unknown)}")
        return out


class AlgorithmRegistry:
    """Register / look up / drop user algorithms by name."""

    def __init__(self):
        self._algos: dict[str, UserAlgorithm] = {}

    def register(self, algo: UserAlgorithm, replace: bool = False) -> None:
        if algo.name in self._algos and not replace:
            raise ValueError(f"algorithm {algo.name} already registered")
        self._algos[algo.name] = algo

    def get(self, name: str) -> UserAlgorithm:
        return self._algos[name]

    def drop(self, name: str) -> None:
        self._algos.pop(name, None)

    def names(self) -> list[str]:
        return sorted(self._algos)


REGISTRY = AlgorithmRegistry()


@dataclass
class UserModel(MiningModel):
    algo: UserAlgorithm | None = None
    params: dict = field(default_factory=dict)
    partition_col: str | None = None
    models: dict = field(default_factory=dict)  # partition value as text (or None) -> model

    def apply(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """Score with the user's function; ``keep`` columns are carried through.

        A row whose partition has no model keeps its place and gets NULL scores.
        """
        algo, params = self.algo, self.params
        return self._batches(df, keep, algo.score_schema, lambda model, pdf: algo.score(model, pdf, params))

    def _batches(self, df: DataFrame, keep: list[str], added: str, call: Callable) -> DataFrame:
        """``keep`` and the columns ``added`` that ``call(model, pdf)`` makes with each row's own model."""
        models, pcol = self.models, self.partition_col
        names = [x.split()[0].strip("`") for x in added.split(",")]

        def run(batches):
            for pdf in batches:
                if pcol is None:
                    out = call(models[None], pdf)
                    yield pd.concat([pdf[keep].reset_index(drop=True), out.reset_index(drop=True)], axis=1)
                    continue
                for key, part in pdf.groupby("__key", sort=False, dropna=False):
                    kept = part[keep].reset_index(drop=True)
                    model = models.get(key if isinstance(key, str) else None)
                    if model is None:
                        yield kept.reindex(columns=[*keep, *names])  # scores are NULL
                        continue
                    yield pd.concat([kept, call(model, part).reset_index(drop=True)], axis=1)

        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema.fields)
        if pcol is not None:  # the key as text, as in the build, whatever its type
            df = df.withColumn("__key", F.col(pcol).cast("string"))
        return df.mapInPandas(run, f"{schema}, {added}")

    def weights(self, df: DataFrame, keep: list[str], column: str) -> DataFrame:
        """``keep`` and one double ``weight_<attribute>`` per attribute: its weight in score ``column``.

        One pass of the user's weight function over the batches; a weight that is not finite is NULL.
        """
        algo, params = self.algo, self.params
        if algo.weights is None:
            raise ValueError(f"{algo.name} has no weight function")
        names = [f"weight_{a}" for a in algo.attributes]

        def call(model, pdf):
            out = algo.weights(model, pdf, params, column)[algo.attributes].astype(float)
            return out.replace([np.inf, -np.inf], np.nan).set_axis(names, axis=1)

        return self._batches(df, keep, ", ".join(f"`{n}` double" for n in names), call)

    def prediction_details(self, df: DataFrame, keep: list[str], column: str, top_n: int = 5, name: str = "details") -> DataFrame:
        """``keep`` and ``name``: the top attributes of each row by the user's weights, largest first.

        array<struct<attribute_name, attribute_value, weight, rank>>; NULL weights come last.
        """
        from quarry.operators.details import details_array
        held = list(dict.fromkeys([*keep, *self.algo.attributes]))
        w = self.weights(df, held, column)
        items = [(a, F.col(a), F.col(f"weight_{a}")) for a in self.algo.attributes]
        return w.select(*keep, details_array(items, top_n, by_abs=False).alias(name))

    def details_df(self):
        from pyspark.sql import SparkSession
        spark = SparkSession.getActiveSession()
        frames = []
        for key, m in self.models.items():
            d = self.algo.details(m, self.params)
            if self.partition_col is not None:
                d.insert(0, "partition_name", str(key))
            frames.append(d)
        pdf = pd.concat(frames, ignore_index=True)
        schema = self.algo.details_schema
        if self.partition_col is not None:
            schema = "partition_name string, " + schema
        return spark.createDataFrame(pdf, schema)


def fit_user_model(df: DataFrame, algo: UserAlgorithm, params: dict | None = None,
                   partition_col: str | None = None, name: str = "user_model") -> UserModel:
    """Distributed build: per-batch statistics -> element-wise sums per key -> finalize."""
    params = algo.validate(params or {})
    pcol = partition_col

    def stats(batches):
        for pdf in batches:
            groups = [(None, pdf)] if pcol is None else list(pdf.groupby("__key", sort=False))
            rows = []
            for key, part in groups:
                for stat, arr in algo.partial(part, params).items():
                    a = np.asarray(arr, dtype=float)
                    rows.append((None if key is None else str(key), stat, list(a.shape),
                                 a.ravel().tolist()))
            yield pd.DataFrame(rows, columns=["pkey", "stat", "shape", "vals"])

    data = df if pcol is None else df.filter(F.col(pcol).isNotNull()).withColumn("__key", F.col(pcol).cast("string"))
    partial = data.mapInPandas(stats, "pkey string, stat string, shape array<int>, vals array<double>")
    # element-wise sum: explode positions (size = statistic length, fixed by the algorithm)
    summed = (partial.select("pkey", "stat", "shape", F.posexplode("vals").alias("pos", "v"))
              .groupBy("pkey", "stat", "pos").agg(F.sum("v").alias("v"), F.first("shape").alias("shape"))
              .collect())
    by_key: dict = {}
    for r in summed:
        d = by_key.setdefault(r["pkey"], {}).setdefault(r["stat"], {"shape": r["shape"], "v": {}})
        d["v"][r["pos"]] = r["v"]
    models = {}
    for key, st in by_key.items():
        arrays = {}
        for stat, d in st.items():
            size = int(np.prod(d["shape"])) if d["shape"] else 1
            flat = np.array([d["v"].get(i, 0.0) for i in range(size)])
            arrays[stat] = flat.reshape(d["shape"]) if d["shape"] else flat[0]
        models[key] = algo.finalize(arrays, params)
    return UserModel(name=name, function="REGRESSION", algorithm=f"ALGO_EXTENSIBLE:{algo.name}",
                     algo=algo, params=params, partition_col=pcol, models=models,
                     settings={"ALGO_EXTENSIBLE_LANG": "Python", **params})


def left_out_weights(score: Callable, attributes: list[str]) -> Callable:
    """A weight function: the score over the score with the attribute left out (0 for numbers, else missing)."""
    def weights(model, pdf, params, column):
        full = score(model, pdf, params)[column].to_numpy(float)
        out = {}
        for a in attributes:
            blank = 0.0 if pd.api.types.is_numeric_dtype(pdf[a]) else None
            without = score(model, pdf.assign(**{a: blank}), params)[column].to_numpy(float)
            with np.errstate(divide="ignore", invalid="ignore"):
                out[a] = full / without
        return pd.DataFrame(out)

    return weights


# ------------------------------------------------------------------ example algorithm
def ridge_algorithm(features: list[str], target: str) -> UserAlgorithm:
    """A user-defined ridge regression written in sufficient-statistics form."""
    def partial(pdf, p):
        X = np.column_stack([np.ones(len(pdf))] + [pdf[f].astype(float).fillna(0.0).to_numpy() for f in features])
        y = pdf[target].astype(float).fillna(0.0).to_numpy()
        return {"xtx": X.T @ X, "xty": X.T @ y, "n": np.array([len(pdf)])}

    def finalize(st, p):
        A = st["xtx"] + p["lambda"] * np.diag([0.0] + [1.0] * len(features))
        return {"beta": np.linalg.solve(A, st["xty"]), "n": float(np.ravel(st["n"])[0])}

    def score(m, pdf, p):
        X = np.column_stack([np.ones(len(pdf))] + [pdf[f].astype(float).fillna(0.0).to_numpy() for f in features])
        return pd.DataFrame({"prediction": X @ m["beta"]})

    def details(m, p):
        return pd.DataFrame({"attribute_name": ["(intercept)"] + features, "coefficient": m["beta"]})

    return UserAlgorithm(name="user_ridge", partial=partial, finalize=finalize, score=score,
                         score_schema="prediction double", details=details,
                         details_schema="attribute_name string, coefficient double",
                         settings_schema={"lambda": (float, 0.0, (0.0, 1e6))},
                         weights=left_out_weights(score, features), attributes=list(features))
