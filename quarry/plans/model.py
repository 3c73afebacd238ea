"""Model objects: settings, signature, detail views.

A model is the small, driver-held result of distributed fitting plus a
set of *detail views* (DataFrames) - the equivalent of the reference's
model dictionary and ``DM$V<code>`` views.  Models can be saved as a
folder of Parquet detail tables plus a JSON manifest.
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, NUMERIC_TYPES)


def attribute_roles(df: DataFrame, exclude: list[str]) -> tuple[list[str], list[str]]:
    """Typing rule: numeric column -> numeric attribute, anything else -> categorical."""
    num, cat = [], []
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        (num if is_numeric(f.dataType) else cat).append(f.name)
    return num, cat


@dataclass
class MiningModel:
    """Common model metadata."""

    name: str
    function: str  # CLASSIFICATION, REGRESSION, CLUSTERING, ...
    algorithm: str
    settings: dict = field(default_factory=dict)
    default_settings: dict = field(default_factory=dict)
    signature: list = field(default_factory=list)  # [(attribute_name, attribute_type)]
    case_id: str | None = None
    target: str | None = None
    _views: dict = field(default_factory=dict, repr=False)

    # -- dictionary views -------------------------------------------------
    def settings_df(self, spark: SparkSession) -> DataFrame:
        rows = [(k, str(v), "INPUT") for k, v in sorted(self.settings.items())]
        rows += [(k, str(v), "DEFAULT") for k, v in sorted(self.default_settings.items())
                 if k not in self.settings]
        return spark.createDataFrame(rows, "setting_name string, setting_value string, setting_type string")

    def signature_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.signature), "attribute_name string, attribute_type string")

    def metadata_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(self.name, self.function, self.algorithm)],
                                     "model_name string, mining_function string, algorithm string")

    def add_view(self, code: str, builder: Callable[[], DataFrame], description: str = "") -> None:
        self._views[code] = (builder, description)

    def views_df(self, spark: SparkSession) -> DataFrame:
        rows = [(f"DM$V{c}{self.name.upper()}", d) for c, (_, d) in sorted(self._views.items())]
        return spark.createDataFrame(rows, "view_name string, view_type string")

    def view(self, code: str) -> DataFrame:
        if code not in self._views:
            raise KeyError(f"model {self.name} has no view {code!r}; has {sorted(self._views)}")
        return self._views[code][0]()

    def save(self, path: str) -> None:
        """Write every detail view as Parquet plus a JSON manifest."""
        os.makedirs(path, exist_ok=True) if "://" not in path else None
        for code in self._views:
            self.view(code).write.mode("overwrite").parquet(f"{path}/view_{code}")
        manifest = {
            "name": self.name, "function": self.function, "algorithm": self.algorithm,
            "settings": self.settings, "signature": self.signature,
            "case_id": self.case_id, "target": self.target, "views": sorted(self._views),
        }
        spark = SparkSession.getActiveSession()
        spark.createDataFrame([(json.dumps(manifest),)], "manifest string") \
            .coalesce(1).write.mode("overwrite").text(f"{path}/manifest")


class ModelStore:
    """In-session model dictionary (``user_mining_models``)."""

    def __init__(self):
        self._models: dict[str, MiningModel] = {}

    def put(self, model: MiningModel, replace: bool = True) -> None:
        key = model.name.upper()
        if key in self._models and not replace:
            raise ValueError(f"model {model.name} exists")
        self._models[key] = model

    def drop(self, name: str) -> None:
        self._models.pop(name.upper(), None)

    def get(self, name: str) -> MiningModel:
        return self._models[name.upper()]

    def models_df(self, spark: SparkSession) -> DataFrame:
        rows = [(m.name, m.function, m.algorithm) for m in self._models.values()]
        return spark.createDataFrame(rows, "model_name string, mining_function string, algorithm_name string")
