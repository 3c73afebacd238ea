"""Data preparation fitted on build data and replayed at scoring.

Each ``fit_*`` runs one aggregate (statistics per attribute - a single
row or a few rows) and returns a small, driver-held transform that is
applied as a projection: no join, no shuffle at scoring time.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.functions.scalar import equi_width_bin
from quarry.plans.model import attribute_roles


@dataclass
class Normalizer:
    """Shift/scale per numeric attribute (``PREP_SHIFT_MEAN`` / ``PREP_SCALE_STDDEV``)."""

    shift: dict = field(default_factory=dict)
    scale: dict = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        cols = []
        for c in df.columns:
            if c in self.shift:
                s = self.scale.get(c) or 1.0
                cols.append(((F.col(c).cast("double") - F.lit(self.shift[c])) / F.lit(s)).alias(c))
            else:
                cols.append(F.col(c))
        return df.select(*cols)

    def inverse(self, df: DataFrame) -> DataFrame:
        """Reverse transform, e.g. to report centroids in original units."""
        cols = []
        for c in df.columns:
            if c in self.shift:
                s = self.scale.get(c) or 1.0
                cols.append((F.col(c) * F.lit(s) + F.lit(self.shift[c])).alias(c))
            else:
                cols.append(F.col(c))
        return df.select(*cols)

    def detail_df(self, spark: SparkSession) -> DataFrame:
        """Normalization detail view (code N): attribute, shift, scale."""
        rows = [(a, float(self.shift[a]), float(self.scale.get(a) or 1.0)) for a in sorted(self.shift)]
        return spark.createDataFrame(rows, "attribute_name string, shift double, scale double")


def fit_normalizer(df: DataFrame, cols: list[str], shift: str = "mean", scale: str = "stddev") -> Normalizer:
    """One aggregate row with mean and sample stddev (or min/max) of every column."""
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    r = df.agg(*aggs).collect()[0]
    n = Normalizer()
    for i, c in enumerate(cols):
        n.shift[c] = (r[f"m{i}"] if shift == "mean" else r[f"lo{i}"] if shift == "min" else 0.0) or 0.0
        if scale == "stddev":
            sc = r[f"s{i}"]
        elif scale == "range":
            sc = (r[f"hi{i}"] - r[f"lo{i}"]) if r[f"hi{i}"] is not None else None
        else:
            sc = 1.0
        n.scale[c] = sc if sc not in (None, 0.0) else 1.0
    return n


@dataclass
class Imputer:
    """Missing values: mean for numeric, mode for categorical."""

    fill: dict = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.select(*[F.coalesce(F.col(c), F.lit(self.fill[c])).alias(c) if c in self.fill
                           else F.col(c) for c in df.columns])


def fit_imputer(df: DataFrame, exclude: list[str] | None = None) -> Imputer:
    """Means in one aggregate; modes from one (attribute, value) count aggregate.

    Mode ties break to the smallest value (count desc, value asc).
    """
    numeric, categorical = attribute_roles(df, list(exclude or []))
    imp = Imputer()
    if numeric:
        r = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in numeric]).collect()[0]
        imp.fill.update({c: r[c] for c in numeric if r[c] is not None})
    if categorical:
        modes = mode_table(df, categorical).collect()
        imp.fill.update({m["attribute_name"]: m["mode_value"] for m in modes})
    return imp


def mode_table(df: DataFrame, cols: list[str]) -> DataFrame:
    """(attribute_name, mode_value, mode_count) for each categorical column."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        [], cols, "attribute_name", "v").filter(F.col("v").isNotNull())
    cnt = long.groupBy("attribute_name", "v").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("attribute_name").orderBy(F.col("n").desc(), F.col("v").asc())
    return cnt.withColumn("r", F.row_number().over(w)).filter("r = 1").select(
        "attribute_name", F.col("v").alias("mode_value"), F.col("n").alias("mode_count"))


def equi_width_binning(df: DataFrame, cols: list[str], bins: int = 10):
    """Fit equi-width bins on the data range; returns (binned df, bin table)."""
    spark = df.sparkSession
    r = df.agg(*[F.min(F.col(c).cast("double")).alias(f"lo{i}") for i, c in enumerate(cols)],
               *[F.max(F.col(c).cast("double")).alias(f"hi{i}") for i, c in enumerate(cols)]).collect()[0]
    ranges = {c: (r[f"lo{i}"], r[f"hi{i}"]) for i, c in enumerate(cols)}
    out = df.select(*[equi_width_bin(c, *ranges[c], bins).alias(c) if c in ranges else F.col(c)
                      for c in df.columns])
    rows = []
    for c, (lo, hi) in ranges.items():
        if lo is None:
            continue
        w = (hi - lo) / bins
        for b in range(1, bins + 1):
            rows.append((c, b, lo + (b - 1) * w, lo + b * w))
    table = spark.createDataFrame(rows, "attribute_name string, bin_id int, lower_bound double, upper_bound double")
    return out, table


def one_hot_names(df: DataFrame, cols: list[str]) -> DataFrame:
    """(attribute_name, attribute_value) pairs a one-hot encoding would create."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        [], cols, "attribute_name", "attribute_value").filter(
        F.col("attribute_value").isNotNull()).distinct()


def class_weights_balanced(df: DataFrame, target: str) -> DataFrame:
    """CLAS_WEIGHTS_BALANCED: weight = n / (k * n_c) per class."""
    c = df.groupBy(target).agg(F.count(F.lit(1)).alias("n_c"))
    w = Window.partitionBy()  # k rows (classes): bounded
    return c.select(F.col(target).alias("target_value"), "n_c",
                    (F.sum("n_c").over(w) / (F.count(F.lit(1)).over(w) * F.col("n_c"))).alias("class_weight"))


FOLD_BUCKETS = 1024


def stratified_folds(df: DataFrame, key: str, target: str, k: int, fold_col: str = "fold") -> DataFrame:
    """Adds the fold 0..k-1: the rows of every class are numbered and dealt round robin.

    So fold sizes of a class differ by one row at most.  The order within a class is that of a
    fixed integer mix of the key, then the key.  Numbers are made in parallel: a window inside each
    (class, slice of the mix) and, per class, the running count of the slices before it - a table
    of ``FOLD_BUCKETS`` rows a class.  NULL targets are a class of their own.
    """
    mixed = F.pmod(F.pmod(F.col(key).cast("long"), F.lit(2147483648)) * 1103515245 + 12345, F.lit(2147483648))
    rows = df.withColumn("__mix", mixed).withColumn("__slice", F.floor(F.col("__mix") / (2147483648 // FOLD_BUCKETS)))
    before = Window.partitionBy("__class").orderBy("__s").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (rows.groupBy(F.col(target).alias("__class"), F.col("__slice").alias("__s"))
               .agg(F.count(F.lit(1)).alias("__n"))
               .select("__class", "__s", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before")))
    place = F.row_number().over(Window.partitionBy(target, "__slice").orderBy("__mix", key)) - 1
    joined = rows.withColumn("__place", place).join(
        F.broadcast(offsets), F.col(target).eqNullSafe(F.col("__class")) & (F.col("__slice") == F.col("__s")))
    return joined.withColumn(fold_col, F.pmod(F.col("__before") + F.col("__place"), F.lit(k)).cast("int")).drop(
        "__mix", "__slice", "__class", "__s", "__before", "__place")
