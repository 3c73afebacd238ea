"""Expectation maximization over numeric and categorical attributes, components merged into clusters.

A component is a product of one Gaussian per numeric and one multinomial per categorical attribute;
a NULL or unknown value leaves its attribute out of the row's likelihood.  One EM iteration is ONE
pass: every task computes its rows' responsibilities in numpy and adds up the components' statistics
(components x attributes numbers), Spark adds the tasks' blocks, and the driver takes the M step.
The log likelihood never falls; the fit ends when it improves by less than ``improvement`` of its
size, or after ``max_iter`` passes.

Components are then agglomerated by the Bhattacharyya distance of their distributions under single,
average or complete linkage until ``clusters`` are left; a row's cluster probability is the sum of
its components'.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.linear import SMALL_BLOCK, fit_design, sum_blocks
from quarry.plans.model import MiningModel
from quarry.session import hold

FLOOR = 1e-6  # of an attribute's variance: the least variance of a component


@dataclass
class Components:
    prior: np.ndarray                 # K
    mean: np.ndarray                  # K x p
    variance: np.ndarray              # K x p
    frequency: list                   # per categorical attribute K x levels

    def log_joint(self, x: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """log of prior and likelihood, rows x K; NaN and codes below 0 are left out."""
        with np.errstate(divide="ignore"):
            out = np.tile(np.log(self.prior), (len(x) if self.mean.shape[1] else len(codes), 1))
            for j in range(self.mean.shape[1]):
                d = (x[:, j, None] - self.mean[None, :, j]) ** 2 / self.variance[None, :, j]
                out += np.where(np.isnan(d), 0.0, -0.5 * (d + np.log(2 * np.pi * self.variance[None, :, j])))
            for j, f in enumerate(self.frequency):
                c = codes[:, j]
                out += np.where((c >= 0)[:, None], np.log(f.T[np.maximum(c, 0)]), 0.0)
        return out

    def responsibilities(self, x: np.ndarray, codes: np.ndarray):
        """(responsibilities, log likelihood of every row); a row no component can have is spread by the priors."""
        joint = self.log_joint(x, codes)
        top = joint.max(1, keepdims=True)
        lost = ~np.isfinite(top[:, 0])
        with np.errstate(invalid="ignore"):
            e = np.exp(joint - top)
        total = e.sum(1, keepdims=True)
        r = np.where(lost[:, None], self.prior[None], e / np.where(total > 0, total, 1.0))
        with np.errstate(divide="ignore"):
            return r, np.where(lost, 0.0, top[:, 0] + np.log(np.where(total[:, 0] > 0, total[:, 0], 1.0)))


def bhattacharyya(c: Components) -> np.ndarray:
    """Distances between all pairs of components, summed over attributes; identical ones are at 0."""
    k = len(c.prior)
    out = np.zeros((k, k))
    for j in range(c.mean.shape[1]):
        v = (c.variance[:, None, j] + c.variance[None, :, j]) / 2
        out += (c.mean[:, None, j] - c.mean[None, :, j]) ** 2 / (8 * v)
        out += 0.5 * np.log(v / np.sqrt(c.variance[:, None, j] * c.variance[None, :, j]))
    for f in c.frequency:
        root = np.sqrt(f)
        out -= np.log(np.maximum(root @ root.T, 1e-300))
    out = np.maximum(out, 0.0)
    np.fill_diagonal(out, 0.0)
    return out


def agglomerate(distance: np.ndarray, clusters: int, linkage: str = "single"):
    """Merge the two nearest groups until ``clusters`` are left; ties go to the smallest members.

    Returns each item's group, numbered from 1 in order of its smallest item, and the merges as
    (smallest item of one, of the other, distance).
    """
    link = {"single": np.min, "average": np.mean, "complete": np.max}
    if linkage not in link:
        raise ValueError(f"unknown linkage {linkage!r}")
    groups, merges = [[i] for i in range(len(distance))], []
    while len(groups) > max(clusters, 1):
        pairs = [(float(link[linkage](distance[np.ix_(a, b)])), i, i + 1 + j)
                 for i, a in enumerate(groups) for j, b in enumerate(groups[i + 1:])]
        d, i, j = min(pairs)
        merges.append((groups[i][0], groups[j][0], d))
        groups[i] = sorted(groups[i] + groups.pop(j))
    member = np.empty(len(distance), np.int64)
    for g, items in enumerate(groups, 1):
        member[items] = g
    return member, merges


@dataclass
class MixtureModel(MiningModel):
    numeric: list = field(default_factory=list)
    levels: dict = field(default_factory=dict)
    components: Components | None = None
    member: np.ndarray | None = None   # cluster of each component
    merges: list = field(default_factory=list)
    history: list = field(default_factory=list)  # log likelihood after each pass
    converged: bool = False

    def inputs(self, df: DataFrame) -> list[Column]:
        """Numerics as doubles, categories as level numbers; -1 for NULL, unknown levels and missing columns."""
        out = []
        for a in self.numeric:
            out.append(F.col(a).cast("double") if a in df.columns else F.lit(None).cast("double"))
        for a, levels in self.levels.items():
            x = F.col(a).cast("string") if a in df.columns else F.lit(None).cast("string")
            found = F.array_position(F.array(*[F.lit(v) for v in levels]), x) - 1 if levels else F.lit(-1)
            out.append(F.coalesce(found, F.lit(-1)).cast("double"))
        return [c.alias(f"__x{i}") for i, c in enumerate(out)]

    def score(self, df: DataFrame) -> DataFrame:
        """``df`` with component_id, cluster_id, cluster_probability and cluster_set of every row.

        ``cluster_set`` is an array of (cluster_id, probability), most probable first; ties go to the
        smaller id.
        """
        n, p, components, member = len(df.columns), len(self.numeric), self.components, self.member
        clusters = int(member.max())
        sets = pa.list_(pa.struct([("cluster_id", pa.int32()), ("probability", pa.float64())]))
        added = T._parse_datatype_string("component_id int, cluster_id int, cluster_probability double, "
                                         "cluster_set array<struct<cluster_id:int,probability:double>>")

        def run(batches):
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = _floats(batch.columns[n:])
                r, _ = components.responsibilities(x[:, :p], x[:, p:].astype(int))
                by = np.zeros((len(r), clusters))
                for k, g in enumerate(member):
                    by[:, g - 1] += r[:, k]
                order = np.argsort(-by, axis=1, kind="stable")
                sorted_by = np.take_along_axis(by, order, 1)
                cluster_set = [[{"cluster_id": int(i) + 1, "probability": float(v)} for i, v in zip(o, s)]
                               for o, s in zip(order, sorted_by)]
                yield pa.RecordBatch.from_arrays(
                    list(batch.columns[:n]) + [pa.array(r.argmax(1) + 1, pa.int32()), pa.array(order[:, 0] + 1, pa.int32()),
                                               pa.array(sorted_by[:, 0]), pa.array(cluster_set, sets)],
                    names=list(batch.schema.names[:n]) + added.fieldNames())

        return df.select(*df.columns, *self.inputs(df)).mapInArrow(run, T.StructType(df.schema.fields + added.fields))

    def components_df(self, spark: SparkSession) -> DataFrame:
        rows = [(k + 1, int(g), float(p)) for k, (g, p) in enumerate(zip(self.member, self.components.prior))]
        return spark.createDataFrame(rows, "component_id int, cluster_id int, prior_probability double")

    def gaussians_df(self, spark: SparkSession) -> DataFrame:
        c = self.components
        rows = [(k + 1, a, float(c.mean[k, j]), float(c.variance[k, j])) for k in range(len(c.prior))
                for j, a in enumerate(self.numeric)]
        return spark.createDataFrame(rows, "component_id int, attribute_name string, mean double, variance double")

    def frequencies_df(self, spark: SparkSession) -> DataFrame:
        rows = [(k + 1, a, v, float(f[k, i])) for (a, levels), f in zip(self.levels.items(), self.components.frequency)
                for i, v in enumerate(levels) for k in range(f.shape[0])]
        return spark.createDataFrame(rows, "component_id int, attribute_name string, attribute_value string, "
                                           "frequency double")

    def merges_df(self, spark: SparkSession) -> DataFrame:
        rows = [(i, a + 1, b + 1, d) for i, (a, b, d) in enumerate(self.merges, 1)]
        return spark.createDataFrame(rows, "step int, left_component int, right_component int, distance double")

    def global_df(self, spark: SparkSession) -> DataFrame:
        rows = [("CONVERGED", None, "YES" if self.converged else "NO"), ("ITERATIONS", float(len(self.history)), None),
                ("LOGLIKELIHOOD", float(self.history[-1]) if self.history else None, None),
                ("NUM_CLUSTERS", float(self.member.max()), None),
                ("NUM_COMPONENTS", float(len(self.components.prior)), None)]
        return spark.createDataFrame(rows, "name string, numeric_value double, string_value string")


def _floats(columns) -> np.ndarray:
    return np.column_stack([c.fill_null(float("nan")).to_numpy(zero_copy_only=False) for c in columns])


class Mixture:
    """EM estimator; see the module's text for the model."""

    DEFAULTS = {"EMCS_NUM_ITERATIONS": "100", "EMCS_LOGLIKE_IMPROVEMENT": ".001", "EMCS_LINKAGE_FUNCTION":
                "EMCS_LINKAGE_SINGLE", "PREP_AUTO": "ON"}

    def __init__(self, components: int = 10, clusters: int = 4, linkage: str = "single", max_iter: int = 100,
                 improvement: float = 1e-3, name: str = "em_mixture"):
        if components < 1 or clusters < 1:
            raise ValueError("components and clusters must be positive")
        self.k, self.clusters, self.linkage = components, clusters, linkage
        self.max_iter, self.improvement, self.name = max_iter, improvement, name

    def fit(self, df: DataFrame, numeric: list[str], categorical: list[str]) -> MixtureModel:
        spark = df.sparkSession
        design = fit_design(df, [], categorical)
        m = MixtureModel(name=self.name, function="CLUSTERING", algorithm="ALGO_EXPECTATION_MAXIMIZATION",
                         numeric=list(numeric), levels=design.categorical,
                         settings={"EMCS_NUM_COMPONENTS": str(self.k), "CLUS_NUM_CLUSTERS": str(self.clusters),
                                   "EMCS_LINKAGE_FUNCTION": f"EMCS_LINKAGE_{self.linkage.upper()}"},
                         default_settings=dict(self.DEFAULTS),
                         signature=[(a, "NUMBER") for a in numeric] + [(a, "VARCHAR2") for a in categorical])
        p, sizes = len(numeric), [len(v) for v in design.categorical.values()]
        inputs = m.inputs(df)
        # sum_blocks reads NULL as 0, so every numeric comes with a mark for known values
        rows = df.select(*inputs).select(
            *[F.nanvl(F.coalesce(F.col(f"__x{i}"), F.lit(0.0)), F.lit(0.0)).alias(f"__v{i}") for i in range(p)],
            *[(F.col(f"__x{i}").isNotNull() & ~F.isnan(f"__x{i}")).cast("double").alias(f"__k{i}") for i in range(p)],
            *[f"__x{p + j}" for j in range(len(sizes))])
        rows = hold(rows)

        def read(cols):
            x = np.column_stack(cols[:p]) if p else np.zeros((len(cols[-1]), 0))
            known = np.column_stack(cols[p:2 * p]) if p else x
            codes = np.column_stack(cols[2 * p:]).astype(int) if sizes else np.zeros((len(x), 0), int)
            return x, known, codes

        def totals(cols):
            x, known, codes = read(cols)
            counts = [np.bincount(codes[codes[:, j] >= 0, j], minlength=s) for j, s in enumerate(sizes)]
            return np.concatenate([[len(x)], known.sum(0), (x * known).sum(0), (x * x * known).sum(0)] + counts).astype(float)

        try:
            flat = sum_blocks(rows, totals)
            if flat is None:
                raise ValueError("no rows")
            n, seen = flat[0], flat[1:1 + p]
            mean = flat[1 + p:1 + 2 * p] / np.maximum(seen, 1)
            var = np.maximum(flat[1 + 2 * p:1 + 3 * p] / np.maximum(seen, 1) - mean ** 2, 0.0)
            floor = np.where(var > 0, var * FLOOR, 1.0)
            at, overall = 1 + 3 * p, []
            for s in sizes:
                overall.append(flat[at:at + s] / max(flat[at:at + s].sum(), 1.0))
                at += s
            m.components = self._start(rows, mean, np.maximum(var, floor), overall, p)
            m.history, m.converged = self._iterate(m, rows, read, n, p, sizes, floor)
        finally:
            rows.unpersist()
        m.member, m.merges = agglomerate(bhattacharyya(m.components), self.clusters, self.linkage)
        m.add_view("O", lambda: m.components_df(spark), "Component priors and clusters")
        m.add_view("M", lambda: m.gaussians_df(spark), "Means and variances of Gaussian attributes")
        m.add_view("F", lambda: m.frequencies_df(spark), "Frequencies of categorical attributes")
        m.add_view("T", lambda: m.merges_df(spark), "Merges of components")
        m.add_view("G", lambda: m.global_df(spark), "Global statistics")
        return m

    def _start(self, rows: DataFrame, mean, var, overall, p: int) -> Components:
        """Components around distinct rows of smallest hash, as wide as the whole table."""
        seeds = rows.distinct().orderBy(F.xxhash64(*rows.columns), *rows.columns).limit(self.k).collect()
        k = len(seeds)
        mu = np.tile(mean, (k, 1)) if p else np.zeros((k, 0))
        frequency = [np.tile(f, (k, 1)) for f in overall]
        for i, r in enumerate(seeds):
            for j in range(p):
                if r[p + j]:
                    mu[i, j] = r[j]
            for j, f in enumerate(frequency):
                if r[2 * p + j] >= 0:
                    f[i] = 0.5 * f[i]
                    f[i, int(r[2 * p + j])] += 0.5
        return Components(np.full(k, 1.0 / k), mu, np.tile(var, (k, 1)) if p else np.zeros((k, 0)), frequency)

    def _iterate(self, m: MixtureModel, rows: DataFrame, read, n: float, p: int, sizes: list[int], floor):
        history: list[float] = []
        k = len(m.components.prior)
        for _ in range(self.max_iter):
            now = m.components

            def block(cols, now=now):
                x, known, codes = read(cols)
                r, loglik = now.responsibilities(np.where(known > 0, x, np.nan), codes)
                counts = []
                for j, s in enumerate(sizes):
                    c = codes[:, j]
                    counts += [np.bincount(c[c >= 0], r[c >= 0, i], minlength=s) for i in range(k)]
                shift = x - now.mean.mean(0) if p else x
                return np.concatenate([[loglik.sum()], r.sum(0), (r.T @ known).ravel(), (r.T @ (shift * known)).ravel(),
                                       (r.T @ (shift ** 2 * known)).ravel()] + counts)

            s = sum_blocks(rows, block, held=1 + k * (1 + 3 * p + sum(sizes)) <= SMALL_BLOCK)
            history.append(float(s[0]))
            if len(history) > 1 and history[-1] - history[-2] < self.improvement * abs(history[-2]):
                return history, True
            weight, at = s[1:1 + k], 1 + k
            seen, first, second = (s[at + i * k * p:at + (i + 1) * k * p].reshape(k, p) for i in range(3))
            at += 3 * k * p
            known = seen > 1e-9
            d = np.divide(first, seen, out=np.zeros((k, p)), where=known)
            var = np.divide(second, seen, out=np.zeros((k, p)), where=known) - d ** 2
            mean = np.where(known, d + now.mean.mean(0), now.mean) if p else now.mean
            variance = np.where(known, np.maximum(var, floor), now.variance) if p else now.variance
            frequency = []
            for size, old in zip(sizes, now.frequency):
                c = s[at:at + k * size].reshape(k, size)
                at += k * size
                total = c.sum(1, keepdims=True)
                frequency.append(np.where(total > 1e-9, c / np.maximum(total, 1e-300), old))
            m.components = Components(weight / n, mean, variance, frequency)
        return history, False
