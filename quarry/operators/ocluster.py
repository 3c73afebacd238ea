"""O-Cluster: axis-parallel recursive partitioning on histogram valleys.

Design after the published O-Cluster algorithm (Milenova and Campos, 2002),
for numeric attributes:

* Every attribute is binned equi-width on its global [min, max] into ``bins``
  bins (one aggregate for all attributes); the binned ids are computed once
  and the binned table is persisted.
* The tree grows level by level.  For all open leaves at once, one Spark
  aggregate ``groupBy(leaf, attribute, bin).count`` gives every histogram
  (leaves x attributes x bins rows, independent of the row count; partial
  aggregation makes a hot leaf cheap).
* Valley test [design, documented here]: in a leaf of n rows, a bin v is a
  valley candidate when the highest bins on its left (p_l) and on its right
  (p_r) both exceed it and both reach the peak baseline
  ``(1 - sensitivity) * n / bins`` (a fraction of the uniform density: higher
  sensitivity admits lower peaks, hence more clusters).  With p = min(p_l, p_r)
  and valley count c, the chi-square statistic of "valley and lower peak have
  the same density" is ``(p - c)^2 / (p + c)`` (1 degree of freedom); the
  valley is significant at ``chi2 >= 2.706`` (90 %).  The leaf splits on the
  attribute / valley of largest statistic, at the valley bin's upper edge:
  ``x < edge`` (and NULL) goes left.  A leaf with no significant valley is
  frozen.
* Splits are applied best-statistic first until ``k`` leaves exist.
* CLUSTER_ID is the chain of split predicates as one nested CASE: scoring
  is a projection.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.scalar import equi_width_bin
from quarry.plans.model import MiningModel

# fixed value: chi-square quantile, 1 degree of freedom, 90 % confidence
CHI2_90_1DF = 2.706


@dataclass
class OClusterNode:
    id: int
    parent: int | None
    level: int
    n: int = 0
    attribute: str | None = None   # split attribute (inner nodes)
    edge: float | None = None      # x < edge -> left
    left: int | None = None
    right: int | None = None


@dataclass
class OClusterModel(MiningModel):
    cols: list = field(default_factory=list)
    bins: int = 10
    lo: dict = field(default_factory=dict)
    hi: dict = field(default_factory=dict)
    nodes: dict = field(default_factory=dict)

    def leaves(self) -> list[OClusterNode]:
        return [n for n in sorted(self.nodes.values(), key=lambda x: x.id) if n.left is None]

    def _descend(self, value_of) -> Column:
        def walk(nid: int) -> Column:
            nd = self.nodes[nid]
            if nd.left is None:
                return F.lit(nid)
            x = value_of(nd.attribute)
            return F.when(x.isNull() | (x < F.lit(float(nd.edge))), walk(nd.left)).otherwise(walk(nd.right))
        return walk(1)

    def cluster_id(self, df: DataFrame) -> Column:
        """CLUSTER_ID: follow the split predicates from the root."""
        return self._descend(lambda a: F.col(a).cast("double") if a in df.columns else F.lit(None).cast("double"))

    def clusters_df(self, spark: SparkSession) -> DataFrame:
        """View D: cluster_id, record_count, parent, tree_level, left/right child (no dispersion),
        and the split predicate of inner nodes (``attribute_name operator value`` sends a row to
        the left child; NULL for leaves)."""
        rows = [(n.id, n.n, n.parent, n.level, n.left, n.right, n.attribute,
                 "<" if n.left is not None else None, float(n.edge) if n.edge is not None else None)
                for n in sorted(self.nodes.values(), key=lambda x: x.id)]
        return spark.createDataFrame(rows, "cluster_id int, record_count long, parent int, tree_level int, "
                                           "left_child_id int, right_child_id int, attribute_name string, "
                                           "operator string, value double")

    def splits_df(self, spark: SparkSession) -> DataFrame:
        """Split predicates: for each inner node, the attribute and threshold sending rows left/right."""
        rows = []
        for n in sorted(self.nodes.values(), key=lambda x: x.id):
            if n.left is not None:
                rows.append((n.id, n.attribute, "<", float(n.edge), n.left))
                rows.append((n.id, n.attribute, ">=", float(n.edge), n.right))
        return spark.createDataFrame(rows, "cluster_id int, attribute_name string, operator string, "
                                           "value double, child_id int")

    def bins_df(self, spark: SparkSession) -> DataFrame:
        """View B: equi-width bin boundaries per attribute."""
        rows = []
        for c in self.cols:
            lo, hi = self.lo[c], self.hi[c]
            if lo is None:
                continue
            w = (hi - lo) / self.bins
            for b in range(1, self.bins + 1):
                rows.append((c, b, lo + (b - 1) * w, lo + b * w))
        return spark.createDataFrame(rows, "attribute_name string, bin_id int, lower_bin_boundary double, "
                                           "upper_bin_boundary double")


def best_valley(h: np.ndarray, n: int, bins: int, sensitivity: float) -> tuple[float, int] | None:
    """(chi2, valley bin index) of the most significant valley of histogram ``h``, or None."""
    base = (1.0 - sensitivity) * n / bins
    best = None
    for v in range(1, len(h) - 1):
        pl, pr = h[:v].max(), h[v + 1:].max()
        if pl <= h[v] or pr <= h[v] or pl < base or pr < base:
            continue
        p, c = float(min(pl, pr)), float(h[v])
        chi2 = (p - c) ** 2 / (p + c)
        if chi2 >= CHI2_90_1DF and (best is None or chi2 > best[0]):
            best = (chi2, v)
    return best


class OCluster:
    DEFAULTS = {"CLUS_NUM_CLUSTERS": "10", "OCLT_SENSITIVITY": "0.5", "PREP_AUTO": "ON"}

    def __init__(self, k: int = 10, sensitivity: float = 0.5, bins: int = 10, name: str = "oc_model"):
        if not 0.0 <= sensitivity <= 1.0:
            raise ValueError("sensitivity must be in [0, 1]")
        self.k, self.sensitivity, self.bins, self.name = k, sensitivity, bins, name

    def fit(self, df: DataFrame, cols: list[str]) -> OClusterModel:
        spark = df.sparkSession
        m = OClusterModel(name=self.name, function="CLUSTERING", algorithm="ALGO_O_CLUSTER", cols=list(cols),
                          bins=self.bins, settings={"CLUS_NUM_CLUSTERS": str(self.k),
                                                    "OCLT_SENSITIVITY": str(self.sensitivity)},
                          default_settings=dict(self.DEFAULTS),
                          signature=[(c, "NUMBER") for c in cols])
        r = df.agg(*[F.min(F.col(c).cast("double")).alias(f"lo{i}") for i, c in enumerate(cols)],
                   *[F.max(F.col(c).cast("double")).alias(f"hi{i}") for i, c in enumerate(cols)],
                   F.count(F.lit(1)).alias("n")).collect()[0]
        for i, c in enumerate(cols):
            m.lo[c], m.hi[c] = r[f"lo{i}"], r[f"hi{i}"]
        m.nodes[1] = OClusterNode(1, None, 1, int(r["n"]))
        # raw values (for the split predicates) and bin ids (for the histograms)
        binned = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)],
                           *[equi_width_bin(F.col(c), m.lo[c], m.hi[c], self.bins).alias(f"b{i}")
                             for i, c in enumerate(cols)]).persist(StorageLevel.MEMORY_AND_DISK)
        pos = {c: i for i, c in enumerate(cols)}
        try:
            open_leaves = [1]
            next_id = 2
            for _ in range(self.k):  # every level but the last splits a leaf
                if not open_leaves or len(m.leaves()) >= self.k:
                    break
                leaf = m._descend(lambda a: F.col(f"x{pos[a]}"))
                pairs = F.array(*[F.struct(F.lit(i).alias("a"), F.col(f"b{i}").alias("b")) for i in range(len(cols))])
                hist = (binned.select(leaf.alias("leaf"), F.inline(pairs))
                        .filter(F.col("leaf").isin(open_leaves) & F.col("b").isNotNull())
                        .groupBy("leaf", "a", "b").agg(F.count(F.lit(1)).alias("n")).collect())
                h = {}
                for row in hist:  # leaves x attributes x bins rows
                    h.setdefault((row["leaf"], row["a"]), np.zeros(self.bins))[row["b"] - 1] = row["n"]
                cands = []
                for lid in open_leaves:
                    best = None
                    for i in range(len(cols)):
                        if (lid, i) not in h:
                            continue
                        found = best_valley(h[(lid, i)], m.nodes[lid].n, self.bins, self.sensitivity)
                        if found and (best is None or found[0] > best[0]):
                            best = (found[0], i, found[1])
                    if best:
                        cands.append((-best[0], lid, best[1], best[2]))
                split = []
                for _, lid, i, v in sorted(cands):
                    if len(m.leaves()) + len(split) >= self.k:
                        break
                    split.append((lid, i, v))
                if not split:
                    break
                for lid, i, v in split:
                    c = cols[i]
                    nd = m.nodes[lid]
                    nd.attribute = c
                    nd.edge = m.lo[c] + (v + 1) * (m.hi[c] - m.lo[c]) / self.bins
                    nd.left, nd.right = next_id, next_id + 1
                    m.nodes[next_id] = OClusterNode(next_id, lid, nd.level + 1)
                    m.nodes[next_id + 1] = OClusterNode(next_id + 1, lid, nd.level + 1)
                    next_id += 2
                # child sizes: one aggregate over the new tree
                leaf = m._descend(lambda a: F.col(f"x{pos[a]}"))
                counts = {row[0]: int(row[1]) for row in binned.groupBy(leaf.alias("leaf")).count().collect()}
                for nid, cnt in counts.items():
                    m.nodes[nid].n = cnt
                open_leaves = [nid for lid, _, _ in split for nid in (m.nodes[lid].left, m.nodes[lid].right)]
        finally:
            binned.unpersist()
        m.add_view("D", lambda: m.clusters_df(spark), "Cluster hierarchy and sizes")
        m.add_view("S", lambda: m.splits_df(spark), "Split predicates")
        m.add_view("B", lambda: m.bins_df(spark), "Binning")
        return m
