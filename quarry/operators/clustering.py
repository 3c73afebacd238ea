"""Clustering: hierarchical (bisecting) k-means and Gaussian mixtures.

Hierarchical k-means [design after the reference's description]:
the root holds every row; repeatedly the leaf with the largest
dispersion (mean squared distance to its centroid) - or the largest
leaf, with ``split='size'`` - is split in two by Lloyd iterations on its
rows.  Node ids follow split order (root 1, then 2, 3, ...), so k leaves
give 2k - 1 nodes.

Every Lloyd iteration is one Spark aggregate
``groupBy(assignment).agg(count, avg(x_i), sum d^2)``; centroids are
driver-side literals (k x p numbers), so the plan never grows.  The
cluster of a row is a pure column expression that descends the tree
comparing distances to the two children: scoring is a projection.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.prep import Normalizer, fit_normalizer
from quarry.plans.model import MiningModel
from quarry.session import hold


def sq_dist(cols: list[Column], center) -> Column:
    d = None
    for c, m in zip(cols, center):
        t = (c - F.lit(float(m))) * (c - F.lit(float(m)))
        d = t if d is None else d + t
    return d


def nearest(cols: list[Column], centers: list) -> Column:
    """Index of the nearest center (ties -> lower index)."""
    ds = [sq_dist(cols, c) for c in centers]
    best = F.least(*ds) if len(ds) > 1 else ds[0]
    expr = None
    for i in reversed(range(len(ds))):
        expr = F.when(ds[i] == best, F.lit(i)) if expr is None else F.when(ds[i] == best, F.lit(i)).otherwise(expr)
    return expr


def lloyd_step(df: DataFrame, cols: list[str], centers: list) -> DataFrame:
    """One Lloyd iteration: (cluster, n, new centroid per column, sse)."""
    xs = [F.col(c).cast("double") for c in cols]
    a = df.select(*[x.alias(c) for x, c in zip(xs, cols)]).withColumn(
        "__c", nearest([F.col(c) for c in cols], centers))
    d2 = None
    for i, ctr in enumerate(centers):
        e = F.when(F.col("__c") == i, sq_dist([F.col(c) for c in cols], ctr))
        d2 = e if d2 is None else F.coalesce(d2, e)
    return a.groupBy(F.col("__c").alias("cluster")).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in cols], F.sum(d2).alias("sse"))


@dataclass
class Node:
    id: int
    parent: int | None
    level: int
    n: int
    centroid: np.ndarray
    dispersion: float
    left: int | None = None
    right: int | None = None


@dataclass
class KMeansTreeModel(MiningModel):
    cols: list = field(default_factory=list)
    norm: Normalizer | None = None
    nodes: dict = field(default_factory=dict)
    tot_withinss: float = 0.0
    n_rows: int = 0

    def leaves(self) -> list[Node]:
        return [n for n in self.nodes.values() if n.left is None]

    def _x(self, df: DataFrame) -> list[Column]:
        xs = []
        for c in self.cols:
            x = F.col(c).cast("double") if c in df.columns else F.lit(None).cast("double")
            x = F.coalesce(x, F.lit(float(self.norm.shift[c])))  # missing -> mean (0 after scaling)
            xs.append((x - F.lit(float(self.norm.shift[c]))) / F.lit(float(self.norm.scale[c])))
        return xs

    def cluster_id(self, df: DataFrame) -> Column:
        """CLUSTER_ID: descend from the root to a leaf."""
        xs = self._x(df)

        def walk(nid: int) -> Column:
            nd = self.nodes[nid]
            if nd.left is None:
                return F.lit(nid)
            l, r = self.nodes[nd.left], self.nodes[nd.right]
            return F.when(sq_dist(xs, l.centroid) <= sq_dist(xs, r.centroid), walk(l.id)).otherwise(walk(r.id))
        return walk(1)

    def cluster_distance(self, df: DataFrame) -> Column:
        """CLUSTER_DISTANCE: distance to the assigned leaf centroid."""
        xs = self._x(df)
        cid = self.cluster_id(df)
        expr = None
        for lf in self.leaves():
            e = F.when(cid == lf.id, F.sqrt(sq_dist(xs, lf.centroid)))
            expr = e if expr is None else F.coalesce(expr, e)
        return expr

    def probability_columns(self, df: DataFrame) -> list[Column]:
        """CLUSTER_PROBABILITY per leaf: exp(-d^2 / (2 s^2)) normalised, s^2 = withinss / n."""
        xs = self._x(df)
        s2 = max(self.tot_withinss / max(self.n_rows, 1), 1e-12)
        ds = [sq_dist(xs, lf.centroid) for lf in self.leaves()]
        m = F.least(*ds) if len(ds) > 1 else ds[0]
        es = [F.exp(-(d - m) / F.lit(2 * s2)) for d in ds]
        tot = es[0]
        for e in es[1:]:
            tot = tot + e
        return [e / tot for e in es]

    def _leaf_ids(self) -> Column:
        return F.array(*[F.lit(lf.id) for lf in self.leaves()])

    def descendants(self, nid: int) -> list[int]:
        """Leaf ids under node ``nid`` (the node itself when it is a leaf)."""
        nd = self.nodes[nid]
        if nd.left is None:
            return [nid]
        return self.descendants(nd.left) + self.descendants(nd.right)

    def cluster_probability(self, df: DataFrame, nid: int) -> Column:
        """CLUSTER_PROBABILITY(m, id): the leaf probability, or the sum over an inner node's leaves."""
        probs = self.probability_columns(df)
        pos = {lf.id: i for i, lf in enumerate(self.leaves())}
        out = None
        for leaf in self.descendants(nid):
            out = probs[pos[leaf]] if out is None else out + probs[pos[leaf]]
        return out

    def cluster_set(self, probs: Column, top_n: int | None = None, min_prob: float = 0.0) -> Column:
        """CLUSTER_SET(m, topN, minProb): array<struct<cluster_id, probability>>, most probable first.

        ``probs`` is the probability array of ``scoring.with_probabilities``.
        """
        ids = self._leaf_ids()
        pairs = F.zip_with(ids, probs, lambda c, p: F.struct(c.alias("cluster_id"), p.alias("probability")))
        kept = F.filter(pairs, lambda e: e["probability"] >= F.lit(float(min_prob)))
        ordered = F.array_sort(kept, lambda a, b: F.when(a["probability"] > b["probability"], -1)
                               .when(a["probability"] < b["probability"], 1)
                               .otherwise(F.signum(a["cluster_id"] - b["cluster_id"]).cast("int")))
        return F.slice(ordered, 1, top_n) if top_n else ordered

    def with_cluster_details(self, df: DataFrame, cluster: Column, top_n: int = 5,
                             name: str = "details") -> DataFrame:
        """CLUSTER_DETAILS(m, cluster, topN): per-attribute weight toward ``cluster``.

        The weight of attribute j is P(cluster | x) minus the same probability
        computed with attribute j left out of every distance (same dispersion
        s^2 = withinss / n).  Returns the top ``top_n`` (attribute, weight)
        structs, largest weight first.  The k x p squared-difference terms
        are one array column, so the p leave-one-out probabilities reuse it.
        """
        leaves = self.leaves()
        g = 1.0 / (2.0 * max(self.tot_withinss / max(self.n_rows, 1), 1e-12))
        xs = F.array(*self._x(df))
        centers = F.array(*[F.array(*[F.lit(float(v)) for v in lf.centroid]) for lf in leaves])
        # k x p squared differences, k full distances, then p leave-one-out distance arrays
        terms = F.transform(centers, lambda c: F.zip_with(xs, c, lambda x, m: (x - m) * (x - m)))
        total = F.transform(F.col("__terms"), lambda t: F.aggregate(t, F.lit(0.0), lambda a, b: a + b))
        without = F.transform(F.sequence(F.lit(1), F.lit(len(self.cols))), lambda j: F.zip_with(
            F.col("__dist"), F.col("__terms"), lambda d, t: d - F.element_at(t, j)))
        pos = F.array_position(self._leaf_ids(), cluster).cast("int")

        def prob_at(dists: Column) -> Column:  # P(cluster) from k squared distances
            e = F.transform(dists, lambda d: F.exp(-(d - F.array_min(dists)) * F.lit(g)))
            return F.element_at(e, pos) / F.aggregate(e, F.lit(0.0), lambda a, b: a + b)

        # element 1: full probability; element j + 1: without attribute j
        probs = F.when(pos > 0, F.transform(F.concat(F.array(F.col("__dist")), F.col("__wo")), prob_at))
        weights = [F.struct(F.lit(attr).alias("attribute"),
                            (F.element_at("__pw", 1) - F.element_at("__pw", j + 2)).alias("weight"))
                   for j, attr in enumerate(self.cols)]
        ordered = F.array_sort(F.array(*weights), lambda a, b: F.when(a["weight"] > b["weight"], -1)
                               .when(a["weight"] < b["weight"], 1)
                               .when(a["attribute"] < b["attribute"], -1)
                               .when(a["attribute"] > b["attribute"], 1).otherwise(0))
        return df.withColumn("__terms", terms).withColumn("__dist", total).withColumn("__wo", without) \
            .withColumn("__pw", probs).withColumn(name, F.slice(ordered, 1, top_n)) \
            .drop("__terms", "__dist", "__wo", "__pw")

    @property
    def classes(self):
        return [lf.id for lf in self.leaves()]

    def clusters_df(self, spark: SparkSession) -> DataFrame:
        """View D: cluster_id, record_count, parent, tree_level, dispersion, left/right child."""
        rows = [(n.id, n.n, n.parent, n.level, float(n.dispersion), n.left, n.right)
                for n in sorted(self.nodes.values(), key=lambda x: x.id)]
        return spark.createDataFrame(rows, "cluster_id int, record_count long, parent int, tree_level int, "
                                           "dispersion double, left_child_id int, right_child_id int")

    def centroids_df(self, spark: SparkSession) -> DataFrame:
        """View C: centroid per node and attribute, reported in original units."""
        rows = []
        for n in self.nodes.values():
            for c, v in zip(self.cols, n.centroid):
                rows.append((n.id, c, float(v * self.norm.scale[c] + self.norm.shift[c])))
        return spark.createDataFrame(rows, "cluster_id int, attribute_name string, mean double")


class HierarchicalKMeans:
    DEFAULTS = {"CLUS_NUM_CLUSTERS": 10, "KMNS_ITERATIONS": 20, "KMNS_CONV_TOLERANCE": 0.001,
                "KMNS_DISTANCE": "KMNS_EUCLIDEAN", "KMNS_SPLIT_CRITERION": "KMNS_VARIANCE"}

    def __init__(self, k: int = 10, max_iter: int = 20, tol: float = 1e-3, split: str = "variance",
                 name: str = "km_model"):
        self.k, self.max_iter, self.tol, self.split, self.name = k, max_iter, tol, split, name

    def fit(self, df: DataFrame, cols: list[str]) -> KMeansTreeModel:
        spark = df.sparkSession
        norm = fit_normalizer(df, cols, "mean", "stddev")
        model = KMeansTreeModel(name=self.name, function="CLUSTERING", algorithm="ALGO_KMEANS",
                                cols=list(cols), norm=norm,
                                settings={"CLUS_NUM_CLUSTERS": self.k, "KMNS_ITERATIONS": self.max_iter,
                                          "KMNS_CONV_TOLERANCE": self.tol,
                                          "KMNS_SPLIT_CRITERION": "KMNS_" + self.split.upper()},
                                default_settings=dict(self.DEFAULTS))
        # z-scored, mean-imputed rows; held because every iteration scans them
        names = [f"__z{i}" for i in range(len(cols))]
        data = hold(df.select(*[x.alias(nm) for x, nm in zip(model._x(df), names)]))
        zc = [F.col(nm) for nm in names]
        r = data.agg(F.count(F.lit(1)).alias("n"), *[F.avg(nm).alias(nm) for nm in names]).collect()[0]
        root_c = np.array([r[nm] or 0.0 for nm in names])
        root_sse = data.agg(F.sum(sq_dist(zc, root_c)).alias("s")).collect()[0]["s"] or 0.0
        n_root = int(r["n"])
        model.nodes[1] = Node(1, None, 1, n_root, root_c, root_sse / max(n_root, 1))
        model.n_rows = n_root
        next_id = 2
        bisections: dict = {}
        blocked: set = set()
        while len(model.leaves()) < self.k:
            cands = [lf for lf in model.leaves() if lf.n >= 2 and lf.id not in blocked]
            if not cands:
                break
            key = (lambda nd: (nd.dispersion, -nd.id)) if self.split == "variance" else (lambda nd: (nd.n, -nd.id))
            leaf = max(cands, key=key)
            if leaf.id not in bisections:
                # bisect every leaf still lacking a split in the same jobs (one
                # aggregate per Lloyd iteration for all of them)
                todo = [lf for lf in cands if lf.id not in bisections]
                bisections.update(self._bisect_many(data, zc, model, todo))
            res = bisections.pop(leaf.id)
            if res is None:
                blocked.add(leaf.id)
                continue
            (c1, n1, s1), (c2, n2, s2) = res
            a = Node(next_id, leaf.id, leaf.level + 1, n1, c1, s1 / max(n1, 1))
            b = Node(next_id + 1, leaf.id, leaf.level + 1, n2, c2, s2 / max(n2, 1))
            leaf.left, leaf.right = a.id, b.id
            model.nodes[a.id], model.nodes[b.id] = a, b
            next_id += 2
        model.tot_withinss = sum(lf.dispersion * lf.n for lf in model.leaves())
        data.unpersist()
        model.add_view("D", lambda: model.clusters_df(spark), "k-Means Clusters")
        model.add_view("C", lambda: model.centroids_df(spark), "k-Means Centroids")
        return model

    def _bisect_many(self, data: DataFrame, zc: list[Column], model: KMeansTreeModel, leaves: list[Node]) -> dict:
        """2-means for several leaves at once.

        Init per leaf: centroid -/+ one standard deviation along its widest
        attribute.  Each Lloyd iteration is ONE aggregate
        ``groupBy(leaf, side)`` over the rows of all still-moving leaves.
        """
        names = [f"__z{i}" for i in range(len(zc))]
        ids = [lf.id for lf in leaves]
        rows = data.withColumn("__leaf", model_leaf_expr(model, zc)).filter(F.col("__leaf").isin(ids))
        var = {int(r["__leaf"]): r for r in rows.groupBy("__leaf").agg(
            *[F.var_pop(nm).alias(nm) for nm in names]).collect()}
        out: dict = {}
        centers: dict = {}
        for lf in leaves:
            r = var.get(lf.id)
            v = np.array([(r[nm] if r is not None else 0.0) or 0.0 for nm in names])
            if v.max() <= 0:
                out[lf.id] = None
                continue
            j = int(np.argmax(v))
            off = np.zeros(len(names))
            off[j] = math.sqrt(v[j])
            centers[lf.id] = [lf.centroid - off, lf.centroid + off]

        def step(active: dict) -> dict:
            side = None
            d2 = None
            for lid, (c1, c2) in active.items():
                hit = F.col("__leaf") == F.lit(lid)
                e = F.when(sq_dist(zc, c1) <= sq_dist(zc, c2), F.lit(0)).otherwise(F.lit(1))
                side = F.when(hit, e) if side is None else side.when(hit, e)
            for lid, (c1, c2) in active.items():
                hit = F.col("__leaf") == F.lit(lid)
                e = F.when(hit & (F.col("__side") == 0), sq_dist(zc, c1)) \
                    .when(hit & (F.col("__side") == 1), sq_dist(zc, c2))
                d2 = e if d2 is None else F.coalesce(d2, e)
            got = rows.filter(F.col("__leaf").isin(list(active))).withColumn("__side", side) \
                .groupBy("__leaf", "__side").agg(F.count(F.lit(1)).alias("n"),
                                                 *[F.avg(nm).alias(nm) for nm in names],
                                                 F.sum(d2).alias("sse")).collect()
            res: dict = {}
            for r in got:
                res.setdefault(int(r["__leaf"]), {})[int(r["__side"])] = r
            return res

        active = dict(centers)
        for _ in range(self.max_iter):
            if not active:
                break
            res = step(active)
            nxt = {}
            for lid, (c1, c2) in active.items():
                sides = res.get(lid, {})
                if len(sides) < 2:
                    out[lid] = None
                    continue
                new = [np.array([sides[i][nm] for nm in names]) for i in (0, 1)]
                shift = max(float(np.sqrt(((a - b) ** 2).sum())) for a, b in zip(new, (c1, c2)))
                centers[lid] = new
                if shift >= self.tol:
                    nxt[lid] = new
            active = nxt
        # final statistics with the converged centers, all leaves in one job
        final = {lid: c for lid, c in centers.items() if out.get(lid, 0) is not None}
        if final:
            res = step(final)
            for lid, c in final.items():
                sides = res.get(lid, {})
                if len(sides) < 2:
                    out[lid] = None
                else:
                    out[lid] = [(c[i], int(sides[i]["n"]), float(sides[i]["sse"])) for i in (0, 1)]
        return out


def model_leaf_expr(model: KMeansTreeModel, zc: list[Column]) -> Column:
    """Leaf of already-scaled coordinates (same descent as cluster_id)."""
    def walk(nid: int) -> Column:
        nd = model.nodes[nid]
        if nd.left is None:
            return F.lit(nid)
        l, r = model.nodes[nd.left], model.nodes[nd.right]
        return F.when(sq_dist(zc, l.centroid) <= sq_dist(zc, r.centroid), walk(l.id)).otherwise(walk(r.id))
    return walk(1)


def cluster_histograms(df: DataFrame, cluster: Column, cols: list[str], bins: int = 10) -> DataFrame:
    """View H: per cluster, attribute and equi-width bin (global range) the row count."""
    r = df.agg(*[F.min(F.col(c).cast("double")).alias(f"lo{i}") for i, c in enumerate(cols)],
               *[F.max(F.col(c).cast("double")).alias(f"hi{i}") for i, c in enumerate(cols)]).collect()[0]
    from quarry.functions.scalar import equi_width_bin
    keyed = df.select(cluster.alias("cluster_id"), *[
        equi_width_bin(c, r[f"lo{i}"], r[f"hi{i}"], bins).alias(c) for i, c in enumerate(cols)])
    return keyed.unpivot("cluster_id", cols, "attribute_name", "bin_id").filter(F.col("bin_id").isNotNull()) \
        .groupBy("cluster_id", "attribute_name", "bin_id").agg(F.count(F.lit(1)).alias("count"))
