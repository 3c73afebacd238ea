"""Rules of clusters: a box around most of each cluster, with support and confidence.

The boxes come from per-cluster histograms - one aggregate over (cluster, attribute, bin) and one
over (cluster, attribute, value) - so the driver sees bins and levels only.  A numeric side is the
shortest run of equi-width bins that holds ``coverage`` of the cluster's known values (ties: more
rows, then the lower run); a categorical side takes the most frequent values (ties: in order) until
they hold as much.  A second pass counts the rows of each cluster that lie in all sides of its box.

A side's confidence says how well it tells the cluster from the table: one minus the share of all
rows inside the side over the share of the cluster's rows inside, at least 0.  NULLs lie outside.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.scalar import equi_width_bin
from quarry.operators.linear import MAX_LEVELS

SCHEMA = ("cluster_id int, attribute_name string, lower_bin int, upper_bin int, lower_bound double, upper_bound double, "
          "attribute_values array<string>, support long, confidence double, rule_support long, rule_confidence double")


@dataclass
class Side:
    attribute: str
    support: int
    everywhere: int                  # rows of all clusters inside
    bins: tuple[int, int] | None = None
    values: list | None = None


def numeric_side(attribute: str, counts: list[int], total: list[int], coverage: float) -> Side | None:
    """The shortest run of bins with enough of the cluster's counts; None for a cluster without values."""
    known = sum(counts)
    if not known:
        return None
    best = None
    for start in range(len(counts)):
        held = 0
        for end in range(start, len(counts)):
            held += counts[end]
            if held >= coverage * known:
                rank = (end - start, -held, start)
                if best is None or rank < best[0]:
                    best = rank, start, end, held
                break
    _, start, end, held = best
    return Side(attribute, held, sum(total[start:end + 1]), (start + 1, end + 1))


def categorical_side(attribute: str, counts: dict[str, int], total: dict[str, int], coverage: float) -> Side | None:
    known, held, values = sum(counts.values()), 0, []
    for v, n in sorted(counts.items(), key=lambda c: (-c[1], c[0])):
        if held >= coverage * known:
            break
        held += n
        values.append(v)
    return Side(attribute, held, sum(total[v] for v in values), None, sorted(values)) if known else None


def cluster_rules(df: DataFrame, cluster: str, numeric: list[str], categorical: list[str] | None = None, bins: int = 10,
                  coverage: float = 0.8) -> DataFrame:
    """One row per cluster and side of its box; rows with a NULL cluster take no part.

    ``lower_bound`` and ``upper_bound`` are in the attribute's own units.  A cluster without any known
    value has no row.
    """
    if not 0 < coverage <= 1:
        raise ValueError("coverage must be in (0, 1]")
    spark, categorical = df.sparkSession, list(categorical or [])
    data = df.filter(F.col(cluster).isNotNull()).select(
        F.col(cluster).cast("int").alias("__c"),
        *[F.nanvl(F.col(a).cast("double"), F.lit(None).cast("double")).alias(a) for a in numeric],
        *[F.col(a).cast("string").alias(a) for a in categorical])
    sizes = {r["__c"]: r["count"] for r in data.groupBy("__c").count().collect()}
    if not sizes:
        return spark.createDataFrame([], SCHEMA)
    rows_all = sum(sizes.values())
    ranges = {}
    if numeric:
        r = data.agg(*[f(a).alias(f"{n}{i}") for i, a in enumerate(numeric) for n, f in (("l", F.min), ("h", F.max))]).first()
        ranges = {a: (r[f"l{i}"], r[f"h{i}"]) for i, a in enumerate(numeric) if r[f"l{i}"] is not None}
    binned = data.select("__c", *[equi_width_bin(a, *ranges[a], bins).alias(a) for a in ranges], *categorical)
    sides: dict[int, list[Side]] = {c: [] for c in sizes}
    if ranges:
        counts: dict = {}
        for r in (binned.unpivot("__c", list(ranges), "attribute", "bin").filter("bin IS NOT NULL")
                  .groupBy("__c", "attribute", "bin").count().collect()):
            counts.setdefault(r["attribute"], {}).setdefault(r["__c"], [0] * bins)[r["bin"] - 1] = r["count"]
        for a in ranges:
            total = [sum(c[i] for c in counts[a].values()) for i in range(bins)]
            for c, own in counts[a].items():
                sides[c].append(numeric_side(a, own, total, coverage))
    for a in categorical:
        levels = binned.filter(F.col(a).isNotNull()).select(a).distinct().limit(MAX_LEVELS + 1).count()
        if levels > MAX_LEVELS:
            raise ValueError(f"{a}: more than {MAX_LEVELS} levels; bin or hash it first")
        found: dict = {}
        for r in binned.filter(F.col(a).isNotNull()).groupBy("__c", a).count().collect():
            found.setdefault(r["__c"], {})[r[a]] = r["count"]
        total_of: dict = {}
        for own in found.values():
            for v, n in own.items():
                total_of[v] = total_of.get(v, 0) + n
        for c, own in found.items():
            sides[c].append(categorical_side(a, own, total_of, coverage))
    sides = {c: [s for s in own if s is not None] for c, own in sides.items()}
    boxed = {c: own for c, own in sides.items() if own}
    supports = {r["__c"]: r["n"] for r in binned.groupBy("__c").agg(
        F.sum(F.when(_inside(boxed), 1).otherwise(0)).alias("n")).collect()} if boxed else {}
    out = []
    for c, own in sorted(boxed.items()):
        for s in own:
            low = high = None
            if s.bins:
                start, width = ranges[s.attribute][0], (ranges[s.attribute][1] - ranges[s.attribute][0]) / bins
                low, high = start + (s.bins[0] - 1) * width, start + s.bins[1] * width
            inside = s.support / sizes[c]
            out.append((c, s.attribute, s.bins and s.bins[0], s.bins and s.bins[1], low, high, s.values, s.support,
                        max(0.0, 1 - (s.everywhere / rows_all) / inside), supports[c], supports[c] / sizes[c]))
    return spark.createDataFrame(out, SCHEMA)


def _inside(boxed: dict[int, list[Side]]) -> Column:
    """True for rows in the box of their own cluster."""
    any_box = F.lit(False)
    for c, own in boxed.items():
        box = F.col("__c") == c
        for s in own:
            box = box & (F.col(s.attribute).between(*s.bins) if s.bins else F.col(s.attribute).isin(s.values))
        any_box = any_box | F.coalesce(box, F.lit(False))
    return any_box
