"""Attribute importance: supervised MDL (EXPLAIN) and pairwise KL dependency.

Both reduce the data to small histograms with one distributed aggregate
(the rows are unpivoted to (attribute, value, target) and counted; the
shuffled volume is attributes x values x classes), then do the entropy
arithmetic on those histograms - still as DataFrame operations.

MDL score [design]: for target T with k classes, attribute A with V_A
observed values (numeric attributes: equi-width bins), N rows with both
present::

    gain    = H(T) - H(T | A)                  (bits per row)
    penalty = (V_A - 1) * (k - 1) * log2(N) / (2 N)
    value   = max(0, (gain - penalty) / H(T))

so 0 means "explains nothing beyond its own description cost".  Ranks are
dense over the value descending, ties (e.g. all zeros) share a rank.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.scalar import equi_width_bin
from quarry.plans.model import attribute_roles

LOG2 = 0.6931471805599453  # ln 2


def keyed_attributes(df: DataFrame, attrs: list[str], numeric: list[str], bins: int):
    """Columns with each attribute as a string key (numeric -> equi-width bin on the data range)."""
    ranges = {}
    if numeric:
        row = df.agg(*[F.min(F.col(a).cast("double")).alias(f"lo{i}") for i, a in enumerate(numeric)],
                     *[F.max(F.col(a).cast("double")).alias(f"hi{i}") for i, a in enumerate(numeric)]).collect()[0]
        ranges = {a: (row[f"lo{i}"], row[f"hi{i}"]) for i, a in enumerate(numeric)}
    cols = []
    for a in attrs:
        if a in ranges:
            cols.append(equi_width_bin(a, ranges[a][0], ranges[a][1], bins).cast("string").alias(a))
        else:
            cols.append(F.col(a).cast("string").alias(a))
    return cols, ranges


def explain(df: DataFrame, target: str, exclude: list[str] | None = None, bins: int = 10) -> DataFrame:
    """EXPLAIN: (attribute_name, explanatory_value, rank)."""
    exclude = list(exclude or [])
    numeric, categorical = attribute_roles(df, exclude + [target])
    attrs = numeric + categorical
    data = df.filter(F.col(target).isNotNull())
    cols, _ = keyed_attributes(data, attrs, numeric, bins)
    keyed = data.select(F.col(target).cast("string").alias("__t"), *cols)
    long = keyed.unpivot("__t", attrs, "attr", "val").filter(F.col("val").isNotNull())
    h = long.groupBy("attr", "val", "__t").agg(F.count(F.lit(1)).alias("n"))
    return mdl_from_histogram(h)


def mdl_from_histogram(h: DataFrame) -> DataFrame:
    """MDL importance from counts (attr, val, __t, n)."""
    wa = Window.partitionBy("attr")
    wav = Window.partitionBy("attr", "val")
    wat = Window.partitionBy("attr", "__t")
    # every window here is over one attribute's histogram (values x classes rows)
    x = h.select("attr", "val", "__t", "n",
                 F.sum("n").over(wa).alias("tot"),
                 F.sum("n").over(wav).alias("n_v"),
                 F.sum("n").over(wat).alias("n_t"))
    per_attr = x.groupBy("attr").agg(
        F.max("tot").alias("tot"),
        # H(T|A) * N  = - sum n_vt log2(n_vt / n_v)
        (-F.sum(F.col("n") * F.log(F.col("n") / F.col("n_v")))).alias("hc_nats"),
        F.countDistinct("val").alias("V"),
        F.countDistinct("__t").alias("K"))
    ht = x.select("attr", "__t", "n_t", "tot").distinct().groupBy("attr").agg(
        (-F.sum(F.col("n_t") * F.log(F.col("n_t") / F.col("tot")))).alias("h_nats"))
    j = per_attr.join(ht, "attr")
    N = F.col("tot").cast("double")
    gain = (F.col("h_nats") - F.col("hc_nats")) / N / F.lit(LOG2)
    penalty = (F.col("V") - 1) * (F.col("K") - 1) * (F.log(N) / F.lit(LOG2)) / (2.0 * N)
    htb = F.col("h_nats") / N / F.lit(LOG2)
    value = F.when(htb <= 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), (gain - penalty) / htb))
    out = j.select(F.col("attr").alias("attribute_name"), value.alias("explanatory_value"))
    return out.withColumn("rank", F.dense_rank().over(Window.orderBy(F.col("explanatory_value").desc())))


def pairwise_kl(df: DataFrame, attrs: list[str] | None = None, exclude: list[str] | None = None,
                bins: int = 10) -> DataFrame:
    """KL(P(a, b) || P(a) P(b)) (mutual information, nats) for every attribute pair.

    One scan: each row emits one (a, b, value_a, value_b) entry per attribute
    *pair of the schema* (p (p-1) / 2 entries - fixed by the column list, not
    by the data), then a single groupBy counts the joint histograms.
    """
    exclude = list(exclude or [])
    numeric, categorical = attribute_roles(df, exclude)
    attrs = attrs or (numeric + categorical)
    numeric = [a for a in numeric if a in attrs]
    cols, _ = keyed_attributes(df, attrs, numeric, bins)
    keyed = df.select(*cols)
    pairs = [(a, b) for i, a in enumerate(attrs) for b in attrs[i + 1:]]
    entries = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"),
                                 F.col(a).alias("va"), F.col(b).alias("vb")) for a, b in pairs])
    joint = keyed.select(F.inline(entries)).filter(F.col("va").isNotNull() & F.col("vb").isNotNull()) \
        .groupBy("a", "b", "va", "vb").agg(F.count(F.lit(1)).alias("n"))
    wp = Window.partitionBy("a", "b")
    x = joint.select("a", "b", "va", "vb", "n",
                     F.sum("n").over(wp).alias("tot"),
                     F.sum("n").over(Window.partitionBy("a", "b", "va")).alias("na"),
                     F.sum("n").over(Window.partitionBy("a", "b", "vb")).alias("nb"))
    kl = x.groupBy("a", "b").agg(
        F.sum((F.col("n") / F.col("tot")) * F.log(F.col("n") * F.col("tot") / (F.col("na") * F.col("nb"))))
        .alias("kl"))
    return kl.select(F.col("a").alias("attribute_1"), F.col("b").alias("attribute_2"), "kl")
