"""Association rules: level-wise Apriori with item aggregates.

Input is transactional: ``(txn, item)`` or ``(txn, item, value)``; a
(txn, item) pair appearing on several rows counts once and its values
are summed (``ASSO_AGGREGATES``).

Plan per level k (all distributed; the driver only holds frequent
itemsets, whose number is bounded by ``avg basket size / min_support``):

* k = 1: ``groupBy(item)`` counts of distinct transactions.
* k >= 2: candidates are generated from the frequent (k-1)-itemsets by
  the Apriori join + prune (driver-side, on itemsets, not on rows).  The
  rows are hash-partitioned and sorted by transaction once; each task counts
  every candidate over slices of its own transactions by matrix products
  (see :func:`count_candidates`) and a ``groupBy`` sums the partial counts.
  No pairs of items inside a transaction are enumerated and the row volume
  is never multiplied by the candidates.
* rules ``A => c`` (single consequent) are built with joins on itemset
  keys: support, confidence, lift, coverage, reverse confidence, count,
  and the summed value of the consequent over supporting transactions.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.plans.model import MiningModel
from quarry.session import PARTITIONS_A_CORE

BROADCAST_MAX_BYTES = 8 << 20
ROWS_A_TASK = 2_000_000


def itemset_key(items) -> tuple[str, ...]:
    return tuple(sorted(items))


def shown(items) -> str:
    """An itemset as text, for reading only: keys are arrays, so an item may hold a comma."""
    return ",".join(items)


@dataclass
class AssociationModel(MiningModel):
    n_txn: int = 0
    itemsets: DataFrame | None = None   # items (sorted array), itemset, number_of_items, count, support
    itemset_values: DataFrame | None = None  # items, itemset, item, value_sum
    rules: DataFrame | None = None
    frequent: dict = field(default_factory=dict)  # sorted tuple of items -> count (driver copy, bounded)

    def top_itemsets(self, n: int, ascending_support: bool = True) -> DataFrame:
        """GET_FREQUENT_ITEMSETS(model, n): ordered by size then support.

        The reference demo sorts support ascending; pass False for the
        most frequent ones.
        """
        s = F.col("support").asc() if ascending_support else F.col("support").desc()
        return self.itemsets.orderBy(F.col("number_of_items").asc(), s, F.col("itemset").asc()).limit(n)

    def top_rules(self, n: int) -> DataFrame:
        """Rules by confidence desc, support desc (key as tie-break)."""
        return self.rules.orderBy(F.col("confidence").desc(), F.col("support").desc(),
                                  F.col("antecedent").asc(), F.col("consequent").asc()).limit(n)


class Apriori:
    DEFAULTS = {"ASSO_MIN_SUPPORT": 0.1, "ASSO_MIN_CONFIDENCE": 0.1, "ASSO_MAX_RULE_LENGTH": 4,
                "ASSO_MIN_REV_CONFIDENCE": 0.0, "ASSO_MIN_SUPPORT_INT": 1}

    def __init__(self, min_support: float = 0.1, min_confidence: float = 0.1,
                 max_rule_length: int = 4, min_rev_confidence: float = 0.0,
                 min_support_int: int = 1, name: str = "ar_model"):
        self.min_support = min_support
        self.min_confidence = min_confidence
        self.max_len = max_rule_length
        self.min_rev_confidence = min_rev_confidence
        self.min_support_int = min_support_int
        self.name = name

    def fit(self, df: DataFrame, txn: str, item: str, value: str | None = None) -> AssociationModel:
        spark = df.sparkSession
        val = F.col(value).cast("double") if value else F.lit(None).cast("double")
        base = (df.select(F.col(txn).alias("txn"), F.col(item).cast("string").alias("item"), val.alias("v"))
                .filter(F.col("item").isNotNull())
                .groupBy("txn", "item").agg(F.sum("v").alias("v")))
        # partitions of at most some ROWS_A_TASK rows, with every transaction in one piece
        parts = max(PARTITIONS_A_CORE * spark.sparkContext.defaultParallelism, -(-df.count() // ROWS_A_TASK))
        base = base.repartition(parts, "txn").sortWithinPartitions("txn").persist()
        n_txn = base.select("txn").distinct().count()
        min_count = max(self.min_support_int, _ceil_count(self.min_support, n_txn))

        # level 1
        l1 = base.groupBy("item").agg(F.count(F.lit(1)).alias("cnt"), F.sum("v").alias("vsum")) \
            .filter(F.col("cnt") >= min_count)
        l1_rows = l1.collect()
        frequent = {(r["item"],): int(r["cnt"]) for r in l1_rows}
        level_keys = [(r["item"],) for r in l1_rows]
        values = [((r["item"],), r["item"], r["vsum"]) for r in l1_rows]
        # rows of frequent items only, as codes (join with a table bounded by the frequent-item count)
        size = sum(len(r["item"].encode()) + 16 for r in l1_rows)
        codes = {r["item"]: i for i, r in enumerate(l1_rows)}
        fitems = spark.createDataFrame(list(codes.items()), "item string, code int")
        rows = base.join(F.broadcast(fitems), "item") if size <= BROADCAST_MAX_BYTES else \
            base.join(fitems, "item").repartition(parts, "txn").sortWithinPartitions("txn")

        k = 2
        while level_keys and k <= self.max_len:
            cands = _candidates(level_keys)
            if not cands:
                break
            kept_rows = count_candidates(rows, codes, cands, min_count)
            kept = {int(r["cand_id"]): int(r["cnt"]) for r in kept_rows}
            if not kept:
                break
            level_keys = [cands[i] for i in sorted(kept)]
            for i, c in kept.items():
                frequent[itemset_key(cands[i])] = c
            if value:
                for r in kept_rows:
                    c = cands[int(r["cand_id"])]
                    values += [(itemset_key(c), c[j], r[f"v{j}"]) for j in range(k)]
            k += 1
        base.unpersist()

        model = AssociationModel(
            name=self.name, function="ASSOCIATION", algorithm="ALGO_APRIORI_ASSOCIATION_RULES",
            settings={"ASSO_MIN_SUPPORT": self.min_support, "ASSO_MIN_CONFIDENCE": self.min_confidence,
                      "ASSO_MAX_RULE_LENGTH": self.max_len, "ASSO_MIN_REV_CONFIDENCE": self.min_rev_confidence,
                      "ASSO_MIN_SUPPORT_INT": self.min_support_int,
                      **({"ASSO_AGGREGATES": value} if value else {})},
            default_settings=dict(self.DEFAULTS), n_txn=n_txn, frequent=frequent)
        model.itemsets = spark.createDataFrame(
            [(list(key), shown(key), len(key), cnt, cnt / n_txn) for key, cnt in frequent.items()],
            "items array<string>, itemset string, number_of_items int, count long, support double")
        model.itemset_values = spark.createDataFrame(
            [(list(key), shown(key), item, v) for key, item, v in values],
            "items array<string>, itemset string, item string, value_sum double")
        model.rules = self._rules(model)
        model.add_view("I", lambda: model.itemsets, "Association Rules Itemsets")
        model.add_view("R", lambda: model.rules, "Association Rules")
        model.add_view("T", lambda: model.itemset_values, "Itemset aggregates")
        return model

    def _rules(self, model: AssociationModel) -> DataFrame:
        """Rules A => c from every frequent itemset of size >= 2 (joins on itemset keys)."""
        iset = model.itemsets
        big = iset.filter(F.col("number_of_items") >= 2).select(
            "items", "itemset", F.col("count").alias("rule_count"), "support")
        split = big.select("itemset", "rule_count", "support",
                           F.explode("items").alias("consequent"), "items")
        split = split.withColumn("antecedent_items", F.array_remove("items", F.col("consequent")))  # stays sorted
        ante = iset.select(F.col("items").alias("antecedent_items"), F.col("itemset").alias("antecedent"),
                           F.col("support").alias("coverage"))
        cons = iset.filter(F.col("number_of_items") == 1).select(
            F.col("items")[0].alias("consequent"), F.col("support").alias("cons_support"))
        vals = model.itemset_values.select("items", F.col("item").alias("consequent"),
                                           F.col("value_sum").alias("consequent_value"))
        r = (split.join(ante, "antecedent_items").join(cons, "consequent")
             .join(vals, ["items", "consequent"], "left")
             .select("antecedent", "antecedent_items", "consequent", "itemset", "rule_count", "support",
                     (F.col("support") / F.col("coverage")).alias("confidence"),
                     (F.col("support") / F.col("cons_support")).alias("reverse_confidence"),
                     (F.col("support") / F.col("coverage") / F.col("cons_support")).alias("lift"),
                     "coverage", "consequent_value",
                     (F.size("items") - 1).alias("antecedent_size")))
        return r.filter((F.col("confidence") >= self.min_confidence) &
                        (F.col("reverse_confidence") >= self.min_rev_confidence))


CELLS = 1 << 20      # of a slice's transactions x items
PREFIX_CHUNK = 64


def count_candidates(rows: DataFrame, codes: dict, cands: list[tuple], min_count: int):
    """Support count (and per-member value sums) of every candidate itemset.

    ``rows`` (txn, code, v) holds frequent items by their ``codes``, partitioned and sorted by txn.  Each task
    takes its transactions in slices of at most ``CELLS`` transactions x items, as 0/1 matrix P and value
    matrix V.  Candidates share prefixes (all items but the last): with M the product of a prefix' columns,
    M'P counts them with every last item, M'V adds up the last item's values and (M V_j)'P those of prefix
    member j - so no item pairs are emitted and no candidate/row join is materialized.  Partial counts are
    summed by a ``groupBy(cand_id)``.  Task memory is bounded by a slice and the candidates, whatever the
    partition's size.
    """
    import numpy as np
    import pyarrow as pa

    k = len(cands[0])
    items = sorted({it for c in cands for it in c})
    index = {it: i for i, it in enumerate(items)}
    column = np.full(len(codes) + 1, -1)
    for it, i in index.items():
        column[codes[it]] = i
    cand_idx = np.array([[index[it] for it in c] for c in cands], dtype=np.int64)
    prefixes, prefix_of = np.unique(cand_idx[:, :-1], axis=0, return_inverse=True)
    prefix_of = prefix_of.ravel()
    by_chunk = [np.flatnonzero(prefix_of // PREFIX_CHUNK == c) for c in range(-(-len(prefixes) // PREFIX_CHUNK))]
    size = max(1, CELLS // len(items))

    def add(sums, row, code, value, n):
        present, vals = np.zeros((n, len(items))), np.zeros((n, len(items)))
        present[row, code] = 1.0
        vals[row, code] = value
        for c, own in enumerate(by_chunk):
            pre = prefixes[c * PREFIX_CHUNK:(c + 1) * PREFIX_CHUNK]
            both = present[:, pre[:, 0]]
            for j in range(1, k - 1):
                both = both * present[:, pre[:, j]]
            at = prefix_of[own] - c * PREFIX_CHUNK, cand_idx[own, -1]
            sums[0, own] += (both.T @ present)[at]
            for j in range(k - 1):
                sums[1 + j, own] += ((both * vals[:, pre[:, j]]).T @ present)[at]
            sums[k, own] += (both.T @ vals)[at]

    def whole(batches):
        """(transaction number, item, value) of whole transactions of at least k items, batch by batch."""
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if rest is None else [rest, batch]).combine_chunks()
            txn = table.column("txn").combine_chunks().dictionary_encode(null_encoding="encode")
            ids = txn.indices.to_numpy(zero_copy_only=False)
            first = np.flatnonzero(ids != ids[-1:])
            cut = int(first[-1]) + 1 if len(first) else 0   # the last transaction may go on in the next batch
            rest = table.slice(cut).combine_chunks().to_batches()[0] if cut < table.num_rows else None
            if cut:
                yield read(table.slice(0, cut), ids[:cut])
        if rest is not None:
            yield read(rest, np.zeros(rest.num_rows, np.int64))

    def read(table, ids):
        item = column[np.asarray(table.column("code"))]
        value = np.asarray(table.column("v").fill_null(0.0))
        keep = item >= 0
        _, row, n = np.unique(ids[keep], return_inverse=True, return_counts=True)
        item, value, full = item[keep], np.where(np.isnan(value[keep]), 0.0, value[keep]), n >= k
        keep = full[row]
        return (np.cumsum(full) - 1)[row[keep]], item[keep], value[keep], int(full.sum())

    def count(batches):
        sums = np.zeros((k + 1, len(cand_idx)))
        for row, item, value, n in whole(b for b in batches if b.num_rows):
            for start in range(0, n, size):
                at = (row >= start) & (row < start + size) if n > size else slice(None)
                add(sums, row[at] - start, item[at], value[at], min(size, n - start))
        met = np.flatnonzero(sums[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(met.astype(np.int32)), pa.array(sums[0, met].astype(np.int64))] + [pa.array(s[met]) for s in sums[1:]],
            names=["cand_id", "cnt"] + [f"v{j}" for j in range(k)])

    schema = "cand_id int, cnt long, " + ", ".join(f"v{j} double" for j in range(k))
    partial = rows.select("txn", "code", "v").mapInArrow(count, schema)
    return partial.groupBy("cand_id").agg(F.sum("cnt").alias("cnt"),
                                          *[F.sum(f"v{j}").alias(f"v{j}") for j in range(k)]) \
        .filter(F.col("cnt") >= min_count).collect()


def _ceil_count(support: float, n: int) -> int:
    import math
    c = support * n
    return int(math.ceil(c - 1e-9))


def _candidates(prev: list[tuple]) -> list[tuple]:
    """Apriori join (shared k-2 prefix) + prune (every (k-1)-subset frequent)."""
    prev = sorted(tuple(sorted(p)) for p in prev)
    prev_set = set(prev)
    by_prefix: dict = {}
    for p in prev:
        by_prefix.setdefault(p[:-1], []).append(p[-1])
    out = []
    for prefix, lasts in by_prefix.items():
        lasts = sorted(lasts)
        for i in range(len(lasts)):
            for j in range(i + 1, len(lasts)):
                c = prefix + (lasts[i], lasts[j])
                if all(s in prev_set for s in combinations(c, len(c) - 1)):
                    out.append(c)
    return out


def basket_stats(df: DataFrame, txn: str, item: str) -> DataFrame:
    """Cardinalities and density of the transaction x item matrix (one row)."""
    return df.agg(F.countDistinct(txn).alias("n_txn"), F.countDistinct(item).alias("n_items"),
                  F.count(F.lit(1)).alias("n_rows")).select(
        "n_txn", "n_items", "n_rows",
        (100.0 * F.col("n_rows") / (F.col("n_txn") * F.col("n_items"))).alias("density"))


def avg_items_per_txn(df: DataFrame, txn: str, item: str) -> DataFrame:
    """Aggregate of an aggregate: average item rows per transaction."""
    return df.groupBy(txn).agg(F.count(item).alias("cp")).agg(F.avg("cp").alias("avg_items"))
