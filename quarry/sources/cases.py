"""Derived case tables built from the driver tables.

These are the stand-ins for the reference's sample schema (see FIXTURES.md):

* ``case360``  one row per customer with demographics-like columns, order
  aggregates and a binary target ``affinity``;
* ``baskets``  transactional (order, brand, amount) rows;
* ``cust_type_map``  star schema with a nested map column per customer;
* ``daily_sales`` / ``hourly_events``  time series;
* ``order_gaps``  interval-censored survival rows.

Every builder is a lazy DataFrame plan: aggregate the fact table first
(partial aggregation happens map-side), then join the much smaller result
to the dimensions.  Dimension tables that are bounded by definition
(nation: 25 rows, region: 5 rows) are broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.scalar import with_totals
from quarry.session import session_key
from quarry.sources.tables import load

# Fixed values of our fixture definitions (FIXTURES.md, derived fixtures).
URGENT_PRIORITY = "1-URGENT"
AFFINITY_MIN_URGENT = 2
SPLIT_BUILD, SPLIT_TEST, SPLIT_APPLY = 0, 1, 2


def case360(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer case table: id ``cust_id``, target ``affinity`` (0/1).

    Columns: cust_id, segment, nation, region, acctbal, n_orders,
    avg_price, sum_qty, last_gap_days, affinity.  Customers without
    orders keep NULL avg_price / last_gap_days (missing values).
    """
    lineitem = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity")
    orders = load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    qty = lineitem.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("qty"))
    max_date = orders.agg(F.max("o_orderdate").alias("max_date"))  # one row
    per_cust = with_totals(
        orders.join(qty, orders.o_orderkey == qty.l_orderkey, "left")
        .groupBy("o_custkey")
        .agg(
            F.count(F.lit(1)).alias("n_orders"),
            # integer cents: exact in any engine and any summation order
            F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("price_cents"),
            F.sum(F.when(F.col("o_orderpriority") == URGENT_PRIORITY, 1).otherwise(0)).alias("n_urgent"),
            F.sum("qty").alias("sum_qty"),
            F.max("o_orderdate").alias("last_order"),
        ), max_date
    ).select(
        "o_custkey", "n_orders", (F.col("price_cents") / F.col("n_orders") / 100.0).alias("avg_price"),
        "n_urgent", "sum_qty",
        F.datediff(F.col("max_date"), F.col("last_order")).alias("last_gap_days"),
    )
    customer = load(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    nation = load(spark, sf_dir, "nation")
    region = load(spark, sf_dir, "region")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "n_name", "r_name")
    return (
        customer.join(F.broadcast(geo), customer.c_nationkey == geo.n_nationkey)
        .join(per_cust, customer.c_custkey == per_cust.o_custkey, "left")
        .select(
            F.col("c_custkey").alias("cust_id"),
            F.col("c_mktsegment").alias("segment"),
            F.col("n_name").alias("nation"),
            F.col("r_name").alias("region"),
            F.col("c_acctbal").alias("acctbal"),
            F.coalesce(F.col("n_orders"), F.lit(0)).cast("bigint").alias("n_orders"),
            F.col("avg_price"),
            F.coalesce(F.col("sum_qty"), F.lit(0.0)).alias("sum_qty"),
            F.col("last_gap_days").cast("bigint").alias("last_gap_days"),
            F.when(F.coalesce(F.col("n_urgent"), F.lit(0)) >= AFFINITY_MIN_URGENT, 1)
            .otherwise(0).cast("int").alias("affinity"),
        )
    )


def split(df: DataFrame, part: int, key: str = "cust_id", parts: int = 3) -> DataFrame:
    """Non-overlapping build/test/apply split by key: ``pmod(key, parts) = part``."""
    return df.filter(F.pmod(F.col(key), F.lit(parts)) == part)


def baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactional 3-column input: (txn_id, item, amount).

    txn = order, item = part brand, amount = summed extended price of the
    brand within the order (value aggregated per (txn, item)).
    """
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    part = load(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return (
        li.join(part, li.l_partkey == part.p_partkey)
        .groupBy(F.col("l_orderkey").alias("txn_id"), F.col("p_brand").alias("item"))
        .agg(F.sum("l_extendedprice").alias("amount"))
    )


def cust_type_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long form of the star-schema nested column: (cust_id, p_type, amount)."""
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    part = load(spark, sf_dir, "part").select("p_partkey", "p_type")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    by_order = (
        li.join(part, li.l_partkey == part.p_partkey)
        .groupBy("l_orderkey", "p_type")
        .agg(F.sum("l_extendedprice").alias("amount"))
    )
    return (
        by_order.join(orders, by_order.l_orderkey == orders.o_orderkey)
        .groupBy(F.col("o_custkey").alias("cust_id"), "p_type")
        .agg(F.sum("amount").alias("amount"))
    )


def cust_type_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Star schema -> case table with a nested map column (p_type -> sum)."""
    return (
        cust_type_sums(spark, sf_dir)
        .groupBy("cust_id")
        .agg(F.map_from_entries(F.collect_list(F.struct("p_type", "amount"))).alias("type_sums"))
    )


def daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(day, amount): orders accumulated per day (gaps not filled here)."""
    o = load(spark, sf_dir, "orders").select("o_orderdate", "o_totalprice")
    return o.groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.sum("o_totalprice").alias("amount"))


def hourly_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_type, hour, n, total): multi-series sensor-like input."""
    e = load(spark, sf_dir, "events").select("event_type", "ts", "value")
    return e.groupBy("event_type", F.date_trunc("hour", "ts").alias("hour")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


def order_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survival rows per order: days to the customer's next order.

    lbound = rbound = gap when a next order exists (exact event); for the
    customer's last order lbound = days to the table's max date and
    rbound = NULL (right-censored, i.e. infinity).
    """
    from quarry.operators.scan import next_in_group

    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate",
                                             "o_totalprice", "o_orderpriority")
    max_date = o.agg(F.max("o_orderdate").alias("max_date"))
    # next order of the same customer, without a per-customer window (a customer
    # with a large share of the orders spans many range partitions)
    nxt = with_totals(next_in_group(o, "o_custkey", ["o_orderdate", "o_orderkey"], "o_orderdate",
                                    "next_date"), max_date)
    gap = F.datediff("next_date", "o_orderdate").cast("double")
    cens = F.datediff("max_date", "o_orderdate").cast("double")
    return nxt.select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority",
        F.when(F.col("next_date").isNull(), cens).otherwise(gap).alias("lbound"),
        F.when(F.col("next_date").isNull(), F.lit(None).cast("double")).otherwise(gap).alias("rbound"),
    )


# ---------------------------------------------------------------- persisted views
_PERSISTED: dict = {}


def _persisted(builder, spark: SparkSession, sf_dir: str) -> DataFrame:
    """One persisted copy per (session, table folder) of a derived case table.

    The customer table is far smaller than the facts it comes from; the baskets hold one row per order
    and brand, nearly as many as the facts.  Many queries reuse them.  MEMORY_AND_DISK storage; a lost block is recomputed from
    its lineage, so executor loss only costs time.
    """
    from pyspark import StorageLevel
    key = (builder.__name__, session_key(spark), sf_dir)
    if key not in _PERSISTED:
        _PERSISTED[key] = builder(spark, sf_dir).persist(StorageLevel.MEMORY_AND_DISK)
    return _PERSISTED[key]


def case_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Persisted ``case360``."""
    return _persisted(case360, spark, sf_dir)


def basket_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Persisted ``baskets``."""
    return _persisted(baskets, spark, sf_dir)
