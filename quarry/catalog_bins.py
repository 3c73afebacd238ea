"""Queries of supervised binning."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.catalog import rnd
from quarry.operators.supervised_bins import fit_supervised_bins
from quarry.sources import cases

COLS = ["acctbal", "n_orders", "avg_price", "sum_qty", "last_gap_days"]


def _bins(spark, sf_dir):
    c = cases.case_table(spark, sf_dir)
    return fit_supervised_bins(c, COLS, "affinity", grid=64, max_level=4), c


def q_supervised_splits(spark, sf_dir):
    """Accepted entropy splits of every numeric attribute for affinity, with their gains."""
    bins, _ = _bins(spark, sf_dir)
    return bins.splits_df(spark).select("attribute_name", "level", "low_cell", "high_cell", "cut_cell",
                                        rnd("gain").alias("gain"))


def q_supervised_bin_counts(spark, sf_dir):
    """Rows and share of the target in every supervised bin of the bought quantity and the number of orders."""
    bins, c = _bins(spark, sf_dir)
    binned = bins.transform(c.select("affinity", "sum_qty", "n_orders")).unpivot(
        ["affinity"], ["sum_qty", "n_orders"], "attribute_name", "bin")
    return binned.groupBy("attribute_name", "bin").agg(F.count("*").alias("n"), rnd(F.avg("affinity")).alias("share"))


QUERIES = {"supervised_splits": q_supervised_splits, "supervised_bin_counts": q_supervised_bin_counts}
