"""Table scans over the Parquet test tables (one file per table)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)

DEFAULT_SF_DIR = "/root/testdata/sf0.01"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one table; Catalyst prunes columns and pushes filters into it."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """CREATE OR REPLACE VIEW for each table, so ``spark.sql`` can use them."""
    for n in names:
        load(spark, sf_dir, n).createOrReplaceTempView(n)


class Tables:
    """Lazy accessor: ``t = Tables(spark, d); t.orders``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return load(self.spark, self.sf_dir, name)
        raise AttributeError(name)
