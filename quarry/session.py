"""Spark session helpers.

On a cluster the session is created by the platform and already names a
shared ``spark.checkpoint.dir``; we read it and never replace it.  Only a
local/test session without that setting gets a scratch directory.
"""

from __future__ import annotations

import os
import tempfile

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

PARTITIONS_A_CORE = 2  # of rows that a fit reads again and again


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "quarry") -> SparkSession:
    """Session tuned for this library: AQE on, UTC, Arrow, no UI."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus) * 2
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Python call-site capture for every Column call costs a stack walk;
        # plans with large literal tables build many columns
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", os.environ.get("QUARRY_DRIVER_MEMORY", "16g"))
        # broadcast threshold stays Spark's default (10 MB); explicit
        # broadcasts in this library are size-checked before they are used.
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory, setting a scratch one only if unset.

    ``spark.checkpoint.dir`` is read from the session configuration (a
    cluster sets it to a shared folder).  When absent (tests, local runs)
    a fresh directory under the system temp folder is created; only a local
    master may do without the setting.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return conf_dir
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    local = tempfile.mkdtemp(prefix="quarry-ckpt-")
    sc.setCheckpointDir(local)
    return local


def session_key(spark: SparkSession) -> str:
    """Names the running application; fits and case tables are remembered under it.

    Unlike the address of a session object it is never used again by a later session.
    """
    return spark.sparkContext.applicationId


def hold(rows: DataFrame) -> DataFrame:
    """``rows`` persisted for the passes of a fit, dealt evenly over a fixed number of partitions a core.

    A pass over a persisted join has a task for each of the join's partitions, and every task returns the
    counters of the whole plan behind it (over 20 KB), pass after pass.  Behind this one shuffle a pass
    has few tasks that return little, however large the input; a lost block is made again from the shuffle.
    """
    cores = max(rows.sparkSession.sparkContext.defaultParallelism, 1)
    return rows.repartition(PARTITIONS_A_CORE * cores).persist(StorageLevel.MEMORY_AND_DISK)
