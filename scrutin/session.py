"""Session helpers.

Library functions never change session configuration: on a cluster the
driver owns the session.  ``local_session`` is for tests, benches and the
command line only.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "scrutin", extra: dict[str, str] | None = None) -> SparkSession:
    """A local session with the UI off and a loopback driver address."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SCRUTIN_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    if not SparkSession.getActiveSession():
        builder = builder.config(CHECKPOINT_CONF, tempfile.mkdtemp(prefix="scrutin-ckpt-"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins; ``local_session`` makes a scratch
    folder for tests.  Anywhere else an unset folder is an error, because
    executors do not share their own disks.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server owns the folder
        return spark.conf.get(CHECKPOINT_CONF, "")
    configured = sc.getConf().get(CHECKPOINT_CONF, None) or sc.getCheckpointDir()
    if not configured:
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def materialise(df):
    """Cut the lineage of a bounded intermediate table (a summary whose size
    is set by the key space, not by the input) with a reliable checkpoint in
    the session's checkpoint folder, so that several consumers read it once
    instead of recomputing it from the scans."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Operators whose result is worth keeping if several jobs read it.
_COSTLY = ("Join", "Aggregate", "Window", "Sort", "Distinct", "Deduplicate", "Repartition", "MapIn", "FlatMap")


def settled(df):
    """``df`` itself if its plan only reads, filters and projects; else a
    checkpoint of it, so that the jobs of an iterative statistic do not repeat
    its joins and aggregates.  Select the columns that are needed first."""
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    nodes = [line.lstrip(" :+-!'") for line in lines]
    return materialise(df) if any(n.startswith(_COSTLY) for n in nodes) else df
