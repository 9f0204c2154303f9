"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "trawl", extra: dict | None = None) -> SparkSession:
    """A session with the settings the plans are tuned for.

    AQE stays on so small joins turn into broadcasts at run time, skewed
    shuffle partitions are split, and tiny partitions are coalesced.
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TRAWL_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_SCRATCH: dict[str, str] = {}


def _checkpoint_base(spark: SparkSession) -> str:
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    # One machine, as in tests: a local folder is shared by definition.
    local = tempfile.mkdtemp(prefix="trawl-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for derived tables, under the session's checkpoint dir.

    The checkpoint dir is the folder every executor can read, so written
    tables survive the loss of the executor that wrote them.
    """
    key = spark.sparkContext.applicationId
    if key not in _SCRATCH:
        _SCRATCH[key] = _checkpoint_base(spark).rstrip("/") + "/trawl"
    return f"{_SCRATCH[key]}/{name}-{uuid.uuid4().hex[:12]}"
