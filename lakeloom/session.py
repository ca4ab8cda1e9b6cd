"""Session helpers: a local session for tests/bench and the shared scratch folder.

Scratch output (round-trip tables, incremental-load checkpoints, lineage cuts) always
lives under the folder the cluster names in ``spark.checkpoint.dir``. Only when that
setting is missing (a bare local test session) do we create one of our own.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "lakeloom") -> SparkSession:
    """A local session for tests and the benchmark; never used by library operators."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session, set to a fresh temp dir only if unset."""
    sc = getattr(spark, "sparkContext", None)
    current = None
    try:
        current = sc.getCheckpointDir() if sc is not None else None
    except Exception:  # Spark Connect has no SparkContext
        current = None
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        master = sc.master if sc is not None else ""
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="lakeloom-ckpt-")  # one process: tests and the benchmark
        if sc is not None:
            sc.setCheckpointDir(current)
    elif sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique, not yet existing path under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/lakeloom/{name}-{uuid.uuid4().hex[:12]}"


def is_local_path(path: str) -> bool:
    return path.startswith("/") or path.startswith("file:") or os.path.isabs(path)


def written(df, name: str):
    """``df`` written once under the shared checkpoint folder and read back: cuts the lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
