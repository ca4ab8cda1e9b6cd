"""Scan-parallelism guard for per-row heavy operators.

The unpivot passes multiply rows by columns before their first aggregation. On a large
table the scan already has thousands of splits and nothing needs to happen. When an
input arrives in fewer partitions than the cluster has cores (a small table, one
unsplittable file, a single row group), the whole expansion would run in those few tasks;
then, and only then, the (already projected) rows are spread round-robin first.
Round-robin repartitioning sorts rows before distributing them, so a retried task
produces the same partitions after an executor loss.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


# Inputs estimated below this size stay as they are: one task handles them quickly and a
# redistribution would only add a stage.
MIN_SPREAD_BYTES = 64 << 10
_SHUFFLES = re.compile(r"\b(Aggregate|Join|Window|Sort|Repartition\w*|RebalancePartitions|Distinct|GlobalLimit|FlatMap\w+)\b")


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of the optimized plan (file sizes for scans; no job runs)."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # Spark Connect or an unsupported plan
        return None


def scans_only(df: DataFrame) -> bool:
    """Whether ``df`` is no more than files read, filtered and projected: cheap to read again, and the same rows."""
    try:
        nodes = str(df._jdf.queryExecution().optimizedPlan()).splitlines()
    except Exception:  # Spark Connect
        return False
    return all(re.match(r"[ :+-]*(Project|Filter|Relation) ", n) for n in nodes)


def spread(df: DataFrame, min_partitions: int | None = None, min_bytes: int = MIN_SPREAD_BYTES) -> DataFrame:
    try:
        target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        if _SHUFFLES.search(str(df._jdf.queryExecution().optimizedPlan())):
            return df  # the partitions of a shuffle are known only after it has run
        current = df.rdd.getNumPartitions()  # of a scan: its file splits, no job runs
    except Exception:  # Spark Connect: no RDD access, leave partitioning to the scan
        return df
    if current >= target:
        return df
    size = estimated_bytes(df)
    if size is not None and size < min_bytes:
        return df
    return df.repartition(target)
