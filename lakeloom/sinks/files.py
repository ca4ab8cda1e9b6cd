"""File sinks: lossless bronze CSV, raw CSV, lakehouse tables (optionally partitioned)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lakeloom.sources.files import BRONZE_CSV_OPTIONS, BRONZE_WRITE_EXTRA, RAW_CSV_OPTIONS


def write_bronze_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Pipe-separated bronze text that ``read_bronze_csv`` reads back unchanged (K1, D3)."""
    df.write.mode(mode).options(**BRONZE_CSV_OPTIONS).options(**BRONZE_WRITE_EXTRA).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", **options: str) -> None:
    """Comma-separated CSV with the raw-source quoting rules."""
    opts = {k: v for k, v in RAW_CSV_OPTIONS.items() if k != "mode"}
    df.write.mode(mode).options(**opts).options(**options).csv(path)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    dynamic_overwrite: bool = False,
    rebalance: bool = False,
) -> None:
    """External lakehouse table by path (K2/K3).

    ``dynamic_overwrite`` replaces only the partitions present in ``df`` (incremental
    loads of a year-partitioned fact) instead of the whole table. ``rebalance`` adds AQE's
    ``REBALANCE`` on the partition columns: one more shuffle, but files of even size per
    partition value, and a hot value (a year with a third of the rows) is split across
    tasks instead of landing in one.
    """
    if rebalance and partition_by:
        df = df.hint("rebalance", *partition_by)
    w = df.write.format(fmt).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if dynamic_overwrite:
        w = w.option("partitionOverwriteMode", "dynamic")
    w.save(path)


def write_counted(df: DataFrame, write, name: str = "rows") -> int:
    """Run ``write(df_observed)`` and return its row count from the same job.

    The count is an ``Observation`` metric collected while writing, so the shape print
    of the reference no longer costs a second full execution. Like any accumulator it is
    informational: a stage re-executed after an executor loss may count its rows twice.
    """
    obs = Observation(name)
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    write(observed)
    return int(obs.get["rows"])
