"""Helpers shared by the training-data operators.

``staged`` is the lineage cut: a parquet table in the folder the cluster names in
``spark.checkpoint.dir``, so a lost executor costs at most the stages since the last cut and
the real size of the table is known to the planner (a join broadcasts it only when it is
smaller than the session's broadcast limit, and shuffles otherwise).
"""

from __future__ import annotations

import ctypes
import gc
import math
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import lakeloom
from lakeloom.session import checkpoint_root

# The white space of the contracts: [\x20\x09-\x0D]. ``bytes.split()`` splits on the same set.
WHITE = b" \t\n\x0b\x0c\r"


# Whole texts differ by orders of magnitude in size, so batches for Python are bounded by bytes.
BATCH_BYTES = 8 << 20
# Of a job whose stages follow each other on the same executors, see ``small_batches``.
SMALL_BATCH_BYTES = 1 << 20
SMALL_BATCH_ROWS = 512


def ship_package(spark: SparkSession) -> None:
    """Send this package's source to the executors, once per application (a small zip).

    Also bounds the session's Arrow batches by bytes, as row counts alone don't bound memory.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    sc = spark.sparkContext
    if getattr(sc, "_lakeloom_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(lakeloom.__file__))
    made = shutil.make_archive(
        os.path.join(tempfile.mkdtemp(prefix="lakeloom-zip-"), "lakeloom_package"), "zip",
        os.path.dirname(package), os.path.basename(package),
    )
    sc.addPyFile(made)
    sc._lakeloom_shipped = True


def small_batches(spark: SparkSession) -> None:
    """Batches for Python and from Parquet that stay small, for a job of several stages (see ``ship_package``).

    Its executors keep what the largest batch of any stage took - Arrow's buffers outside the heap, the readers'
    columns on it, the worker's copies of the texts. Batches of other bounds give the same rows.
    """
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(SMALL_BATCH_BYTES))
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(SMALL_BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of one table (all rows, whole values)."""
    ship_package(spark)
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/lakeloom/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucket_count(rows: int, per_bucket: int, least: int = 1) -> int:
    """Buckets such that each holds about ``per_bucket`` rows."""
    return max(least, math.ceil(rows / per_bucket))


def unsigned_pmod(value: Column, n: int | Column) -> Column:
    return F.pmod(value, F.lit(n) if isinstance(n, int) else n)


def key_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """(rows, bounds) of whole runs of equal keys, from batches sorted by ``keys`` (integers).

    Run r is ``rows[bounds[r]:bounds[r + 1]]``. Only an unfinished run is held back.
    """
    carry = None
    for b in batches:
        if not b.num_rows:
            continue
        rows = pa.Table.from_batches([b])
        rows = pa.concat_tables([carry, rows]).combine_chunks() if carry is not None else rows
        differ = np.zeros(rows.num_rows - 1, bool)
        for k in keys:
            v = rows.column(k).to_numpy()
            differ |= v[1:] != v[:-1]
        bounds = np.concatenate([[0], np.flatnonzero(differ) + 1])
        if len(bounds) > 1:
            yield rows.slice(0, bounds[-1]), bounds
        carry = rows.slice(bounds[-1])
    if carry is not None:
        yield carry, np.array([0, carry.num_rows])


def binary_matrix(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    """The rows of a binary column of equal lengths as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``run`` for mapInArrow, whose Python worker gives freed memory back to the system at the end of a task.

    Spark keeps workers for the tasks of later stages; what their allocators hold on to would add to those.
    """

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
            if trim:
                trim(0)

    return mapped
