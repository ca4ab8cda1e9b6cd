"""Exact de-duplication by a tree merge of sorted digest runs.

Every scan partition normalises its texts, hashes them (SHA-256 plus normalised length, so a
digest clash of texts of different length is still told apart) and sorts its rows into a run
that keeps one row per digest: the best survivor so far and the number of rows it stands for.
Runs then meet in rounds of a radix-``fan_in`` recursive halving: in round r each slot hands
the rows whose digest range lies elsewhere to the ``fan_in`` slots that differ from it in
digit r only, and every slot merges the ``fan_in`` sorted pieces it gets, keeping the verified
smallest identifier again. After log(slots) rounds slot s holds the merged run of the s-th
digest range. A text copied a billion times is one row per run from the first level on, so no
round has a hot slot, and no task ever holds more than its sorted, spillable run.

Defined cases: a null text counts as empty; empty and all-white texts are equal; rows that
repeat a doc_id are separate members of their group (each repeats ``keep_id``); a null doc_id
loses every tie; an empty table gives an empty result; only doc_id and text are read, so extra
columns cannot clash.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm._shared import WHITE, lean, shuffle_partitions, staged

_MARKS = "doc_id long, digest binary, norm_bytes long, points long, run int"
_RUN = "slot int, digest binary, norm_bytes long, points long, keep_id long, n long"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    run = TaskContext.get().partitionId()
    for b in batches:
        text = pc.fill_null(b.column(1).cast(pa.string()), "")
        plain = [t.translate(None, WHITE) for t in text.cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                b.column(0),
                pa.array([hashlib.sha256(t).digest() for t in plain], pa.binary()),
                pa.array([len(t) for t in plain], pa.int64()),
                pc.utf8_length(text).cast(pa.int64()),
                pa.array([run] * len(plain), pa.int32()),
            ],
            names=["doc_id", "digest", "norm_bytes", "points", "run"],
        )


def _merge_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per (slot, digest, norm_bytes) of rows sorted by these, best survivor first."""
    head, total = None, 0
    for b in batches:
        out = []
        for row in zip(*(c.to_pylist() for c in b.columns)):
            if head is not None and row[:3] == head[:3]:
                total += row[5]
                continue
            if head is not None:
                out.append((*head[:5], total))
            head, total = row, row[5]
        yield _rows(out)
    if head is not None:
        yield _rows([(*head[:5], total)])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * 6
    kinds = (pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
    names = ["slot", "digest", "norm_bytes", "points", "keep_id", "n"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)


def _merged(runs: DataFrame) -> DataFrame:
    ordered = runs.sortWithinPartitions(
        "slot", "digest", "norm_bytes", F.desc("points"), F.asc_nulls_last("keep_id")
    )
    return ordered.mapInArrow(lean(_merge_runs), _RUN)


def digest_marks(docs: DataFrame) -> DataFrame:
    """doc_id, digest, norm_bytes, points and the run (scan partition) of every row."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lean(_digests), _MARKS)


def merge_tree(marks: DataFrame, fan_in: int = 16) -> DataFrame:
    """(digest, norm_bytes, keep_id, n): the survivor of every digest."""
    parts = shuffle_partitions(marks.sparkSession)
    rounds = max(1, math.ceil(math.log(max(parts, 2), fan_in)))
    slots = fan_in**rounds
    runs = _merged(
        marks.select(
            F.pmod("run", F.lit(slots)).cast("int").alias("slot"), "digest", "norm_bytes", "points",
            F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("n"),
        )
    )
    # the slot that finally owns a digest: its first four bytes, scaled to the number of slots
    first = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long")
    owner = F.floor(first * slots / F.lit(2**32)).cast("int")
    for r in range(rounds):
        step = fan_in**r
        mine, there = F.floor(F.col("slot") / step) % fan_in, F.floor(owner / step) % fan_in
        runs = _merged(
            runs.withColumn("slot", (F.col("slot") + (there - mine) * step).cast("int")).repartition(parts, "slot")
        )
    return runs.select("digest", "norm_bytes", "keep_id", "n")


def exact_dedup(docs: DataFrame, fan_in: int = 16) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per input row."""
    marks = staged(digest_marks(docs), "digests")
    best = merge_tree(marks, fan_in)
    return marks.select("doc_id", "digest", "norm_bytes").join(best, ["digest", "norm_bytes"]).select(
        "doc_id",
        "keep_id",
        F.col("n").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def survivors(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``found = exact_dedup(docs)`` keeps; repeated rows once."""
    digest = F.sha2(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", "").cast("binary"), 256)
    keep = found.where("kept").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha")).distinct()
    marked = docs.withColumn("__digest", digest)
    kept = marked.join(keep, F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.col("__digest") == F.col("__sha")), "left_semi")
    # repeats of one id: the longest text, then the smallest, whichever task reads it first
    first = Window.partitionBy("doc_id", "__digest").orderBy(F.length("text").desc_nulls_last(), "text")
    return kept.withColumn("__copy", F.row_number().over(first)).where("__copy = 1").select(*docs.columns)


ORACLE_SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), k AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM k
"""
