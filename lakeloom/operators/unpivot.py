"""The shared profiling passes.

Pass A (``column_counts``): one scan, one aggregate row, every per-column scalar
(rows, non-null) at once, turned long on the tiny result.

Pass B (``value_frequencies``): unpivot cells to (column, key) and count each pair with
a map-side partial aggregate, then summarise per column. A hot value (even a third of
all rows) collapses to one row per map task before the exchange; the per-column
summary is again a partial+final aggregate, so no task ever receives a whole column.
Long text is grouped by a SHA-256 digest + length (fixed 70 bytes) instead of the text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from lakeloom.functions.values import DIGEST_OVER, _sql_name, canonical_text_sql, group_key, is_digest, key_start, is_scalar, key_text, text_of, typed_key
from lakeloom.operators.parallel import spread
from lakeloom.operators.transforms import q


def _lit(text: str) -> str:
    """A Spark SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def column_counts(df: DataFrame, columns: Sequence[str] | None = None, table: str | None = None) -> DataFrame:
    """Long (column, rows, non_null) for each column in one aggregate (Pass A).

    Expressions are built as SQL text: one driver call per expression instead of a tree
    of Column calls per column, which matters on wide tables.
    """
    cols = list(df.columns if columns is None else columns)
    aggs = [F.expr("count(1) AS __rows")]
    aggs += [F.expr(f"count({_sql_name(c)}) AS __nn{i}") for i, c in enumerate(cols)]
    one = df.agg(*aggs)
    if not cols:
        return one.select(F.lit(None).cast("string").alias("column"), F.col("__rows").alias("rows"),
                          F.lit(0).cast("bigint").alias("non_null")).where(F.lit(False))
    entries = ", ".join(f"named_struct('column', {_lit(c)}, 'non_null', __nn{i})" for i, c in enumerate(cols))
    out = one.select(F.col("__rows").alias("rows"), F.expr(f"inline(array({entries}))")).select(
        "column", "rows", "non_null")
    if table is not None:
        out = out.select(F.lit(table).alias("table_name"), "*")
    return out


def _element_cell(column: str, elem_type):
    """Lambda for ``transform``: an array element as a (column, value) cell."""
    return lambda x: F.struct(F.lit(column).alias("column"), text_of(x, elem_type).alias("value"))


def long_cells(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    explode_arrays: bool = True,
    digest_over: int | None = DIGEST_OVER,
    keep_value: bool = False,
) -> DataFrame:
    """(column, key[, value]) per non-null cell; array cells contribute their elements (X11)."""
    cols = list(df.columns if columns is None else columns)
    pieces: list[Column] = []
    for c in cols:
        dt = df.schema[c].dataType
        if isinstance(dt, ArrayType) and explode_arrays:
            elem = dt.elementType
            pieces.append(
                F.coalesce(
                    F.transform(q(c), _element_cell(c, elem)),
                    F.array().cast("array<struct<column:string,value:string>>"),
                )
            )
        elif is_scalar(dt):
            pieces.append(F.expr(f"array(named_struct('column', {_lit(c)}, 'value', CAST({_sql_name(c)} AS STRING)))"))
        else:
            pieces.append(F.array(F.struct(F.lit(c).alias("column"), F.expr(canonical_text_sql(_sql_name(c), dt)).alias("value"))))
    if not pieces:
        return df.sparkSession.createDataFrame([], "column string, key string, value string")
    src = spread(df.select(*[q(c) for c in cols]))
    cells = src.select(F.inline(F.concat(*pieces))).where(F.col("value").isNotNull())
    key = group_key(F.col("value"), digest_over)
    sel = [F.col("column"), key.alias("key")]
    if keep_value:
        sel.append(F.col("value"))
    return cells.select(*sel)


def value_frequencies(cells: DataFrame, extra_keys: Sequence[str] = ()) -> DataFrame:
    """(extra..., column, key, cnt): one shuffle with map-side combine."""
    return cells.groupBy(*extra_keys, "column", "key").agg(F.count(F.lit(1)).alias("cnt"))


def column_summary(freq: DataFrame, extra_keys: Sequence[str] = ()) -> DataFrame:
    """Per column: distinct values, non-null cells, highest frequency and its value.

    ``top_key`` is the smallest key among the most frequent ones (deterministic ties, D6);
    where it is a digest, ``tied_keys`` gives all keys its text may have to be chosen from.
    """
    return freq.groupBy(*extra_keys, "column").agg(
        F.count(F.lit(1)).alias("distinct"),
        F.sum("cnt").alias("cells"),
        F.max("cnt").alias("max_freq"),
        F.min(F.struct((-F.col("cnt")).alias("neg"), F.col("key").alias("key"))).alias("__top"),
    ).select(*extra_keys, "column", "distinct", "cells", "max_freq", F.col("__top.key").alias("top_key"))


def tied_keys(freq: DataFrame, summary: DataFrame, digest_over: int | None = DIGEST_OVER) -> DataFrame:
    """(column, key): the top key, or all most frequent keys whose long texts start alike."""
    top = summary.select(F.col("column").alias("__c"), "max_freq", "top_key")
    same = (F.col("column") == F.col("__c")) & (F.col("cnt") == F.col("max_freq"))
    start = key_start(F.col("key"), digest_over) == key_start(F.col("top_key"), digest_over)
    alike = is_digest(F.col("key"), digest_over) & is_digest(F.col("top_key"), digest_over) & start
    return freq.join(top, same).where((F.col("key") == F.col("top_key")) | alike).select("column", "key")


def resolve_keys(
    df: DataFrame,
    wanted: DataFrame,
    columns: Sequence[str],
    explode_arrays: bool = True,
    digest_over: int | None = DIGEST_OVER,
) -> DataFrame:
    """Map digest keys back to their text: (column, key) -> (column, key, value).

    Only digest keys are looked up, by a semi-join of a second scan; the planner broadcasts
    them where they are measured small. Short keys are their own text and need no lookup.
    """
    digests = wanted.where(is_digest(F.col("key"), digest_over)).select("column", "key").distinct()
    cells = long_cells(df, columns, explode_arrays=explode_arrays, digest_over=digest_over, keep_value=True)
    found = (
        cells.join(digests, ["column", "key"], "left_semi")
        .groupBy("column", "key")
        .agg(F.min("value").alias("value"))
    )
    plain = wanted.where(~is_digest(F.col("key"), digest_over)).select(
        "column", "key", key_text(F.col("key"), digest_over).alias("value"))
    return plain.unionByName(found)


def long_keys(df: DataFrame, columns: Sequence[str], digest_over: int | None = DIGEST_OVER,
              id_offset: int = 0) -> tuple[DataFrame, list[tuple[int, str]]]:
    """Typed keys ``(ci, i, d, s)`` of every non-null cell, one scan for all columns.

    Cheaper than text cells when only equality within a column matters (distinct counts,
    uniqueness): numbers are never formatted, long text is a digest, and only an integer
    column id travels through the shuffle. Returns the cells and the ``(ci, name)`` list.
    """
    entries, names = [], []
    for c in columns:
        ci = id_offset + len(names)
        entries.append(F.struct(F.lit(ci).alias("ci"), typed_key(c, df.schema[c].dataType, digest_over).alias("k")))
        names.append((ci, c))
    if not entries:
        return df.sparkSession.createDataFrame([], "ci int, i bigint, d double, s string"), names
    src = spread(df.select(*[q(c) for _, c in names]))
    cells = src.select(F.inline(F.array(*entries))).where(F.col("k").isNotNull()).select("ci", "k.i", "k.d", "k.s")
    return cells, names


def key_stats(keys: DataFrame) -> DataFrame:
    """(ci, distinct, cells, max_freq) from typed keys: two partial+final aggregates."""
    freq = keys.groupBy("ci", "i", "d", "s").agg(F.count(F.lit(1)).alias("cnt"))
    return freq.groupBy("ci").agg(
        F.count(F.lit(1)).alias("distinct"),
        F.sum("cnt").alias("cells"),
        F.max("cnt").alias("max_freq"),
    )
