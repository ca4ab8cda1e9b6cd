"""Single-table profilers (R2-R13), re-aimed from in-memory frames to distributed aggregates.

Every profiler returns a long ("tidy") DataFrame, one row per column or per value, so
the report scales with the number of columns instead of growing a wide row.

Kind detection (JSON, markup, dates) needs a rule for *which* rows decide (D1):
``mode="first"`` looks at the first row by ``order_by`` (``min_by``, a partial
aggregate); ``mode="share"`` asks that at least ``threshold`` of the non-null cells match.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StringType

from lakeloom.functions.json import looks_like_json, looks_like_xml
from lakeloom.functions.patterns import is_date_text
from lakeloom.functions.values import (
    DIGEST_OVER,
    _sql_name,
    is_non_numeric,
    is_numeric,
    is_scalar,
    is_temporal,
    typed_key,
)
from lakeloom.operators.parallel import spread
from lakeloom.operators.quantiles import exact_quantiles
from lakeloom.operators.transforms import parse_datetime, q, vote_date_formats
from lakeloom.operators.unpivot import (
    column_counts,
    column_summary,
    key_stats,
    long_cells,
    long_keys,
    resolve_keys,
    tied_keys,
    value_frequencies,
)
from lakeloom.session import checkpoint_root


def head(df: DataFrame, n: int = 5, order_by: Sequence[str] | str | None = None) -> DataFrame:
    """First ``n`` rows by ``order_by`` (R2); a top-n per partition then a merge, no full sort."""
    if order_by is None:
        return df.limit(n)
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    return df.orderBy(*[q(k) for k in keys]).limit(n)


def column_types(df: DataFrame) -> DataFrame:
    """(column, dtype) from the schema (R3, D7); no data is read."""
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column_name string, dtype string")


def shape(df: DataFrame) -> DataFrame:
    """(rows, cols) (R4); the row count is a partial+final count, column count from the schema."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select("rows", F.lit(len(df.columns)).cast("int").alias("cols"))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, null_count, non_null_count, null_ratio_nonnull, null_ratio_rows).

    ``null_ratio_nonnull`` is the reference's nulls / non-null (null when there is no
    non-null value instead of infinity); ``null_ratio_rows`` is nulls / rows.
    """
    cc = column_counts(df, columns)
    nulls = F.col("rows") - F.col("non_null")
    return cc.select(
        F.col("column").alias("column_name"),
        nulls.alias("null_count"),
        F.col("non_null").alias("non_null_count"),
        F.when(F.col("non_null") > 0, nulls / F.col("non_null")).alias("null_ratio_nonnull"),
        F.when(F.col("rows") > 0, nulls / F.col("rows")).alias("null_ratio_rows"),
    )


def non_numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if is_non_numeric(f.dataType)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if is_numeric(f.dataType)]


def describe_non_numeric(df: DataFrame, columns: Sequence[str] | None = None,
                         digest_over: int | None = DIGEST_OVER) -> DataFrame:
    """(column, count, unique, top, freq) over all non-numeric columns (R5, A10, P9). Nulls are not counted.

    Text, booleans, dates and times, binary and nested columns. ``top`` is the smallest of the most
    frequent values (D6) as text, null for binary and nested columns. A column without values has
    a row with no values counted; without such columns there are no rows.
    """
    cols = non_numeric_columns(df) if columns is None else list(columns)
    if not cols:
        return df.sparkSession.createDataFrame([], "column_name string, count long, unique long, top string, freq long")
    named = [c for c in cols if is_scalar(df.schema[c].dataType)]
    freq = value_frequencies(long_cells(df, cols, explode_arrays=False, digest_over=digest_over))
    summary = column_summary(freq)
    of_named = summary.where(F.col("column").isin(named))
    tops = resolve_keys(df, tied_keys(freq, of_named, digest_over), named, explode_arrays=False, digest_over=digest_over)
    every = df.sparkSession.createDataFrame([(c,) for c in cols], "name string").alias("e")  # one row a column
    s = summary.alias("s")
    t = tops.groupBy("column").agg(F.min("value").alias("value")).alias("t")
    joined = every.join(s, F.col("e.name") == F.col("s.column"), "left").join(t, F.col("e.name") == F.col("t.column"), "left")
    return joined.select(
        F.col("e.name").alias("column_name"),
        F.coalesce("s.cells", F.lit(0)).cast("long").alias("count"),
        F.coalesce("s.distinct", F.lit(0)).cast("long").alias("unique"),
        F.col("t.value").alias("top"),
        F.col("s.max_freq").alias("freq"),
    )


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None, digits: int | None = None,
                     **quantile_opts) -> DataFrame:
    """(column, count, mean, std, min, p25, p50, p75, max) over numeric columns.

    Sample standard deviation; exact quantiles with linear interpolation.
    """
    cols = numeric_columns(df) if columns is None else list(columns)
    spark = df.sparkSession
    if not cols:
        return spark.createDataFrame([], "column_name string, count long, mean double, std double, min double, "
                                         "p25 double, p50 double, p75 double, max double")
    aggs = []
    for i, c in enumerate(cols):
        x = f"CASE WHEN NOT isnan(CAST({_sql_name(c)} AS DOUBLE)) THEN CAST({_sql_name(c)} AS DOUBLE) END"
        aggs += [F.expr(f"{fn}({x}) AS {alias}{i}") for fn, alias in
                 (("count", "n"), ("avg", "m"), ("stddev_samp", "s"), ("min", "lo"), ("max", "hi"))]
    # one row of moments: collected once, it also gives the quantile operator its counts
    one = df.agg(*aggs).first()
    rows = [(c, int(one[f"n{i}"]), one[f"m{i}"], one[f"s{i}"], one[f"lo{i}"], one[f"hi{i}"]) for i, c in enumerate(cols)]
    moments = spark.createDataFrame(rows, "column string, count long, mean double, std double, min double, max double")
    qs = exact_quantiles(df, cols, (0.25, 0.5, 0.75), counts={r[0]: r[1] for r in rows}, **quantile_opts)
    wide = qs.groupBy("column").pivot("prob", [0.25, 0.5, 0.75]).agg(F.first("value"))
    wide = wide.toDF("column", "p25", "p50", "p75")
    out = F.broadcast(moments).join(wide, "column", "left")  # one row per numeric column
    stats = ["mean", "std", "min", "p25", "p50", "p75", "max"]
    if digits is not None:
        return out.select(F.col("column").alias("column_name"), "count", *[F.round(s, digits).alias(s) for s in stats])
    return out.select(F.col("column").alias("column_name"), "count", *stats)


def describe_all(df: DataFrame, digits: int | None = None, **quantile_opts) -> DataFrame:
    """All columns in one report, other statistics null (R6: describe of all).

    Non-numeric columns carry count/unique/top/freq, numeric columns count/mean/std/min/quartiles/max.
    """
    text = describe_non_numeric(df)
    nums = describe_numeric(df, digits=digits, **quantile_opts)
    # unique/freq are absent for numeric columns: doubles, as in pandas' mixed describe
    return text.unionByName(nums, allowMissingColumns=True).select(
        "column_name", "count", F.col("unique").cast("double").alias("unique"), "top",
        F.col("freq").cast("double").alias("freq"), "mean", "std", "min", "p25", "p50", "p75", "max",
    )


def duplicate_count(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """(duplicate_qty) = rows - distinct rows, nulls equal to nulls.

    Rows are first counted by a fingerprint of two 64-bit hashes, so what is shuffled is 16 bytes a
    row, and a row repeated a billion times collapses before the exchange. Only rows whose fingerprint
    repeats are then compared by their exact keys (long text as SHA-256, nested values by content).
    """
    cols = list(df.columns if subset is None else subset)
    keys = [typed_key(c, df.schema[c].dataType).alias(f"k{i}") for i, c in enumerate(cols)]
    names = [f"k{i}" for i in range(len(cols))]
    rows = spread(df.select(*[q(c) for c in cols])).select(*keys).select(
        F.xxhash64(*names).alias("h1"), F.xxhash64(F.lit(1), *reversed(names)).alias("h2"), *names)
    again = rows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h1", "h2")
    groups = rows.join(again, ["h1", "h2"], "left_semi").groupBy("h1", "h2", *names).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicate_qty"))


def unique_columns(df: DataFrame, columns: Sequence[str] | None = None, null_is_value: bool = True) -> DataFrame:
    """Columns whose values are all different (R8; with ``null_is_value=False``, M1 rules).

    R8 counts null as one more value: unique iff distinct non-null + (any null) == rows.
    M1 ignores nulls: every non-null value occurs once and there is at least one.
    Values are exact: decimals by all their digits, NaN is a value, nested and binary values by content.
    """
    cols = list(df.columns if columns is None else columns)
    cc = column_counts(df, cols)
    keys, ids = long_keys(df, cols)
    ids_df = df.sparkSession.createDataFrame(ids, "ci int, column string")
    summary = key_stats(keys).join(F.broadcast(ids_df), "ci").select("column", "distinct", "cells", "max_freq")
    j = cc.join(summary, "column", "left")
    distinct = F.coalesce(F.col("distinct"), F.lit(0))
    max_freq = F.coalesce(F.col("max_freq"), F.lit(0))
    has_null = (F.col("rows") > F.col("non_null")).cast("int")
    if null_is_value:
        cond = (distinct + has_null) == F.col("rows")
    else:
        cond = (max_freq == 1)
    return j.where(cond).select(F.col("column").alias("column_name"), F.col("rows").alias("row_count"))


def _detect(df: DataFrame, columns: Sequence[str], predicate, mode: str, order_by: str | None,
            threshold: float) -> DataFrame:
    """Columns whose rows satisfy ``predicate`` under the D1 rule, as (column)."""
    spark = df.sparkSession
    if not columns:
        return spark.createDataFrame([], "column_name string")
    if mode == "first":
        if order_by is None:
            raise ValueError("mode='first' needs order_by: a DataFrame has no first row")
        key = q(order_by) if isinstance(order_by, str) else F.struct(*[q(k) for k in order_by])
        # first row by key with raw values; the predicate runs on that one row only
        first = df.agg(F.min_by(F.struct(*[q(c).alias(f"v{i}") for i, c in enumerate(columns)]), key).alias("r"))
        entries = F.array(*[F.struct(F.lit(c).alias("column"), predicate(F.col(f"r.v{i}").cast("string")).alias("hit"))
                            for i, c in enumerate(columns)])
        return first.select(F.inline(entries)).where(F.col("hit")).select(F.col("column").alias("column_name"))
    elif mode == "share":
        aggs = [
            (F.avg(F.when(q(c).isNotNull(), predicate(q(c).cast("string")).cast("int"))) >= F.lit(threshold)).alias(f"d{i}")
            for i, c in enumerate(columns)
        ]
    else:
        raise ValueError(f"mode must be 'first' or 'share', got {mode!r}")
    keys = [] if order_by is None else ([order_by] if isinstance(order_by, str) else list(order_by))
    one = spread(df.select(*[q(c) for c in dict.fromkeys(list(columns) + keys)])).agg(*aggs)
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"d{i}").alias("hit")) for i, c in enumerate(columns)])
    return one.select(F.inline(entries)).where(F.col("hit")).select(F.col("column").alias("column_name"))


def scalar_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if is_scalar(f.dataType)]


def detect_json_columns(df: DataFrame, mode: str = "share", order_by: str | None = None,
                        threshold: float = 0.95) -> DataFrame:
    """Columns holding JSON text: ``{`` and ``:`` in the deciding rows."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return _detect(df, cols, looks_like_json, mode, order_by, threshold)


def detect_xml_columns(df: DataFrame, mode: str = "share", order_by: str | None = None,
                       threshold: float = 0.95) -> DataFrame:
    """Columns holding markup: ``<`` in the deciding rows."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return _detect(df, cols, looks_like_xml, mode, order_by, threshold)


def detect_date_columns(df: DataFrame, mode: str = "share", order_by: str | None = None,
                        threshold: float = 0.95, strict: bool = True) -> DataFrame:
    """Columns whose text renders as a date (R13 detection), any scalar type."""
    cols = scalar_columns(df)
    if strict:
        # a rendered number or boolean never has two date separators: skip the regex on them
        cols = [c for c in cols if not is_numeric(df.schema[c].dataType)
                and not isinstance(df.schema[c].dataType, BooleanType)]
    return _detect(df, cols, lambda t: is_date_text(t, strict), mode, order_by, threshold)


def date_columns(df: DataFrame, mode: str = "share", order_by: str | Sequence[str] | None = None,
                 threshold: float = 0.95, strict: bool = True, day_first: bool | None = True) -> DataFrame:
    """(column, min_date, max_date, days) for each date-like column.

    ``day_first=None`` lets each text column's cells elect the order of day and month
    (``vote_date_formats``: one more job).

    Detection and ranges come from one aggregate over the table: for every candidate
    column the share of date-like cells (or the first row's test), and the min and max of
    the *parsed* values (B2); each range pairs a column's own min and max (B1).
    """
    spark = df.sparkSession
    cols = scalar_columns(df)
    if strict:  # a rendered number or boolean never has two date separators
        cols = [c for c in cols if not is_numeric(df.schema[c].dataType)
                and not isinstance(df.schema[c].dataType, BooleanType)]
    if not cols:
        return spark.createDataFrame([], "column_name string, min_date timestamp_ntz, max_date timestamp_ntz, days int")
    if mode == "first":
        if order_by is None:
            raise ValueError("mode='first' needs order_by: a DataFrame has no first row")
        key = q(order_by) if isinstance(order_by, str) else F.struct(*[q(k) for k in order_by])
    elif mode != "share":
        raise ValueError(f"mode must be 'first' or 'share', got {mode!r}")
    votes = vote_date_formats({"": df.select(*[q(c) for c in cols])}) if day_first is None else {}
    aggs = []
    for i, c in enumerate(cols):
        text = q(c).cast("string")
        if mode == "first":
            hit = is_date_text(F.min_by(q(c), key).cast("string"), strict)
        else:
            hit = F.avg(F.when(q(c).isNotNull(), is_date_text(text, strict).cast("int"))) >= F.lit(threshold)
        dt = df.schema[c].dataType
        order = votes[("", c)].day_first if ("", c) in votes else day_first is not False
        t = parse_datetime(q(c), dt, day_first=order)
        if not is_temporal(dt):  # parse only cells that look like dates: the regex is cheap
            t = F.when(is_date_text(text, strict), t)
        aggs += [hit.alias(f"h{i}"), F.min(t).alias(f"a{i}"), F.max(t).alias(f"b{i}")]
    one = spread(df.select(*[q(c) for c in dict.fromkeys(cols + ([] if mode == "share" else (
        [order_by] if isinstance(order_by, str) else list(order_by))))])).agg(*aggs)
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"h{i}").alias("hit"),
                                 F.col(f"a{i}").alias("min_date"), F.col(f"b{i}").alias("max_date"))
                        for i, c in enumerate(cols)])
    return one.select(F.inline(entries)).where(F.col("hit")).select(
        F.col("column").alias("column_name"), "min_date", "max_date",
        F.datediff(F.to_date("max_date"), F.to_date("min_date")).alias("days"),
    )


def value_counts(df: DataFrame, percentage: float = 0.05, columns: Sequence[str] | None = None,
                 digest_over: int | None = DIGEST_OVER) -> DataFrame:
    """(column, value, share) for values holding at least ``percentage`` of a column.

    Text columns and arrays of text (exploded, X11); shares among non-null cells. At most
    1/percentage rows per column survive.
    """
    if columns is None:
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)
                or (isinstance(f.dataType, ArrayType) and isinstance(f.dataType.elementType, StringType))]
    else:
        cols = list(columns)
    spark = df.sparkSession
    if not cols:
        return spark.createDataFrame([], "column_name string, value string, share double")
    freq = value_frequencies(long_cells(df, cols, explode_arrays=True, digest_over=digest_over))
    totals = freq.groupBy("column").agg(F.sum("cnt").alias("total"))
    shares = (
        freq.join(F.broadcast(totals), "column")  # one row per column: bounded by the schema
        .select("column", "key", (F.col("cnt") / F.col("total")).alias("share"))
        .where(F.col("share") >= F.lit(percentage))
    )
    names = resolve_keys(df, shares.select("column", "key"), cols, explode_arrays=True, digest_over=digest_over)
    return shares.join(names, ["column", "key"]).select(
        F.col("column").alias("column_name"), "value", "share")


def value_counts_wide(df: DataFrame, percentage: float = 0.05, columns: Sequence[str] | None = None) -> DataFrame:
    """R12 in the reference's wide shape: one row per value, one share column per column."""
    # the long result is tiny (at most 1/percentage rows per column): cut it once in the
    # shared checkpoint folder so finding its columns and pivoting do not recompute it
    checkpoint_root(df.sparkSession)  # names the folder, or says that none is set
    long = value_counts(df, percentage, columns).checkpoint(eager=True)
    cols = [r["column_name"] for r in long.select("column_name").distinct().collect()]  # at most len(schema)
    cols.sort()
    if not cols:
        return long.select("value")
    return long.groupBy("value").pivot("column_name", cols).agg(F.first("share"))
