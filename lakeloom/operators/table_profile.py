"""The profile of a whole table set from one shared table of value counts (M5, M6).

Every table is read once: its cells become ``(c, key)`` rows - ``c`` numbers the columns of the whole
set - next to one row per table row that holds the row's fingerprint, and the set is grouped and counted in
one shuffle with map-side combine. What the detectors need of a cell (looks like JSON, like markup,
like a date, the date it parses to) depends on its value only, so it travels as two more aggregates
of the group. The counts are written once; every report is read off them:

* rows and duplicate rows: the fingerprints' counts;
* nulls: rows minus cells; unique columns: distinct values against rows;
* describe, dominant values: the highest counts and the shares;
* JSON, markup and date columns with their ranges: the flags weighted by the counts.

Only texts over ``DIGEST_OVER`` characters that are to be reported need a further read of their
columns, as counts hold digests of those. Columns of which only the number of cells is asked for
(``counted``) send no cell through the shuffle: one aggregate row a table counts them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, StringType

from lakeloom.functions.json import looks_like_json, looks_like_xml
from lakeloom.functions.patterns import is_date_text
from lakeloom.functions.values import (
    DIGEST_OVER,
    _sql_name,
    is_digest,
    is_non_numeric,
    is_temporal,
    key_start,
    key_value_sql,
    text_key_sql,
    typed_key,
)
from lakeloom.operators.parallel import spread
from lakeloom.operators.transforms import parse_datetime, q
from lakeloom.session import written

ROW, CELL, ELEMENT = "row", "cell", "element"  # what a numbered column counts
_FLAGS = {"json": 1, "xml": 2, "date": 4}
COUNTS_DDL = "c int, t tinyint, i bigint, d double, s string, cnt bigint, flags int, day timestamp_ntz"


@dataclass(frozen=True)
class ProfiledColumn:
    c: int
    table: str
    name: str | None
    kind: str
    dtype: DataType | None


def numbered_columns(tables: Mapping[str, DataFrame]) -> list[ProfiledColumn]:
    """Every table's row fingerprint, its columns, and the elements of its lists of text."""
    out: list[ProfiledColumn] = []
    for table, df in tables.items():
        out.append(ProfiledColumn(len(out), table, None, ROW, None))
        for f in df.schema.fields:
            out.append(ProfiledColumn(len(out), table, f.name, CELL, f.dataType))
        for f in df.schema.fields:
            if isinstance(f.dataType, ArrayType) and isinstance(f.dataType.elementType, StringType):
                out.append(ProfiledColumn(len(out), table, f.name, ELEMENT, f.dataType))
    return out


def _flags(c: str, dt: DataType, strict: bool, day_first: bool) -> tuple[Column, Column]:
    """(bit flags, parsed date) of a cell; both depend on its value only."""
    none = F.lit(None).cast("timestamp_ntz")
    if is_temporal(dt):
        return F.lit(_FLAGS["date"]), q(c).cast("timestamp_ntz")
    if not isinstance(dt, StringType):
        return F.lit(0), none
    date = is_date_text(q(c), strict)
    bits = [F.when(looks_like_json(q(c)), 1).otherwise(0), F.when(looks_like_xml(q(c)), 2).otherwise(0),
            F.when(date, 4).otherwise(0)]
    return reduce(lambda a, b: a + b, bits), F.when(date, parse_datetime(q(c), dt, day_first=day_first))


def _cells(df: DataFrame, columns: Sequence[ProfiledColumn], strict: bool, day_first: bool) -> DataFrame:
    """(c, k, f, d) of every non-null cell of ``columns`` of one table; a fingerprint covers all its columns."""
    of_rows = any(x.kind == ROW for x in columns)
    names = list(dict.fromkeys(df.columns if of_rows else (x.name for x in columns)))
    keys = [typed_key(c, df.schema[c].dataType).alias(f"k{i}") for i, c in enumerate(names)]
    place = {c: f"k{i}" for i, c in enumerate(names)}
    src = spread(df.select(*[q(c) for c in names])).select(*[q(c) for c in names], *keys)
    no_date = F.lit(None).cast("timestamp_ntz")

    def entry(c: int, key: Column, flags: Column, day: Column) -> Column:
        return F.struct(F.lit(c).alias("c"), key.alias("k"), flags.cast("int").alias("f"), day.alias("d"))

    def listed(c: int):  # a lambda's second parameter would be the place in the list
        return lambda k: entry(c, k, F.lit(0), no_date)

    cells, lists = [], []
    for x in columns:
        if x.kind == ROW:
            ks = [F.col(place[c]) for c in names]
            second = F.xxhash64(F.lit(1), *reversed(ks)).cast("string")  # 128 bits in all
            print_ = F.struct(F.lit(9).cast("tinyint").alias("t"), F.xxhash64(*ks).alias("i"),
                              F.lit(None).cast("double").alias("d"), second.alias("s"))
            cells.append(entry(x.c, print_, F.lit(0), no_date))
        elif x.kind == CELL:
            cells.append(entry(x.c, F.col(place[x.name]), *_flags(x.name, x.dtype, strict, day_first)))
        else:
            element = F.expr(f"transform(filter(`{x.name.replace('`', '``')}`, x -> x IS NOT NULL), x -> named_struct("
                             f"'t', CAST(1 AS TINYINT), 'i', CAST(NULL AS BIGINT), 'd', CAST(NULL AS DOUBLE), "
                             f"'s', {text_key_sql('x')}))")
            lists.append(F.coalesce(F.transform(element, listed(x.c)), F.array()))
    rows = F.array(*cells)
    return src.select(F.inline(F.concat(rows, *lists) if lists else rows)).where(F.col("k").isNotNull())


def value_counts_of_set(tables: Mapping[str, DataFrame], columns: Sequence[ProfiledColumn], strict: bool = True,
                        day_first: bool = True) -> DataFrame:
    """(c, t, i, d, s, cnt, flags, day): every distinct value of ``columns``; one scan a table, one shuffle."""
    of_table = {t: [x for x in columns if x.table == t] for t in tables}
    parts = [_cells(df, of_table[t], strict, day_first) for t, df in tables.items() if of_table[t]]
    cells = reduce(lambda a, b: a.unionByName(b), parts).select("c", "k.t", "k.i", F.col("k.d").alias("d"), "k.s", "f",
                                                                F.col("d").alias("day"))
    return cells.groupBy("c", "t", "i", "d", "s").agg(
        F.count(F.lit(1)).alias("cnt"), F.max("f").alias("flags"), F.max("day").alias("day"))


def cells_of_set(tables: Mapping[str, DataFrame], columns: Sequence[ProfiledColumn]) -> DataFrame | None:
    """(c, cells) of ``columns`` without their values: one aggregate row a table, nothing else is shuffled."""
    parts = []
    for t, df in tables.items():
        mine = [x for x in columns if x.table == t and x.kind != ELEMENT]  # an element's cells are asked for with its values
        if not mine:
            continue
        number = {x.c: f"count({'1' if x.kind == ROW else _sql_name(x.name)}) AS n{x.c}" for x in mine}
        entries = ", ".join(f"named_struct('c', {c}, 'cells', n{c})" for c in number)
        parts.append(df.agg(*map(F.expr, number.values())).select(F.expr(f"inline(array({entries}))")))
    return reduce(lambda a, b: a.unionByName(b), parts) if parts else None


def column_stats(counts: DataFrame) -> DataFrame:
    """One row per numbered column that has cells; partial and final aggregates, bounded by the schema."""
    weighted = {n: F.sum(F.when(F.col("flags").bitwiseAND(F.lit(b)) != 0, F.col("cnt")).otherwise(0)).alias(n)
                for n, b in _FLAGS.items()}
    return counts.groupBy("c").agg(
        F.sum("cnt").alias("cells"),
        F.count(F.lit(1)).alias("distinct"),
        F.max("cnt").alias("max_freq"),
        F.min(F.struct((-F.col("cnt")).alias("neg"), F.struct("i", "s").alias("key"))).alias("top"),
        *weighted.values(),
        F.min("day").alias("min_date"), F.max("day").alias("max_date"),
    ).select("c", "cells", "distinct", "max_freq", F.col("top.key.i").alias("i"), F.col("top.key.s").alias("s"),
             *weighted, "min_date", "max_date")


def _counts_texts(x: ProfiledColumn) -> bool:
    return x.kind == ELEMENT or (x.kind == CELL and isinstance(x.dtype, StringType))


def long_texts(tables: Mapping[str, DataFrame], columns: Sequence[ProfiledColumn], wanted: DataFrame) -> DataFrame:
    """(c, s, value): the texts of the digest keys ``wanted(c, s)``; reads only the columns that have any."""
    spark = wanted.sparkSession
    needed = {r["c"] for r in wanted.select("c").distinct().collect()}  # at most one a column

    def of_column(c: int):
        return lambda v: F.struct(F.lit(c).alias("c"), v.alias("value"))

    parts = []
    for t, df in tables.items():
        mine = [x for x in columns if x.table == t and x.c in needed]
        if not mine:
            continue
        lists = [F.transform(F.coalesce(q(x.name), F.array()) if x.kind == ELEMENT else F.array(q(x.name)), of_column(x.c))
                 for x in mine]
        cells = spread(df.select(*{x.name: q(x.name) for x in mine}.values())).select(F.inline(F.concat(*lists)))
        parts.append(cells.where(F.length("value") > DIGEST_OVER).select(
            "c", F.expr(text_key_sql("value")).alias("s"), "value"))
    if not parts:
        return spark.createDataFrame([], "c int, s string, value string")
    cells = reduce(lambda a, b: a.unionByName(b), parts)
    return cells.join(wanted.distinct(), ["c", "s"], "left_semi").groupBy("c", "s").agg(F.min("value").alias("value"))


@dataclass(frozen=True)
class SetProfile:
    """The written counts of a table set and what is read off them."""

    tables: Mapping[str, DataFrame]
    columns: list[ProfiledColumn]
    counts: DataFrame  # of the counted columns
    stats: DataFrame  # one row a numbered column; rows of its table in ``rows``
    shares: DataFrame  # (c, value, share) of the dominant texts
    tops: DataFrame  # (c, top)

    @property
    def spark(self) -> SparkSession:
        return self.counts.sparkSession


def profile_set(tables: Mapping[str, DataFrame], percentage: float = 0.05, strict: bool = True, day_first: bool = True,
                counted: Callable[[ProfiledColumn], bool] | None = None) -> SetProfile:
    """The profile of all columns; ``counted`` says of which the values are needed, not only the number of cells."""
    columns = numbered_columns(tables)
    valued = [x for x in columns if counted is None or counted(x)]
    spark = next(iter(tables.values())).sparkSession
    if valued:
        counts = written(value_counts_of_set(tables, valued, strict, day_first), "profile-counts")
    else:
        counts = spark.createDataFrame([], COUNTS_DDL)
    names = spark.createDataFrame(
        [(x.c, x.table, x.name, x.kind, x.dtype.simpleString() if x.dtype is not None else None,
          x.kind == CELL and is_non_numeric(x.dtype), len(tables[x.table].columns)) for x in columns],
        "c int, table_name string, column_name string, kind string, dtype string, describe boolean, cols int")
    found = column_stats(counts)
    known_values = {x.c for x in valued}
    uncounted = cells_of_set(tables, [x for x in columns if x.c not in known_values])
    if uncounted is not None:
        found = written(found.unionByName(uncounted, allowMissingColumns=True), "profile-cells")
    sizes = found.select("c", "cells").join(names.where(F.col("kind") == ROW).select("c", "table_name"), "c").select(
        "table_name", F.col("cells").alias("rows"))
    # K rows, one a column of the set
    stats = names.join(F.broadcast(found), "c", "left").join(F.broadcast(sizes), "table_name", "left").fillna(
        0, ["cells", "distinct", "max_freq", "rows", *_FLAGS])
    stats = written(stats, "profile-stats")

    texts = [x.c for x in valued if _counts_texts(x)]
    known = F.broadcast(stats.select("c", "cells", "max_freq", F.col("s").alias("top_s")))
    of_texts = counts.where(F.col("c").isin(texts)).select("c", "s", "cnt").join(known, "c") if texts else None
    if of_texts is None:
        empty = spark.createDataFrame([], "c int, value string, share double")
        shares, values = empty, spark.createDataFrame([], "c int, s string, value string")
    else:
        share = F.col("cnt") / F.col("cells")
        dominant = written(of_texts.where(share >= percentage).select("c", "s", share.alias("share")), "profile-shares")
        start = key_start(F.col("s")) == key_start(F.col("top_s"))
        tied = of_texts.where((F.col("cnt") == F.col("max_freq")) & is_digest(F.col("s")) & is_digest(F.col("top_s")) & start)
        wanted = written(tied.select("c", "s").unionByName(dominant.where(is_digest(F.col("s"))).select("c", "s")),
                         "profile-digests")
        values = written(long_texts(tables, valued, wanted), "profile-texts")
        plain = F.expr(key_value_sql(StringType()))
        shares = dominant.where(~is_digest(F.col("s"))).select("c", plain.alias("value"), "share").unionByName(
            dominant.join(values, ["c", "s"]).select("c", "value", "share"))
    tops = _tops(valued, counts, stats, values) if valued else spark.createDataFrame([], "c int, top string")
    return SetProfile(tables, columns, counts, stats, shares, tops)


def _tops(columns: Sequence[ProfiledColumn], counts: DataFrame, stats: DataFrame, values: DataFrame) -> DataFrame:
    """(c, top): the smallest of the most frequent values as text; none for binary and nested columns."""
    kinds: dict[str, list[int]] = {}
    for x in columns:
        if x.kind == CELL and (isinstance(x.dtype, (StringType, BooleanType)) or is_temporal(x.dtype)):
            kinds.setdefault(key_value_sql(x.dtype), []).append(x.c)
    short = [stats.where(F.col("c").isin(ids)).select("c", F.expr(sql).alias("top")) for sql, ids in kinds.items()]
    # long texts: the tied digests' texts are all known, the shares' too
    tied = values.join(counts.select("c", "s", "cnt"), ["c", "s"]).join(
        F.broadcast(stats.where(is_digest(F.col("s"))).select("c", "max_freq")), "c")
    long = tied.where(F.col("cnt") == F.col("max_freq")).groupBy("c").agg(F.min("value").alias("top"))
    out = reduce(lambda a, b: a.unionByName(b), short, long)
    return out.where(F.col("top").isNotNull())
