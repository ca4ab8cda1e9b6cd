"""Cross-table tools over a table set ``{name: DataFrame}`` (M1-M4, R4 over sets, U1).

Each tool builds *one* plan over all tables (a union of per-table projections), so the
tables are scanned once and shuffled once, whatever their number.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType

from lakeloom.functions.patterns import semantic_type
from lakeloom.functions.casts import is_integral
from lakeloom.functions.values import DIGEST_OVER, _sql_name, is_numeric, is_scalar, is_temporal, micros_sql, typed_key, typed_key_sql
from lakeloom.operators.parallel import spread
from lakeloom.operators.transforms import daily_slices, q
from lakeloom.operators.unpivot import _lit, column_counts, key_stats, long_keys


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _empty(spark, ddl: str) -> DataFrame:
    return spark.createDataFrame([], ddl)


def _spark_of(tables: Mapping[str, DataFrame]):
    for df in tables.values():
        return df.sparkSession
    raise ValueError("empty table set")


def table_set_shapes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, rows, cols) for every table (R4 over a set, S6-S9)."""
    frames = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), "rows", F.lit(len(df.columns)).cast("int").alias("cols")
        )
        for name, df in tables.items()
    ]
    return _union(frames)


def _value_class(dt) -> str:
    if is_numeric(dt):
        return "number"
    if isinstance(dt, StringType):
        return "text"
    return "time" if is_temporal(dt) else dt.typeName()


def _value_hash(column: str, dt) -> str:
    """A 64-bit hash that is equal for equal values of any two columns, as Spark SQL."""
    x = _sql_name(column)
    if isinstance(dt, StringType):
        return f"xxhash64({x})"
    if is_integral(dt):
        return f"xxhash64(CAST({x} AS BIGINT))"
    if isinstance(dt, (FloatType, DoubleType)):
        d = f"CAST({x} AS DOUBLE)"
        return f"CASE WHEN {d} = floor({d}) AND abs({d}) < 9.0E18 THEN xxhash64(CAST({d} AS BIGINT)) ELSE xxhash64({d}) END"
    # null parts of a key leave the hash as it is
    return f"transform(array({typed_key_sql(column, dt, None)}), k -> xxhash64(k.i, k.d, k.s))[0]"


BITS = 32_768  # of one bitmap aggregate
SPARSE = 64  # the second bitmap holds one value in so many, and fills up that much later


def column_sketches(tables: Mapping[str, DataFrame], columns: Sequence[tuple[str, str]], bitmaps: bool = True) -> list[dict]:
    """Counts, ranges and value bitmaps of the columns ``(table, column)``: one aggregate row a table.

    ``n`` values; ``lo`` and ``hi``: numbers and times as doubles, text by its start, both of which keep
    the order; ``low`` and ``high``: integers exactly; ``dense`` and ``sparse``: bits of the values' hashes,
    of all values and of one in ``SPARSE``. All are mergeable aggregates; the driver gets one row a
    column, 8 KB at most.
    """
    frames = []
    for name, df in tables.items():
        aggs, entries, hashes = [], [], []
        for i, (t, c) in enumerate(columns):
            if t != name:
                continue
            dt, x = df.schema[c].dataType, _sql_name(c)
            # text by its first two code points, in the order of their numbers
            order, exact = f"CAST(ascii({x}) * 1114112L + ascii(substring({x}, 2, 1)) AS DOUBLE)", None
            if is_numeric(dt):
                order, exact = f"CAST({x} AS DOUBLE)", x if is_integral(dt) else None
            elif is_temporal(dt):
                order = f"CAST({micros_sql(x, dt)} AS DOUBLE)"
            elif not isinstance(dt, StringType):
                order = "CAST(NULL AS DOUBLE)"
            found = {"n": f"count({x})", "lo": f"min({order})", "hi": f"max({order})"}
            if exact:
                found |= {"low": f"CAST(min({exact}) AS BIGINT)", "high": f"CAST(max({exact}) AS BIGINT)"}
            if bitmaps:
                h = f"__hash{i}"
                hashes.append(F.expr(f"CASE WHEN {x} IS NOT NULL THEN {_value_hash(c, dt)} END AS {h}"))
                found |= {"dense": f"bitmap_construct_agg(pmod({h}, {BITS}))",
                          "sparse": f"bitmap_construct_agg(CASE WHEN pmod({h}, {SPARSE}) = 0 THEN pmod(shiftright({h}, 20), {BITS}) END)"}
            aggs += [F.expr(f"{sql} AS {k}{i}") for k, sql in found.items()]
            kinds = {"n": "BIGINT", "lo": "DOUBLE", "hi": "DOUBLE", "low": "BIGINT", "high": "BIGINT",
                     "dense": "BINARY", "sparse": "BINARY"}
            entries.append(f"named_struct('i', {i}, " + ", ".join(
                f"'{k}', CAST({f'{k}{i}' if k in found else 'NULL'} AS {kind})" for k, kind in kinds.items()) + ")")
        if entries:
            rows = spread(df.select(*[q(c) for t, c in columns if t == name])).select("*", *hashes)
            frames.append(rows.agg(*aggs).select(F.expr(f"inline(array({', '.join(entries)}))")))

    def number(x):  # NaN is the largest number
        return (x != x, 0.0 if x != x else x)

    out: list[dict] = [{} for _ in columns]
    for r in _union(frames).collect() if frames else []:
        s = r.asDict()
        s["lo"], s["hi"] = number(s["lo"] or 0.0), number(s["hi"] or 0.0)
        for k in ("dense", "sparse"):
            s[k] = int.from_bytes(bytes(s[k] or b""), "little")
        out[s["i"]] = s
    return out


def repeating_columns(tables: Mapping[str, DataFrame]) -> dict[str, set[str]]:
    """Columns proved to repeat a value before any cell is shuffled; the others stay open.

    More whole numbers than there are between the smallest and the largest must repeat one.
    """
    columns = [(t, f.name) for t, df in tables.items() for f in df.schema.fields if is_integral(f.dataType)]
    found: dict[str, set[str]] = {}
    for (table, column), s in zip(columns, column_sketches(tables, columns, bitmaps=False)):
        if s["n"] and s["high"] - s["low"] + 1 < s["n"]:
            found.setdefault(table, set()).add(column)
    return found


def unique_columns_table_set(tables: Mapping[str, DataFrame], prune: bool = False) -> DataFrame:
    """(table_name, column_name, row_count) for columns whose non-null values never repeat.

    At least one non-null value is required. One grouped pass over all tables' cells; with ``prune`` it
    leaves out the columns that ``repeating_columns`` refutes by a scan of the whole-number columns.
    """
    spark = _spark_of(tables)
    refuted = repeating_columns(tables) if prune else {}
    cells, counts, names = [], [], []
    for name, df in tables.items():
        cols = [c for c in df.columns if c not in refuted.get(name, ())]
        if not cols:
            continue
        keys, ids = long_keys(df, cols, id_offset=len(names))
        cells.append(keys)
        names.extend((ci, name, c) for ci, c in ids)
        counts.append(df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows"))
    if not names:
        return _empty(spark, "table_name string, column_name string, row_count long")
    stats = key_stats(_union(cells))
    ids_df = spark.createDataFrame(names, "ci int, table_name string, column_name string")
    return (
        stats.where(F.col("max_freq") == 1)
        .join(F.broadcast(ids_df), "ci")  # one row per column: bounded by the schema
        .join(F.broadcast(_union(counts)), "table_name")  # one row per table
        .select("table_name", "column_name", F.col("rows").alias("row_count"))
    )


def reference_name_filter(dep: str, ref: str) -> bool:
    """The reference's pair rule: different names, neither containing ``Id`` (case-sensitive)."""
    return dep != ref and "Id" not in dep and "Id" not in ref


def _bit(c: int):
    """Word of 64 bits that holds column c, and the bit's value there."""
    return c // 64, 1 << (c % 64)


def _inclusion_masks(cells: DataFrame, k: int) -> DataFrame:
    """(a, m0, m1, ...): for every column a with values, the columns that hold all of them, as bits.

    No pair is materialised per value: for each distinct value v, S(v) = bitmask of the columns holding
    v (``bit_or`` in a partial+final aggregate keyed by v: one shuffle, hot values collapse map-side).
    a is contained in b iff b's bit survives ``bit_and`` of S(v) over a's values. Each value row is
    expanded once per column that holds it, then a second partial aggregate keyed by a ANDs the masks.
    """
    words = (k + 63) // 64

    def bit(word: int):
        lo = word * 64
        in_word = (F.col("c") >= lo) & (F.col("c") < lo + 64)
        return F.when(in_word, F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("c") - lo)).otherwise(
            F.lit(0).cast("bigint"))

    per_value = cells.groupBy("t", "i", "d", "s").agg(
        *[F.bit_or(bit(w)).alias(f"m{w}") for w in range(words)],
        F.min("c").alias("c_lo"),
        F.max("c").alias("c_hi"),
    )
    # most values live in one or two columns: their members are (c_lo, c_hi), no bit scan
    popcount = sum((F.bit_count(F.col(f"m{w}")) for w in range(words)), F.lit(0))
    words_of = "array(" + ", ".join(f"m{w}" for w in range(words)) + ")"
    scan = F.expr(f"filter(sequence(0, {k - 1}), i -> (shiftright({words_of}[i div 64], CAST(i % 64 AS INT)) & 1) = 1)")
    members = (
        F.when(F.col("c_lo") == F.col("c_hi"), F.array(F.col("c_lo")))
        .when(popcount == 2, F.array(F.col("c_lo"), F.col("c_hi")))
        .otherwise(scan)
    )
    expanded = per_value.select(F.explode(members).alias("a"), *[f"m{w}" for w in range(words)])
    return expanded.groupBy("a").agg(*[F.bit_and(f"m{w}").alias(f"m{w}") for w in range(words)])


def contained_columns(
    tables: Mapping[str, DataFrame],
    name_filter: Callable[[str, str], bool] | str | None = "reference",
    null_is_value: bool = False,
    day: str | date | None = None,
    slice_by_day: bool = False,
    prune: bool = False,
) -> DataFrame:
    """Inclusion dependencies: (table_1, col_1, table_2, col_2) where every value of
    ``col_1`` occurs in ``col_2`` (M2, J4, F5).

    Values compare by class (``typed_key``): 1 equals 1.0, text never equals numbers.
    Columns without values are skipped; so are empty tables. ``name_filter="reference"``
    keeps the reference's rule (``reference_name_filter``), ``None`` keeps every pair, a
    callable ``(col_1, col_2) -> bool`` applies a custom rule.

    All columns that a pair allowed by name holds are compared in one pass (``_inclusion_masks``). With
    ``prune`` pairs are ruled out before it as far as they can be proved false, and only the columns of the
    others are shuffled; the rows are the same. The proofs are one more scan of every table: kind of
    value, ranges and bitmaps of hashed values (``column_sketches``; a bit that b lacks belongs to a value
    that b lacks). A column that is then only a candidate container sends the cells inside the range of
    what it may contain. It pays where shuffling cells costs more than reading them twice.

    The driver holds one sketch of 8 KB a column. Output is at most K^2 rows.
    """
    spark = _spark_of(tables)
    if slice_by_day:
        tables = daily_slices(tables, day)
    columns = [(name, f.name) for name, df in tables.items() for f in df.schema.fields if is_scalar(f.dataType)]
    if not columns:
        return _empty(spark, "table_1 string, col_1 string, table_2 string, col_2 string")
    k = len(columns)
    types = [tables[t].schema[c].dataType for t, c in columns]
    named = {None: lambda a, b: True, "reference": reference_name_filter}.get(name_filter, name_filter)
    # allowed[a]: the columns that may contain a, as bits of one integer
    allowed = [sum(1 << j for j in range(k) if j != i and named(columns[i][1], columns[j][1])) for i in range(k)]
    sketches = column_sketches(tables, columns) if prune else None
    if prune:
        kinds = [_value_class(t) for t in types]
        for i, one in enumerate(sketches):
            if one["n"] == 0:
                allowed[i] = allowed[i] if null_is_value else 0
                continue
            for j in (j for j in range(k) if allowed[i] >> j & 1):
                other = sketches[j]
                inside = other["n"] and kinds[i] == kinds[j] and other["lo"] <= one["lo"] and one["hi"] <= other["hi"]
                if not inside or one["dense"] & ~other["dense"] or one["sparse"] & ~other["sparse"]:
                    allowed[i] ^= 1 << j

    def cells_of(used: list[int], only: Mapping[int, str]) -> DataFrame:
        """(t, i, d, s, c) of the columns ``used``, c counted within them; one scan a table."""
        parts = []
        for name, df in tables.items():
            entries = []
            for place, c in enumerate(used):
                if columns[c][0] != name:
                    continue
                key = typed_key(columns[c][1], types[c], DIGEST_OVER)
                if null_is_value:
                    key = F.coalesce(key, F.expr("named_struct('t', CAST(-1 AS TINYINT), 'i', CAST(NULL AS BIGINT), "
                                                 "'d', CAST(NULL AS DOUBLE), 's', CAST(NULL AS STRING))"))
                if c in only:
                    key = F.when(F.expr(only[c]), key)
                entries.append(F.struct(key.alias("v"), F.lit(place).alias("c")))
            if entries:
                mine = [columns[c][1] for c in used if columns[c][0] == name]
                parts.append(spread(df.select(*[q(c) for c in mine])).select(F.inline(F.array(*entries))))
        return _union(parts).where(F.col("v").isNotNull()).select("v.*", "c")

    def in_play() -> list[int]:
        union = 0
        for i, mask in enumerate(allowed):
            union |= mask | (1 << i if mask else 0)
        return [c for c in range(k) if union >> c & 1]

    used = in_play()
    if not used:
        return _empty(spark, "table_1 string, col_1 string, table_2 string, col_2 string")
    only = {}
    if prune and not null_is_value:
        for c in used:
            if not allowed[c] and is_numeric(types[c]):  # a container only
                inner = [sketches[a] for a in used if allowed[a] >> c & 1]
                lo, hi = min(r["lo"] for r in inner), max(r["hi"] for r in inner)
                if not lo[0] and not hi[0]:
                    x = f"CAST({_sql_name(columns[c][1])} AS DOUBLE)"
                    only[c] = f"{x} >= CAST('{lo[1]!r}' AS DOUBLE) AND {x} <= CAST('{hi[1]!r}' AS DOUBLE)"
    masks = _inclusion_masks(cells_of(used, only), len(used))
    # the pairs still allowed, one row each: at most K^2 names, no data
    pairs = [(p, columns[c][0], columns[c][1], w, bit if bit < 1 << 63 else bit - (1 << 64), columns[o][0], columns[o][1])
             for p, c in enumerate(used) for r, o in enumerate(used) if allowed[c] >> o & 1 for w, bit in [_bit(r)]]
    open_ = spark.createDataFrame(
        pairs, "a int, table_1 string, col_1 string, w int, bit long, table_2 string, col_2 string")
    words = F.array(*[F.col(f"m{w}") for w in range((len(used) + 63) // 64)])
    return masks.join(F.broadcast(open_), "a").where(
        F.get(words, F.col("w")).bitwiseAND(F.col("bit")) != 0).select("table_1", "col_1", "table_2", "col_2")


def find_value(tables: Mapping[str, DataFrame], value: str, day: str | date | None = None,
               slice_by_day: bool = False) -> DataFrame:
    """(column_name, table_name, value) for every text column holding a cell equal to ``value`` (M3).

    Like the reference, the comparison is with the *text* value, so numeric columns never
    match. One ``bool_or`` per column in a single aggregate per table: a scan, no shuffle.
    An empty result is an empty DataFrame (B6).
    """
    spark = _spark_of(tables)
    frames = []
    if slice_by_day:
        tables = daily_slices(tables, day)
    for name, df in tables.items():
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
        if not cols:
            continue
        one = df.agg(*[F.bool_or(q(c) == F.lit(value)).alias(f"h{i}") for i, c in enumerate(cols)])
        entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"h{i}").alias("hit")) for i, c in enumerate(cols)])
        frames.append(
            one.select(F.inline(entries)).where(F.col("hit")).select(
                F.col("column").alias("column_name"), F.lit(name).alias("table_name"), F.lit(value).alias("value")
            )
        )
    if not frames:
        return _empty(spark, "column_name string, table_name string, value string")
    return _union(frames)


def _key_cols(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _order_key(key: str | Sequence[str]):
    if isinstance(key, str):
        return q(key)
    keys = list(key)
    return q(keys[0]) if len(keys) == 1 else F.struct(*[q(k) for k in keys])


def data_dictionary(
    tables: Mapping[str, DataFrame],
    order_by: Mapping[str, str | Sequence[str]] | None = None,
    mode: str = "first",
    threshold: float = 0.95,
    strict: bool = True,
    mixed: bool = False,
) -> DataFrame:
    """(column_name, table_name, dtype): a semantic type per column.

    ``mode="first"``: the label of the first row by ``order_by[table]`` (the reference's
    ``LIMIT 1`` probe made order-explicit, via ``min_by``). ``mode="share"``: the label
    held by the most non-null cells, if at least ``threshold`` of them carry it.
    Unclassifiable values (e.g. ``-5``) give no row.
    """
    spark = _spark_of(tables)
    frames = []
    for name, df in tables.items():
        cols = [f.name for f in df.schema.fields if is_scalar(f.dataType)]
        if not cols:
            continue
        if mode == "first":
            key = (order_by or {}).get(name)
            if key is None:
                raise ValueError(f"mode='first' needs order_by for table {name!r}")
            # take the first row with raw values; only that one row is rendered as text
            first = df.select(*[q(c) for c in dict.fromkeys(cols + _key_cols(key))]).agg(
                F.min_by(F.struct(*[q(c).alias(f"v{i}") for i, c in enumerate(cols)]), _order_key(key)).alias("r"))
            entries = F.array(*[
                F.struct(F.lit(c).alias("column"), F.col(f"r.v{i}").cast("string").alias("text"))
                for i, c in enumerate(cols)
            ])
            frames.append(first.select(F.inline(entries)).select(
                F.col("column").alias("column_name"), F.lit(name).alias("table_name"), "text"))
        elif mode == "share":
            entries = ", ".join(f"named_struct('column', {_lit(c)}, 'text', CAST({_sql_name(c)} AS STRING))"
                                for c in cols)
            # unpivot first, then one classifier over the text column (not one per column)
            cells = spread(df.select(*[q(c) for c in cols])).select(F.expr(f"inline(array({entries}))"))
            labelled = cells.select("column", semantic_type(F.col("text"), strict, mixed).alias("dtype"))
            counts = labelled.where(F.col("dtype").isNotNull()).groupBy("column", "dtype").agg(F.count(F.lit(1)).alias("n"))
            best = counts.groupBy("column").agg(F.max(F.struct("n", "dtype")).alias("b"))
            nonnull = column_counts(df, cols)
            frames.append(
                best.join(nonnull, "column")
                .where(F.col("b.n") >= F.lit(threshold) * F.col("non_null"))
                .select(F.col("column").alias("column_name"), F.lit(name).alias("table_name"), F.col("b.dtype").alias("dtype"))
            )
        else:
            raise ValueError(f"mode must be 'first' or 'share', got {mode!r}")
    if not frames:
        return _empty(spark, "column_name string, table_name string, dtype string")
    if mode == "first":  # one classifier over the first rows of every table
        firsts = _union(frames)
        return firsts.select("column_name", "table_name", semantic_type(F.col("text"), strict, mixed).alias("dtype")) \
            .where(F.col("dtype").isNotNull())
    return _union(frames)


def sliced(tables: Mapping[str, DataFrame], day: str | date | None = None) -> dict[str, DataFrame]:
    """Today's slice of every table (F3): first date column == day, whole table if none."""
    return daily_slices(tables, day)
