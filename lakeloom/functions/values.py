"""Value encodings shared by the profiling passes.

* ``tagged_value``: a class-tagged canonical text so that values of different columns
  compare the way the reference's ``isin`` compares them: integer 1 equals float 1.0,
  text ``'1'`` never equals number 1, dates only equal dates.
* ``group_key``: a fixed-width grouping key for long text, so a shuffle moves a digest
  instead of a whole document.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    MapType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from lakeloom.functions.casts import is_integral

# Values longer than this many characters are grouped by a SHA-256 digest + length.
DIGEST_OVER = 64


def is_scalar(dt: DataType) -> bool:
    return not isinstance(dt, (ArrayType, StructType, MapType, BinaryType))


def is_numeric(dt: DataType) -> bool:
    return is_integral(dt) or isinstance(dt, (FloatType, DoubleType, DecimalType))


def is_text_like(dt: DataType) -> bool:
    """Columns pandas would call object/string: text and booleans."""
    return isinstance(dt, (StringType, BooleanType))


def is_non_numeric(dt: DataType) -> bool:
    """Everything but numbers: text, booleans, dates and times, binary and nested values."""
    return not is_numeric(dt)


def is_temporal(dt: DataType) -> bool:
    return isinstance(dt, (DateType, TimestampType, TimestampNTZType))


def tagged_value(c: Column, dt: DataType) -> Column | None:
    """Canonical, class-tagged text of a scalar value; None for unsupported types."""
    if is_integral(dt):
        return F.concat(F.lit("n:"), c.cast("string"))
    if isinstance(dt, DecimalType):
        # integral decimals compare equal to integers; keep the rest exact
        return F.concat(
            F.lit("n:"),
            F.when(c == F.floor(c), F.floor(c).cast("string")).otherwise(
                F.regexp_replace(c.cast("string"), r"0+$", "")
            ),
        )
    if isinstance(dt, (FloatType, DoubleType)):
        d = c.cast("double")
        integral = (d == F.floor(d)) & (F.abs(d) < F.lit(9.0e18))
        return F.concat(F.lit("n:"), F.when(integral, d.cast("bigint").cast("string")).otherwise(d.cast("string")))
    if isinstance(dt, StringType):
        return F.concat(F.lit("s:"), c)
    if isinstance(dt, BooleanType):
        return F.concat(F.lit("b:"), c.cast("string"))
    if isinstance(dt, (DateType, TimestampType, TimestampNTZType)):
        return F.concat(F.lit("d:"), c.cast("timestamp_ntz").cast("string"))
    return None


def sql_tagged_value(col_sql: str, dt: DataType) -> str | None:
    """The DuckDB rendering of ``tagged_value`` for oracles (self-consistent, not byte-equal)."""
    if is_integral(dt):
        return f"'n:' || CAST({col_sql} AS VARCHAR)"
    if isinstance(dt, (FloatType, DoubleType, DecimalType)):
        d = f"CAST({col_sql} AS DOUBLE)"
        return (
            f"CASE WHEN {d} IS NULL THEN NULL WHEN {d} = floor({d}) AND abs({d}) < 9.0e18 "
            f"THEN 'n:' || CAST(CAST({d} AS BIGINT) AS VARCHAR) ELSE 'n:' || CAST({d} AS VARCHAR) END"
        )
    if isinstance(dt, StringType):
        return f"'s:' || {col_sql}"
    if isinstance(dt, BooleanType):
        return f"'b:' || CAST({col_sql} AS VARCHAR)"
    if isinstance(dt, (DateType, TimestampType, TimestampNTZType)):
        return f"'d:' || CAST(CAST({col_sql} AS TIMESTAMP) AS VARCHAR)"
    return None


def text_of(c: Column, dt: DataType) -> Column:
    """Plain text rendering used for value reports (maps become sorted entries)."""
    if isinstance(dt, MapType):
        return F.to_json(F.array_sort(F.map_entries(c)))
    if not is_scalar(dt):
        return F.to_json(c)
    return c.cast("string")


def group_key(text: Column, digest_over: int | None = DIGEST_OVER) -> Column:
    """Grouping key: ``=<text>`` when short, else ``=<first characters>#<sha256>:<length>``.

    A key longer than ``=`` and ``digest_over`` characters is a digest. Keys sort as their
    texts do, up to long texts with equal first characters (``is_digest`` tells those).
    """
    plain = F.concat(F.lit("="), text)
    if digest_over is None:
        return plain
    return F.when(F.length(text) <= digest_over, plain).otherwise(
        F.concat(plain.substr(1, digest_over + 1), F.lit("#"), F.sha2(text, 256), F.lit(":"),
                 F.length(text).cast("string"))
    )


def is_digest(key: Column, digest_over: int | None = DIGEST_OVER) -> Column:
    return F.lit(False) if digest_over is None else F.length(key) > digest_over + 1


def key_start(key: Column, digest_over: int | None = DIGEST_OVER) -> Column:
    """What a key says about its text: the whole of a short one, the start of a long one."""
    return key if digest_over is None else key.substr(1, digest_over + 1)


def key_text(key: Column, digest_over: int | None = DIGEST_OVER) -> Column:
    """The text of a short key; null for a digest key (resolve those with a lookup)."""
    return F.when(~is_digest(key, digest_over), key.substr(F.lit(2), F.length(key)))


def _sql_name(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _canonical(x: str, dt: DataType, depth: int = 0) -> str:
    """A nested value with its maps as sorted entries and no negative zeros, as Spark SQL."""
    v = f"v{depth}"
    if isinstance(dt, (FloatType, DoubleType)):
        return f"({x} + CAST(0 AS {dt.simpleString()}))"
    if isinstance(dt, ArrayType):
        inner = _canonical(v, dt.elementType, depth + 1)
        return x if inner == v else f"transform({x}, {v} -> {inner})"
    if isinstance(dt, MapType):
        key, value = _canonical(f"{v}.key", dt.keyType, depth + 1), _canonical(f"{v}.value", dt.valueType, depth + 1)
        return f"array_sort(transform(map_entries({x}), {v} -> named_struct('key', {key}, 'value', {value})))"
    if isinstance(dt, StructType):
        inner = [(f.name, _canonical(f"{x}.{_sql_name(f.name)}", f.dataType, depth)) for f in dt.fields]
        if all(e == f"{x}.{_sql_name(n)}" for n, e in inner):
            return x
        fields = ", ".join("'" + n.replace("\\", "\\\\").replace("'", "\\'") + f"', {e}" for n, e in inner)
        return f"CASE WHEN {x} IS NOT NULL THEN named_struct({fields}) END"
    return x


def canonical_text_sql(c: str, dt: DataType) -> str:
    """Text that is equal for equal values: hexadecimal of binary, JSON of nested ones (maps sorted)."""
    if isinstance(dt, BinaryType):
        return f"hex({c})"
    if isinstance(dt, (ArrayType, MapType, StructType)):
        return f"to_json({_canonical(c, dt)}, map('ignoreNullFields', 'false'))"
    return f"CAST({c} AS STRING)"


def text_key_sql(x: str, digest_over: int | None = DIGEST_OVER) -> str:
    """``group_key`` of a text as Spark SQL."""
    if digest_over is None:
        return f"concat('=', {x})"
    n = int(digest_over)
    digest = f"concat('=', substring({x}, 1, {n}), '#', sha2({x}, 256), ':', CAST(length({x}) AS STRING))"
    return f"CASE WHEN length({x}) <= {n} THEN concat('=', {x}) ELSE {digest} END"


def micros_sql(x: str, dt: DataType) -> str:
    """Microseconds of a date or time, equal for equal wall clock times whatever the session's time zone.

    Of a timestamp with time zone it is the instant: its wall clock time repeats where clocks are set back.
    """
    if isinstance(dt, TimestampType):
        return f"unix_micros({x})"
    days = f"unix_date(CAST({x} AS DATE)) * 86400000000L"
    if isinstance(dt, DateType):
        return days
    return f"({days} + hour({x}) * 3600000000L + minute({x}) * 60000000L + CAST(extract(SECOND FROM {x}) * 1000000 AS BIGINT))"


def typed_key_sql(name: str, dt: DataType, digest_over: int | None = DIGEST_OVER) -> str:
    """``typed_key`` of column ``name`` as Spark SQL text (one expression, one parse)."""
    c = _sql_name(name)

    def mk(tag: int, i: str = "CAST(NULL AS BIGINT)", d: str = "CAST(NULL AS DOUBLE)", s: str = "CAST(NULL AS STRING)") -> str:
        return (f"CASE WHEN {c} IS NULL THEN NULL ELSE named_struct('t', CAST({tag} AS TINYINT), "
                f"'i', {i}, 'd', {d}, 's', {s}) END")

    if is_integral(dt):
        return mk(0, i=f"CAST({c} AS BIGINT)")
    if isinstance(dt, (FloatType, DoubleType)):
        x = f"CAST({c} AS DOUBLE)"
        integral = f"({x} = floor({x}) AND abs({x}) < 9.0E18)"
        return mk(0, i=f"CASE WHEN {integral} THEN CAST({x} AS BIGINT) END", d=f"CASE WHEN NOT {integral} THEN {x} END")
    if isinstance(dt, DecimalType):
        if dt.scale == 0 and dt.precision <= 18:
            return mk(0, i=f"CAST({c} AS BIGINT)")
        text, x = f"CAST({c} AS STRING)", f"CAST({c} AS DOUBLE)"
        whole = "TRUE" if dt.scale == 0 else f"({c} = 0 OR {text} RLIKE '[.]0*$')"
        integral = f"({whole} AND abs({x}) < 9.0E18)"
        # a double stands for the decimal only where it gives back the same decimal
        double = f"coalesce(TRY_CAST({x} AS {dt.simpleString()}) = {c}, FALSE)"
        digits = text if dt.scale == 0 else f"TRIM(TRAILING '0' FROM {text})"
        return mk(0, i=f"CASE WHEN {integral} THEN CAST({c} AS BIGINT) END",
                  d=f"CASE WHEN NOT {integral} AND {double} THEN {x} END",
                  s=f"CASE WHEN NOT {integral} AND NOT {double} THEN concat('#', {digits}) END")
    if isinstance(dt, StringType):
        return mk(1, s=text_key_sql(c, digest_over))
    if isinstance(dt, BooleanType):
        return mk(2, i=f"CASE WHEN {c} THEN 1L ELSE 0L END")
    if is_temporal(dt):
        return mk(3, i=micros_sql(c, dt))
    tag = 5 if isinstance(dt, BinaryType) else 4
    return mk(tag, s=text_key_sql(canonical_text_sql(c, dt), digest_over))


def typed_key(c: str, dt: DataType, digest_over: int | None = DIGEST_OVER) -> Column:
    """Exact, class-tagged grouping key ``struct<t, i, d, s>`` of column ``c``.

    * numbers: integral values of any numeric type in ``i``, so 1 == 1.0 across columns, as
      ``isin`` compares; other floating values in ``d`` (NaN is a value, equal to itself); decimals
      in ``i`` or ``d`` where that is exact, else all their digits in ``s``;
    * text: ``s`` (``=text``, or its start and a SHA-256 digest for long text); never equal to numbers;
    * dates and timestamps: microseconds in ``i`` under their own tag; booleans likewise;
    * binary and nested values: ``s`` of their canonical text (maps as sorted entries).

    Tags are small ints: 0 number, 1 text, 2 boolean, 3 date/time, 4 nested, 5 binary. Null cells give
    a null key. Built as one SQL expression: a per-column tree of Column calls would cost hundreds
    of driver round trips on a wide table set.
    """
    return F.expr(typed_key_sql(c, dt, digest_over))


def key_value_sql(dt: DataType, i: str = "i", s: str = "s", digest_over: int | None = DIGEST_OVER) -> str:
    """The text of a key's value as Spark SQL; null for a digest and for binary and nested values."""
    if isinstance(dt, StringType):
        whole = f"substring({s}, 2)"
        return whole if digest_over is None else f"CASE WHEN length({s}) <= {int(digest_over) + 1} THEN {whole} END"
    if isinstance(dt, BooleanType):
        return f"CASE WHEN {i} = 1 THEN 'true' WHEN {i} = 0 THEN 'false' END"
    if isinstance(dt, TimestampType):
        return f"CAST(timestamp_micros({i}) AS STRING)"
    if isinstance(dt, DateType):
        return f"CAST(date_from_unix_date(CAST({i} div 86400000000L AS INT)) AS STRING)"
    if isinstance(dt, TimestampNTZType):
        return f"CAST(timestampadd(MICROSECOND, {i}, {_EPOCH}) AS STRING)"
    return "CAST(NULL AS STRING)"
