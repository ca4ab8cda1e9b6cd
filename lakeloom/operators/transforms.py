"""Row-wise transforms of the bronze and silver layers.

All are projections: narrow, no shuffle, fused into one whole-stage-codegen stage.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

from lakeloom.functions.casts import legacy_cast
from lakeloom.functions.json import flatten_struct_columns, infer_json_schemas
from lakeloom.functions.patterns import anchored, patterns
from lakeloom.functions.values import is_temporal


def q(name: str) -> Column:
    """Column by exact name; dots and spaces in names are literal."""
    return F.col("`" + name.replace("`", "``") + "`")


def cast_all_to_string(df: DataFrame) -> DataFrame:
    """Every column as text, names kept as they are."""
    return df.select([q(c).cast(StringType()).alias(c) for c in df.columns])


def parse_json_column(df: DataFrame, column: str, schema: StructType | str, into: str = "payload") -> DataFrame:
    """Parse JSON text with a fixed schema into a struct column.

    Malformed text gives a struct of nulls, null text gives null (PERMISSIVE ``from_json``).
    """
    return df.withColumn(into, F.from_json(q(column), schema))


def flatten_payload(
    df: DataFrame,
    column: str,
    schema: StructType | str,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Parse ``column`` and expand its fields next to the kept columns (P2 + P3).

    ``keep=None`` keeps every column except the JSON text itself.
    """
    keep = [c for c in df.columns if c != column] if keep is None else list(keep)
    parsed = F.from_json(q(column), schema)
    return df.select(*[q(c) for c in keep], parsed.alias("__payload")).select(
        *[q(c) for c in keep], "__payload.*"
    )


def flatten_json_auto(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    mode: str = "share",
    threshold: float = 0.5,
    order_by: str | Sequence[str] | None = None,
    expand_lists: int = 0,
) -> DataFrame:
    """Append the fields of JSON text columns with dotted names.

    One aggregate infers the schemas of all text columns from all rows. ``columns=None`` flattens the
    columns that hold JSON: with ``mode="share"`` where at least ``threshold`` of the non-null cells
    begin and end as objects do, with ``mode="first"`` where the first row by ``order_by`` does (the reference's
    rule). The original column is kept; a cell that is no object gives nulls; nested objects
    become ``a.b`` columns; lists stay lists, and their first ``expand_lists`` elements become columns
    ``a.0``, ``a.1``, ... as well. Clashing names get the source column as prefix.
    """
    if mode not in ("share", "first"):
        raise ValueError(f"mode must be 'first' or 'share', got {mode!r}")
    first_by = None
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
        if mode == "first":
            if order_by is None:
                raise ValueError("mode='first' needs order_by: a DataFrame has no first row")
            first_by = [order_by] if isinstance(order_by, str) else list(order_by)
    else:
        threshold = 0.0
    schemas = infer_json_schemas(df, columns, threshold, first_by)
    taken, parsed, new = set(df.columns), [], []
    for i, (c, ddl) in enumerate(schemas.items()):
        holder = f"__json{i}"
        parsed.append(F.from_json(q(c), ddl).alias(holder))
        struct_t = StructType.fromDDL(f"s {ddl}")["s"].dataType
        fields = list(zip(_flat_names(struct_t), flatten_struct_columns(q(holder), struct_t), _flat_types(struct_t)))
        for fname, value, dt in fields:
            pieces = [(fname, value)]
            if expand_lists and isinstance(dt, ArrayType):
                pieces += [(f"{fname}.{k}", F.get(value, F.lit(k))) for k in range(expand_lists)]
            for name, col in pieces:
                name = name if name not in taken else f"{c}.{name}"
                taken.add(name)
                new.append(col.alias(name))
    if not new:
        return df
    return df.select("*", *parsed).select(*[q(c) for c in df.columns], *new)


def _flat_types(schema: StructType) -> list[DataType]:
    out: list[DataType] = []
    for f in schema.fields:
        out.extend(_flat_types(f.dataType) if isinstance(f.dataType, StructType) else [f.dataType])
    return out


def _flat_names(schema: StructType, prefix: str = "") -> list[str]:
    names: list[str] = []
    for f in schema.fields:
        if isinstance(f.dataType, StructType):
            names.extend(_flat_names(f.dataType, f"{prefix}{f.name}."))
        else:
            names.append(f"{prefix}{f.name}")
    return names


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by a dict; names absent from ``df`` are ignored like ``withColumnRenamed``."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def cast_columns(df: DataFrame, casts: Mapping[str, str | DataType]) -> DataFrame:
    """Cast by a dict of DDL types with the ANSI-safe lenient cast."""
    missing = [c for c in casts if c not in df.columns]
    if missing:
        raise KeyError(f"cannot cast missing columns {missing}")
    return df.withColumns({c: legacy_cast(q(c), t) for c, t in casts.items()})


# Named time functions allowed for derived (partition) columns.
TIME_FUNCTIONS = {
    "year": F.year,
    "quarter": F.quarter,
    "month": F.month,
    "dayofmonth": F.dayofmonth,
    "hour": F.hour,
}


def derive_time_columns(df: DataFrame, spec: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """``{source: {new_column: function_name}}`` -> new columns.

    Unknown function names raise ``ValueError`` instead of being skipped silently.
    """
    new: dict[str, Column] = {}
    for source, derived in spec.items():
        for new_col, fname in derived.items():
            fn = TIME_FUNCTIONS.get(fname)
            if fn is None:
                raise ValueError(f"unknown time function {fname!r}; allowed: {sorted(TIME_FUNCTIONS)}")
            new[new_col] = fn(q(source))
    return df.withColumns(new) if new else df


# Text formats tried, in order, after the ISO forms a plain cast understands.
_DAY_FIRST_FORMATS = ("dd.MM.yyyy", "dd/MM/yyyy", "dd-MM-yyyy", "yyyy/MM/dd", "yyyy.MM.dd")
_MONTH_FIRST_FORMATS = ("MM.dd.yyyy", "MM/dd/yyyy", "MM-dd-yyyy", "yyyy/MM/dd", "yyyy.MM.dd")


def _once(value: Column, of: Callable[[Column], Column]) -> Column:
    """``of(value)`` with the value worked out once; a filter would do so at every place that names it."""
    return F.get(F.transform(F.array(value), lambda x: of(x)), F.lit(0))


def _separated(head: Column, fmt: str) -> Column:
    """Whether a text has the separators of ``fmt`` where any text that the format reads has them."""
    year_last = fmt.endswith("yyyy")
    sep = fmt[2] if year_last else fmt[4]
    places = (3, 6) if year_last else (-3, -6)  # a year may have more than four digits, day and month have two
    return (F.substring(head, places[0], 1) == sep) & (F.substring(head, places[1], 1) == sep)


def parse_datetime(c: Column, dt: DataType | None = None, day_first: bool = True) -> Column:
    """Mixed-format text to ``timestamp_ntz``; null when no format fits.

    Day-first is explicit: ``05.06.2013`` is 5 June with ``day_first=True``. No text fits two formats, and
    a format is tried only on texts with its separators: a failed parse costs far more than a read one.
    """
    if dt is not None and is_temporal(dt):
        return c.cast("timestamp_ntz")
    fmts = _DAY_FIRST_FORMATS if day_first else _MONTH_FIRST_FORMATS

    def day_of(head: Column) -> Column:
        return F.coalesce(*[F.when(_separated(head, f), F.try_to_timestamp(head, F.lit(f))) for f in fmts])

    def moment(text: Column, head: Column, day: Column) -> Column:
        clock = F.regexp_extract(text, r"^\S+\s+(.+)$", 1)
        timed = F.concat(F.date_format(day, "yyyy-MM-dd "), clock).try_cast("timestamp_ntz")
        whole_day = day.cast("date").cast("timestamp_ntz")
        return F.coalesce(F.when(head == text, whole_day).otherwise(timed), day.cast("timestamp_ntz"))  # or an unread time

    def read(text: Column) -> Column:
        other = _once(F.regexp_extract(text, r"^(\S+)", 1), lambda h: _once(day_of(h), lambda d: moment(text, h, d)))
        return F.coalesce(text.try_cast("timestamp_ntz"), other)

    return _once(F.trim(c.cast("string")), read)


def first_temporal_column(df: DataFrame) -> str | None:
    for f in df.schema.fields:
        if is_temporal(f.dataType):
            return f.name
    return None


@dataclass(frozen=True)
class DateVote:
    """What the cells of a text column say about its dates: share of date-like cells, order of day and month."""

    share: float
    day_first: bool


# Cells with the year last: two numbers of two digits, of which only the day may exceed twelve.
_YEAR_LAST = "^[0-9]{2}[-./ ][0-9]{2}[-./ ][0-9]{4}"


def _vote_sql(column: str) -> dict[str, str]:
    """Aggregates of one text column: date-like share, and the cells only day-first or month-first fits."""
    c = "`" + column.replace("`", "``") + "`"
    p = patterns(True)
    like = f"({c} RLIKE '{anchored(p['date'])}' OR {c} RLIKE '{anchored(p['date_alt'])}')"
    first, second = f"CAST(substring({c}, 1, 2) AS INT)", f"CAST(substring({c}, 4, 2) AS INT)"

    def cells(number: str) -> str:
        return f"count(CASE WHEN {c} RLIKE '{_YEAR_LAST}' THEN CASE WHEN {number} > 12 THEN 1 END END)"

    return {"share": f"avg(CASE WHEN {c} IS NOT NULL THEN CAST({like} AS INT) END)", "dmy": cells(first), "mdy": cells(second)}


def vote_date_formats(tables: Mapping[str, DataFrame], default_day_first: bool = True) -> dict[tuple[str, str], DateVote]:
    """(table, column) -> vote for every text column of a table set (X8, R13, F3), in one job.

    A cell whose first number exceeds twelve can only be day-first, one whose second does only
    month-first; the larger number of such cells wins, a tie goes to ``default_day_first``. All are
    mergeable aggregates, one row a table.
    """
    frames, names = [], []
    for table, df in tables.items():
        text = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
        if not text:
            continue
        aggs, entries = [], []
        for c in text:
            i = len(names)
            names.append((table, c))
            aggs += [F.expr(f"{sql} AS {k}{i}") for k, sql in _vote_sql(c).items()]
            entries.append(f"named_struct('i', {i}, 'share', share{i}, 'dmy', dmy{i}, 'mdy', mdy{i})")
        frames.append(df.agg(*aggs).select(F.expr(f"inline(array({', '.join(entries)}))")))
    if not frames:
        return {}
    out = {}
    for r in reduce(lambda a, b: a.unionByName(b), frames).collect():  # one row a text column
        first = default_day_first if r["dmy"] == r["mdy"] else r["dmy"] > r["mdy"]
        out[names[r["i"]]] = DateVote(float(r["share"] or 0.0), first)
    return out


def daily_slice(
    df: DataFrame,
    day: str | date | None = None,
    date_column: str | None = None,
    day_first: bool | None = None,
    threshold: float = 0.95,
    votes: Mapping[str, DateVote] | None = None,
) -> DataFrame:
    """Rows of one day by the first date column; the whole table when it has none.

    The first typed date/timestamp column is used, else the first text column of which at least
    ``threshold`` of the cells look like dates. ``day_first=None`` lets the column's cells elect the order of
    day and month (``vote_date_formats``; ``votes`` may come from a job over a whole table set). ``day``
    defaults to today. On typed columns the predicate is a range that reaches the parquet scan.
    """
    col_name = date_column or first_temporal_column(df)
    if col_name is None or not is_temporal(df.schema[col_name].dataType):
        text = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType) and col_name in (None, f.name)]
        if votes is None and (col_name is None or day_first is None):
            votes = {c: v for (_, c), v in vote_date_formats({"": df.select(*[q(c) for c in text])}).items()} if text else {}
        if col_name is None:
            col_name = next((c for c in text if c in votes and votes[c].share >= threshold), None)
        if day_first is None:
            day_first = votes[col_name].day_first if votes and col_name in votes else True
    if col_name is None:
        return df
    dt = df.schema[col_name].dataType
    day_col = F.current_date() if day is None else F.lit(str(day)).cast("date")
    if is_temporal(dt):
        c = q(col_name)
        # a range predicate on the raw column is pushed into the parquet reader
        start = day_col.cast("timestamp_ntz")
        end = F.date_add(day_col, 1).cast("timestamp_ntz")
        return df.where((c.cast("timestamp_ntz") >= start) & (c.cast("timestamp_ntz") < end))
    return df.where(_once(parse_datetime(q(col_name), day_first=day_first), lambda t: F.to_date(t) == day_col))


def daily_slices(tables: Mapping[str, DataFrame], day: str | date | None = None) -> dict[str, DataFrame]:
    """One day of every table of a set; the date columns of all tables without a typed one are found in one job."""
    untyped = {t: df for t, df in tables.items() if first_temporal_column(df) is None}
    votes = vote_date_formats(untyped)
    return {
        t: daily_slice(df, day, votes={c: v for (table, c), v in votes.items() if table == t} if t in untyped else None)
        for t, df in tables.items()
    }
