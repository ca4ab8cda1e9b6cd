"""Profile one table or a table set into one long report.

The reference writes one workbook sheet per profiler; here the rows of all eleven reports are
normalised to ``(table_name, profile, column_name, metric, num_value, str_value)`` and
unioned, so a whole table set yields one DataFrame and one partitioned write.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, VariantType

from lakeloom.functions.patterns import anchored, patterns
from lakeloom.functions.values import _sql_name, canonical_text_sql, is_non_numeric, is_numeric, is_temporal
from lakeloom.operators import profilers
from lakeloom.operators.table_profile import CELL, ELEMENT, ROW, ProfiledColumn, profile_set
from lakeloom.operators.transforms import q

REPORT_DDL = "table_name string, profile string, column_name string, metric string, num_value double, str_value string"


def _lit(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _melted(name: str, when: str, metrics: Mapping[str, tuple[str, str]]) -> list[str]:
    """Report entries of one profile: metric -> (number, text) as Spark SQL, kept ``when`` that holds."""
    return [
        f"named_struct('profile', {_lit(name)}, 'metric', {_lit(m)}, 'num_value', CAST({num} AS DOUBLE), "
        f"'str_value', CAST({text} AS STRING), 'keep', {when})"
        for m, (num, text) in metrics.items()
    ]


def _detected(flag: str, threshold: float) -> str:
    return f"(kind = 'cell' AND cells > 0 AND {flag} >= {threshold} * cells)"


def _column_entries(threshold: float) -> dict[str, list[str]]:
    """The reports that are read off one row of statistics a column."""
    nulls, share = "(rows - cells)", "{0} / nullif(cells, 0)"
    dates = {"min_date": ("NULL", "min_date"), "max_date": ("NULL", "max_date"),
             "days": ("datediff(CAST(max_date AS DATE), CAST(min_date AS DATE))", "NULL")}
    return {
        "shape": _melted("shape", "kind = 'row'", {"rows": ("rows", "NULL"), "cols": ("cols", "NULL")}),
        "col_types": _melted("col_types", "kind = 'cell'", {"dtype": ("NULL", "dtype")}),
        "describe_non_num": _melted("describe_non_num", "describe", {
            "count": ("cells", "NULL"), "unique": ("distinct", "NULL"), "top": ("NULL", "top"),
            "freq": ("CASE WHEN cells > 0 THEN max_freq END", "NULL")}),
        "duplicate_count": _melted("duplicate_count", "kind = 'row'", {"duplicate_qty": ("cells - distinct", "NULL")}),
        "unique_cols": _melted("unique_cols", "kind = 'cell' AND distinct + CAST(rows > cells AS INT) = rows",
                               {"row_count": ("rows", "NULL")}),
        "null_counts": _melted("null_counts", "kind = 'cell'", {
            "null_count": (nulls, "NULL"), "non_null_count": ("cells", "NULL")}) + _melted("null_ratio", "kind = 'cell'", {
                "of_non_null": (f"CASE WHEN cells > 0 THEN {nulls} / cells END", "NULL"),
                "of_rows": (f"CASE WHEN rows > 0 THEN {nulls} / rows END", "NULL")}),
        "json_cols": _melted("json_cols", _detected("json", threshold), {"share": (share.format("json"), "NULL")}),
        "xml_cols": _melted("xml_cols", _detected("xml", threshold), {"share": (share.format("xml"), "NULL")}),
        "date_cols": _melted("date_cols", _detected("date", threshold), dates),
    }


# Every report of the default registry, in its order; the flatten step is an operator, not a report.
# ``null_counts`` gives its ratios as rows of the profile ``null_ratio``.
REPORTS = ("head", "col_types", "shape", "describe_non_num", "duplicate_count", "unique_cols", "null_counts",
           "json_cols", "xml_cols", "date_cols", "value_counts")
HEAD_ROWS = 5


def _is_text(x: ProfiledColumn) -> bool:
    return x.kind == CELL and isinstance(x.dtype, StringType)


# Of which columns a report needs the values; the others need no more than numbers of rows and cells.
_VALUES_OF: dict[str, Callable[[ProfiledColumn], bool]] = {
    "describe_non_num": lambda x: x.kind == CELL and is_non_numeric(x.dtype),
    "duplicate_count": lambda x: x.kind == ROW,
    "unique_cols": lambda x: x.kind == CELL,
    "json_cols": _is_text,
    "xml_cols": _is_text,
    "date_cols": lambda x: _is_text(x) or (x.kind == CELL and is_temporal(x.dtype)),
    "value_counts": lambda x: _is_text(x) or x.kind == ELEMENT,
}


def _head(df: DataFrame, table: str, order_by: Sequence[str] | str | None, n: int) -> DataFrame:
    """The first rows by ``order_by`` (all orderable columns where none is named), a metric a row."""
    keys = [order_by] if isinstance(order_by, str) else list(order_by or [
        f.name for f in df.schema.fields if not isinstance(f.dataType, (MapType, VariantType))])
    first = profilers.head(df, n, keys)
    place = F.row_number().over(Window.orderBy(*[q(k) for k in keys]))  # over the n rows only
    entries = []
    for f in df.schema.fields:
        c = _sql_name(f.name)
        if is_numeric(f.dataType):
            num, text = c, "NULL"
        elif isinstance(f.dataType, ArrayType):  # lists by their length
            num, text = f"CASE WHEN {c} IS NOT NULL THEN size({c}) END", "NULL"
        else:
            num, text = "NULL", canonical_text_sql(c, f.dataType)
        entries.append(f"named_struct('column_name', {_lit(f.name)}, 'metric', concat('row_', __row), "
                       f"'num_value', CAST({num} AS DOUBLE), 'str_value', CAST({text} AS STRING))")
    return first.withColumn("__row", place).select(
        F.lit(table).alias("table_name"), F.lit("head").alias("profile"), F.expr(f"inline(array({', '.join(entries)}))"))


def profile_report(
    tables: Mapping[str, DataFrame],
    profilers_: Mapping[str, Callable] | None = None,
    reports: Sequence[str] | None = None,
    order_by: Mapping[str, Sequence[str] | str] | None = None,
    percentage: float = 0.05,
    threshold: float = 0.95,
) -> DataFrame:
    """The reports of a whole table set (M5) as one DataFrame.

    All but ``head`` come from one pass over each table (``table_profile``), which counts the values of
    the columns that the named reports need them of; ``head`` is a top-n of its own. ``profilers_`` are functions ``(df, table) -> report rows`` of the caller; given alone they
    take the place of the default reports, with ``reports`` they come on top of those named.
    """
    if reports is None:
        reports = REPORTS if profilers_ is None else ()
    unknown = set(reports) - set(REPORTS)
    if unknown:
        raise ValueError(f"unknown reports {sorted(unknown)}; known: {list(REPORTS)}")
    order = ["table_name", "profile", "column_name", "metric", "num_value", "str_value"]
    frames: list[DataFrame] = []
    entries = [e for name, es in _column_entries(threshold).items() if name in reports for e in es]
    if entries or "value_counts" in reports:
        found = profile_set(tables, percentage, counted=lambda x: any(r in _VALUES_OF and _VALUES_OF[r](x) for r in reports))
        known = found.stats.join(F.broadcast(found.tops), "c", "left")  # one row a column
        if entries:
            frames.append(known.select("table_name", "column_name", F.expr(f"inline(array({', '.join(entries)}))"))
                          .where("keep").select(*order))
        if "value_counts" in reports:
            names = F.broadcast(found.stats.select("c", "table_name", "column_name"))
            frames.append(found.shares.join(names, "c").select(
                "table_name", F.lit("value_counts").alias("profile"), "column_name", F.lit("share").alias("metric"),
                F.col("share").alias("num_value"), F.col("value").alias("str_value")))
    if "head" in reports:
        frames += [_head(df, t, (order_by or {}).get(t), HEAD_ROWS).select(*order) for t, df in tables.items()]
    # functions of the caller may return other shapes: missing columns become null
    frames += [fn(df, t) for t, df in tables.items() for fn in (profilers_ or {}).values()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# Report name -> that report of one table alone, to pick from or to mix with a caller's own functions.
DEFAULT_PROFILERS: dict[str, Callable[[DataFrame, str], DataFrame]] = {
    name: (lambda df, table, name=name: profile_report({table: df}, reports=[name])) for name in REPORTS
}


def profile(df: DataFrame, table: str = "table", profilers_: Mapping[str, Callable] | None = None, **options) -> DataFrame:
    """Every report of one table (M6)."""
    return profile_report({table: df}, profilers_, **options)


def write_report(report: DataFrame, path: str, fmt: str = "parquet", run_date: str | None = None) -> None:
    """Report sink of any tool, partitioned by run date and profile where there are any (K7, K8)."""
    parts = ["profile"] if "profile" in report.columns else []
    if run_date:
        report = report.withColumn("run_date", F.lit(run_date))
        parts = ["run_date", *parts]
    writer = report.write.mode("overwrite").format(fmt)
    (writer.partitionBy(*parts) if parts else writer).save(path)


# ------------------------------------------------------------------- oracle SQL

def report_sql(tables: Sequence[str]) -> str:
    """DuckDB SQL producing the same report as ``profile_report`` on the driver tables."""
    from lakeloom.plans.tables import ORDER_KEYS, SCHEMAS

    spark_names = {"int": "int", "long": "bigint", "double": "double", "string": "string", "ts": "timestamp_ntz",
                   "floats": "array<float>"}
    parts: list[str] = []
    date = patterns(True)

    def is_date(c):
        return " OR ".join(f"regexp_matches(CAST({c} AS VARCHAR), '{anchored(date[k])}')" for k in ("date", "date_alt"))

    def row(t, prof, col, metric, num, text="NULL"):
        c = f"'{col}'" if col is not None else "NULL"
        return (f"SELECT '{t}' AS table_name, '{prof}' AS profile, CAST({c} AS VARCHAR) AS column_name, "
                f"'{metric}' AS metric, CAST({num} AS DOUBLE) AS num_value, CAST({text} AS VARCHAR) AS str_value")

    def share(t, c, test):
        return f"(SELECT avg(CASE WHEN {c} IS NULL THEN NULL WHEN {test.format(x=c)} THEN 1 ELSE 0 END) AS s FROM {t})"

    for t in tables:
        cols = SCHEMAS[t]
        parts.append(row(t, "shape", None, "rows", "COUNT(*)") + f" FROM {t}")
        parts.append(row(t, "shape", None, "cols", len(cols)))
        first = f"(SELECT *, row_number() OVER (ORDER BY {', '.join(ORDER_KEYS[t])}) AS place FROM {t})"
        for c, k in cols:
            num = {"floats": f"len({c})", "string": "NULL", "ts": "NULL"}.get(k, c)
            text = c if k in ("string", "ts") else "NULL"
            parts.append(f"SELECT '{t}', 'head', '{c}', 'row_' || place, CAST({num} AS DOUBLE), CAST({text} AS VARCHAR) "
                         f"FROM {first} WHERE place <= {HEAD_ROWS}")
            parts.append(row(t, "col_types", c, "dtype", "NULL", f"'{spark_names[k]}'"))
            nulls = f"(COUNT(*) - COUNT({c}))"
            for prof, metric, sql in (("null_counts", "null_count", nulls), ("null_counts", "non_null_count", f"COUNT({c})"),
                                      ("null_ratio", "of_non_null", f"CASE WHEN COUNT({c}) > 0 THEN {nulls} / COUNT({c}) END"),
                                      ("null_ratio", "of_rows", f"CASE WHEN COUNT(*) > 0 THEN {nulls} / COUNT(*) END")):
                parts.append(row(t, prof, c, metric, sql) + f" FROM {t}")
            parts.append(
                row(t, "unique_cols", c, "row_count", "COUNT(*)")
                + f" FROM {t} HAVING COUNT(DISTINCT {c}) + MAX(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) = COUNT(*)"
            )
        all_cols = ", ".join(c for c, _ in cols)
        parts.append(
            row(t, "duplicate_count", None, "duplicate_qty",
                f"COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT {all_cols} FROM {t}))") + f" FROM {t}"
        )
        for c, k in cols:
            if k not in ("string", "ts", "floats"):
                continue
            freq = f"(SELECT {c} AS v, COUNT(*) AS n FROM {t} WHERE {c} IS NOT NULL GROUP BY 1)"
            parts.append(row(t, "describe_non_num", c, "count", "coalesce(SUM(n), 0)") + f" FROM {freq}")
            parts.append(row(t, "describe_non_num", c, "unique", "COUNT(*)") + f" FROM {freq}")
            parts.append(row(t, "describe_non_num", c, "freq", "MAX(n)") + f" FROM {freq}")
            top = "NULL" if k == "floats" else "first(v ORDER BY n DESC, v ASC)"
            parts.append(row(t, "describe_non_num", c, "top", "NULL", top) + (f" FROM {freq}" if k != "floats" else ""))
            if k == "string":
                parts.append(
                    f"SELECT '{t}', 'value_counts', '{c}', 'share', CAST(n / SUM(n) OVER () AS DOUBLE), CAST(v AS VARCHAR) "
                    f"FROM {freq} QUALIFY n / SUM(n) OVER () >= 0.05"
                )
                for prof, test in (("json_cols", "(contains({x}, '{{') AND contains({x}, ':'))"),
                                   ("xml_cols", "contains({x}, '<')")):
                    parts.append(row(t, prof, c, "share", "s") + f" FROM {share(t, c, test)} WHERE s >= 0.95")
            if k in ("string", "ts"):
                day = c if k == "ts" else f"TRY_CAST({c} AS TIMESTAMP)"
                dated = (f"(SELECT min({day}) AS lo, max({day}) AS hi FROM {t} HAVING avg(CASE WHEN {c} IS NULL THEN NULL "
                         f"WHEN {is_date(c)} THEN 1 ELSE 0 END) >= 0.95)")
                parts.append(row(t, "date_cols", c, "min_date", "NULL", "lo") + f" FROM {dated}")
                parts.append(row(t, "date_cols", c, "max_date", "NULL", "hi") + f" FROM {dated}")
                parts.append(row(t, "date_cols", c, "days", "datediff('day', CAST(lo AS DATE), CAST(hi AS DATE))")
                             + f" FROM {dated}")
    return "\nUNION ALL\n".join(parts)


def profile_files(spark, paths: Sequence[str], out: str | None = None, run_date: str | None = None) -> DataFrame:
    """Profile named CSV/Parquet files (M6): read by extension, one report, optionally written."""
    from lakeloom.sources.files import read_any

    tables = {p.rstrip("/").rsplit("/", 1)[-1]: read_any(spark, p) for p in paths}
    report = profile_report(tables)
    if out:
        write_report(report, out, run_date=run_date)
    return report


def profile_directory(spark, directory: str, out: str | None = None, run_date: str | None = None,
                      formats: tuple[str, ...] = ("parquet", "csv")) -> DataFrame:
    """Profile every table file of a folder or container path."""
    from lakeloom.sources.tablesets import read_table_set

    report = profile_report(read_table_set(spark, directory, formats=formats))
    if out:
        write_report(report, out, run_date=run_date)
    return report


def profile_database(spark, database: str | None = None, out: str | None = None,
                     run_date: str | None = None) -> DataFrame:
    """Profile every table of a Spark catalog database (M5 for catalog/JDBC-registered sources)."""
    from lakeloom.sources.tablesets import catalog_table_set

    report = profile_report(catalog_table_set(spark, database))
    if out:
        write_report(report, out, run_date=run_date)
    return report
