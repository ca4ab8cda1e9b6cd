"""JSON column helpers: detection predicates, schema inference, struct flattening."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType


def looks_like_json(text: Column) -> Column:
    """The reference's JSON test: the text holds both ``{`` and ``:``."""
    return text.contains("{") & text.contains(":")


def looks_like_xml(text: Column) -> Column:
    """The reference's markup test: the text holds ``<``."""
    return text.contains("<")


def _variant_ddl_to_struct_ddl(ddl: str) -> str:
    # schema_of_variant_agg renders objects as OBJECT<...>; from_json wants STRUCT<...>.
    return re.sub(r"\bOBJECT<", "STRUCT<", ddl)


def _object_variant(column: str) -> str:
    """The cell as a variant where it holds a JSON object, else null, as Spark SQL."""
    c = "`" + column.replace("`", "``") + "`"
    return f"CASE WHEN ltrim({c}) LIKE '{{%' THEN try_parse_json({c}) END"


def infer_json_schemas(df: DataFrame, columns: Sequence[str], threshold: float = 0.0,
                       first_by: Sequence[str] | None = None) -> dict[str, str]:
    """Column -> ``STRUCT<...>`` DDL of the JSON objects in each text column, from *all* its rows.

    One aggregate for all columns: ``schema_of_variant_agg`` merges partial schemas on the executors
    and only one row of DDL strings reaches the driver. Only cells that hold objects count; scalars,
    lists and broken text parse to null later. A column is given if at least ``threshold`` of its
    non-null cells begin and end as objects do, or, with ``first_by``, if the first row by those columns looks like JSON.
    """
    columns = list(columns)
    if not columns:
        return {}
    aggs = []
    for i, c in enumerate(columns):
        name = "`" + c.replace("`", "``") + "`"
        aggs.append(F.expr(f"schema_of_variant_agg({_object_variant(c)}) AS s{i}"))
        aggs.append(F.expr(f"avg(CASE WHEN {name} IS NOT NULL THEN CAST(trim({name}) LIKE '{{%}}' AS INT) END) AS p{i}"))
        if first_by is not None:
            key = ", ".join("`" + k.replace("`", "``") + "`" for k in first_by)
            aggs.append(F.expr(f"min_by({name}, struct({key})) AS f{i}"))
    row = df.agg(*aggs).first()
    out = {}
    for i, c in enumerate(columns):
        ddl = row[f"s{i}"]
        if not ddl or not ddl.startswith("OBJECT<"):
            continue
        if first_by is not None:
            chosen = row[f"f{i}"] is not None and "{" in row[f"f{i}"] and ":" in row[f"f{i}"]
        else:
            chosen = (row[f"p{i}"] or 0.0) >= threshold
        if chosen:
            out[c] = _variant_ddl_to_struct_ddl(ddl)
    return out


def infer_json_schema(df: DataFrame, column: str) -> str | None:
    """The schema of one JSON text column, or None when no row is a JSON object."""
    return infer_json_schemas(df, [column]).get(column)


def flatten_struct_columns(struct_col: Column, schema: StructType, prefix: str = "") -> list[Column]:
    """Recursive dotted-name expansion of a struct; arrays stay arrays."""
    out: list[Column] = []
    for field in schema.fields:
        name = f"{prefix}{field.name}"
        child = struct_col.getField(field.name)
        if isinstance(field.dataType, StructType):
            out.extend(flatten_struct_columns(child, field.dataType, prefix=f"{name}."))
        else:
            out.append(child.alias(name))
    return out


def is_nested(dt) -> bool:
    return isinstance(dt, (StructType, ArrayType))
