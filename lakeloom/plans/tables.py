"""The driver tables: names, column types and the key that orders each table's rows.

Used to build the registered queries and their SQL oracles; the data itself is
always read from parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    ArrayType,
    DataType,
    StructField,
    StructType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    TimestampNTZType,
)

_T = {
    "int": IntegerType(),
    "long": LongType(),
    "double": DoubleType(),
    "string": StringType(),
    "ts": TimestampNTZType(),
    "floats": ArrayType(FloatType()),
}

SCHEMAS: dict[str, list[tuple[str, str]]] = {
    "region": [("r_regionkey", "int"), ("r_name", "string")],
    "nation": [("n_nationkey", "int"), ("n_name", "string"), ("n_regionkey", "int")],
    "customer": [("c_custkey", "long"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"),
                 ("c_mktsegment", "string")],
    "supplier": [("s_suppkey", "long"), ("s_name", "string"), ("s_nationkey", "int"), ("s_acctbal", "double")],
    "part": [("p_partkey", "long"), ("p_name", "string"), ("p_brand", "string"), ("p_type", "string"),
             ("p_size", "int"), ("p_retailprice", "double")],
    "orders": [("o_orderkey", "long"), ("o_custkey", "long"), ("o_orderstatus", "string"), ("o_totalprice", "double"),
               ("o_orderdate", "ts"), ("o_orderpriority", "string")],
    "lineitem": [("l_orderkey", "long"), ("l_partkey", "long"), ("l_suppkey", "long"), ("l_linenumber", "int"),
                 ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"),
                 ("l_returnflag", "string"), ("l_linestatus", "string"), ("l_shipdate", "ts")],
    "events": [("event_id", "long"), ("ts", "ts"), ("user_id", "long"), ("event_type", "string"), ("value", "double"),
               ("props", "string")],
    "documents": [("doc_id", "long"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "long")],
    "embeddings": [("vec_id", "long"), ("embedding", "floats"), ("label", "int")],
    "pages": [("page_id", "long"), ("url", "string"), ("html", "string")],
    "benchmark": [("item_id", "long"), ("text", "string")],
    "labels": [("doc_id", "long"), ("quality", "int"), ("toxic", "int")],
    "conversations": [("conv_id", "long"), ("turn", "long"), ("role", "string"), ("text", "string")],
}

# Row order of each table (stands in for file order where "the first row" matters).
ORDER_KEYS: dict[str, list[str]] = {
    "region": ["r_regionkey"],
    "nation": ["n_nationkey"],
    "customer": ["c_custkey"],
    "supplier": ["s_suppkey"],
    "part": ["p_partkey"],
    "orders": ["o_orderkey"],
    "lineitem": ["l_orderkey", "l_linenumber"],
    "events": ["event_id"],
    "documents": ["doc_id"],
    "embeddings": ["vec_id"],
    "pages": ["page_id"],
    "benchmark": ["item_id"],
    "labels": ["doc_id"],
    "conversations": ["conv_id", "turn"],
}

TABLE_NAMES = list(SCHEMAS)


def dtype(table: str, column: str) -> DataType:
    return _T[dict(SCHEMAS[table])[column]]


def columns(table: str, kinds: tuple[str, ...] | None = None) -> list[str]:
    return [c for c, k in SCHEMAS[table] if kinds is None or k in kinds]


def schema_of(name: str) -> StructType:
    return StructType([StructField(c, _T[k]) for c, k in SCHEMAS[name]])


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table with the schema its own files state."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_all(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> dict[str, DataFrame]:
    return {n: load(spark, sf_dir, n) for n in (names or TABLE_NAMES)}
