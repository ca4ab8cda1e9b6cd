"""Expression builders: everything here returns a ``Column`` evaluated JVM-side."""

from lakeloom.functions.casts import legacy_cast, lenient_text, percent_text
from lakeloom.functions.json import (
    flatten_struct_columns,
    infer_json_schema,
    looks_like_json,
    looks_like_xml,
)
from lakeloom.functions.patterns import is_date_text, semantic_type
from lakeloom.functions.values import group_key, is_digest, key_start, tagged_value, text_of

__all__ = [
    "legacy_cast",
    "lenient_text",
    "percent_text",
    "flatten_struct_columns",
    "infer_json_schema",
    "looks_like_json",
    "looks_like_xml",
    "is_date_text",
    "semantic_type",
    "group_key",
    "is_digest",
    "key_start",
    "tagged_value",
    "text_of",
]
