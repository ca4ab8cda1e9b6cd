"""Cast builders that behave the same whatever the session's ANSI setting is.

A plain ``cast('7.0' AS INT)`` throws under ANSI mode and gives 7 without it;
``try_cast('7.0' AS INT)`` is null in both. ``legacy_cast`` reproduces the lenient
(non-ANSI) text-to-integer cast with ANSI-safe built-ins, so casting bronze text
never fails a job and never depends on the session configuration.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
)

# Leading sign and digits, optional fraction that is truncated away.
_INTEGRAL_TEXT = r"^([+-]?[0-9]+)(\.[0-9]*)?$"

_INTEGRAL = ("tinyint", "smallint", "int", "bigint")


def _ddl(type_: str | DataType) -> str:
    if isinstance(type_, DataType):
        return type_.simpleString()
    aliases = {
        "integer": "int",
        "integertype": "int",
        "long": "bigint",
        "longtype": "bigint",
        "short": "smallint",
        "byte": "tinyint",
        "floattype": "float",
        "doubletype": "double",
        "datetype": "date",
        "stringtype": "string",
        "timestamptype": "timestamp",
        "booleantype": "boolean",
    }
    t = type_.strip().lower()
    return aliases.get(t, t)


def legacy_cast(col: str | Column, type_: str | DataType) -> Column:
    """Cast with non-ANSI leniency: bad input becomes null, ``'7.9'`` becomes 7 for ints."""
    c = F.col(col) if isinstance(col, str) else col
    ddl = _ddl(type_)
    if ddl in _INTEGRAL:
        text = F.trim(c.cast("string"))
        digits = F.regexp_extract(text, _INTEGRAL_TEXT, 1)
        return digits.try_cast(ddl)
    if ddl == "string":
        return c.cast(StringType())
    return c.try_cast(ddl)


def is_integral(dt: DataType) -> bool:
    return isinstance(dt, (ByteType, ShortType, IntegerType, LongType))


def lenient_text(c: Column) -> Column:
    """Binary to text, invalid UTF-8 bytes replaced by U+FFFD instead of failing.

    The reference's decoder drops undecodable bytes; replacing them keeps lengths honest.
    """
    return F.make_valid_utf8(c.cast("string"))


def percent_text(ratio: Column, digits: int = 1) -> Column:
    """A ratio as percent text, e.g. 0.25 -> ``25.0%``.

    Reports keep the number; this is for display only. Java rounds half up, so 0.1225 is
    ``12.3%`` here where Python's float formatting may print ``12.2%``.
    """
    return F.when(ratio.isNotNull(), F.format_string(f"%.{digits}f%%", ratio * 100))
