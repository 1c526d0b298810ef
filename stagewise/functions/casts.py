"""Strict text-to-type casts: text that does not spell the type gives null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stagewise.functions.timestamps import parse_timestamp

# Spelling of whole and fractional numbers.
WHOLE_NUMBER = r"^[+-]?[0-9]+$"
FRACTION = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"

# Type groups in output order, under every name a schema may use.
TYPE_GROUPS = ("string", "int", "bigint", "double", "float", "timestamp")
TYPE_NAMES = {
    "String": "string", "StringType": "string", "string": "string",
    "Integer": "int", "IntegerType": "int", "int": "int",
    "Long": "bigint", "LongType": "bigint", "bigint": "bigint",
    "Double": "double", "DoubleType": "double", "double": "double",
    "Float": "float", "FloatType": "float", "float": "float",
    "Timestamp": "timestamp", "TimestampType": "timestamp", "timestamp": "timestamp",
}


def type_group(name: str) -> str:
    """Canonical type group; unknown names mean string."""
    return TYPE_NAMES.get(name, "string")


def strict_cast(text: Column, group: str) -> Column:
    if group == "timestamp":
        return parse_timestamp(text)
    if group in ("int", "bigint"):
        return F.when(text.rlike(WHOLE_NUMBER), text.try_cast(group))
    if group in ("double", "float"):
        return F.when(text.rlike(FRACTION), text.try_cast(group))
    return text


def is_bad(text: Column, cast: Column) -> Column:
    """Whether a value is present and its cast failed; null and '' are never bad."""
    return text.isNotNull() & (text != "") & cast.isNull()
