"""Cleansing of raw text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for a missing value.
NULL_TOKENS = ("", r"\N")

# Fixed value: shape of a 8-4-4-4-12 identifier.
UUID_REGEX = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"


def null_tokens_to_null(text: Column, tokens: tuple[str, ...] = NULL_TOKENS) -> Column:
    return F.when(~text.isin(*tokens), text)


def uuid_or_null(text: Column) -> Column:
    """Lower-case identifier, or null where the text has no such shape."""
    return F.when(text.rlike(UUID_REGEX), F.lower(text))


def normalise_key_list(text: Column) -> Column:
    """``[a],[b]`` as ``a,b``."""
    return F.translate(text, "[]", "")


def labelled_values(names: list[str], values: list[Column]) -> Column:
    """``(name,value), (name,value)`` text of one row."""
    pairs = [
        F.concat(F.lit(f"({name},"), F.coalesce(value.cast("string"), F.lit("null")), F.lit(")"))
        for name, value in zip(names, values, strict=True)
    ]
    return F.concat_ws(", ", *pairs)
