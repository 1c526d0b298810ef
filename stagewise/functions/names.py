"""Column-name handling: quoting, and parsing of comma-listed key columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """Backtick-quote a column name so that dots, blanks and backticks are literal."""
    return "`" + name.replace("`", "``") + "`"


def column(name: str, side: str | None = None) -> Column:
    """Reference a column by its exact name, optionally of one aliased join side."""
    return F.col(f"{side}.{quoted(name)}" if side else quoted(name))


def columns(names: Iterable[str], side: str | None = None) -> list[Column]:
    return [column(name, side) for name in names]


def key_list(text: str | Iterable[str]) -> list[str]:
    """``"[a],[b]"`` or ``"a,b"`` as ``["a", "b"]``; lists pass through."""
    if not isinstance(text, str):
        return list(text)
    names = [part.strip() for part in text.replace("[", "").replace("]", "").split(",")]
    return [name for name in names if name]
