"""Row-level operators: hashes, de-duplication, re-assembly by hash, splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagewise.functions.names import column, columns
from stagewise.functions.text import labelled_values


def row_hash(names: Sequence[str], separator: str = ",") -> Column:
    """MD5 of the joined column texts. Nulls are skipped and separators are not
    escaped, so different rows can share a hash; see :func:`row_identity`."""
    return F.md5(F.concat_ws(separator, *columns(names)))


def row_identity(names: Sequence[str]) -> Column:
    """SHA-256 of the row as JSON with null fields kept: distinct rows stay apart."""
    return F.sha2(F.to_json(F.struct(*columns(names)), {"ignoreNullFields": "false"}), 256)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Unique rows; copies are folded before the shuffle."""
    return df.distinct()


def rejoin_on_hash(left: DataFrame, right: DataFrame, hash_column: str = "Hash") -> DataFrame:
    """Re-assemble rows from two projections that carry the same row hash.

    Both sides must be distinct on the hash. Type enforcement does without this join;
    it stays for rows whose parts come from different sources.
    """
    return left.join(right, hash_column, "inner")


def split_to_rows(df: DataFrame, text: str, separator: str = ",", keep: Sequence[str] = ()) -> DataFrame:
    """One row per part of a text, with its position from 0; ``separator`` is taken literally."""
    pattern = r"\Q" + separator.replace(r"\E", r"\E\\E\Q") + r"\E"
    return df.select(*columns(keep), F.posexplode(F.split(column(text), pattern)).alias("position", "part"))


def rows_to_text(df: DataFrame, by: Sequence[str], text: Column, order: Sequence[Column], separator: str = ",") -> DataFrame:
    """The texts of each group's rows joined in order; null texts are left out.

    A group becomes one value, so it has to fit into one. Rows that tie in ``order``
    follow each other by their texts.
    """
    ranks = [F.struct(value.isNull(), value).alias(f"_{i}") for i, value in enumerate(order)]
    rows = df.select(*columns(by), *ranks, text.cast("string").alias("_text")).filter("_text IS NOT NULL")
    listed = F.array_sort(F.collect_list(F.struct(*[f"_{i}" for i in range(len(ranks))], "_text")))
    return rows.groupBy(*columns(by)).agg(F.array_join(F.transform(listed, lambda row: row["_text"]), separator).alias("text"))


def first_row_text(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The first row under an explicit order as ``(column,value), ...`` text."""
    first = df.orderBy(*order).limit(1)
    return first.select(labelled_values(df.columns, columns(df.columns)).alias("first_row"))
