"""Keyed upsert with exact change detection and an action per row.

Keys compare with plain equality, so a row with a null key part matches nothing:
on the source side it is inserted (or left out on request), on the target side it
stays. Values compare null-safe. Target rows without a source row stay.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagewise.functions.names import column, columns, key_list
from stagewise.functions.timestamps import utc_wall_time, wall_time

# Row actions. The first two are what a merge reports.
INSERT = "INSERT"
UPDATE = "UPDATE"
UNCHANGED = "UNCHANGED"
TARGET_ONLY = "TARGET_ONLY"

# Fixed value: audit column stamped on update.
AUDIT_COLUMN = "ModifiedOn"


def keys_equal(keys: Sequence[str], left: str = "s", right: str = "t") -> Column:
    return reduce(lambda a, b: a & b, [column(key, left) == column(key, right) for key in keys])


def keys_complete(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [column(key).isNotNull() for key in keys])


def values_differ(values: Sequence[str], left: str = "s", right: str = "t") -> Column:
    """Whether any value column differs; two nulls are equal."""
    same = [column(name, left).eqNullSafe(column(name, right)) for name in values]
    return ~reduce(lambda a, b: a & b, same, F.lit(True))


def duplicate_keys(df: DataFrame, keys: str | Iterable[str]) -> DataFrame:
    """Complete keys held by more than one row, with their row count."""
    keys = key_list(keys)
    counts = df.filter(keys_complete(keys)).groupBy(*columns(keys)).agg(F.count("*").alias("n_rows"))
    return counts.filter("n_rows > 1")


def require_unique_keys(df: DataFrame, keys: str | Iterable[str]) -> DataFrame:
    """The same rows; the query fails when a complete key occurs twice.

    The check is a scalar subquery over the key columns alone. Copies of a key are
    folded before its shuffle, and the rows themselves keep their partitioning, so
    adaptive execution can still split a join they take part in.
    """
    keys = key_list(keys)
    repeated = duplicate_keys(df, keys).agg(
        F.count("*").alias("n"), F.min(F.to_json(F.struct(*columns(keys)))).alias("example")
    )
    message = F.format_string("%d keys have more than one source row, such as %s", F.col("n"), F.col("example"))
    verdict = F.when(F.col("n") == 0, True).otherwise(F.raise_error(message).cast("boolean"))
    return df.filter(repeated.select(verdict.alias("unique")).scalar())


def changes(
    target: DataFrame, source: DataFrame, keys: str | Iterable[str], values: Sequence[str]
) -> DataFrame:
    """Matched keys with old and new values and whether they differ."""
    keys = key_list(keys)
    pair = source.alias("s").join(target.alias("t"), keys_equal(keys), "inner")
    return pair.select(
        *columns(keys, "s"),
        *[column(name, "t").alias(f"old_{name}") for name in values],
        *[column(name, "s").alias(f"new_{name}") for name in values],
        values_differ(values).alias("changed"),
    )


def inserts(target: DataFrame, source: DataFrame, keys: str | Iterable[str], values: Sequence[str]) -> DataFrame:
    """Source rows whose key the target lacks: value columns, keys last.

    Rows with a null key part match nothing; they pass beside the join, where they would
    all meet in one task.
    """
    keys = key_list(keys)
    missing = _missing(target, source.filter(keys_complete(keys)), keys)
    return missing.unionByName(null_key_rows(source, keys)).select(*columns(values), *columns(keys))


def _missing(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    known = target.select(*columns(keys)).distinct()
    return source.alias("s").join(known.alias("t"), keys_equal(keys), "left_anti")


def updates(target: DataFrame, source: DataFrame, keys: str | Iterable[str], values: Sequence[str]) -> DataFrame:
    """New values of matched rows that differ: the residual test runs in the join."""
    keys = key_list(keys)
    pair = source.alias("s").join(target.alias("t"), keys_equal(keys) & values_differ(values), "inner")
    return pair.select(*columns(keys, "s"), *columns(values, "s"))


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: str | Iterable[str],
    values: Sequence[str] | None = None,
    batch_time: datetime | Column | None = None,
    audit_column: str = AUDIT_COLUMN,
    insert_null_keys: bool = True,
    target_unique: bool = False,
) -> DataFrame:
    """The target after the merge, with ``_action`` for every row.

    ``values`` are the columns taken from the source (default: all but keys and audit
    column). Other target columns keep their value on update and are null on insert;
    the audit column is stamped on update only. The target may hold several rows per
    key, also very many: it stays the side of its join that adaptive execution can
    split. With ``target_unique`` one full outer join does the work of two joins; its
    sides cannot be split, which only matters when a target key has very many rows.
    """
    keys = key_list(keys)
    values, incoming = _incoming(target, source, keys, values, audit_column)
    stamp = _batch_stamp(batch_time)
    matchable = require_unique_keys(incoming.filter(keys_complete(keys)), keys)
    current = target.filter(keys_complete(keys))

    has_source = column(keys[0], "s").isNotNull()
    has_target = column(keys[0], "t").isNotNull()
    action = _action_of(has_source, has_target, values)
    cells = [_merged_cell(field, keys, values, audit_column, stamp) for field in target.schema.fields]
    if target_unique:
        pair = matchable.alias("s").join(current.alias("t"), keys_equal(keys), "full_outer")
        result = pair.withColumn("_action", action).select(*cells, "_action")
    else:
        pair = current.alias("t").join(matchable.alias("s"), keys_equal(keys), "left")
        result = pair.withColumn("_action", action).select(*cells, "_action")
        result = result.unionByName(_as_inserted(_missing(current, matchable, keys), target))

    result = result.unionByName(null_key_rows(target, keys).withColumn("_action", F.lit(TARGET_ONLY)))
    if insert_null_keys:
        result = result.unionByName(_as_inserted(null_key_rows(incoming, keys), target))
    return result


def one_sided_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: str | Iterable[str],
    values: Sequence[str] | None = None,
    batch_time: datetime | Column | None = None,
    audit_column: str = AUDIT_COLUMN,
    insert_null_keys: bool = True,
    buckets: int | None = None,
    hash_source: bool = True,
) -> DataFrame:
    """``upsert`` into a target bucketed by its keys, which is scanned once where it lies.

    One full outer join: the source has one row per key and is dealt out as the target is
    bucketed, so the target is neither shuffled nor, with ``hash_source``, sorted; a key's
    target rows, however many, stream past the source row. Rows with null keys match nothing
    in the same join. The caller has checked that the source rows of a bucket fit in memory.
    """
    keys = key_list(keys)
    values, incoming = _incoming(target, source, keys, values, audit_column)
    stamp = _batch_stamp(batch_time)
    sent = require_unique_keys(incoming if insert_null_keys else incoming.filter(keys_complete(keys)), keys)
    sent = sent.withColumn("_in_source", F.lit(True))
    if buckets is not None:
        sent = sent.repartition(buckets, *columns(keys))
    if hash_source:
        sent = sent.hint("shuffle_hash")
    known = target.withColumn("_in_target", F.lit(True))
    pair = sent.alias("s").join(known.alias("t"), keys_equal(keys), "full_outer")
    action = _action_of(F.col("_in_source").isNotNull(), F.col("_in_target").isNotNull(), values)
    cells = [_merged_cell(field, keys, values, audit_column, stamp) for field in target.schema.fields]
    return pair.withColumn("_action", action).select(*cells, "_action")


def _incoming(
    target: DataFrame, source: DataFrame, keys: Sequence[str], values: Sequence[str] | None, audit_column: str
) -> tuple[list[str], DataFrame]:
    """The value columns of an upsert, and its source in the target's types."""
    if values is None:
        values = [name for name in source.columns if name not in keys]
    values = [name for name in values if name != audit_column]
    unknown = [name for name in [*keys, *values] if name not in target.columns]
    if unknown:
        raise ValueError("not in the target: " + ", ".join(unknown))
    types = {field.name: field.dataType for field in target.schema.fields}
    sent = {field.name: field.dataType for field in source.schema.fields}
    return values, source.select(*[_fitted(name, sent[name], types[name]) for name in [*keys, *values]])


def _action_of(has_source: Column, has_target: Column, values: Sequence[str]) -> Column:
    return (
        F.when(~has_target, INSERT)
        .when(~has_source, TARGET_ONLY)
        .when(values_differ(values), UPDATE)
        .otherwise(UNCHANGED)
    )


def _fitted(name: str, sent: T.DataType, wanted: T.DataType) -> Column:
    """A source column in the target's type; a value that does not fit fails the query."""
    if sent == wanted:
        return column(name)
    value = column(name).try_cast(wanted)
    misfit = column(name).isNotNull() & value.isNull()
    return F.when(misfit, F.raise_error(F.lit(f"a value of {name} does not fit the target"))).otherwise(value).alias(name)


def _merged_cell(
    field: T.StructField, keys: Sequence[str], values: Sequence[str], audit_column: str, stamp: Column
) -> Column:
    """One target column after the merge, given the row's ``_action``."""
    name, action, old = field.name, F.col("_action"), column(field.name, "t")
    if name in keys:
        value = F.coalesce(old, column(name, "s"))
    elif name in values:
        value = F.when(action.isin(INSERT, UPDATE), column(name, "s")).otherwise(old)
    elif name == audit_column:
        value = F.when(action == UPDATE, stamp.cast(field.dataType)).otherwise(old)
    else:
        value = old
    return value.alias(name)


def null_key_rows(df: DataFrame, keys: str | Iterable[str]) -> DataFrame:
    """Rows a key equality can never match, for quarantine."""
    return df.filter(~keys_complete(key_list(keys)))


def action_counts(merged: DataFrame) -> DataFrame:
    """Rows per reported action."""
    touched = merged.filter(F.col("_action").isin(INSERT, UPDATE))
    return touched.groupBy(F.col("_action").alias("action")).agg(F.count("*").alias("n_rows"))


def action_totals(merged: DataFrame) -> DataFrame:
    """Inserted and updated row counts as one row."""
    return merged.agg(
        F.count_if(F.col("_action") == INSERT).alias("inserted"),
        F.count_if(F.col("_action") == UPDATE).alias("updated"),
    )


def _as_inserted(rows: DataFrame, target: DataFrame) -> DataFrame:
    cells = [
        (column(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in target.schema.fields
    ]
    return rows.select(*cells, F.lit(INSERT).alias("_action"))


def _batch_stamp(batch_time: datetime | Column | None) -> Column:
    if batch_time is None:
        return utc_wall_time(F.current_timestamp())
    return batch_time if isinstance(batch_time, Column) else wall_time(batch_time)
