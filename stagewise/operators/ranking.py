"""Ordering the versions of a key: newest first, as a total order.

The order is effective date, explicit tie-breakers, an optional preference between
inputs, then every remaining sortable column, all descending with nulls last. Rows
that still tie are equal in all of these, so any of them may win.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagewise.functions.names import column, columns, key_list
from stagewise.session import ensure_checkpoint_dir

# A key with more rows than this is ranked by several tasks.
HOT_ROWS = 20_000_000


def sortable(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.ArrayType):
        return sortable(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(sortable(field.dataType) for field in data_type.fields)
    return not isinstance(data_type, (T.MapType, T.VariantType))


def newest_first(
    df: DataFrame,
    keys: Iterable[str],
    effective_date: str,
    tie_breakers: Sequence[str] = (),
    prefer: Sequence[str] = (),
) -> list[Column]:
    """Sort columns that put the newest version of each key first."""
    leading = [effective_date, *tie_breakers, *prefer]
    known = {*keys, *leading}
    rest = [f.name for f in df.schema.fields if f.name not in known and sortable(f.dataType)]
    return [column(name).desc_nulls_last() for name in leading + rest]


def top_versions(
    df: DataFrame,
    keys: str | Iterable[str],
    effective_date: str,
    tie_breakers: Sequence[str] = (),
    prefer: Sequence[str] = (),
    depth: int = 1,
    rank_column: str = "RowN",
) -> DataFrame:
    """The ``depth`` newest rows of each key, with their rank.

    Spark turns the rank filter into a group limit that runs before the shuffle, so
    a key with very many versions sends at most ``depth`` rows per input partition.
    """
    keys = key_list(keys)
    window = Window.partitionBy(*columns(keys)).orderBy(*newest_first(df, keys, effective_date, tie_breakers, prefer))
    return df.withColumn(rank_column, F.row_number().over(window)).filter(column(rank_column) <= depth)


def latest_per_key(
    df: DataFrame,
    keys: str | Iterable[str],
    effective_date: str,
    tie_breakers: Sequence[str] = (),
    prefer: Sequence[str] = (),
) -> DataFrame:
    """The newest row of each key; null keys form one key."""
    return top_versions(df, keys, effective_date, tie_breakers, prefer).drop("RowN")


def rank_versions(
    df: DataFrame,
    keys: str | Iterable[str],
    effective_date: str,
    tie_breakers: Sequence[str] = (),
    prefer: Sequence[str] = (),
    rank_column: str = "RowN",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Every row with its rank within its key, newest = 1.

    A window sorts each key in one task. Keys holding more than ``hot_rows`` rows are
    ranked apart, over ranges of their own versions, so that no task receives a whole
    hot key; rows and ranks are the same, up to the order of rows that tie in all sort
    columns. Counting the keys is one aggregation over the key columns, run when this
    function is called; hot keys, at most all rows / ``hot_rows``, stay on the executors.
    """
    keys = key_list(keys)
    order = newest_first(df, keys, effective_date, tie_breakers, prefer)
    hot = _hot_keys(df, keys, hot_rows)
    window = Window.partitionBy(*columns(keys)).orderBy(*order)
    if hot is None:
        return df.withColumn(rank_column, F.row_number().over(window).cast("bigint"))

    is_hot = _null_safe(df.alias("d"), hot.alias("h"), keys)
    cold = df.alias("d").join(hot.alias("h"), is_hot, "left_anti")
    busy = df.alias("d").join(hot.alias("h"), is_hot, "left_semi")
    ranked = cold.withColumn(rank_column, F.row_number().over(window).cast("bigint"))
    return ranked.unionByName(_rank_by_ranges(busy, keys, order, rank_column))


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & column(key, "d").eqNullSafe(column(key, "h"))
    return condition


def _hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame | None:
    """Keys with more than ``hot_rows`` rows; None if there is none, and then nothing is kept."""
    counts = df.groupBy(*columns(keys)).agg(F.count("*").alias("_versions"))
    hot = counts.filter(F.col("_versions") > hot_rows).select(*columns(keys))
    if hot.isEmpty():
        return None
    ensure_checkpoint_dir(df.sparkSession)
    return hot.checkpoint()


def _rank_by_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[Column], rank_column: str) -> DataFrame:
    """Rank rows whose keys are too large for one task.

    Rows are ranged by keys and order, and by a row number where they tie, so that a
    range can end anywhere, also between copies. Each range is ranked alone; a key's
    ranks continue over its ranges by adding the sizes of the ranges before. Row and
    range numbers are pinned by a checkpoint, as both sides of the join need them.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (
        df.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(parts, *columns(keys), *order, "_tie")
        .withColumn("_range", F.spark_partition_id())
        .checkpoint()
    )

    sizes = ranged.groupBy(*columns(keys), "_range").agg(F.count("*").alias("_size"))
    before = Window.partitionBy(*columns(keys)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *columns(keys), "_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    within = Window.partitionBy(*columns(keys), "_range").orderBy(*order, "_tie")
    local = ranged.withColumn("_at", F.row_number().over(within))
    same = _null_safe(local, offsets, keys) & (F.col("d._range") == F.col("h._range"))
    return local.alias("d").join(offsets.alias("h"), same).select(
        *columns(df.columns, "d"), (F.col("h._offset") + F.col("d._at")).cast("bigint").alias(rank_column)
    )
