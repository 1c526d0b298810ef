"""Latest-wins merge of newly staged rows into the current rows of a table."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stagewise.functions.names import column, columns, key_list
from stagewise.operators.ranking import latest_per_key, newest_first, top_versions

# The two inputs of a merge, and the column that names them.
SOURCE_FOLDER = "SourceFolder"
STAGE = "Stage"
ACTIVE = "Active"

# Fixed value: a source watermark starting so asks for a full reload.
RELOAD_PREFIX = "1900-01-01"


def is_full_reload(source_watermark: str | None) -> bool:
    return source_watermark is not None and source_watermark.startswith(RELOAD_PREFIX)


def stage_active_union(stage: DataFrame, active: DataFrame | None) -> DataFrame:
    """All rows of both inputs, aligned by name and tagged with their input."""
    tagged = stage.withColumn(SOURCE_FOLDER, F.lit(STAGE))
    if active is None:
        return tagged
    return tagged.unionByName(active.withColumn(SOURCE_FOLDER, F.lit(ACTIVE)), allowMissingColumns=True)


def latest_wins_merge(
    stage: DataFrame,
    active: DataFrame | None,
    keys: str | Iterable[str],
    effective_date: str,
    tie_breakers: Sequence[str] = (),
    source_watermark: str | None = None,
) -> DataFrame:
    """The newest row per key of Stage and Active together.

    Makes no assumption about Active: it may hold several rows per key. Without
    Active, or when ``source_watermark`` asks for a full reload, Stage alone counts.
    """
    if is_full_reload(source_watermark):
        active = None
    both = stage_active_union(stage, active)
    # "Stage" sorts after "Active", so descending order prefers Stage on a tie.
    return latest_per_key(both, keys, effective_date, tie_breakers, prefer=[SOURCE_FOLDER]).drop(SOURCE_FOLDER)


def merge_metrics(
    stage: DataFrame,
    active: DataFrame,
    keys: str | Iterable[str],
    effective_date: str,
    tie_breakers: Sequence[str] = (),
) -> DataFrame:
    """One row of counts for a merge.

    ``updated`` counts Active rows ranked second or lower; ``updated_rank2`` those
    ranked exactly second. The two newest rows per key are enough for all of them,
    given the number of Active rows.
    """
    # Which input ranks where is settled by these columns; the others are not read.
    deciding = columns([*key_list(keys), effective_date, *tie_breakers])
    active = active.select(*deciding)
    both = stage_active_union(stage.select(*deciding), active)
    top = top_versions(both, keys, effective_date, tie_breakers, prefer=[SOURCE_FOLDER], depth=2)
    is_active = F.col(SOURCE_FOLDER) == ACTIVE
    zero = F.lit(0).cast("bigint")
    from_top = top.agg(
        F.count_if(F.col("RowN") == 1).alias("merged"),
        F.count_if((F.col("RowN") == 1) & is_active).alias("kept"),
        F.count_if((F.col("RowN") == 2) & is_active).alias("updated_rank2"),
        zero.alias("active"),
        F.max(column(effective_date)).alias("max_effective_date"),
    )
    from_active = active.agg(
        zero.alias("merged"),
        zero.alias("kept"),
        zero.alias("updated_rank2"),
        F.count("*").alias("active"),
        F.max(column(effective_date)).alias("max_effective_date"),
    )
    total = from_top.unionByName(from_active).agg(
        *[F.sum(name).alias(name) for name in ("merged", "kept", "updated_rank2", "active")],
        F.max("max_effective_date").alias("max_effective_date"),
    )
    return total.select(
        "active",
        "merged",
        (F.col("merged") - F.col("active")).alias("inserted"),
        (F.col("active") - F.col("kept")).alias("updated"),
        "updated_rank2",
        "max_effective_date",
    )


def merge_into_current(
    stage: DataFrame,
    current: DataFrame,
    keys: str | Iterable[str],
    effective_date: str,
    tie_breakers: Sequence[str] = (),
    buckets: int | None = None,
    null_keys: bool = True,
    hash_stage: bool = False,
) -> DataFrame:
    """Merge Stage into a current table known to hold one row per key.

    Adds ``_action`` (INSERT, UPDATE or KEEP) and ``_rank2`` (the replaced row ranked
    exactly second). Stage is reduced to one row per key before it is shuffled, and
    the current side is joined on its plain key columns: a current table bucketed by
    the keys is neither shuffled nor ranked. Null key parts are equal to each other
    here; rows that have one are joined apart, as only null-safe equality matches them.

    ``buckets`` deals the reduced Stage out as the current side is bucketed. With
    ``hash_stage`` Stage is the hashed side, and the current side is not sorted either; the
    caller has checked that the staged rows of a bucket fit in memory. Where Stage is known
    to have no null key part, ``null_keys=False`` makes it one join.
    """
    keys = key_list(keys)
    complete = reduce(lambda a, b: a & b, [column(key).isNotNull() for key in keys])
    dealt = buckets, hash_stage
    if not null_keys:
        return _join_current(stage, current, keys, effective_date, tie_breakers, False, *dealt)
    parts = [
        _join_current(stage.filter(rows), current.filter(rows), keys, effective_date, tie_breakers, null_safe, *dealt)
        for rows, null_safe in ((complete, False), (~complete, True))
    ]
    return parts[0].unionByName(parts[1])


def _join_current(
    stage: DataFrame, current: DataFrame, keys: list[str], effective_date: str, tie_breakers: Sequence[str], null_safe: bool,
    buckets: int | None, hash_stage: bool,
) -> DataFrame:
    age = [effective_date, *tie_breakers]
    window = Window.partitionBy(*columns(keys)).orderBy(*newest_first(stage, keys, effective_date, tie_breakers))
    newest = (
        top_versions(stage, keys, effective_date, tie_breakers, depth=2)
        .withColumn("_next_age", F.lead(F.struct(*columns(age))).over(window))
        .filter("RowN = 1")
        .withColumn("_in_stage", F.lit(True))
    )
    if buckets is not None:
        newest = newest.repartition(buckets, *columns(keys))
    if hash_stage:
        newest = newest.hint("shuffle_hash")
    known = current.withColumn("_in_current", F.lit(True))
    equal = Column.eqNullSafe if null_safe else Column.__eq__
    on = reduce(lambda a, b: a & b, [equal(column(key, "s"), column(key, "c")) for key in keys])
    pair = newest.alias("s").join(known.alias("c"), on, "full_outer")

    in_stage, in_current = F.col("_in_stage").isNotNull(), F.col("_in_current").isNotNull()
    stage_age = F.struct(*columns(age, "s"))
    current_age = F.struct(*columns(age, "c"))
    wins = F.col("_wins")
    decided = pair.withColumn("_wins", in_stage & (~in_current | (stage_age >= current_age)))

    def pick(name: str) -> Column:
        new = column(name, "s") if name in stage.columns else F.lit(None)
        old = column(name, "c") if name in current.columns else F.lit(None)
        return F.when(wins, new).otherwise(old).alias(name)

    names = list(dict.fromkeys([*current.columns, *stage.columns]))
    action = F.when(~wins, "KEEP").when(in_current, "UPDATE").otherwise("INSERT")
    rank2 = wins & in_current & (F.col("_next_age").isNull() | (F.col("_next_age") < current_age))
    return decided.select(*[pick(name) for name in names], action.alias("_action"), rank2.alias("_rank2"))
