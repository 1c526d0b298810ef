"""Bringing another copy of a table up to date from its change feed."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagewise.functions.names import key_list
from stagewise.operators.ranking import latest_per_key

#: Column of a feed that tells the commit of a change.
COMMIT = "_commit"


def apply_changes(old: DataFrame, feed: DataFrame, keys: str | Iterable[str]) -> DataFrame:
    """``old`` after the inserts and updates of ``feed``, as ``CurrentTable.changes`` gives them.

    For tables of one row per key, nulls being equal, as a latest-wins merge makes them. Of
    several changes of a key the one of the last commit counts. Columns that only the feed
    has are null in rows it does not touch.
    """
    before = old.withColumn(COMMIT, F.lit(-1).cast("bigint"))
    both = before.unionByName(feed.drop("_action"), allowMissingColumns=True)
    return latest_per_key(both, key_list(keys), COMMIT).drop(COMMIT)
