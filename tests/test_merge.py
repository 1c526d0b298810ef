import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from support import as_multiset, day, exchanges, ranked

from stagewise.operators import ranking
from stagewise.operators.merge import (
    latest_wins_merge,
    merge_into_current,
    merge_metrics,
    stage_active_union,
)
from stagewise.operators.ranking import latest_per_key, rank_versions

SCHEMA = "a int, b string, at timestamp_ntz, seq int, v string"
KEYS = ["a", "b"]


def random_rows(seed, n, key_range=6, null_keys=True):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a = rng.randrange(key_range)
        b = rng.choice("xy")
        if null_keys and rng.random() < 0.15:
            a = None
        if null_keys and rng.random() < 0.1:
            b = None
        at = None if rng.random() < 0.15 else day(rng.randrange(5))
        rows.append((a, b, at, rng.randrange(4), f"v{i % 7}"))
    return rows


def dicts(rows, folder=None):
    names = ["a", "b", "at", "seq", "v"]
    out = [dict(zip(names, r)) for r in rows]
    if folder:
        for row in out:
            row["SourceFolder"] = folder
    return out


@pytest.mark.parametrize("seed", range(4))
def test_rank_versions_matches_brute_force(spark, seed):
    rows = random_rows(seed, 80)
    got = rank_versions(spark.createDataFrame(rows, SCHEMA), KEYS, "at", ["seq"])
    want = sorted(
        ((r["a"], r["at"], r["b"], r["seq"], r["v"], n) for r, n in ranked(dicts(rows), KEYS, ["at", "seq", "v"])),
        key=repr,
    )
    assert as_multiset(got, ["a", "at", "b", "seq", "v", "RowN"]) == want


@pytest.mark.parametrize("hot_rows", [0, 3, 40])
def test_hot_keys_get_the_same_ranks(spark, hot_rows):
    rows = random_rows(9, 60) + [(1, "x", day(2), 1, "same")] * 50 + [(None, "x", day(1), 2, "same")] * 30
    df = spark.createDataFrame(rows, SCHEMA)
    plain = rank_versions(df, KEYS, "at", ["seq"])
    split = rank_versions(df, KEYS, "at", ["seq"], hot_rows=hot_rows)
    assert split.columns == plain.columns
    assert as_multiset(split) == as_multiset(plain)


def test_hot_key_is_spread_over_ranges(spark):
    df = spark.range(4000).select(
        F.lit(1).alias("a"), F.lit("x").alias("b"), F.expr("timestamp_ntz'2024-01-01'").alias("at"),
        F.col("id").cast("int").alias("seq"), F.lit("v").alias("v"),
    )
    split = rank_versions(df, KEYS, "at", ["seq"], hot_rows=1000)
    assert split.groupBy().agg(F.sum("RowN"), F.countDistinct("RowN")).first() == (4000 * 4001 // 2, 4000)
    # Adaptive execution would join these few rows into one task again.
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        per_task = split.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert max(row["count"] for row in per_task) < 4000


def test_hot_keys_keep_their_rows(spark):
    rows = [(1, -0.0, {"m": 1}), (1, 0.0, {"m": 2}), (1, float("nan"), None), (1, -0.0, {"m": 1}), (2, None, None)]
    df = spark.createDataFrame(rows, "k int, at double, m map<string,int>")
    plain, split = rank_versions(df, "k", "at"), rank_versions(df, "k", "at", hot_rows=1)
    whole = lambda d: sorted(repr((r.k, r.at, r.m)) for r in d.collect())
    assert whole(plain) == whole(split) == whole(df)
    assert sorted(r.RowN for r in split.collect()) == [1, 1, 2, 3, 4]
    assert ranking._hot_keys(df, ["k"], 1).count() == 1


def test_latest_per_key_limits_groups_before_the_shuffle(spark):
    df = spark.createDataFrame(random_rows(1, 30), SCHEMA)
    plan = latest_per_key(df, KEYS, "at", ["seq"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.count("Exchange hashpartitioning") == 1


def test_null_dates_lose(spark):
    df = spark.createDataFrame([(1, "x", None, 9, "new"), (1, "x", day(0), 1, "old")], SCHEMA)
    assert latest_per_key(df, KEYS, "at").first().v == "old"


def test_union_aligns_by_name(spark):
    stage = spark.createDataFrame([(1, "p")], "id int, name string")
    active = spark.createDataFrame([("q", 2)], "name string, id int")
    got = stage_active_union(stage, active)
    assert as_multiset(got, ["id", "name", "SourceFolder"]) == [(1, "p", "Stage"), (2, "q", "Active")]


def model_merge(stage, active):
    """Winner rows, and counts, of a merge by brute force."""
    both = dicts(stage, "Stage") + dicts(active, "Active")
    order = ["at", "seq", "SourceFolder", "v"]
    rank = ranked(both, KEYS, order)
    winners = [r for r, n in rank if n == 1]
    counts = {
        "active": len(active),
        "merged": len(winners),
        "inserted": len(winners) - len(active),
        "updated": sum(1 for r, n in rank if n >= 2 and r["SourceFolder"] == "Active"),
        "updated_rank2": sum(1 for r, n in rank if n == 2 and r["SourceFolder"] == "Active"),
        "max_effective_date": max((r["at"] for r in both if r["at"]), default=None),
    }
    return sorted(((r["a"], r["b"], r["at"], r["seq"], r["v"]) for r in winners), key=repr), counts


@pytest.mark.parametrize("seed", range(5))
def test_merge_and_metrics_match_brute_force(spark, seed):
    stage_rows = random_rows(seed, 50)
    active_rows = latest_per_key(spark.createDataFrame(random_rows(100 + seed, 60), SCHEMA), KEYS, "at", ["seq"])
    active_rows = [tuple(r) for r in active_rows.collect()]
    stage = spark.createDataFrame(stage_rows, SCHEMA)
    active = spark.createDataFrame(active_rows, SCHEMA)
    want_rows, want = model_merge(stage_rows, active_rows)

    names = ["a", "b", "at", "seq", "v"]
    assert as_multiset(latest_wins_merge(stage, active, KEYS, "at", ["seq"]), names) == want_rows
    assert merge_metrics(stage, active, KEYS, "at", ["seq"]).first().asDict() == want

    joined = merge_into_current(stage, active, KEYS, "at", ["seq"])
    assert as_multiset(joined, names) == want_rows
    counts = {r["_action"]: r["count"] for r in joined.groupBy("_action").count().collect()}
    assert counts.get("INSERT", 0) == want["inserted"]
    assert counts.get("UPDATE", 0) == want["updated"]
    assert joined.filter("_rank2").count() == want["updated_rank2"]


def test_updates_with_several_newer_versions_are_counted(spark):
    stage = spark.createDataFrame([(1, "x", day(n), 0, "s") for n in (1, 2, 3)], SCHEMA)
    active = spark.createDataFrame([(1, "x", day(0), 0, "a")], SCHEMA)
    got = merge_metrics(stage, active, KEYS, "at").first()
    assert (got.updated, got.updated_rank2, got.inserted) == (1, 0, 0)


def test_merge_is_idempotent_and_keyed(spark):
    stage = spark.createDataFrame(random_rows(3, 50), SCHEMA)
    active = latest_per_key(spark.createDataFrame(random_rows(4, 50), SCHEMA), KEYS, "at", ["seq"])
    once = latest_wins_merge(stage, active, KEYS, "at", ["seq"])
    twice = latest_wins_merge(stage, once, KEYS, "at", ["seq"])
    assert as_multiset(once) == as_multiset(twice)
    assert once.count() == once.select(*KEYS).distinct().count()
    shuffled = latest_wins_merge(stage.repartition(7, "v"), active.repartition(3), KEYS, "at", ["seq"])
    assert as_multiset(once) == as_multiset(shuffled)


def test_stage_wins_a_tie_and_stale_stage_loses(spark):
    active = spark.createDataFrame([(1, "x", day(2), 0, "old"), (2, "x", day(2), 0, "keep")], SCHEMA)
    stage = spark.createDataFrame([(1, "x", day(2), 0, "new"), (2, "x", day(1), 0, "stale")], SCHEMA)
    for merged in (
        latest_wins_merge(stage, active, KEYS, "at", ["seq"]),
        merge_into_current(stage, active, KEYS, "at", ["seq"]),
    ):
        assert as_multiset(merged, ["a", "v"]) == [(1, "new"), (2, "keep")]


def test_full_reload_ignores_active(spark):
    active = spark.createDataFrame([(1, "x", day(9), 0, "old")], SCHEMA)
    stage = spark.createDataFrame([(2, "x", day(1), 0, "new")], SCHEMA)
    got = latest_wins_merge(stage, active, KEYS, "at", source_watermark="1900-01-01 00:00:00.000")
    assert as_multiset(got, ["a", "v"]) == [(2, "new")]
    assert latest_wins_merge(stage, None, "[a],[b]", "at").count() == 1


def test_reordered_and_missing_columns(spark):
    active = spark.createDataFrame([(1, "x", day(0), 0, "old")], SCHEMA)
    stage = spark.createDataFrame([("n", day(1), "x", 1)], "extra string, at timestamp_ntz, b string, a int")
    got = merge_into_current(stage, active, KEYS, "at").first()
    assert (got.extra, got.v, got.at, got._action) == ("n", None, datetime(2024, 1, 2), "UPDATE")


def test_metrics_need_one_wide_shuffle(spark):
    stage = spark.createDataFrame(random_rows(3, 50), SCHEMA)
    active = spark.createDataFrame(random_rows(4, 50), SCHEMA)
    assert exchanges(merge_metrics(stage, active, KEYS, "at", ["seq"])) == 1
