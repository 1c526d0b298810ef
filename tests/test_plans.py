"""What the plans of the registered queries must and must not contain."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from stagewise.operators import upsert as up
from stagewise.operators.merge import merge_metrics

FOLDER = "/root/testdata/sf0.001"
QUERIES = {name: query for name, (query, _) in contract.REGISTERED.items()}

# Shuffles each plan may hold before adaptive execution; queries not named need none.
SHUFFLES = {
    "rank_versions": 1, "latest_per_key": 1, "stage_active_union": 1, "latest_wins_merge": 2,
    "merge_with_actions": 6, "full_reload": 1, "merge_metrics": 3, "change_detection": 2, "merge_inserts": 2,
    "merge_updates": 2, "merge_upsert": 4, "merge_actions": 5, "merge_action_pivot": 4, "merge_duplicate_keys": 1,
    "multi_table_merge": 9, "incremental_copy_manifest": 4, "cast_pass": 1, "cast_fail": 1, "distinct_rows": 1,
    "hash_rejoin": 4, "source_watermark": 1, "config_lookup": 3, "config_watermark_update": 3,
    "process_log": 7, "log_to_json": 7, "log_json_array": 7,
    "string_agg": 1, "merge_upsert_general": 8,
    "feed_applied": 1, "rank_versions_by_ranges": 8,
}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_small_joins(spark):
    """Plan joins as for data too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan(spark, no_small_joins, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    assert "Python" not in plan and "Pandas" not in plan
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastExchange"):
        assert unwanted not in plan
    assert plan.count("Exchange hashpartitioning") <= SHUFFLES.get(name, 0)


def test_metrics_read_only_what_they_need(spark):
    events = spark.read.parquet(f"{FOLDER}/events.parquet")
    newer = events.filter(F.col("ts") >= F.expr("TIMESTAMP_NTZ'2024-01-02 00:00:00'"))
    plan = plan_of(merge_metrics(newer, events, ["user_id", "event_type"], "ts", ["event_id"]))
    assert "props" not in plan and "value" not in plan
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan


def test_a_hot_target_key_is_split_by_adaptive_execution(spark):
    """An upsert into a target where one key has most of the rows."""
    target = spark.range(60_000).select(
        F.when(F.col("id") < 50_000, 1).otherwise(F.col("id")).cast("int").alias("k"),
        F.col("id").cast("string").alias("v"),
        F.lit(None).cast("timestamp_ntz").alias("ModifiedOn"),
    )
    source = spark.range(40).select(F.col("id").cast("int").alias("k"), F.lit("new").alias("v"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        merged = up.upsert(target.repartition(6), source, "k")
        rows = merged.filter("v = 'new'").collect()
        # The plan of the rows before the filter, after it has run.
        merged.collect()
        plan = plan_of(merged)
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert len(rows) == 50_000 + 39
    assert "skew=true" in plan
