"""Registered queries that write: loads, feeds, one-sided upserts, logs, copies, published tables.

They work in a new folder of the session's shared work folder and return what a reader of
the result sees.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.operators.enforce import typed_projection
from stagewise.operators.feed import apply_changes
from stagewise.operators.ranking import rank_versions
from stagewise.operators.rows import split_to_rows
from stagewise.plans import config as cf
from stagewise.plans.load import Outcome, TableLoad, TableUpsert, load_table, log_outcomes, run_all, set_aside, upsert_table
from stagewise.plans.log import read_log
from stagewise.session import work_folder
from stagewise.showcase import inputs, merging
from stagewise.showcase.inputs import BATCH_TIME, EVENT_KEYS, EVENTS_SQL, ORDER_VALUES, table
from stagewise.sources.copy import copied_manifest, copy_new_files, read_copy
from stagewise.sources.current import CurrentTable, publish_table

BUCKETS = 8


def _succeeded(outcome: Outcome) -> Outcome:
    if not outcome.succeeded:
        raise RuntimeError(outcome.error_message)
    return outcome


def _loaded(spark: SparkSession, folder: str, label: str) -> tuple[TableLoad, CurrentTable]:
    """The events' older side as the current table, then the newer side staged and merged."""
    root = work_folder(spark, label)
    load = TableLoad("events", f"{root}/Stage", f"{root}/Active", EVENT_KEYS, "ts", ["event_id"], buckets=BUCKETS)
    stage, active = inputs.event_sides(spark, folder)
    for rows in (active, stage):
        rows.write.mode("append").parquet(load.stage_path)
        _succeeded(load_table(spark, load))
    return load, CurrentTable(spark, load.current_path, load.keys, load.buckets)


def load_cycle(spark: SparkSession, folder: str) -> DataFrame:
    _, current = _loaded(spark, folder, "load")
    return current.read()


def change_feed(spark: SparkSession, folder: str) -> DataFrame:
    """What the second load inserted and updated, from the files of that commit alone."""
    _, current = _loaded(spark, folder, "feed")
    return current.changes(1, 2)


def feed_applied(spark: SparkSession, folder: str) -> DataFrame:
    """The table before the second load, brought up to date from the feed."""
    _, current = _loaded(spark, folder, "applied")
    first = current.commits()[0]
    return apply_changes(current.read_version(first), current.changes(first.number), EVENT_KEYS)


def one_sided(spark: SparkSession, folder: str) -> DataFrame:
    """The general upsert, with repeated and null keys, into a bucketed table."""
    root = work_folder(spark, "upsert")
    target, source = inputs.upsert_sides(spark, folder)
    part = F.expr("nullif(o_custkey % 7, 0)")
    target = target.withColumn("part", part).drop("o_custkey")
    twice = target.unionByName(target.filter(F.col("o_orderkey") % 5 == 0))
    keys = ["o_orderkey", "part"]
    CurrentTable(spark, root, keys, BUCKETS).replace(twice)
    sent = source.withColumn("part", part).select(*keys, *ORDER_VALUES)
    at = spark.sql(f"SELECT TIMESTAMP_NTZ'{BATCH_TIME}' AS t").first().t
    _succeeded(upsert_table(spark, TableUpsert("orders", sent, root, keys, ORDER_VALUES), at))
    return CurrentTable(spark, root, keys, BUCKETS).read()


def logged_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Several tables loaded side by side, their outcomes logged twice under one run."""
    root, loads = work_folder(spark, "runs"), []
    for name, keys, date, ties, until, since in merging.TABLES:
        stage, active = inputs.split_versions(table(spark, folder, name), keys, date, ties, until, since)
        load = TableLoad(name, f"{root}/{name}/Stage", f"{root}/{name}/Active", keys, date, ties, buckets=BUCKETS)
        active.write.parquet(load.stage_path)
        _succeeded(load_table(spark, load))
        stage.write.mode("append").parquet(load.stage_path)
        loads.append(load)
    outcomes = run_all(spark, loads)
    for _ in range(2):
        log_outcomes(spark, outcomes, f"{root}/log", "one")
    return read_log(spark, f"{root}/log").select("EtlConfigKey", "RowsInserted", "RowsUpdated", "ErrorMessage", "MaxEffectiveDate")


def published(spark: SparkSession, folder: str) -> DataFrame:
    """A published table after its rows were switched."""
    stage, active = inputs.event_sides(spark, folder)
    name = "published_events"
    publish_table(active, name)
    publish_table(stage, name)
    return spark.table(name)


def copied(spark: SparkSession, folder: str) -> DataFrame:
    """The events copied in two runs, the second with new files only."""
    root = work_folder(spark, "copy")
    stage, active = inputs.event_sides(spark, folder)
    for rows, day in ((active, "old days"), (stage, "new days")):
        rows.write.parquet(f"{root}/from/day={day}")
        copy_new_files(spark, f"{root}/from", f"{root}/to")
    if copy_new_files(spark, f"{root}/from", f"{root}/to") or copied_manifest(spark, f"{root}/to").isEmpty():
        raise RuntimeError("files were copied twice, or not at all")
    return read_copy(spark, f"{root}/to")


def reconciled(spark: SparkSession, folder: str) -> tuple[TableLoad, CurrentTable]:
    root = work_folder(spark, "types")
    load = TableLoad("events", f"{root}/Stage", f"{root}/Active", "event_id", "ts")
    events = table(spark, folder, "events").select("event_id", "ts", "user_id")
    by = F.col("event_id") % 10
    for rows in (events.filter(by >= 5), events.filter(by.between(1, 4)).withColumn("user_id", F.col("user_id").cast("int"))):
        rows.repartition(2).write.mode("append").parquet(load.stage_path)
    texts = events.filter(by == 0).withColumn("user_id", F.concat(F.lit("u"), F.col("user_id").cast("string")))
    texts.coalesce(1).write.mode("append").parquet(load.stage_path)
    _succeeded(load_table(spark, load))
    return load, CurrentTable(spark, load.current_path, load.keys)


def types_joined(spark: SparkSession, folder: str) -> DataFrame:
    """Files of two widths of a column loaded together."""
    return reconciled(spark, folder)[1].read()


def types_set_aside(spark: SparkSession, folder: str) -> DataFrame:
    """The rows whose files have text in that column."""
    rows = set_aside(spark, reconciled(spark, folder)[1])
    fields = F.from_json("row", "event_id bigint, user_id string")
    return rows.select(fields.alias("r"), "reason").select("r.event_id", "r.user_id", "reason")


def ranked_by_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """All versions ranked, keys of more than a few rows over ranges of their own."""
    ranked = rank_versions(table(spark, folder, "events"), EVENT_KEYS, "ts", ["event_id"], hot_rows=4)
    return ranked.select("event_id", *EVENT_KEYS, "ts", "RowN")


def looked_up(spark: SparkSession, folder: str) -> DataFrame:
    """The one config row of a source."""
    return cf.lookup(inputs.config_rows(spark, folder), "Customer#000000007", "SourceTable")


def split_at_bars(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    text = F.concat(F.col("event_type"), F.lit("||"), F.col("props"), F.lit("||"))
    return split_to_rows(events.select("event_id", text.alias("t")), "t", "||", keep=["event_id"])


# A schema table with a column of each type.
SCHEMA_ROWS = [("order key", "Long"), ("made at", "Timestamp"), ("small-key", "Integer"), ("total.price", "Double"), ("half", "Float"), ("status", "String")]


def typed_by_schema(spark: SparkSession, folder: str) -> DataFrame:
    """All-text orders in the types and order of a schema table; every seventh time is in another format."""
    key, at = F.col("o_orderkey"), F.timestamp_add("SECOND", (F.col("o_orderkey") % 86400).cast("int"), F.col("o_orderdate"))
    forms = [F.date_format(at, f"{day}'T'HH:mm:ss'Z'") for day in ("yyyy-MM-dd", "yyyy/MM/dd")]
    raw = table(spark, folder, "orders").select(
        key.cast("string").alias("order key"),
        F.when(key % 7 == 0, forms[1]).otherwise(forms[0]).alias("made at"),
        (key % 1000).cast("string").alias("small-key"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("total.price"),
        F.concat((key % 100).cast("string"), F.lit(".5")).alias("half"),
        F.col("o_orderstatus").alias("status"),
    )
    return raw.select(*typed_projection(spark.createDataFrame(SCHEMA_ROWS, "name string, type string")))


EVENT_COLUMNS = "event_id, ts, user_id, event_type, value, props"
MERGED_SQL = f"WITH {EVENTS_SQL} SELECT {EVENT_COLUMNS} FROM ranked WHERE RowN = 1"

QUERIES = {
    "load_cycle": (load_cycle, MERGED_SQL),
    "change_feed": (
        change_feed,
        f"""WITH {EVENTS_SQL},
            had AS (SELECT user_id, event_type, bool_or(SourceFolder = 'Active') AS had FROM ranked GROUP BY user_id, event_type)
            SELECT {EVENT_COLUMNS}, CASE WHEN had THEN 'UPDATE' ELSE 'INSERT' END AS _action, CAST(2 AS BIGINT) AS _commit
            FROM ranked JOIN had USING (user_id, event_type) WHERE RowN = 1 AND SourceFolder = 'Stage'""",
    ),
    "feed_applied": (feed_applied, MERGED_SQL),
    "upsert_one_sided": (
        one_sided,
        "SELECT * EXCLUDE (_action) FROM (" + merging.QUERIES["merge_upsert_general"][1] + ")",
    ),
    "logged_runs": (
        logged_runs,
        "SELECT table_name AS EtlConfigKey, inserted AS RowsInserted, updated AS RowsUpdated, CAST(NULL AS VARCHAR) AS ErrorMessage, "
        "max_effective_date AS MaxEffectiveDate FROM (" + merging.QUERIES["multi_table_merge"][1] + ")",
    ),
    "published_table": (published, f"WITH {EVENTS_SQL} SELECT * FROM stage"),
    "dataset_copy": (
        copied,
        f"WITH {EVENTS_SQL} SELECT *, 'old days' AS day FROM active UNION ALL SELECT *, 'new days' AS day FROM stage",
    ),
    "types_joined": (types_joined, "SELECT event_id, ts, user_id FROM events WHERE event_id % 10 <> 0"),
    "types_set_aside": (
        types_set_aside,
        "SELECT event_id, 'u' || user_id AS user_id, 'user_id is string, not bigint' AS reason FROM events WHERE event_id % 10 = 0",
    ),
    "rank_versions_by_ranges": (ranked_by_ranges, merging.QUERIES["rank_versions"][1]),
    "config_lookup_one": (
        looked_up,
        f"WITH {inputs.CONFIG_SQL} SELECT * FROM config WHERE SourceTable = 'Customer#000000007'",
    ),
    "schema_typed_projection": (
        typed_by_schema,
        """SELECT o_orderkey AS "order key", o_orderdate + to_seconds(o_orderkey % 86400) AS "made at",
                  CAST(o_orderkey % 1000 AS INTEGER) AS "small-key", o_totalprice AS "total.price",
                  CAST((o_orderkey % 100) + 0.5 AS FLOAT) AS half, o_orderstatus AS status FROM orders""",
    ),
    "split_at_bars": (
        split_at_bars,
        """SELECT event_id, CAST(i - 1 AS INTEGER) AS position, parts[i] AS part
           FROM (SELECT event_id, parts, unnest(range(1, len(parts) + 1)) AS i
                 FROM (SELECT event_id, string_split(event_type || '||' || props || '||', '||') AS parts FROM events))""",
    ),
}
