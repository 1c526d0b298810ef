"""Registered queries: ranking, latest-wins merge, keyed upsert, copy."""

from __future__ import annotations

from pyspark.sql import functions as F

from stagewise.operators import upsert as up
from stagewise.operators.merge import (
    latest_wins_merge,
    merge_into_current,
    merge_metrics,
    stage_active_union,
)
from stagewise.operators.ranking import latest_per_key, rank_versions
from stagewise.operators.watermarks import destination_watermark
from stagewise.showcase import inputs
from stagewise.showcase.inputs import (
    BATCH_TIME,
    EVENT_KEYS,
    EVENTS_SQL,
    ORDER_KEYS,
    ORDER_VALUES,
    UPSERT_SQL,
    ntz,
    table,
)
from stagewise.sources.copy import pending


def rank(spark, folder):
    ranked = rank_versions(table(spark, folder, "events"), EVENT_KEYS, "ts", ["event_id"])
    return ranked.select("event_id", *EVENT_KEYS, "ts", "RowN")


def latest_lines(spark, folder):
    return latest_per_key(table(spark, folder, "lineitem"), "[l_orderkey],[l_linenumber]", "l_shipdate")


def union(spark, folder):
    stage, active = inputs.event_sides(spark, folder)
    reordered = active.select(*reversed(active.columns))
    return stage_active_union(stage, reordered)


def merge(spark, folder):
    stage, active = inputs.event_sides(spark, folder)
    return latest_wins_merge(stage, active, EVENT_KEYS, "ts", ["event_id"])


def merge_joined(spark, folder):
    stage, active = inputs.event_sides(spark, folder)
    return merge_into_current(stage, active, EVENT_KEYS, "ts", ["event_id"])


def reload(spark, folder):
    _, active = inputs.event_sides(spark, folder)
    events = table(spark, folder, "events")
    return latest_wins_merge(events, active, EVENT_KEYS, "ts", ["event_id"], source_watermark="1900-01-01 00:00:00")


def metrics(spark, folder):
    stage, active = inputs.event_sides(spark, folder)
    return merge_metrics(stage, active, EVENT_KEYS, "ts", ["event_id"])


def watermark(spark, folder):
    return destination_watermark(table(spark, folder, "events"), "ts")


def change_detection(spark, folder):
    target, source = inputs.upsert_sides(spark, folder)
    return up.changes(target, source, ORDER_KEYS, ORDER_VALUES)


def inserts(spark, folder):
    target, source = inputs.upsert_sides(spark, folder)
    return up.inserts(target, source, ORDER_KEYS, ORDER_VALUES)


def updates(spark, folder):
    target, source = inputs.upsert_sides(spark, folder)
    return up.updates(target, source, ORDER_KEYS, ORDER_VALUES)


def merged(spark, folder):
    target, source = inputs.upsert_sides(spark, folder)
    # An order key occurs once in the target, so one full outer join is enough.
    return up.upsert(target, source, ORDER_KEYS, ORDER_VALUES, ntz(BATCH_TIME), target_unique=True)


def merged_general(spark, folder):
    """The general form: the source as a query's text, a target with repeated and null keys."""
    target, source = inputs.upsert_sides(spark, folder)
    source.createOrReplaceTempView("orders_to_upsert")
    fields = ", ".join(ORDER_VALUES)
    query = f"SELECT nullif(o_custkey % 7, 0) AS part, o_orderkey, {fields} FROM orders_to_upsert"
    target = target.withColumn("part", F.expr("nullif(o_custkey % 7, 0)")).drop("o_custkey")
    twice = target.unionByName(target.filter(F.col("o_orderkey") % 5 == 0))
    return up.upsert(twice, spark.sql(query), ["o_orderkey", "part"], ORDER_VALUES, ntz(BATCH_TIME))


def action_counts(spark, folder):
    return up.action_counts(merged(spark, folder))


def action_totals(spark, folder):
    return up.action_totals(merged(spark, folder))


def duplicate_keys(spark, folder):
    return up.duplicate_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


# Name, keys, effective date, tie-breakers and the two dates that split each table.
TABLES = [
    ("events", EVENT_KEYS, "ts", ["event_id"], "2024-01-03 00:00:00", "2024-01-02 00:00:00"),
    ("lineitem", ["l_orderkey", "l_linenumber"], "l_shipdate", ["l_partkey"], "1998-01-01 00:00:00", "1997-07-01 00:00:00"),
    ("orders", ["o_custkey"], "o_orderdate", ["o_orderkey"], "1997-01-01 00:00:00", "1996-07-01 00:00:00"),
]


def several_tables(spark, folder):
    """Outcome of a merge for each configured table, planned as one query."""
    outcomes = None
    for name, keys, date, ties, until, since in TABLES:
        stage, active = inputs.split_versions(table(spark, folder, name), keys, date, ties, until, since)
        counted = merge_metrics(stage, active, keys, date, ties).select(F.lit(name).alias("table_name"), "*")
        outcomes = counted if outcomes is None else outcomes.unionByName(counted)
    return outcomes


def _table_sql(name, keys, date, ties, until, since):
    key_text, tie_text = ", ".join(keys), "".join(f", {tie} DESC" for tie in ties)
    return f"""
SELECT '{name}' AS table_name, n_active AS active, merged, merged - n_active AS inserted, updated, updated_rank2,
       max_effective_date
FROM (
  WITH active AS (
    SELECT {key_text}, {date}{"".join(", " + tie for tie in ties)} FROM {name} WHERE {date} < TIMESTAMP '{until}'
    QUALIFY row_number() OVER (PARTITION BY {key_text} ORDER BY {date} DESC NULLS LAST{tie_text}) = 1),
  tagged AS (
    SELECT {key_text}, {date}{"".join(", " + tie for tie in ties)}, 'Stage' AS side FROM {name}
    WHERE {date} >= TIMESTAMP '{since}' OR {date} IS NULL
    UNION ALL SELECT *, 'Active' FROM active),
  ranked AS (
    SELECT *, row_number() OVER (PARTITION BY {key_text} ORDER BY {date} DESC NULLS LAST{tie_text}, side DESC) AS rn FROM tagged)
  SELECT count(*) FILTER (side = 'Active') AS n_active, count(*) FILTER (rn = 1) AS merged,
         count(*) FILTER (side = 'Active' AND rn >= 2) AS updated,
         count(*) FILTER (side = 'Active' AND rn = 2) AS updated_rank2, max({date}) AS max_effective_date
  FROM ranked)"""


def copy_manifest(spark, folder):
    """Documents to copy: those not yet labelled, or labelled at another size."""
    documents = table(spark, folder, "documents").select("doc_id", "n_chars")
    labels = table(spark, folder, "labels").select("doc_id", "toxic")
    copied = documents.join(labels, "doc_id").select("doc_id", (F.col("n_chars") + F.col("toxic")).alias("n_chars"))
    return pending(documents, copied, ["doc_id", "n_chars"])


QUERIES = {
    "rank_versions": (
        rank,
        """SELECT event_id, user_id, event_type, ts,
                  row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, event_id DESC) AS RowN
           FROM events""",
    ),
    "latest_per_key": (
        latest_lines,
        """SELECT * FROM lineitem
           QUALIFY row_number() OVER (
             PARTITION BY l_orderkey, l_linenumber
             ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
                      l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) = 1""",
    ),
    "stage_active_union": (union, f"WITH {EVENTS_SQL} SELECT * FROM tagged"),
    "latest_wins_merge": (
        merge,
        f"WITH {EVENTS_SQL} SELECT event_id, ts, user_id, event_type, value, props FROM ranked WHERE RowN = 1",
    ),
    "merge_with_actions": (
        merge_joined,
        f"""WITH {EVENTS_SQL},
            per_key AS (
              SELECT user_id, event_type, bool_or(SourceFolder = 'Active') AS had,
                     bool_or(SourceFolder = 'Active' AND RowN = 1) AS kept,
                     bool_or(SourceFolder = 'Active' AND RowN = 2) AS second
              FROM ranked GROUP BY user_id, event_type)
            SELECT r.event_id, r.ts, r.user_id, r.event_type, r.value, r.props,
                   CASE WHEN kept THEN 'KEEP' WHEN had THEN 'UPDATE' ELSE 'INSERT' END AS _action,
                   second AS _rank2
            FROM ranked r JOIN per_key USING (user_id, event_type) WHERE RowN = 1""",
    ),
    "full_reload": (
        reload,
        """SELECT * FROM events
           QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, event_id DESC) = 1""",
    ),
    "merge_metrics": (
        metrics,
        f"""WITH {EVENTS_SQL}
            SELECT count(*) FILTER (SourceFolder = 'Active') AS active,
                   count(*) FILTER (RowN = 1) AS merged,
                   count(*) FILTER (RowN = 1) - count(*) FILTER (SourceFolder = 'Active') AS inserted,
                   count(*) FILTER (SourceFolder = 'Active' AND RowN >= 2) AS updated,
                   count(*) FILTER (SourceFolder = 'Active' AND RowN = 2) AS updated_rank2,
                   max(ts) AS max_effective_date
            FROM ranked""",
    ),
    "dest_watermark": (watermark, "SELECT max(ts) AS DestinationMaxEffectiveDate FROM events"),
    "change_detection": (
        change_detection,
        f"""WITH {UPSERT_SQL}
            SELECT s.o_orderkey, s.o_custkey,
                   t.o_orderstatus AS old_o_orderstatus, t.o_totalprice AS old_o_totalprice,
                   t.o_orderpriority AS old_o_orderpriority,
                   s.o_orderstatus AS new_o_orderstatus, s.o_totalprice AS new_o_totalprice,
                   s.o_orderpriority AS new_o_orderpriority,
                   (s.o_orderstatus IS DISTINCT FROM t.o_orderstatus OR s.o_totalprice IS DISTINCT FROM t.o_totalprice
                    OR s.o_orderpriority IS DISTINCT FROM t.o_orderpriority) AS changed
            FROM source s JOIN target t ON t.o_orderkey = s.o_orderkey AND t.o_custkey = s.o_custkey""",
    ),
    "merge_inserts": (
        inserts,
        f"""WITH {UPSERT_SQL}
            SELECT o_orderstatus, o_totalprice, o_orderpriority, o_orderkey, o_custkey FROM source s
            WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.o_orderkey = s.o_orderkey AND t.o_custkey = s.o_custkey)""",
    ),
    "merge_updates": (
        updates,
        f"""WITH {UPSERT_SQL}
            SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority
            FROM merged WHERE _action = 'UPDATE'""",
    ),
    "merge_upsert": (
        merged,
        f"""WITH {UPSERT_SQL}
            SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
                   CASE WHEN _action = 'UPDATE' THEN TIMESTAMP '{BATCH_TIME}' ELSE old_modified END AS ModifiedOn,
                   _action
            FROM merged""",
    ),
    "merge_upsert_general": (
        merged_general,
        f"""WITH {UPSERT_SQL.rstrip()},
            keyed AS (SELECT *, nullif(o_custkey % 7, 0) AS part FROM merged),
            known AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, ModifiedOn FROM target
                      UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, ModifiedOn
                      FROM target WHERE o_orderkey % 5 = 0)
            SELECT o_orderkey, part, o_orderstatus, o_totalprice, o_orderpriority,
                   CASE WHEN _action = 'UPDATE' THEN TIMESTAMP '{BATCH_TIME}' ELSE old_modified END AS ModifiedOn, _action
            FROM keyed WHERE part IS NOT NULL
            UNION ALL SELECT o_orderkey, part, o_orderstatus, o_totalprice, o_orderpriority,
                   CASE WHEN _action = 'UPDATE' THEN TIMESTAMP '{BATCH_TIME}' ELSE old_modified END, _action
            FROM keyed WHERE part IS NOT NULL AND _action <> 'INSERT' AND o_orderkey % 5 = 0
            UNION ALL SELECT o_orderkey, NULL, o_orderstatus, o_totalprice, o_orderpriority, ModifiedOn, 'TARGET_ONLY'
            FROM known WHERE o_custkey % 7 = 0
            UNION ALL SELECT o_orderkey, NULL, o_orderstatus, o_totalprice, o_orderpriority, NULL, 'INSERT'
            FROM source WHERE o_custkey % 7 = 0""",
    ),
    "merge_actions": (
        action_counts,
        f"""WITH {UPSERT_SQL}
            SELECT _action AS action, count(*) AS n_rows FROM merged
            WHERE _action IN ('INSERT', 'UPDATE') GROUP BY _action""",
    ),
    "merge_action_pivot": (
        action_totals,
        f"""WITH {UPSERT_SQL}
            SELECT count(*) FILTER (_action = 'INSERT') AS inserted, count(*) FILTER (_action = 'UPDATE') AS updated
            FROM merged""",
    ),
    "merge_duplicate_keys": (
        duplicate_keys,
        """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
           WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
           GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    ),
    "multi_table_merge": (several_tables, " UNION ALL ".join(_table_sql(*spec) for spec in TABLES)),
    "incremental_copy_manifest": (
        copy_manifest,
        """WITH copied AS (
             SELECT d.doc_id, d.n_chars + l.toxic AS n_chars FROM documents d JOIN labels l ON d.doc_id = l.doc_id)
           SELECT doc_id, n_chars FROM documents d
           WHERE NOT EXISTS (SELECT 1 FROM copied c WHERE c.doc_id = d.doc_id AND c.n_chars = d.n_chars)""",
    ),
}
