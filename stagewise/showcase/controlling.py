"""Registered queries: cleansing, watermarks, configuration, process log."""

from __future__ import annotations

from pyspark.sql import functions as F

from stagewise.functions.text import normalise_key_list, null_tokens_to_null, uuid_or_null
from stagewise.functions.timestamps import strip_offset
from stagewise.operators.merge import merge_into_current
from stagewise.operators.rows import first_row_text, rows_to_text, split_to_rows
from stagewise.operators.watermarks import newest_at_destination, newest_at_source, source_watermark
from stagewise.plans import config as cf
from stagewise.plans import log as lg
from stagewise.plans.errors import Rule, classify
from stagewise.showcase import inputs
from stagewise.showcase.inputs import BATCH_TIME, CONFIG_SQL, EVENT_KEYS, EVENTS_SQL, WATERMARK_SQL, ntz, table

# -- cleansing -----------------------------------------------------------------------


def null_tokens(spark, folder):
    key, priority = F.col("o_orderkey"), F.col("o_orderpriority")
    raw = F.when(key % 5 == 0, "").when(key % 5 == 1, r"\N").otherwise(priority)
    return table(spark, folder, "orders").select("o_orderkey", null_tokens_to_null(raw).alias("priority"))


def stripped_offsets(spark, folder):
    wall = F.timestamp_add("SECOND", (F.col("o_orderkey") % 86400).cast("int"), F.col("o_orderdate"))
    part = inputs.clock_parts(wall)
    text = F.concat(part["date"], F.lit("T"), part["time"], F.lit("+05:30"))
    return table(spark, folder, "orders").select("o_orderkey", strip_offset(text).alias("created_on"))


def uuids(spark, folder):
    digest = F.upper(F.md5("c_name"))
    cuts = [F.substring(digest, at, size) for at, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    text = F.concat_ws("-", *cuts)
    raw = F.when(F.col("c_custkey") % 9 == 0, F.left(text, F.lit(30))).otherwise(text)
    return table(spark, folder, "customer").select(
        "c_custkey", uuid_or_null(raw).alias("created_by"), uuid_or_null(raw).isNotNull().alias("is_uuid")
    )


def key_lists(spark, folder):
    text = F.concat(F.lit("["), F.col("c_name"), F.lit("],["), F.col("c_mktsegment"), F.lit("]"))
    return table(spark, folder, "customer").select("c_custkey", normalise_key_list(text).alias("key_columns"))


def split_rows(spark, folder):
    return split_to_rows(table(spark, folder, "documents"), "text", ",", keep=["doc_id"])


def texts_of_orders(spark, folder):
    """The parts of every order in the order of its lines."""
    lines = table(spark, folder, "lineitem")
    part = F.concat(F.col("l_linenumber").cast("string"), F.lit(":"), F.col("l_partkey").cast("string"))
    return rows_to_text(lines, ["l_orderkey"], part, [F.col("l_linenumber"), F.col("l_partkey")])


# -- watermarks and configuration ----------------------------------------------------


def source_mark(spark, folder):
    return source_watermark(inputs.orders_with_date_text(spark, folder), "date_text", by=["o_orderstatus"])


def json_rows(spark, folder):
    """Parameter arrays as text, two structs each, back to rows."""
    config = inputs.config_rows(spark, folder)
    names = list(cf.PARAMETER_FIELDS)
    again = F.struct(*[F.col(n) for n in names[:-1]], F.concat(F.lit("copy."), F.col(names[-1])).alias(names[-1]))
    texts = config.select(F.to_json(F.array(F.struct(*names), again)).alias("parameter_list"))
    return cf.parameter_rows(texts, "parameter_list")


def parameters(spark, folder):
    runs = cf.run_parameters(inputs.config_rows(spark, folder), path=F.lit("load_table"))
    return runs.select("path", "timeout", F.explode("parameters").alias("name", "value"))


def lookups(spark, folder):
    """Which of the names that orders ask for have exactly one config row."""
    name = F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))
    asked = F.when(F.col("o_orderstatus") == "P", F.upper(name)).otherwise(name)
    requested = table(spark, folder, "orders").select(asked.alias("SourceTable"))
    return cf.lookup_many(inputs.config_rows(spark, folder), requested, "SourceTable")


def validation(spark, folder):
    bad = cf.invalid_rows(inputs.config_rows(spark, folder), list(cf.PARAMETER_FIELDS))
    return bad.select("EtlConfigKey", F.array_join("missing", ",").alias("missing"), "message")


def watermark_update(spark, folder):
    """Both watermarks of every source, from its destination rows and its source texts."""
    orders = inputs.orders_with_date_text(spark, folder)
    config = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("EtlConfigKey"),
        F.col("c_name").alias("SourceName"),
        ntz("1900-01-01 00:00:00").alias("DestinationMaxEffectiveDate"),
        ntz("1900-01-01 00:00:00").alias("SourceMaxEffectiveDate"),
        ntz("2020-01-01 00:00:00").alias("ModifiedOn"),
    )
    marks = orders.groupBy(F.col("o_custkey").alias("EtlConfigKey")).agg(
        newest_at_destination("o_orderdate"), newest_at_source("date_text")
    )
    return cf.update_watermarks(config, marks, "EtlConfigKey", ntz(BATCH_TIME))


# -- process log ---------------------------------------------------------------------


def _outcomes(spark, folder, by, run=None):
    """Counts and times of the event merge, per source (of each run)."""
    stage, active = inputs.event_sides(spark, folder)
    merged = merge_into_current(stage, active, EVENT_KEYS, "ts", ["event_id"])
    if run is not None:
        merged = merged.withColumn(run, F.col(run).cast("string")).repartition(run)  # one shuffle serves the counts and the grouping by run
    key = F.col(by).cast("string")
    return merged.groupBy(*([] if run is None else [run]), key.alias("EtlConfigKey")).agg(
        F.count_if(F.col("_action") == "INSERT").alias("RowsInserted"),
        F.count_if(F.col("_action") == "UPDATE").alias("RowsUpdated"),
        F.min("ts").alias("StartedOn"),
        F.max("ts").alias("EndedOn"),
        F.max("ts").alias("MaxEffectiveDate"),
    ).select(
        "*",
        F.concat(F.lit("/Active/"), F.col("EtlConfigKey")).alias("DestinationName"),
        F.when(F.col("RowsInserted") == 0, "nothing inserted").alias("ErrorMessage"),
    )


def process_log(spark, folder):
    return lg.log_records(_outcomes(spark, folder, "user_id"), ntz(BATCH_TIME))


def _as_text(df):
    return df.select(*[F.col(name).cast("string").alias(name) for name in df.columns])


def log_json(spark, folder):
    return lg.as_json(_as_text(process_log(spark, folder)))


def log_json_array(spark, folder):
    """The outcomes of each run, a handful of sources, as one array text; a run per user."""
    records = lg.log_records(_outcomes(spark, folder, "event_type", run="user_id"), ntz(BATCH_TIME), keep=["user_id"])
    return lg.as_json_array(_as_text(records), order_by="EtlConfigKey", run="user_id")


RULES = [
    Rule("error", '"k": 1', "; a -> x", keep_message=True),
    Rule("error", '"k": 2', "; b -> y", keep_message=True),
    Rule("click", '"k": 1', "a -> x"),
    Rule("click", '"k": 2', "b -> y"),
]


def errors(spark, folder):
    message = F.concat(F.col("event_type"), F.lit(":"), F.col("props"))
    outcome = classify(F.col("event_type"), message, RULES, custom_kind="signup")
    return table(spark, folder, "events").select("event_id", outcome.alias("outcome"))


def first_row(spark, folder):
    rows = table(spark, folder, "events").select("event_id", "user_id", "event_type", "props", "ts")
    newest = first_row_text(rows, [F.col("ts").desc(), F.col("event_id").desc()])
    return newest


OUTCOME_SQL = """
per_key AS (
  SELECT user_id, event_type, bool_or(SourceFolder = 'Active') AS had,
         bool_or(SourceFolder = 'Active' AND RowN = 1) AS kept
  FROM ranked GROUP BY user_id, event_type),
winners AS (SELECT r.*, had, kept FROM ranked r JOIN per_key USING (user_id, event_type) WHERE RowN = 1),
outcomes AS (
  SELECT {run}CAST({by} AS VARCHAR) AS EtlConfigKey, count(*) FILTER (NOT had) AS RowsInserted,
         count(*) FILTER (had AND NOT kept) AS RowsUpdated, min(ts) AS StartedOn, max(ts) AS EndedOn
  FROM winners GROUP BY {run}{by}),
records AS (
  SELECT {run}TIMESTAMP '{batch}' AS CreatedOn, '/Active/' || EtlConfigKey AS DestinationName, RowsInserted, RowsUpdated,
         CAST(CAST(date_diff('microsecond', StartedOn, EndedOn) // 10000 AS DECIMAL(18,0)) / 100 AS DECIMAL(18,2))
           AS ProcessSeconds,
         CASE WHEN RowsInserted = 0 THEN 'nothing inserted' END AS ErrorMessage, EndedOn AS MaxEffectiveDate, EtlConfigKey
  FROM outcomes)
"""
BY_USER = OUTCOME_SQL.format(run="", by="user_id", batch=BATCH_TIME)
BY_TYPE = OUTCOME_SQL.format(run="user_id, ", by="event_type", batch=BATCH_TIME)
TEXT_STRUCT = """struct_pack(CreatedOn := CAST(CreatedOn AS VARCHAR), DestinationName := DestinationName,
  RowsInserted := CAST(RowsInserted AS VARCHAR), RowsUpdated := CAST(RowsUpdated AS VARCHAR),
  ProcessSeconds := CAST(ProcessSeconds AS VARCHAR), ErrorMessage := ErrorMessage,
  MaxEffectiveDate := CAST(MaxEffectiveDate AS VARCHAR), EtlConfigKey := EtlConfigKey)"""

QUERIES = {
    "null_token_normalise": (
        null_tokens,
        r"""SELECT o_orderkey,
                   CASE WHEN raw IN ('', '\N') THEN NULL ELSE raw END AS priority
            FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN '' WHEN o_orderkey % 5 = 1 THEN '\N'
                                          ELSE o_orderpriority END AS raw FROM orders)""",
    ),
    "strip_offset_ts": (
        stripped_offsets,
        "SELECT o_orderkey, o_orderdate + to_seconds(o_orderkey % 86400) AS created_on FROM orders",
    ),
    "uuid_check": (
        uuids,
        """SELECT c_custkey,
                  CASE WHEN c_custkey % 9 <> 0 THEN
                    substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4)
                    || '-' || substr(h, 21, 12) END AS created_by,
                  c_custkey % 9 <> 0 AS is_uuid
           FROM (SELECT c_custkey, md5(c_name) AS h FROM customer)""",
    ),
    "normalise_keys": (key_lists, "SELECT c_custkey, c_name || ',' || c_mktsegment AS key_columns FROM customer"),
    "split_to_rows": (
        split_rows,
        """SELECT doc_id, CAST(i - 1 AS INTEGER) AS position, parts[i] AS part
           FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i
                 FROM (SELECT doc_id, string_split(text, ',') AS parts FROM documents))""",
    ),
    "string_agg": (
        texts_of_orders,
        """SELECT l_orderkey, string_agg(l_linenumber || ':' || l_partkey, ',' ORDER BY l_linenumber, l_partkey) AS text
           FROM lineitem WHERE l_linenumber IS NOT NULL AND l_partkey IS NOT NULL GROUP BY l_orderkey""",
    ),
    "source_watermark": (
        source_mark,
        f"""WITH {WATERMARK_SQL}
            SELECT o_orderstatus, max(minute_mark) AS SourceMaxEffectiveDate FROM marks GROUP BY o_orderstatus""",
    ),
    "config_json_to_rows": (
        json_rows,
        f"""WITH {CONFIG_SQL}
            SELECT * FROM config
            UNION ALL SELECT * REPLACE ('copy.' || DestinationName AS DestinationName) FROM config""",
    ),
    "run_parameters": (
        parameters,
        f"WITH {CONFIG_SQL} "
        + " UNION ALL ".join(
            f"SELECT 'load_table' AS path, CAST({cf.RUN_TIMEOUT} AS INTEGER) AS timeout, '{name}' AS name, "
            f"{field} AS value FROM config"
            for field, name in cf.PARAMETER_FIELDS.items()
        ),
    ),
    "config_lookup": (
        lookups,
        """WITH asked AS (
             SELECT DISTINCT CASE WHEN o_orderstatus = 'P' THEN upper(n) ELSE n END AS SourceTable
             FROM (SELECT o_orderstatus, 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS n FROM orders)),
           counts AS (SELECT c_name, count(*) AS n FROM customer GROUP BY c_name)
           SELECT SourceTable, coalesce(n, 0) AS n_rows, coalesce(n, 0) = 1 AS usable
           FROM asked LEFT JOIN counts ON c_name = SourceTable""",
    ),
    "config_validate": (
        validation,
        f"""WITH {CONFIG_SQL}
            SELECT EtlConfigKey, 'KeyColumns' AS missing, 'NULL in config: KeyColumns' AS message
            FROM config WHERE KeyColumns IS NULL""",
    ),
    "config_watermark_update": (
        watermark_update,
        f"""WITH {WATERMARK_SQL},
            found AS (
              SELECT o_custkey, max(o_orderdate) AS at_destination, max(minute_mark) AS at_source
              FROM marks GROUP BY o_custkey)
            SELECT c_custkey AS EtlConfigKey, c_name AS SourceName,
                   CASE WHEN o_custkey IS NULL THEN TIMESTAMP '1900-01-01' ELSE at_destination END
                     AS DestinationMaxEffectiveDate,
                   CASE WHEN o_custkey IS NULL THEN TIMESTAMP '1900-01-01' ELSE at_source END AS SourceMaxEffectiveDate,
                   CASE WHEN o_custkey IS NULL THEN TIMESTAMP '2020-01-01' ELSE TIMESTAMP '{BATCH_TIME}' END AS ModifiedOn
            FROM customer LEFT JOIN found ON o_custkey = c_custkey""",
    ),
    "process_log": (process_log, f"WITH {EVENTS_SQL}, {BY_USER} SELECT * FROM records"),
    "log_to_json": (
        log_json,
        f"WITH {EVENTS_SQL}, {BY_USER} SELECT CAST(to_json({TEXT_STRUCT}) AS VARCHAR) AS record FROM records",
    ),
    "log_json_array": (
        log_json_array,
        f"""WITH {EVENTS_SQL}, {BY_TYPE}
            SELECT CAST(user_id AS VARCHAR) AS user_id,
                   CAST(to_json(list({TEXT_STRUCT} ORDER BY EtlConfigKey)) AS VARCHAR) AS records
            FROM records GROUP BY user_id""",
    ),
    "classify_errors": (
        errors,
        """SELECT event_id,
                  CASE WHEN event_type = 'signup' THEN 'Failure; ' || m
                       WHEN event_type = 'error' AND contains(m, '"k": 1') THEN m || '; a -> x'
                       WHEN event_type = 'error' AND contains(m, '"k": 2') THEN m || '; b -> y'
                       WHEN event_type = 'click' AND contains(m, '"k": 1') THEN 'a -> x'
                       WHEN event_type = 'click' AND contains(m, '"k": 2') THEN 'b -> y'
                       WHEN event_type IN ('error', 'click') THEN m
                       ELSE 'Unhandled Excpetion...' || m END AS outcome
           FROM (SELECT event_id, event_type, event_type || ':' || props AS m FROM events)""",
    ),
    "first_row_kv": (
        first_row,
        """SELECT '(event_id,' || event_id || '), (user_id,' || user_id || '), (event_type,' || event_type
                  || '), (props,' || props || '), (ts,' || CAST(ts AS VARCHAR) || ')' AS first_row
           FROM events ORDER BY ts DESC, event_id DESC LIMIT 1""",
    ),
}
