"""Inputs of the registered queries, derived from the given tables as a whole.

Every split below covers its table: rows before a date form the older side and rows
from an earlier date on form the newer side, so the overlap arrives twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.operators.ranking import latest_per_key


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ntz(text: str) -> Column:
    return F.expr(f"TIMESTAMP_NTZ'{text}'")


# -- latest-wins merge ---------------------------------------------------------------

EVENT_KEYS = ["user_id", "event_type"]
EVENTS_ACTIVE_UNTIL = "2024-01-03 00:00:00"
EVENTS_STAGE_FROM = "2024-01-02 00:00:00"

EVENTS_SQL = f"""
active AS (
  SELECT * FROM events WHERE ts < TIMESTAMP '{EVENTS_ACTIVE_UNTIL}'
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, event_id DESC) = 1),
stage AS (SELECT * FROM events WHERE ts >= TIMESTAMP '{EVENTS_STAGE_FROM}' OR ts IS NULL),
tagged AS (
  SELECT *, 'Stage' AS SourceFolder FROM stage
  UNION ALL SELECT *, 'Active' AS SourceFolder FROM active),
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY user_id, event_type
    ORDER BY ts DESC NULLS LAST, event_id DESC, SourceFolder DESC) AS RowN
  FROM tagged)
"""


def split_versions(
    df: DataFrame, keys: list[str], date: str, ties: list[str], active_until: str, stage_from: str
) -> tuple[DataFrame, DataFrame]:
    """Stage rows and current rows of one table, split on its effective date; rows
    without a date are staged."""
    active = latest_per_key(df.filter(F.col(date) < ntz(active_until)), keys, date, ties)
    return df.filter((F.col(date) >= ntz(stage_from)) | F.col(date).isNull()), active


def event_sides(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    events = table(spark, folder, "events")
    return split_versions(events, EVENT_KEYS, "ts", ["event_id"], EVENTS_ACTIVE_UNTIL, EVENTS_STAGE_FROM)


# -- keyed upsert --------------------------------------------------------------------

ORDER_KEYS = ["o_orderkey", "o_custkey"]
ORDER_VALUES = ["o_orderstatus", "o_totalprice", "o_orderpriority"]
TARGET_UNTIL = "1999-01-01 00:00:00"
SOURCE_FROM = "1997-01-01 00:00:00"
BATCH_TIME = "2024-06-01 12:00:00"

UPSERT_SQL = f"""
target AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
         CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderpriority END AS o_orderpriority,
         o_orderdate AS ModifiedOn
  FROM orders WHERE o_orderdate < TIMESTAMP '{TARGET_UNTIL}'),
source AS (
  SELECT o_orderkey, o_custkey,
         CASE WHEN o_orderstatus = 'P' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
         CASE WHEN o_orderpriority = '2-HIGH' THEN o_totalprice + 10 ELSE o_totalprice END AS o_totalprice,
         CASE WHEN o_orderpriority NOT IN ('1-URGENT', '5-LOW') THEN o_orderpriority END AS o_orderpriority
  FROM orders WHERE o_orderdate >= TIMESTAMP '{SOURCE_FROM}' OR o_orderdate IS NULL),
merged AS (
  SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey, coalesce(t.o_custkey, s.o_custkey) AS o_custkey,
         CASE WHEN s.o_orderkey IS NULL THEN t.o_orderstatus ELSE s.o_orderstatus END AS o_orderstatus,
         CASE WHEN s.o_orderkey IS NULL THEN t.o_totalprice ELSE s.o_totalprice END AS o_totalprice,
         CASE WHEN s.o_orderkey IS NULL THEN t.o_orderpriority ELSE s.o_orderpriority END AS o_orderpriority,
         CASE WHEN t.o_orderkey IS NULL THEN 'INSERT'
              WHEN s.o_orderkey IS NULL THEN 'TARGET_ONLY'
              WHEN s.o_orderstatus IS DISTINCT FROM t.o_orderstatus
                OR s.o_totalprice IS DISTINCT FROM t.o_totalprice
                OR s.o_orderpriority IS DISTINCT FROM t.o_orderpriority THEN 'UPDATE'
              ELSE 'UNCHANGED' END AS _action,
         t.ModifiedOn AS old_modified
  FROM target t FULL OUTER JOIN source s ON t.o_orderkey = s.o_orderkey AND t.o_custkey = s.o_custkey)
"""


def upsert_sides(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Target rows, and re-extracted source rows with corrections (those without a date too)."""
    orders = table(spark, folder, "orders")
    priority = F.col("o_orderpriority")
    target = orders.filter(F.col("o_orderdate") < ntz(TARGET_UNTIL)).select(
        *ORDER_KEYS,
        "o_orderstatus",
        "o_totalprice",
        F.when(priority != "1-URGENT", priority).alias("o_orderpriority"),
        F.col("o_orderdate").alias("ModifiedOn"),
    )
    source = orders.filter((F.col("o_orderdate") >= ntz(SOURCE_FROM)) | F.col("o_orderdate").isNull()).select(
        *ORDER_KEYS,
        F.when(F.col("o_orderstatus") == "P", "F").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(priority == "2-HIGH", F.col("o_totalprice") + 10).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        F.when(~priority.isin("1-URGENT", "5-LOW"), priority).alias("o_orderpriority"),
    )
    return target, source


# -- type enforcement ----------------------------------------------------------------

TEXT_TYPES = {
    "s_status": "String",
    "s_key": "Integer",
    "s_long": "Long",
    "s_price": "Double",
    "s_float": "Float",
    "s_date": "Timestamp",
}
TEXT_COLUMNS = list(TEXT_TYPES)

# What the texts below spell, by the number of the format they are written in.
TEXT_SQL = """
plain AS (
  SELECT *, o_orderkey % 16 AS form,
         o_orderdate + to_seconds(o_orderkey % 86400) AS wall,
         to_milliseconds(o_orderkey % 1000) AS ms
  FROM orders),
dated AS (
  SELECT *, CASE WHEN form = 6 AND o_orderdate < TIMESTAMP '2000-01-01' THEN 0 ELSE form END AS fmt FROM plain),
texts AS (
  SELECT o_orderkey, fmt, o_orderstatus AS s_status,
         CASE WHEN o_orderkey % 10 = 0 THEN 'abc' WHEN o_orderkey % 13 = 0 THEN ''
              WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 19 = 0 THEN '1.5'
              ELSE CAST(o_orderkey AS VARCHAR) END AS s_key,
         CAST(o_orderkey + 3000000000 AS VARCHAR) AS s_long,
         CASE WHEN o_orderkey % 11 = 0 THEN 'n/a'
              ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS s_price,
         CAST(o_orderkey % 100 AS VARCHAR) || '.5' AS s_float,
         CASE WHEN o_orderkey % 10 = 0 OR o_orderkey % 13 = 0 OR o_orderkey % 17 = 0 OR o_orderkey % 19 = 0
              THEN NULL ELSE CAST(o_orderkey AS INTEGER) END AS v_key,
         o_orderkey % 10 = 0 OR (o_orderkey % 13 <> 0 AND o_orderkey % 17 <> 0 AND o_orderkey % 19 = 0) AS bad_key,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_totalprice END AS v_price,
         o_orderkey % 11 = 0 AS bad_price,
         CAST((o_orderkey % 100) + 0.5 AS FLOAT) AS v_float,
         CASE fmt WHEN 0 THEN o_orderdate WHEN 1 THEN o_orderdate WHEN 2 THEN o_orderdate
                  WHEN 3 THEN wall WHEN 10 THEN wall WHEN 9 THEN wall
                  WHEN 4 THEN wall + ms - INTERVAL 330 MINUTE WHEN 11 THEN wall + ms - INTERVAL 330 MINUTE
                  WHEN 5 THEN wall + ms + INTERVAL 8 HOUR WHEN 12 THEN wall + ms + INTERVAL 8 HOUR
                  WHEN 6 THEN wall - INTERVAL 1 HOUR WHEN 7 THEN wall + INTERVAL 7 HOUR
                  WHEN 8 THEN date_trunc('minute', wall) END AS v_date,
         fmt = 13 AS bad_date
  FROM dated),
verdicts AS (
  SELECT *, concat_ws(',', CASE WHEN bad_key THEN 's_key' END, CASE WHEN bad_price THEN 's_price' END,
                      CASE WHEN bad_date THEN 's_date' END) AS bad_columns
  FROM texts)
"""


def clock_parts(wall: Column) -> dict[str, Column]:
    """Date, time and 12-hour clock of a wall time as text, free of the session zone."""
    text, hour = wall.cast("string"), F.hour(wall)
    return {
        "date": F.left(text, F.lit(10)),
        "time": F.substring(text, 12, 8),
        "hour12": ((hour + 11) % 12 + 1).cast("string"),
        "minute": F.substring(text, 15, 2),
        "half": F.when(hour < 12, "AM").otherwise("PM"),
    }


def written_date(form: Column, day: Column, wall: Column, millis: Column) -> Column:
    """A day, its time and its milliseconds as text in a numbered format."""
    part = clock_parts(wall)
    date, time = part["date"], part["time"]
    slashed, digits = F.translate(date, "-", "/"), F.translate(date, "-", "")
    exact = F.concat(F.lit("T"), time, F.lit("."), F.lpad(millis.cast("string"), 3, "0"))
    twelve = F.concat(F.lpad(part["hour12"], 2, "0"), F.lit(":"), part["minute"], F.lit(" "), part["half"])
    written = {
        0: date,
        1: digits,
        2: slashed,
        3: F.concat(date, F.lit("T"), time, F.lit("Z")),
        4: F.concat(date, exact, F.lit("+05:30")),
        5: F.concat(date, exact, F.lit("-0800")),
        6: F.concat(F.substring(digits, 3, 6), F.translate(time, ":", ""), F.lit("+0100")),
        7: F.concat(F.date_format(day, "EEE, d MMM yyyy "), time, F.lit(" -0700")),
        8: F.concat(F.lit("0"), F.date_format(day, "yyyy.MMMM.dd"), F.lit(" AD "), twelve),
        9: F.concat(F.translate(date, "-", "."), F.lit(" AD at "), time, F.lit(" UTC")),
        10: F.concat(slashed, F.lit("T"), time, F.lit("Z")),
        11: F.concat(slashed, exact, F.lit("+05:30")),
        12: F.concat(slashed, exact, F.lit("-0800")),
        13: F.lit("not a date"),
        14: F.lit(""),
    }
    branch = F
    for number, value in written.items():
        branch = branch.when(form == number, value)
    return branch


def text_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as raw text, some of it wrong for its declared type."""
    key, date = F.col("o_orderkey"), F.col("o_orderdate")
    two_digit_too_early = (key % 16 == 6) & (date < ntz("2000-01-01 00:00:00"))
    orders = table(spark, folder, "orders").withColumns(
        {
            "form": F.when(two_digit_too_early, 0).otherwise(key % 16),
            "wall": F.timestamp_add("SECOND", (key % 86400).cast("int"), date),
        }
    )
    return orders.select(
        "o_orderkey",
        F.col("o_orderstatus").alias("s_status"),
        F.when(key % 10 == 0, "abc")
        .when(key % 13 == 0, "")
        .when(key % 17 == 0, F.lit(None))
        .when(key % 19 == 0, "1.5")
        .otherwise(key.cast("string"))
        .alias("s_key"),
        (key + 3_000_000_000).cast("string").alias("s_long"),
        F.when(key % 11 == 0, "n/a")
        .otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
        .alias("s_price"),
        F.concat((key % 100).cast("string"), F.lit(".5")).alias("s_float"),
        written_date(F.col("form"), date, F.col("wall"), key % 1000).alias("s_date"),
    )


# -- watermark texts -----------------------------------------------------------------

WATERMARK_SQL = """
marks AS (
  SELECT *, date_trunc('minute', o_orderdate + to_seconds(o_orderkey % 86400)) AS minute_mark FROM orders)
"""


def orders_with_date_text(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with their date as padded AM/PM text or as ISO text."""
    key = F.col("o_orderkey")
    wall = F.timestamp_add("SECOND", (key % 86400).cast("int"), F.col("o_orderdate"))
    part = clock_parts(wall)
    am_pm = F.concat(
        F.date_format("o_orderdate", "MMM "),
        F.lpad(F.dayofmonth("o_orderdate").cast("string"), 2, " "),
        F.date_format("o_orderdate", " yyyy "),
        part["hour12"], F.lit(":"), part["minute"], part["half"],
    )
    iso = F.concat(part["date"], F.lit("T"), part["time"])
    return table(spark, folder, "orders").withColumn("date_text", F.when(key % 2 == 0, am_pm).otherwise(iso))


# -- configuration -------------------------------------------------------------------

CONFIG_SQL = """
config AS (
  SELECT CAST(c_custkey AS VARCHAR) AS EtlConfigKey, lower(c_mktsegment) AS SourceSchema, c_name AS SourceTable,
         'o_orderdate' AS SourceEffectiveDateColumn,
         CASE WHEN c_acctbal < 0 THEN '1900-01-01' ELSE '1998-01-01 00:00:00' END AS SourceMaxEffectiveDate,
         CASE WHEN c_mktsegment <> 'BUILDING' THEN '[o_orderkey],[o_custkey]' END AS KeyColumns,
         'dbo.' || c_name AS DestinationName
  FROM customer)
"""


def config_rows(spark: SparkSession, folder: str) -> DataFrame:
    """One load configuration per customer."""
    segment = F.col("c_mktsegment")
    return table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("EtlConfigKey"),
        F.lower(segment).alias("SourceSchema"),
        F.col("c_name").alias("SourceTable"),
        F.lit("o_orderdate").alias("SourceEffectiveDateColumn"),
        F.when(F.col("c_acctbal") < 0, "1900-01-01").otherwise("1998-01-01 00:00:00").alias("SourceMaxEffectiveDate"),
        F.when(segment != "BUILDING", "[o_orderkey],[o_custkey]").alias("KeyColumns"),
        F.concat(F.lit("dbo."), F.col("c_name")).alias("DestinationName"),
    )
