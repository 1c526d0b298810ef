"""Registered queries: type enforcement, hashes, de-duplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from stagewise.functions.timestamps import format_timestamp, or_sentinel, parse_timestamp
from stagewise.operators import enforce as en
from stagewise.operators.rows import distinct_rows, rejoin_on_hash, row_hash, row_identity
from stagewise.showcase import inputs
from stagewise.showcase.inputs import TEXT_COLUMNS, TEXT_SQL, TEXT_TYPES, table


def verdict(spark, folder):
    checked = en.with_verdict(inputs.text_orders(spark, folder), TEXT_TYPES)
    return checked.select("o_orderkey", F.array_join(en.BAD_COLUMNS, ",").alias("bad_columns"), en.VERDICT)


def passing(spark, folder):
    passed, _ = en.enforce(inputs.text_orders(spark, folder).select(*TEXT_COLUMNS), TEXT_TYPES)
    return passed


def failing(spark, folder):
    _, failed = en.enforce(inputs.text_orders(spark, folder).select(*TEXT_COLUMNS), TEXT_TYPES)
    return failed.withColumn(en.BAD_COLUMNS, F.array_join(en.BAD_COLUMNS, ","))


def parsed(spark, folder):
    return inputs.text_orders(spark, folder).select("o_orderkey", parse_timestamp(F.col("s_date")).alias("parsed"))


def sentinel(spark, folder):
    moment = or_sentinel(parse_timestamp(F.col("s_date")))
    return inputs.text_orders(spark, folder).select("o_orderkey", moment.alias("parsed"))


def formatted(spark, folder):
    return table(spark, folder, "events").select("event_id", format_timestamp(F.col("ts")).alias("ts_text"))


# Declared types by column name, as a schema table would hold them.
PROJECTION_TYPES = {
    "order key": "Long",
    "small-key": "Integer",
    "total.price": "Double",
    "half": "Float",
    "status": "String",
    "made on": "Date",
}


def schema_projection(spark, folder):
    raw = table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("order key"),
        (F.col("o_orderkey") % 1000).cast("string").alias("small-key"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("total.price"),
        F.concat((F.col("o_orderkey") % 100).cast("string"), F.lit(".5")).alias("half"),
        F.col("o_orderstatus").alias("status"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("made on"),
    )
    return raw.selectExpr(*en.cast_projection(PROJECTION_TYPES))


def distinct_documents(spark, folder):
    return distinct_rows(table(spark, folder, "documents").select("lang", "n_chars", "text"))


HASHED = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
# Prices as fixed decimals, so that their texts are the same everywhere; nulls are marked.
HASHED_SQL = ", ".join(
    f"coalesce({text}, 'null')" for text in (
        "CAST(o_orderkey AS VARCHAR)", "CAST(o_custkey AS VARCHAR)", "o_orderstatus",
        "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)", "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')", "o_orderpriority",
    )
)


def _order_texts(spark, folder):
    orders = table(spark, folder, "orders").withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))
    return orders.select(F.col("o_orderkey").alias("key"), *[
        F.coalesce(F.col(name).cast("string"), F.lit("null")).alias(name) for name in HASHED])


def hashes(spark, folder):
    return _order_texts(spark, folder).select(F.col("key").alias("o_orderkey"), row_hash(HASHED).alias("Hash"))


def rejoined(spark, folder):
    """Number, date and text columns of a row, typed apart and joined again."""
    rows = distinct_rows(table(spark, folder, "orders").select(*HASHED)).withColumn("Hash", row_identity(HASHED))
    numbers = rows.select("Hash", "o_totalprice", "o_orderdate", F.col("o_orderkey").cast("string").try_cast("bigint").alias("o_orderkey"),
                          F.col("o_custkey").cast("string").try_cast("int").alias("o_custkey"))
    texts = rows.select("Hash", "o_orderstatus", "o_orderpriority")
    return rejoin_on_hash(numbers, texts).drop("Hash")


QUERIES = {
    "cast_verdict": (
        verdict,
        f"""WITH {TEXT_SQL}
            SELECT o_orderkey, bad_columns, CASE WHEN bad_columns = '' THEN 'Pass' ELSE 'Fail' END AS Exception
            FROM verdicts""",
    ),
    "cast_pass": (
        passing,
        f"""WITH {TEXT_SQL}
            SELECT s_status, v_key AS s_key, CAST(s_long AS BIGINT) AS s_long, v_price AS s_price, v_float AS s_float,
                   v_date AS s_date
            FROM verdicts WHERE bad_columns = ''""",
    ),
    "cast_fail": (
        failing,
        f"""WITH {TEXT_SQL},
            written AS (
              SELECT v.*, d.o_orderdate, d.wall, strftime(d.wall + d.ms, '%g') AS millis
              FROM verdicts v JOIN dated d USING (o_orderkey))
            SELECT s_status, s_key, s_long, s_price, s_float,
                   CASE fmt WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
                            WHEN 1 THEN strftime(o_orderdate, '%Y%m%d')
                            WHEN 2 THEN strftime(o_orderdate, '%Y/%m/%d')
                            WHEN 3 THEN strftime(wall, '%Y-%m-%dT%H:%M:%SZ')
                            WHEN 4 THEN strftime(wall, '%Y-%m-%dT%H:%M:%S.') || millis || '+05:30'
                            WHEN 5 THEN strftime(wall, '%Y-%m-%dT%H:%M:%S.') || millis || '-0800'
                            WHEN 6 THEN strftime(wall, '%y%m%d%H%M%S+0100')
                            WHEN 7 THEN strftime(wall, '%a, %-d %b %Y %H:%M:%S -0700')
                            WHEN 8 THEN strftime(wall, '0%Y.%B.%d AD %I:%M %p')
                            WHEN 9 THEN strftime(wall, '%Y.%m.%d AD at %H:%M:%S UTC')
                            WHEN 10 THEN strftime(wall, '%Y/%m/%dT%H:%M:%SZ')
                            WHEN 11 THEN strftime(wall, '%Y/%m/%dT%H:%M:%S.') || millis || '+05:30'
                            WHEN 12 THEN strftime(wall, '%Y/%m/%dT%H:%M:%S.') || millis || '-0800'
                            WHEN 13 THEN 'not a date' WHEN 14 THEN '' END AS s_date,
                   bad_columns AS _bad_columns, 'Fail' AS Exception
            FROM written WHERE bad_columns <> ''""",
    ),
    "parse_timestamps": (parsed, f"WITH {TEXT_SQL} SELECT o_orderkey, v_date AS parsed FROM texts"),
    "timestamp_sentinel": (
        sentinel,
        f"""WITH {TEXT_SQL}
            SELECT o_orderkey, coalesce(v_date, TIMESTAMP '1900-01-01 00:00:00') AS parsed FROM texts""",
    ),
    "format_timestamps": (
        formatted,
        "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS ts_text FROM events",
    ),
    "schema_driven_projection": (
        schema_projection,
        """SELECT o_orderkey AS "order key", CAST(o_orderkey % 1000 AS INTEGER) AS "small-key",
                  o_totalprice AS "total.price", CAST((o_orderkey % 100) + 0.5 AS FLOAT) AS half,
                  o_orderstatus AS status, strftime(o_orderdate, '%Y-%m-%d') AS "made on"
           FROM orders""",
    ),
    "distinct_rows": (distinct_documents, "SELECT DISTINCT lang, n_chars, text FROM documents"),
    "row_hash": (
        hashes,
        """SELECT o_orderkey, md5(concat_ws(',', """ + HASHED_SQL + """)) AS Hash
           FROM orders""",
    ),
    "hash_rejoin": (
        rejoined,
        """SELECT DISTINCT o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, o_totalprice, o_orderdate,
                  o_orderstatus, o_orderpriority
           FROM orders""",
    ),
}
