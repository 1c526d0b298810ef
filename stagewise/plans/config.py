"""Configuration rows as data: parsing, validation, lookup, watermark updates."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagewise.functions.names import column, columns
from stagewise.functions.timestamps import wall_time

# Fields of the parameter list, and the run parameters they become.
PARAMETER_FIELDS = {
    "EtlConfigKey": "etlConfigKey",
    "SourceSchema": "sourceSchema",
    "SourceTable": "sourceTable",
    "SourceEffectiveDateColumn": "sourceEffectiveDateColumn",
    "SourceMaxEffectiveDate": "sourceMaxEffectiveDate",
    "KeyColumns": "keyColumns",
    "DestinationName": "destinationName",
}
PARAMETER_SCHEMA = "array<struct<" + ",".join(f"{name}:string" for name in PARAMETER_FIELDS) + ">>"

# Seconds one table may take, and how many tables run at once.
RUN_TIMEOUT = 3600
TABLES_AT_ONCE = 5


def parameter_rows(df: DataFrame, json_column: str) -> DataFrame:
    """One row per struct of a JSON array text, under the declared schema.

    A null or blank text has no rows; any other that is no such array fails the query.
    """
    text = column(json_column)
    parsed = F.from_json(text, PARAMETER_SCHEMA)
    broken = parsed.isNull() & (F.trim(text) != "")
    return df.select(F.inline(F.when(broken, F.raise_error(F.concat(F.lit("malformed parameter list: "), text))).otherwise(parsed)))


def run_parameters(config: DataFrame, path: str | Column = "load_table", timeout: int = RUN_TIMEOUT) -> DataFrame:
    """``path, timeout, parameters`` per config row; null values are kept in the map."""
    pairs = [cell for field, name in PARAMETER_FIELDS.items() for cell in (F.lit(name), column(field))]
    path = path if isinstance(path, Column) else F.lit(path)
    return config.select(path.alias("path"), F.lit(timeout).alias("timeout"), F.create_map(*pairs).alias("parameters"))


def missing_fields(required: Sequence[str]) -> Column:
    """Names of the required fields that are null."""
    return F.array_compact(F.array(*[F.when(column(name).isNull(), F.lit(name)) for name in required]))


def invalid_rows(config: DataFrame, required: Sequence[str]) -> DataFrame:
    """Config rows that cannot be run, with their missing fields and a message."""
    missing = config.withColumn("missing", missing_fields(required)).filter(F.size("missing") > 0)
    return missing.withColumn(
        "message", F.format_string("NULL in config: %s", F.array_join("missing", ","))
    )


def lookup(config: DataFrame, source_name: str, name_column: str = "SourceName") -> DataFrame:
    """The config row of one source; the query fails unless there is exactly one.

    The count stays in the plan, so it is checked whenever the row is used.
    """
    found = config.filter(column(name_column) == source_name)
    counted = found.agg(F.count("*").alias("_n"), F.first(F.struct(*columns(config.columns))).alias("_row"))
    message = F.format_string("%s config rows for %s", F.col("_n").cast("string"), F.lit(source_name))
    single = F.when(F.col("_n") == 1, True).otherwise(F.raise_error(message).cast("boolean"))
    return counted.filter(single).select("_row.*")


def lookup_many(config: DataFrame, requested: DataFrame, name_column: str = "SourceName") -> DataFrame:
    """For every requested name its number of config rows and whether that is one."""
    names = requested.select(column(name_column)).distinct()
    counts = config.groupBy(column(name_column)).agg(F.count("*").alias("_n"))
    found = names.join(counts, name_column, "left")
    n_rows = F.coalesce(F.col("_n"), F.lit(0).cast("bigint"))
    return found.select(column(name_column), n_rows.alias("n_rows"), (n_rows == 1).alias("usable"))


def update_watermarks(
    config: DataFrame, watermarks: DataFrame, key: str, batch_time: datetime | Column
) -> DataFrame:
    """Config with new watermarks and change time where a source reported one.

    ``watermarks`` holds one row per source: ``key`` and any of the two watermark
    columns. A source without rows, or with a null watermark, keeps its old value.
    """
    stamp = batch_time if isinstance(batch_time, Column) else wall_time(batch_time)
    pair = config.alias("c").join(watermarks.alias("w"), column(key, "c") == column(key, "w"), "left")
    reported = column(key, "w").isNotNull()
    cells = []
    for name in config.columns:
        old = column(name, "c")
        if name != key and name in watermarks.columns:
            old = F.when(reported & column(name, "w").isNotNull(), column(name, "w")).otherwise(old)
        elif name == "ModifiedOn":
            old = F.when(reported, stamp).otherwise(old)
        cells.append(old.alias(name))
    return pair.select(*cells)
