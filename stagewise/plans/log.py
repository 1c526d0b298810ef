"""Process-log records as typed rows, and their JSON forms."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.functions.names import column, columns
from stagewise.functions.timestamps import elapsed_seconds, wall_time
from stagewise.sources.files import Folder

LOG_SCHEMA = (
    "CreatedOn timestamp_ntz, DestinationName string, RowsInserted bigint, RowsUpdated bigint, "
    "ProcessSeconds decimal(18,2), ErrorMessage string, MaxEffectiveDate timestamp_ntz, EtlConfigKey string"
)

# What an upsert's log record says about its process and both ends, unless told otherwise.
UPSERT_LABELS = {
    "ProcessType": "Spark job",
    "ProcessName": "keyed upsert",
    "SourceType": "table",
    "DestinationType": "table",
}

# What the calling pipeline passes in for the log.
PIPELINE_FIELDS = (
    "DataFactoryName", "PipelineName", "PipelineRunId", "PipelineTriggerName", "PipelineTriggerType",
)


def log_records(outcomes: DataFrame, created_on: datetime | Column, keep: Sequence[str] = ()) -> DataFrame:
    """Log rows from outcomes with ``StartedOn`` and ``EndedOn``; seconds round down. Columns
    to ``keep`` follow."""
    stamp = created_on if isinstance(created_on, Column) else wall_time(created_on)
    return outcomes.select(
        stamp.alias("CreatedOn"),
        "DestinationName",
        "RowsInserted",
        "RowsUpdated",
        elapsed_seconds(F.col("StartedOn"), F.col("EndedOn")).alias("ProcessSeconds"),
        "ErrorMessage",
        "MaxEffectiveDate",
        "EtlConfigKey",
        *columns(keep),
    )


def upsert_log_records(
    outcomes: DataFrame, pipeline: dict[str, str], labels: dict[str, str] | None = None
) -> DataFrame:
    """Log rows of the keyed-upsert path: pipeline identity, labels, real counts."""
    identity = [F.lit(pipeline.get(name)).cast("string").alias(name) for name in PIPELINE_FIELDS]
    label = {name: F.lit(text).alias(name) for name, text in {**UPSERT_LABELS, **(labels or {})}.items()}
    return outcomes.select(
        "ProcessUserKey",
        *identity,
        label["ProcessType"],
        label["ProcessName"],
        label["SourceType"],
        "SourceName",
        label["DestinationType"],
        "DestinationName",
        "RowsInserted",
        "RowsUpdated",
        F.lit(0).cast("bigint").alias("RowsDeleted"),
        elapsed_seconds(F.col("StartedOn"), F.col("EndedOn")).alias("ProcessSeconds"),
        *[
            (column(name) if name in outcomes.columns else F.lit(None)).cast(kind).alias(name)
            for name, kind in (("ErrorMessage", "string"), ("MaxEffectiveDate", "timestamp_ntz"))
        ],
    )


def as_json(df: DataFrame, name: str = "record") -> DataFrame:
    """Each row as a JSON object text; null fields are kept."""
    return df.select(F.to_json(F.struct(*columns(df.columns)), {"ignoreNullFields": "false"}).alias(name))


def as_json_array(df: DataFrame, order_by: str, name: str = "records", run: str | None = None) -> DataFrame:
    """The rows of each run as one JSON array text, ordered by one column.

    ``run`` names the column that tells runs apart, which stays beside the text; without
    it the rows are those of one run. An array holds one row per configured table.
    """
    names = [c for c in df.columns if c != run]
    fields = [order_by, *[c for c in names if c != order_by]]
    listed = F.array_sort(F.collect_list(F.struct(*columns(fields))))
    reordered = F.transform(listed, lambda row: F.struct(*[row[c].alias(c) for c in names]))
    text = F.to_json(reordered, {"ignoreNullFields": "false"}).alias(name)
    return df.groupBy(*([] if run is None else columns([run]))).agg(text)


def append_log(df: DataFrame, path: str, run: str | None = None) -> None:
    """Append the rows of one run. The run's rows lie in a folder of its own, so a run that
    is logged already adds nothing, and one whose writing broke off is written again."""
    run = run or uuid.uuid4().hex
    folder = Folder(df.sparkSession, path)
    if run in _replaced(folder) or Folder(df.sparkSession, f"{path}/run={run}/_SUCCESS").exists():
        return
    df.coalesce(1).write.mode("overwrite").parquet(f"{path}/run={run}")


def _index(folder: Folder) -> dict:
    """What was compacted: the folders that hold it, and the runs they stand for."""
    names = [p.rsplit("/", 1)[1] for p in Folder(folder._spark, f"{folder.path}/index").children()]
    return json.loads(folder.read_file(f"index/{names[-1]}")) if names else {"number": 0, "folder": None, "runs": []}


def _replaced(folder: Folder) -> set[str]:
    return set(_index(folder)["runs"])


def _log_folders(spark: SparkSession, path: str) -> tuple[dict, list[str]]:
    """The index, and the complete run folders it does not stand for."""
    folder = Folder(spark, path)
    index = _index(folder)
    runs = [p.rsplit("/", 1)[1] for p in folder.children() if p.rsplit("/", 1)[1].startswith("run=")]
    done = [run for run in runs if run.removeprefix("run=") not in set(index["runs"])]
    return index, [run for run in done if Folder(spark, f"{path}/{run}/_SUCCESS").exists()]


def compact_log(spark: SparkSession, path: str) -> int:
    """Gather all runs' rows into few files; returns how many runs were gathered.

    The gathered rows are written beside the runs and count once the index names them;
    from then on the runs' folders do not. These are removed last, and by a later call
    if this one stops.
    """
    index, runs = _log_folders(spark, path)
    folder = Folder(spark, path)
    if runs:
        name = f"gathered/{uuid.uuid4().hex}"
        read_log(spark, path).coalesce(max(1, len(runs) // 10_000)).write.parquet(f"{path}/{name}")
        number = index["number"] + 1
        known = [*index["runs"], *(run.removeprefix("run=") for run in runs)]
        folder.create_file(f"index/{number:012d}.json", json.dumps({"number": number, "folder": name, "runs": known}))
    replaced = _replaced(folder)
    for child in folder.children():
        if child.rsplit("/", 1)[1].removeprefix("run=") in replaced:
            folder.remove(child)
    return len(runs)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """All logged rows; runs may have logged different columns."""
    index, runs = _log_folders(spark, path)
    found = [f"{path}/{name}" for name in ([index["folder"]] if index["folder"] else []) + runs]
    return spark.read.option("mergeSchema", "true").parquet(*found)
