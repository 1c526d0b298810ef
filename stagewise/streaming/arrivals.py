"""Staged files as a stream: each file is merged once, and nothing need be cleared.

The file source remembers which Stage files it has handed out, which takes the place
of emptying Stage after a load. Every run takes what has arrived and stops. A batch
handed out again after a crash is not merged again, but published if that was left undone.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stagewise.plans.load import Outcome, TableLoad, follow_up, merge_stage, now
from stagewise.sources.current import CurrentTable


def merge_arrivals(
    spark: SparkSession,
    load: TableLoad,
    schema: T.StructType | str,
    progress_path: str,
    files_per_batch: int | None = None,
) -> list[Outcome]:
    """Merge all Stage files not merged yet; one outcome per micro-batch.

    ``progress_path`` is the stream's checkpoint folder, on storage all executors share.
    ``files_per_batch`` bounds a batch when much has piled up.
    """
    outcomes = []

    def merge_batch(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        outcome = Outcome(load.etl_config_key, load.current_path, now())
        table = CurrentTable(session, load.current_path, load.keys, load.buckets)
        commit = table.latest()
        facts = commit.facts if commit is not None else {}
        merged = facts.get("progress") == progress_path and facts.get("batch", -1) >= number
        if not merged:
            # A reload is for the first batch of a stream; later ones add to what it wrote.
            step = load if number == 0 else replace(load, source_watermark=None)
            steps = ["publish"] if load.publish_as is not None else []
            commit = merge_stage(session, step, batch, outcome, {"batch": number, "progress": progress_path, "steps": steps})
            outcome.steps.append("merge")
        elif not table.unfinished(commit):
            return  # merged and published before the stream stopped
        follow_up(session, load, table, commit, outcome)
        outcome.ended_on = now()
        outcomes.append(outcome)

    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    query = (
        reader.parquet(load.stage_path)
        .writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", progress_path)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return outcomes
