"""Load one table or many: merge, switch, publish, clear Stage, log.

The steps of a load run in order and stop at the first failure; an outcome is logged
either way. A commit names the Stage files it has consumed and the steps that follow it:
a load that stops later is continued there by the next one, which merges only files that
no commit has consumed. Only consumed files are cleared, last.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import UTC, datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagewise.functions.names import column, columns, key_list
from stagewise.functions.timestamps import wall_time
from stagewise.operators.merge import is_full_reload, merge_into_current
from stagewise.operators.ranking import latest_per_key
from stagewise.operators.upsert import AUDIT_COLUMN, INSERT, UPDATE, one_sided_upsert, upsert
from stagewise.operators.watermarks import newest_at_source
from stagewise.plans.config import RUN_TIMEOUT, TABLES_AT_ONCE, lookup, update_watermarks
from stagewise.plans.errors import OUTCOME_RULES, classify
from stagewise.plans.log import append_log, log_records, upsert_log_records
from stagewise.sources.current import Commit, CurrentTable, ddl_of, publish_table, publish_view, restored, stored
from stagewise.sources.files import Folder, Listed
from stagewise.sources.reconcile import SET_ASIDE_SCHEMA, read_together

# Staged rows of one bucket that a task may hold in memory; with more the join sorts.
HASHED_ROWS = 1_000_000


@dataclass(frozen=True)
class TableLoad:
    """One row of the load configuration."""

    etl_config_key: str
    stage_path: str
    current_path: str
    keys: str | Sequence[str]
    effective_date: str
    tie_breakers: Sequence[str] = ()
    source_watermark: str | None = None
    buckets: int | None = None
    publish_as: str | None = None
    publish: str = "view"


@dataclass
class Outcome:
    """What a load did; becomes one process-log row."""

    etl_config_key: str
    destination_name: str
    started_on: datetime
    ended_on: datetime | None = None
    rows_inserted: int = 0
    rows_updated: int = 0
    rows_updated_rank2: int = 0
    max_effective_date: datetime | None = None
    error_message: str | None = None
    steps: list[str] = field(default_factory=list)
    error_kind: str | None = None
    expired: threading.Event = field(default_factory=lambda: getattr(_limits, "expired", None) or threading.Event(), repr=False)

    @property
    def succeeded(self) -> bool:
        return self.error_message is None

    def check_time(self) -> None:
        """Stop a load that is over its time before it changes anything more."""
        if self.expired.is_set():
            raise TimeoutError("the load is over its time limit")

    def failed(self, error: Exception) -> None:
        """Note a failure; a job cancelled at the time limit counts as that."""
        if self.expired.is_set():
            error = TimeoutError("the load is over its time limit")
        self.error_kind = type(error).__name__
        self.error_message = f"{self.error_kind}: {error}"


# What the thread of a load knows of its time limit.
_limits = threading.local()


OUTCOME_SCHEMA = (
    "EtlConfigKey string, DestinationName string, RowsInserted bigint, RowsUpdated bigint, "
    "StartedOn timestamp_ntz, EndedOn timestamp_ntz, ErrorMessage string, MaxEffectiveDate timestamp_ntz"
)


def now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


def require_fields(fields: dict) -> None:
    """Refuse a configuration with missing values before anything runs."""
    missing = [name for name, value in fields.items() if not value]
    if missing:
        raise ValueError("NULL in config: " + ",".join(missing))


def merge_stage(
    spark: SparkSession, load: TableLoad, stage: DataFrame, outcome: Outcome, facts: dict | None = None
) -> Commit:
    """Merge staged rows into the current table and switch to the result.

    In a bucketed table only the buckets of staged keys are read and rewritten. Counts are
    taken from the files written and stored with the commit, next to any ``facts`` given.
    """
    table = CurrentTable(spark, load.current_path, load.keys, load.buckets)
    keys = key_list(load.keys)
    before, latest = table.last_number(), table.latest()
    reload = is_full_reload(load.source_watermark)
    keep, rewritten = None, []
    if reload or latest is None:
        merged = latest_per_key(stage, keys, load.effective_date, load.tie_breakers)
        merged = merged.withColumns({"_action": F.lit(INSERT), "_rank2": F.lit(False)})
    elif table.can_extend(latest, ddl_of(stage)):
        touched = touched_buckets(table, stage)
        keep, rewritten = latest, sorted(touched)
        merged = merge_into_current(
            stage, table.read_version(latest, rewritten), keys, load.effective_date, load.tie_breakers, load.buckets,
            null_keys=any(nulls for _, nulls in touched.values()),
            hash_stage=all(rows <= HASHED_ROWS for rows, _ in touched.values()),
        )
    else:
        merged = merge_into_current(stage, table.read_version(latest), keys, load.effective_date, load.tie_breakers)
    facts = {**(facts or {}), "feed": latest is None or not reload}
    return settle(table, merged, outcome, facts, before, load.effective_date, keep, rewritten)


def touched_buckets(table: CurrentTable, rows: DataFrame) -> dict[int, tuple[int, bool]]:
    """The buckets these rows fall into: how many rows, and whether a key part is null. Reads
    the keys alone; there are at most as many results as buckets."""
    null = F.lit(False)
    for key in table.keys:
        null = null | column(key).isNull()
    found = rows.groupBy(table.bucket_of().alias("bucket")).agg(F.count("*").alias("n"), F.max(null).alias("nulls"))
    return {row.bucket: (row.n, row.nulls) for row in found.collect()}


def settle(
    table: CurrentTable, merged: DataFrame, outcome: Outcome, facts: dict, before: int, effective_date: str | None,
    keep: Commit | None, rewritten: Sequence[int],
) -> Commit:
    """Write merged rows, switch to them, and put what the files hold into commit and outcome."""
    ddl = ddl_of(merged)
    path = table.write_version(merged, placed=keep is not None)
    held = table.counted(path, ddl, effective_date)
    n = lambda test: sum(file.rows for file in held if test(file))
    marks = bucket_marks(table, effective_date, keep, rewritten)
    for file in held:
        if file.newest is not None:
            marks[str(file.bucket)] = max(file.newest, marks.get(str(file.bucket), file.newest))
    outcome.rows_inserted = n(lambda f: f.action == INSERT)
    outcome.rows_updated = n(lambda f: f.action == UPDATE)
    outcome.rows_updated_rank2 = n(lambda f: f.rank2)
    outcome.max_effective_date = max(marks.values(), default=None)
    facts = {
        **facts, "inserted": outcome.rows_inserted, "updated": outcome.rows_updated, "updated_rank2": outcome.rows_updated_rank2,
        "max_effective_date": stored(outcome.max_effective_date),
        "marks": {"column": effective_date, "of": {bucket: stored(mark) for bucket, mark in marks.items()}},
    }
    outcome.check_time()
    return table.switch_to(path, ddl, facts, before, held, keep, rewritten)


def bucket_marks(table: CurrentTable, effective_date: str | None, keep: Commit | None, rewritten: Sequence[int]) -> dict[str, Any]:
    """The newest effective date of each bucket that is carried over: as its commit noted it, or
    else from the column."""
    if keep is None or effective_date is None:
        return {}
    gone = {str(bucket) for bucket in rewritten}
    noted = keep.facts.get("marks", {})
    if noted.get("column") == effective_date:
        return {bucket: restored(mark) for bucket, mark in noted["of"].items() if bucket not in gone}
    others = table.read_version(keep, [int(bucket) for bucket in keep.files if bucket not in gone])
    found = others.groupBy(table.bucket_of().alias("bucket")).agg(F.max(column(effective_date)).alias("newest"))
    return {str(row.bucket): row.newest for row in found.collect() if row.newest is not None}


def publish_current(spark: SparkSession, load: TableLoad) -> None:
    if load.publish_as is None:
        return
    table = CurrentTable(spark, load.current_path, load.keys, load.buckets)
    if load.publish == "table":
        publish_table(table.read(), load.publish_as)
    else:
        publish_view(spark, table, load.publish_as)


def load_table(spark: SparkSession, load: TableLoad) -> Outcome:
    """Run one load, or continue one that stopped after its commit. Never raises: a failure
    is part of the outcome."""
    outcome = Outcome(load.etl_config_key, load.current_path, now())
    try:
        folder = Folder(spark, load.stage_path)
        arrived = folder.files()
        require_fields({"KeyColumns": load.keys, "SourceEffectiveDateColumn": load.effective_date})
        table = CurrentTable(spark, load.current_path, load.keys, load.buckets)
        commit = table.latest()
        consumed = table.ledger(commit)
        fresh = [file for file in arrived if file not in consumed]
        if fresh:
            # Files of earlier loads that still lie there are not forgotten.
            ledger = table.write_ledger([*fresh, *consumed.intersection(arrived)])
            steps = [*(["publish"] if load.publish_as is not None else []), "clear"]
            stage, aside = read_together(spark, load.stage_path, fresh)
            if aside is not None:
                # Before the commit that consumes the files; a load that stops here writes them again.
                aside.write.parquet(f"{table.root}/set_aside/{ledger.rsplit('/', 1)[1]}")
            commit = merge_stage(spark, load, stage, outcome, {"ledger": ledger, "steps": steps, "set_aside": aside is not None})
            outcome.steps.append("merge")
        follow_up(spark, load, table, commit, outcome, folder)
    except Exception as error:  # noqa: BLE001 - every failure becomes a log row
        outcome.failed(error)
    outcome.ended_on = now()
    return outcome


def follow_up(
    spark: SparkSession, load: TableLoad, table: CurrentTable, commit: Commit | None, outcome: Outcome, folder: Folder | None = None
) -> None:
    """The steps after a commit that have not been done yet; each is noted once it is."""
    if commit is None:
        return
    pending = table.unfinished(commit)
    outcome.check_time()
    if "publish" in pending or "merge" in outcome.steps:
        publish_current(spark, load)
        table.finish(commit, "publish")
        outcome.steps.append("publish")
    if folder is not None and "clear" in pending:
        outcome.check_time()
        for file in clearable(table, commit, folder):
            folder.remove(file.path)
        table.finish(commit, "clear")
        outcome.steps.append("clear")


def set_aside(spark: SparkSession, table: CurrentTable) -> DataFrame:
    """Rows of consumed files that did not fit in with the others: ``file, row, reason``."""
    names = [f"{table.root}/set_aside/{c.facts['ledger'].rsplit('/', 1)[1]}" for c in table.commits() if c.facts.get("set_aside")]
    return spark.read.schema(SET_ASIDE_SCHEMA).parquet(*names) if names else spark.createDataFrame([], SET_ASIDE_SCHEMA)


def clearable(table: CurrentTable, commit: Commit, folder: Folder) -> list[Listed]:
    """Consumed files as they lie there now; one written anew since then is not among them."""
    consumed = table.ledger(commit)
    return [file for file in folder.files() if file in consumed]


@dataclass(frozen=True)
class TableUpsert:
    """One row of the upsert configuration; the source is a query or a DataFrame."""

    etl_config_key: str
    source: str | DataFrame
    current_path: str
    keys: str | Sequence[str]
    values: Sequence[str] | None = None
    effective_date: str | None = None
    audit_column: str = AUDIT_COLUMN
    insert_null_keys: bool = True
    buckets: int | None = None


def upsert_table(spark: SparkSession, config: TableUpsert, batch_time: datetime | None = None) -> Outcome:
    """Upsert a source into an existing current table. Never raises."""
    outcome = Outcome(config.etl_config_key, config.current_path, now())
    try:
        source = spark.sql(config.source) if isinstance(config.source, str) else config.source
        table = CurrentTable(spark, config.current_path, config.keys, config.buckets)
        before, latest = table.last_number(), table.latest()
        if latest is None:
            raise ValueError(f"no current table at {config.current_path}")
        table.buckets = config.buckets or latest.buckets
        settings = (config.keys, config.values, batch_time or outcome.started_on, config.audit_column, config.insert_null_keys)
        keep, rewritten = None, []
        if table.can_extend(latest, latest.ddl):
            keys = _in_types_of(source, latest.ddl, table.keys)
            touched = touched_buckets(table, keys)
            keep, rewritten = latest, sorted(touched)
            hashed = all(rows <= HASHED_ROWS for rows, _ in touched.values())
            merged = one_sided_upsert(table.read_version(latest, rewritten), source, *settings, table.buckets, hashed)
        else:
            merged = upsert(table.read_version(latest), source, *settings)
        settle(table, merged, outcome, {"feed": True}, before, config.effective_date, keep, rewritten)
        outcome.steps.append("merge")
    except Exception as error:  # noqa: BLE001 - every failure becomes a log row
        outcome.failed(error)
    outcome.ended_on = now()
    return outcome


def _in_types_of(rows: DataFrame, ddl: str, names: Sequence[str]) -> DataFrame:
    """Columns in the table's types, as the upsert will send them; a misfit fails there."""
    types = {f.name: f.dataType for f in T.StructType.fromDDL(ddl).fields}
    return rows.select(*[column(name).try_cast(types[name]).alias(name) for name in names])


# How often watermarks are tried again when other sources write theirs.
CONFIG_ATTEMPTS = 10

# Config columns a keyed upsert cannot do without.
UPSERT_FIELDS = (
    "DestinationTable", "DestinationName", "MergeColumns", "KeyColumns", "SourceQuery",
    "SourceEffectiveDateColumn", "DestinationEffectiveDateColumn",
)


def run_upsert(
    spark: SparkSession, config: CurrentTable, source_name: str, base_path: str,
    pipeline: dict[str, str], log_path: str, batch_time: datetime | None = None,
) -> Outcome:
    """The whole keyed upsert of one configured source.

    Looks up the source's config row, upserts its query into the destination, then
    writes both watermarks back to the config. Watermarks are written only after the new
    destination version is in place; a run that stops before that can be repeated. A log
    record is appended whatever happens; a bad config row, a failing watermark or a failing
    log is raised as well.
    """
    outcome, row = Outcome(source_name, source_name, now()), None
    try:
        row = lookup(config.read(), source_name).first()
        outcome.destination_name = row.DestinationName
        require_fields({name: row[name] for name in UPSERT_FIELDS})
        upsert_config = TableUpsert(
            etl_config_key=source_name,
            source=row.SourceQuery,
            current_path=f"{base_path}/{row.DestinationTable}",
            keys=row.KeyColumns,
            values=key_list(row.MergeColumns),
            effective_date=row.DestinationEffectiveDateColumn,
        )
        outcome = upsert_table(spark, upsert_config, batch_time)
        if outcome.succeeded:
            _write_watermarks(spark, config, source_name, row, outcome, batch_time)
            outcome.steps.append("watermarks")
    except Exception as error:
        outcome.failed(error)
        raise
    finally:
        outcome.ended_on = outcome.ended_on or now()
        logged = outcome_rows(spark, [outcome]).withColumns(
            {
                "ProcessUserKey": F.lit(row and row.ProcessUserKey).cast("int"),
                "SourceName": F.lit(source_name),
                "DestinationName": F.lit(row and row.DestinationName).cast("string"),
            }
        )
        append_log(upsert_log_records(logged, pipeline), log_path)
    return outcome


def _write_watermarks(
    spark: SparkSession, config: CurrentTable, source_name: str, row: Any, outcome: Outcome, batch_time: datetime | None
) -> None:
    at_source = spark.table(source_name).agg(newest_at_source(row.SourceEffectiveDateColumn))
    marks = at_source.select(
        F.lit(source_name).alias("SourceName"),
        "SourceMaxEffectiveDate",
        _moment(outcome.max_effective_date).alias("DestinationMaxEffectiveDate"),
    )
    # Another source may write its watermarks meanwhile: read the newest and try again.
    for attempt in range(CONFIG_ATTEMPTS):
        number = config.last_number()
        try:
            config.replace(update_watermarks(config.read(), marks, "SourceName", batch_time or now()), after=number)
            return
        except Exception:  # noqa: BLE001 - raised again unless another writer was faster
            if config.last_number() == number or attempt == CONFIG_ATTEMPTS - 1:
                raise


def _moment(value: datetime | None) -> Column:
    return F.lit(None).cast("timestamp_ntz") if value is None else wall_time(value)


def run_all(
    spark: SparkSession, loads: Sequence[TableLoad], at_once: int = TABLES_AT_ONCE,
    run: Callable[[SparkSession, TableLoad], Outcome] = load_table, limit: float = RUN_TIMEOUT,
) -> list[Outcome]:
    """Run several loads, a few at once. One failing load does not stop the others.

    A load that takes more than ``limit`` seconds has its jobs cancelled and ends as a
    failure, before its next step. Each load has a scheduler pool of its own, which shares
    the cluster fairly where the session's scheduler mode is FAIR.
    """
    def one(load: TableLoad) -> Outcome:
        _limits.expired = threading.Event()
        tag = f"load-{uuid.uuid4().hex}"
        context, ended = spark.sparkContext, threading.Event()
        context.addJobTag(tag)
        context.setLocalProperty("spark.scheduler.pool", f"load-{load.etl_config_key}")
        watch = threading.Thread(target=_cancel_late, args=(context, tag, limit, _limits.expired, ended), daemon=True)
        watch.start()
        try:
            return run(spark, load)
        finally:
            ended.set()
            context.removeJobTag(tag)
            context.setLocalProperty("spark.scheduler.pool", None)
            _limits.expired = None

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        return list(pool.map(one, loads))


def _cancel_late(context: Any, tag: str, limit: float, expired: threading.Event, ended: threading.Event) -> None:
    """Once the time is over, cancel the load's jobs until it has ended; it may start others."""
    if ended.wait(limit):
        return
    expired.set()
    while not ended.wait(0.2):
        context.cancelJobsWithTag(tag)


def outcome_rows(spark: SparkSession, outcomes: Sequence[Outcome]) -> DataFrame:
    """Outcomes, one per configured table, as a DataFrame; failures read as the error rules say."""
    rows = [
        (o.etl_config_key, o.destination_name, o.rows_inserted, o.rows_updated,
         o.started_on, o.ended_on, o.error_message, o.max_effective_date, o.error_kind)
        for o in outcomes
    ]
    df = spark.createDataFrame(rows, OUTCOME_SCHEMA + ", _kind string")
    text = F.when(F.col("ErrorMessage").isNotNull(), classify(F.col("_kind"), F.col("ErrorMessage"), OUTCOME_RULES, "ValueError"))
    return df.withColumn("ErrorMessage", text).drop("_kind")


def log_outcomes(spark: SparkSession, outcomes: Sequence[Outcome], path: str, run: str | None = None) -> DataFrame:
    """Append the outcomes to the process log; returns the appended rows. A ``run`` that is
    logged already is not logged again."""
    records = log_records(outcome_rows(spark, outcomes), now())
    append_log(records, path, run)
    return records


def loads_from_config(parameters: DataFrame, base_path: str, **options) -> list[TableLoad]:
    """Loads from parsed parameter rows, one per configured table."""
    return [
        TableLoad(
            etl_config_key=row.EtlConfigKey,
            stage_path=f"{base_path}/{row.SourceSchema}/{row.SourceTable}/Stage",
            current_path=f"{base_path}/{row.SourceSchema}/{row.SourceTable}/Active",
            keys=row.KeyColumns,
            effective_date=row.SourceEffectiveDateColumn,
            source_watermark=row.SourceMaxEffectiveDate,
            publish_as=row.DestinationName,
            **options,
        )
        for row in parameters.collect()
    ]
