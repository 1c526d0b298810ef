"""Incremental copy of a dataset between two stores, byte by byte, by the executors.

Listing and copying run in tasks, on any store that pyarrow's file systems reach; neither
file names nor contents pass the driver. A copied file is stored under a name of its own
below ``data``, and counts once the manifest names it. The manifest is a table that is
switched as a whole when all files of a run have been copied, so readers, which go by it,
see the files of one complete run or of the next. A task that is run twice leaves a file
that nothing names.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator, Sequence
from datetime import UTC, datetime

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.functions.names import column, columns
from stagewise.functions.timestamps import wall_time
from stagewise.sources.current import CurrentTable
from stagewise.sources.files import arrow_store, read_files, visible

LISTING_SCHEMA = "path string, size bigint, modified timestamp"
MANIFEST_SCHEMA = "path string, size bigint, modified timestamp, kind string, stored string, copied_on timestamp_ntz"
#: Kinds of files: parquet files are told by their first and last bytes, not by their names.
PARQUET, OTHER = "parquet", "other"
#: Bytes that a task holds while it copies; folders and files that one task gets at least.
_BLOCK, _PER_TASK = 8 << 20, 16


def pending(source: DataFrame, target: DataFrame, on: Sequence[str]) -> DataFrame:
    """Source manifest rows the target lacks, or holds with other values of ``on``."""
    same = F.lit(True)
    for name in on:
        same = same & (column(name, "s") == column(name, "t"))
    return source.alias("s").join(target.select(*columns(on)).alias("t"), same, "left_anti")


def file_manifest(spark: SparkSession, root: str, work: str) -> DataFrame:
    """``path`` below ``root``, size and time of every visible file, whatever its name.

    Tasks list one level of folders at a time, whose rows are kept in ``work``, a folder
    that all executors share; the number of levels is that of the deepest file. A missing
    root is empty.
    """
    def level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = arrow_store(root)
        for batch in batches:
            for folder in batch.column("path").to_pylist():
                found = store.get_file_info(pafs.FileSelector(f"{base}/{folder}" if folder else base, allow_not_found=True))
                found = [f for f in found if visible(f.base_name) and f.type in (pafs.FileType.File, pafs.FileType.Directory)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f"{folder}/{f.base_name}" if folder else f.base_name for f in found], pa.string()),
                     pa.array([f.size for f in found], pa.int64()),
                     pa.array([f.mtime and f.mtime.astimezone(UTC) for f in found], pa.timestamp("us", "UTC")),
                     pa.array([f.type == pafs.FileType.Directory for f in found], pa.bool_())], names=["path", "size", "modified", "folder"])

    schema = LISTING_SCHEMA + ", folder boolean"
    folders, levels = spark.createDataFrame([("",)], "path string"), []
    while True:
        levels.append(f"{work}/level-{len(levels)}")
        folders.select("path").mapInArrow(level, schema).write.parquet(levels[-1])
        found = spark.read.schema(schema).parquet(levels[-1])
        n = found.filter("folder").count()
        if not n:
            break
        folders = found.filter("folder").repartition(_tasks(spark, n), "path")
    return spark.read.schema(schema).parquet(*levels).filter("not folder").drop("folder")


def _tasks(spark: SparkSession, n: int) -> int:
    return max(1, min(n // _PER_TASK + 1, 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))))


def _manifest(spark: SparkSession, target: str) -> CurrentTable:
    return CurrentTable(spark, f"{target}/manifest", "path")


def copied_manifest(spark: SparkSession, target: str) -> DataFrame:
    """The newest copy of every file, as recorded at the target."""
    rows = _manifest(spark, target.rstrip("/")).read()
    return spark.createDataFrame([], MANIFEST_SCHEMA) if rows is None else rows


def copy_new_files(spark: SparkSession, source: str, target: str, copied_on: datetime | None = None) -> int:
    """Copy new and changed source files of any type; returns how many.

    Files gone from the source stay at the target. A file that changes while it is copied is
    copied as its bytes were read, and again by the next run. A run that stops leaves the
    target as it was.
    """
    source, target = source.rstrip("/"), target.rstrip("/")
    run, stamp = uuid.uuid4().hex, wall_time(copied_on or datetime.now(UTC))
    work, manifest = f"{target}/runs/{run}", _manifest(spark, target)
    before, known = manifest.last_number(), copied_manifest(spark, target)
    todo = pending(file_manifest(spark, source, f"{work}/listing"), known, ["path", "size", "modified"])
    todo.write.parquet(f"{work}/todo")
    todo = spark.read.schema(LISTING_SCHEMA).parquet(f"{work}/todo")
    n = todo.count()
    if n:
        def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from_store, from_base = arrow_store(source)
            to_store, to_base = arrow_store(f"{target}/data")
            for batch in batches:
                kept = [_copied(from_store, from_base, to_store, to_base, path) for path in batch.column("path").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in ("path", "size", "modified")), *(pa.array(list(x), pa.string()) for x in zip(*kept))],
                    names=["path", "size", "modified", "kind", "stored"]) if kept else batch
        dealt = todo.repartition(_tasks(spark, n), "path")
        dealt.mapInArrow(copy, LISTING_SCHEMA + ", kind string, stored string").write.parquet(f"{work}/copied")
        copied = spark.read.schema(LISTING_SCHEMA + ", kind string, stored string").parquet(f"{work}/copied").withColumn("copied_on", stamp)
        manifest.replace(pending(known, copied, ["path"]).unionByName(copied), {"run": run}, before)
    store, base = arrow_store(work)
    store.delete_dir(base)
    return n


def _copied(from_store: pafs.FileSystem, from_base: str, to_store: pafs.FileSystem, to_base: str, path: str) -> tuple[str, str]:
    """Copy one file in blocks; its kind, and where it is stored below the data folder. The
    folder's name is kept, as it may tell partition values."""
    folder, name = posixpath.split(path)
    stem, ending = posixpath.splitext(name)
    stored = posixpath.join(folder, f"{stem}~{uuid.uuid4().hex}{ending}")
    to_store.create_dir(posixpath.join(to_base, folder) if folder else to_base, recursive=True)
    first, last = b"", b""
    with from_store.open_input_stream(f"{from_base}/{path}") as read, to_store.open_output_stream(f"{to_base}/{stored}") as write:
        while block := read.read(_BLOCK):
            first, last = first or block[:4], (last + block[-4:])[-4:]
            write.write(block)
    return PARQUET if first == last == b"PAR1" else OTHER, stored


def read_copy(spark: SparkSession, target: str) -> DataFrame | None:
    """The rows of the copied parquet files; None before there is one. Files of other types
    are found through ``copied_manifest``."""
    target = target.rstrip("/")
    files = copied_manifest(spark, target).filter(F.col("kind") == PARQUET).select("stored").toArrow().column("stored").to_pylist()
    if not files:
        return None
    return read_files(spark, f"{target}/data", [f"{target}/data/{file}" for file in files])


def remove_replaced(spark: SparkSession, target: str) -> int:
    """Delete stored files that the manifest does not name; returns how many. Only for times
    without a running copy or reader of an older manifest."""
    target = target.rstrip("/")
    work = f"{target}/runs/{uuid.uuid4().hex}"
    stored = file_manifest(spark, f"{target}/data", f"{work}/listing").select(F.col("path").alias("stored"))
    stale = pending(stored, copied_manifest(spark, target), ["stored"])

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = arrow_store(f"{target}/data")
        for batch in batches:
            for path in batch.column("stored").to_pylist():
                if store.get_file_info(f"{base}/{path}").type == pafs.FileType.File:
                    store.delete_file(f"{base}/{path}")
            yield batch
    stale.mapInArrow(remove, "stored string").write.parquet(f"{work}/removed")
    n = spark.read.schema("stored string").parquet(f"{work}/removed").count()
    store, base = arrow_store(work)
    store.delete_dir(base)
    return n
