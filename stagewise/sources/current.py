"""The current rows of a table: written beside the old ones, then switched.

A commit is one small file that names the table's data files; the newest readable commit
is the table. Until that file exists readers see the commit before, so a load that dies
half-way loses nothing, and a file being read is never overwritten.

With ``buckets`` the rows are bucketed by the keys and a commit names the files of each
bucket. A load rewrites only the buckets its staged keys fall into; the others are carried
over by reference, whatever version folder they lie in. Every version folder is partitioned
by what happened to its rows (``_action``, ``_rank2``), so that it is the change feed of its
commit as well, without a second copy.
"""

from __future__ import annotations

import contextlib
import hashlib
import json
import re
import threading
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import asdict, dataclass, field
from datetime import date, datetime
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagewise.functions.names import column, columns, key_list, quoted
from stagewise.sources.files import FILES_SCHEMA, Folder, Listed, as_literal, files_frame

#: Partition columns of the version folders.
TAGS = {"_action": "string", "_rank2": "boolean"}
#: Action of rows that were written without a merge.
REPLACE = "REPLACE"
#: Files of a task that are open at a time: one for each action of its bucket.
_OPEN_FILES = 8
#: The bucket of tables without buckets.
WHOLE = -1
_BUCKET = re.compile(r"_(\d+)(?:\..*)?$")


@dataclass(frozen=True)
class Commit:
    number: int
    path: str
    ddl: str
    keys: list[str]
    buckets: int | None = None
    facts: dict = field(default_factory=dict)
    #: Data files by bucket, below the folder of versions; None in commits of whole folders.
    files: dict[str, list[str]] | None = None
    #: How many files each version folder held when it was written.
    written: dict[str, int] = field(default_factory=dict)


class FileCount(NamedTuple):
    """What a version folder holds: a row for each file."""

    bucket: int
    file: str
    action: str
    rank2: bool
    rows: int
    newest: Any


class CurrentTable:
    def __init__(self, spark: SparkSession, root: str, keys: str | Iterable[str], buckets: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.keys = key_list(keys)
        self.buckets = buckets
        self._commits = Folder(spark, f"{self.root}/commits")
        self._versions = Folder(spark, f"{self.root}/versions")
        self._steps = Folder(spark, f"{self.root}/steps")

    def commits(self) -> list[Commit]:
        """Complete commits, oldest first. A commit cut off while written is skipped."""
        return [commit for path in self._commits.children() if (commit := self._commit_at(path)) is not None]

    def latest(self) -> Commit | None:
        return next((commit for path in reversed(self._commits.children()) if (commit := self._commit_at(path)) is not None), None)

    def _commit_at(self, path: str) -> Commit | None:
        try:
            return Commit(**json.loads(self._commits.read_file(path.rsplit("/", 1)[1])))
        except ValueError:
            return None

    def read(self) -> DataFrame | None:
        """The current rows, or None before the first commit."""
        commit = self.latest()
        return None if commit is None else self.read_version(commit)

    def read_version(self, commit: Commit, buckets: Iterable[int] | None = None) -> DataFrame:
        """The rows of a commit, or of some of its buckets.

        A bucketed scan: joins on the keys need no shuffle of it. Files are picked by name
        while the scan is planned, so other buckets and superseded files are not opened.
        """
        names = [f.name for f in T.StructType.fromDDL(commit.ddl).fields]
        if commit.files is None:
            return self.spark.read.schema(commit.ddl).parquet(as_literal(commit.path)).select(*columns(names))
        if commit.buckets is None:
            return self._tagged(commit.path, commit.ddl).select(*columns(names))
        wanted = None if buckets is None else {str(b) for b in buckets}
        live = [file for bucket, files in commit.files.items() if wanted is None or bucket in wanted for file in files]
        table = self.spark.table(self._bucketed_table(commit, live))
        if not live:
            table = table.filter(F.lit(False))
        elif len(live) < sum(commit.written[version] for version in {file.split("/")[0] for file in live}):
            table = table.filter(F.col("_metadata.file_name").isin([file.rsplit("/", 1)[1] for file in live]))
        return table.select(*columns(names))

    def _bucketed_table(self, commit: Commit, live: Iterable[str]) -> str:
        """A catalog table over exactly the partitions of the version folders that hold these files."""
        name, partitions = self._bucketed_name(commit, live)
        if not self.spark.catalog.tableExists(name):
            clustering = ",".join(quoted(key) for key in commit.keys)
            tags = ", ".join(f"{tag} {kind}" for tag, kind in TAGS.items())
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({commit.ddl}, _version string, {tags}) USING parquet "
                f"PARTITIONED BY (_version, {', '.join(TAGS)}) CLUSTERED BY ({clustering}) INTO {commit.buckets} BUCKETS "
                f"LOCATION '{_text(self._versions.path)}'"
            )
        if partitions:
            # Repeated for an entry that another session left half-made.
            specs = [",".join(f"{name}='{value}'" for name, value in (part.split("=") for part in p.split("/"))) for p in partitions]
            self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(f"PARTITION ({spec})" for spec in specs))
        return name

    def _bucketed_name(self, commit: Commit, live: Iterable[str]) -> tuple[str, list[str]]:
        partitions = sorted({file.rsplit("/", 1)[0] for file in live})
        about = json.dumps([commit.ddl, commit.keys, commit.buckets, partitions])
        return f"current_{self._root_hash()}_{hashlib.md5(about.encode()).hexdigest()[:16]}", partitions

    def _tagged(self, path: str, ddl: str) -> DataFrame:
        """One version folder with its tags."""
        tags = ", ".join(f"{tag} {kind}" for tag, kind in TAGS.items())
        return self.spark.read.schema(f"{ddl}, {tags}").option("basePath", path).parquet(as_literal(path))

    def bucket_of(self) -> Column:
        """The bucket a row falls into, by its keys; the keys must have the table's types."""
        return F.pmod(F.hash(*columns(self.keys)), F.lit(self.buckets))

    def can_extend(self, commit: Commit, ddl: str) -> bool:
        """Whether rows with these columns may stand beside the buckets of ``commit``: same
        buckets, same types; new columns are null in buckets that are not rewritten."""
        if self.buckets is None or commit.files is None or (commit.buckets, commit.keys) != (self.buckets, self.keys):
            return False
        new = {f.name: f.dataType for f in T.StructType.fromDDL(ddl).fields}
        return all(new.get(f.name, f.dataType) == f.dataType for f in T.StructType.fromDDL(commit.ddl).fields)

    def write_version(self, df: DataFrame, placed: bool = False) -> str:
        """Write a version folder and return its path; nothing is switched.

        ``placed`` says that rows of one key bucket already share a task, as after a
        merge with a bucketed current side. Rows are written as they come, without a sort.
        """
        given = [name for name in TAGS if name in df.columns]
        if any(name in ("_version", *TAGS) for name in df.drop(*given).columns):
            raise ValueError("_version, _action and _rank2 are no column names of a table")
        tags = {"_action": F.lit(REPLACE), "_rank2": F.lit(False)}
        df = df.withColumns({name: tags[name] for name in tags if name not in given})
        path = f"{self.root}/versions/_version={uuid.uuid4().hex}"
        if self.buckets is not None and not placed:
            df = df.repartition(self.buckets, *columns(self.keys))
        writer = df.write.mode("errorifexists").partitionBy(*TAGS)
        with _unsorted_writes(self.spark):
            if self.buckets is None:
                writer.parquet(path)
            else:
                writer.format("parquet").bucketBy(self.buckets, *self.keys).option("path", path).saveAsTable(self._catalog_name(path))
        return path

    def counted(self, path: str, ddl: str, newest: str | None = None) -> list[FileCount]:
        """Rows and the newest ``newest`` of each file of a version folder that has rows.

        Counted from what was written, so a task that ran twice is not counted twice. Reads
        that one column; there are as many rows as buckets times actions.
        """
        value = column(newest) if newest else F.lit(None).cast("string")
        found = self._tagged(path, ddl).groupBy(F.col("_metadata.file_name").alias("file"), *TAGS).agg(
            F.count("*").alias("rows"), F.max(value).alias("newest"))
        out = []
        for row in found.collect():
            bucket = WHOLE if self.buckets is None else int(_BUCKET.search(row.file).group(1))
            name = f"{path.rsplit('/', 1)[1]}/_action={row._action}/_rank2={str(row._rank2).lower()}/{row.file}"
            out.append(FileCount(bucket, name, row._action, row._rank2, row.rows, row.newest))
        return sorted(out, key=lambda f: f.file)

    def last_number(self) -> int:
        """Number of the newest commit file, readable or not; 0 without one."""
        names = [name.rsplit("/", 1)[1] for name in self._commits.children()]
        return max((int(name.split(".")[0]) for name in names), default=0)

    def switch_to(
        self, path: str, ddl: str, facts: dict | None = None, after: int | None = None,
        held: list[FileCount] | None = None, keep: Commit | None = None, rewritten: Iterable[int] = (),
    ) -> Commit:
        """Make a written version the current one.

        ``after`` is ``last_number()`` from before the rows were read: the switch fails
        if another writer has committed since. The store must create files atomically,
        as HDFS and local folders do. ``held`` are the folder's files as ``counted`` gives
        them; with ``keep`` the buckets of that commit that were not ``rewritten`` stay.
        """
        number = (self.last_number() if after is None else after) + 1
        held = self.counted(path, ddl) if held is None else held
        files, written = {}, {path.rsplit("/", 1)[1]: len(held)}
        if keep is not None:
            gone = {str(bucket) for bucket in rewritten}
            files = {bucket: names for bucket, names in keep.files.items() if bucket not in gone}
            versions = {name.split("/")[0] for names in files.values() for name in names}
            written |= {version: n for version, n in keep.written.items() if version in versions}
        for file in held:
            files.setdefault(str(file.bucket), []).append(file.file)
        commit = Commit(number, path, ddl, self.keys, self.buckets, facts or {}, files, written)
        self._commits.create_file(f"{number:012d}.json", json.dumps(asdict(commit), default=str))
        return commit

    def replace(self, df: DataFrame, facts: dict | None = None, after: int | None = None) -> Commit:
        path = self.write_version(df)
        return self.switch_to(path, ddl_of(df), facts, after)

    def clear(self) -> Commit | None:
        """Switch to an empty version of the same schema."""
        rows = self.read()
        return None if rows is None else self.replace(rows.limit(0))

    def changes(self, after: int, until: int | None = None) -> DataFrame:
        """The rows that commits ``after + 1`` to ``until`` inserted or updated, with their
        ``_action`` and ``_commit``. Only the folders of these actions are read.

        Fails where a commit between them replaced the table without telling what changed.
        """
        between = {c.number: c for c in self.commits() if c.number > after and (until is None or c.number <= until)}
        newest = max(between, default=after) if until is None else until
        missing = [n for n in range(after + 1, newest + 1) if n not in between or not between[n].facts.get("feed")]
        if missing:
            raise ValueError(f"commits without change rows: {missing}")
        latest = between[newest] if between else self.latest()
        if latest is None:
            raise ValueError("no commit")
        names = [f.name for f in T.StructType.fromDDL(latest.ddl).fields]
        feed = self.spark.createDataFrame([], f"{latest.ddl}, _action string, _commit bigint")
        for commit in between.values():
            rows = self._tagged(commit.path, latest.ddl).filter(F.col("_action").isin("INSERT", "UPDATE"))
            feed = feed.unionByName(rows.select(*columns(names), "_action", F.lit(commit.number).cast("bigint").alias("_commit")))
        return feed

    def write_ledger(self, files: Iterable[Listed]) -> str:
        """Write the names of consumed files; a commit that names the result makes them count."""
        name = f"ledger/{uuid.uuid4().hex}"
        files_frame(self.spark, files).coalesce(1).write.parquet(f"{self.root}/{name}")
        return name

    def ledger(self, commit: Commit | None) -> set[Listed]:
        """Files that the commit, or one before it, has consumed, as far as they lay there at the time."""
        name = None if commit is None else commit.facts.get("ledger")
        if name is None:
            return set()
        rows = self.spark.read.schema(FILES_SCHEMA).parquet(f"{self.root}/{name}").toArrow()
        return set(map(Listed._make, zip(*(rows.column(c).to_pylist() for c in ("path", "length", "modified")))))

    def unfinished(self, commit: Commit | None) -> list[str]:
        """Steps a commit asks for that have not been noted as done."""
        if commit is None:
            return []
        done = {path.rsplit("/", 1)[1] for path in self._steps.children()}
        return [step for step in commit.facts.get("steps", []) if f"{commit.number:012d}.{step}" not in done]

    def finish(self, commit: Commit, step: str) -> None:
        if step in self.unfinished(commit):
            self._steps.create_file(f"{commit.number:012d}.{step}", "")

    def remove_old_versions(self, keep: int = 2) -> int:
        """Delete version folders no kept commit has files in, and the commits before the
        kept ones; returns how many folders.

        Only for times without a running load: a version not yet switched to is not
        named by any commit.
        """
        commits = self.commits()
        kept = commits[-keep:]
        folders = {c.path.rsplit("/", 1)[1] for c in kept if c.buckets is None or c.files is None}
        folders |= {file.split("/")[0] for c in kept for files in (c.files or {}).values() for file in files}
        # A commit's own folder is its change feed even where none of its rows are left.
        folders |= {c.path.rsplit("/", 1)[1] for c in kept}
        stale = [path for path in self._versions.children() if path.rsplit("/", 1)[1] not in folders]
        first = kept[0].number if kept else 0
        ledgers = {c.facts.get("ledger") for c in kept}
        for commit in commits[:-keep]:
            if commit.facts.get("ledger") and commit.facts["ledger"] not in ledgers:
                self._versions.remove(f"{self.root}/{commit.facts['ledger']}")
        for folder in (self._commits, self._steps):
            for path in folder.children():
                if int(path.rsplit("/", 1)[1].split(".")[0]) < first:
                    folder.remove(path)
        for path in stale:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._catalog_name(path)}")
            self._versions.remove(path)
        # Catalog entries are made anew where a reader needs them; those of whole kept commits may be in views.
        whole = {self._bucketed_name(c, [f for files in c.files.values() for f in files])[0] for c in kept if c.files is not None}
        for table in self.spark.catalog.listTables(pattern=f"current_{self._root_hash()}_*"):
            if table.name not in whole:
                self.spark.sql(f"DROP TABLE IF EXISTS {table.name}")
        return len(stale)

    def _root_hash(self) -> str:
        return hashlib.md5(self.root.encode()).hexdigest()[:12]

    def _catalog_name(self, path: str) -> str:
        return f"version_{self._root_hash()}_{path.rsplit('/', 1)[1].removeprefix('_version=')}"


_writes: dict[int, tuple[int, str | None]] = {}
_writes_lock = threading.Lock()


@contextlib.contextmanager
def _unsorted_writes(spark: SparkSession) -> Iterator[None]:
    """Let tasks keep the few files of their bucket open instead of sorting rows by file.

    The setting is the session's; loads that run side by side share it, and the last one
    puts the old value back.
    """
    key, own = "spark.sql.maxConcurrentOutputFileWriters", id(spark._jsparkSession)
    with _writes_lock:
        running, before = _writes.get(own, (0, spark.conf.get(key, None)))
        _writes[own] = running + 1, before
        spark.conf.set(key, str(max(_OPEN_FILES, int(before or 0))))
    try:
        yield
    finally:
        with _writes_lock:
            running, before = _writes[own]
            if running > 1:
                _writes[own] = running - 1, before
            else:
                del _writes[own]
                spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _text(value: str) -> str:
    return value.replace("\\", "\\\\").replace("'", "\\'")


#: Kinds of values that are stored with a commit and read back as what they were.
_KINDS = {"datetime": datetime.fromisoformat, "date": date.fromisoformat}


def stored(value: Any) -> Any:
    """A value as JSON that ``restored`` turns back."""
    kind = type(value).__name__
    if kind in _KINDS:
        return {kind: value.isoformat()}
    return value if value is None or isinstance(value, (str, int, float, bool)) else {"text": str(value)}


def restored(value: Any) -> Any:
    if isinstance(value, dict):
        (kind, text), = value.items()
        return _KINDS.get(kind, str)(text)
    return value


def ddl_of(df: DataFrame) -> str:
    return ", ".join(f"{quoted(f.name)} {_type_ddl(f.dataType)}" for f in df.schema.fields if f.name not in TAGS)


def _type_ddl(kind: T.DataType) -> str:
    """A type's text with nested field names quoted."""
    if isinstance(kind, T.StructType):
        return "struct<" + ", ".join(f"{quoted(f.name)}: {_type_ddl(f.dataType)}" for f in kind.fields) + ">"
    if isinstance(kind, T.ArrayType):
        return f"array<{_type_ddl(kind.elementType)}>"
    if isinstance(kind, T.MapType):
        return f"map<{_type_ddl(kind.keyType)}, {_type_ddl(kind.valueType)}>"
    return kind.simpleString()


def publish_table(df: DataFrame, name: str) -> None:
    """Give a catalog table these rows: written beside the old ones, then switched.

    The switch is one catalog step that points the table at its new folder, so a write
    that fails leaves readers the old rows. Folders of earlier rows stay for queries that
    still read them; the one before the last is removed. A table whose columns changed
    otherwise than by new ones at the end has to be created anew.
    """
    spark = df.sparkSession
    base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/published_{hashlib.md5(name.encode()).hexdigest()[:12]}"
    path = f"{base}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    create = f"TABLE {name} ({ddl_of(df)}) USING parquet LOCATION '{_text(path)}'"
    if spark.catalog.tableExists(name):
        old, new = spark.table(name).schema.fields, df.schema.fields
        location = next((r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect() if r.col_name == "Location"), "")
        same = [(f.name, f.dataType) for f in old] == [(f.name, f.dataType) for f in new[:len(old)]]
        if same and f"/{base.rsplit('/', 1)[1]}/" in location:
            if new[len(old):]:
                added = ", ".join(f"{quoted(f.name)} {_type_ddl(f.dataType)}" for f in new[len(old):])
                spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({added})")
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{_text(path)}'")
        else:
            spark.sql(f"DROP TABLE {name}")
            spark.sql(f"CREATE {create}")
    else:
        location = ""
        spark.sql(f"CREATE {create}")
    spark.catalog.refreshTable(name)
    folder = Folder(spark, base)
    for child in folder.children():
        if child.rsplit("/", 1)[1] not in (path.rsplit("/", 1)[1], location.rsplit("/", 1)[-1]):
            folder.remove(child)


def publish_view(spark: SparkSession, table: CurrentTable, name: str) -> None:
    """Point a catalog view at the current version: one atomic switch, no second copy."""
    commit = table.latest()
    if commit is None:
        return
    names = ", ".join(quoted(f.name) for f in T.StructType.fromDDL(commit.ddl).fields)
    if commit.files is None or commit.buckets is None:
        source, picked = f"parquet.`{commit.path}`", "true"
    else:
        live = [file for files in commit.files.values() for file in files]
        source = table._bucketed_table(commit, live)
        picked = "_metadata.file_name IN (" + ", ".join(f"'{file.rsplit('/', 1)[1]}'" for file in live) + ")" if live else "false"
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {names} FROM {source} WHERE {picked}")
