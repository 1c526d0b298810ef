"""Paths on any Hadoop file system, and readers for which a missing path is empty."""

from __future__ import annotations

import posixpath
import re
from collections.abc import Iterable
from datetime import datetime
from functools import reduce
from typing import NamedTuple

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Listed(NamedTuple):
    """A file as it lay there when it was listed. One written anew under the same name differs."""

    path: str
    length: int
    modified: datetime


FILES_SCHEMA = "path string, length bigint, modified timestamp_ntz"


class Folder:
    """The few path operations a load needs, on the path's own file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._spark = spark
        self._io = spark._jvm.org.apache.commons.io.IOUtils
        self._new_path = spark._jvm.org.apache.hadoop.fs.Path
        self._root = self._new_path(self.path)
        self._fs = self._root.getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self) -> bool:
        return self._fs.exists(self._root)

    def children(self) -> list[str]:
        """Visible files and folders directly below; none when the path is missing."""
        if not self.exists():
            return []
        paths = [status.getPath() for status in self._fs.listStatus(self._root)]
        return sorted(p.toString() for p in paths if visible(p.getName()))

    def files(self) -> list[Listed]:
        """All visible files below, at any depth, by Spark's own parallel listing; contents are not read."""
        if not self.exists():
            return []
        found = self._spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(as_literal(self.path))
        modified = F.timestamp_micros(F.unix_micros("modificationTime")).cast("timestamp_ntz")
        table = found.select("path", F.col("length"), modified.alias("modified")).toArrow()
        return sorted(map(Listed._make, zip(*(table.column(c).to_pylist() for c in ("path", "length", "modified")))))

    def create_file(self, name: str, text: str) -> None:
        """Create a file that must not exist yet."""
        out = self._fs.create(self._new_path(f"{self.path}/{name}"), False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read_file(self, name: str) -> str:
        stream = self._fs.open(self._new_path(f"{self.path}/{name}"))
        try:
            return self._io.toString(stream, "UTF-8")
        finally:
            stream.close()

    def remove(self, path: str) -> None:
        self._fs.delete(self._new_path(path), True)


def visible(name: str) -> bool:
    """Spark's rule: names with a leading dot, or underscore without an equals sign, are hidden."""
    return not (name.startswith(".") or name.startswith("_") and "=" not in name)


def as_literal(path: str) -> str:
    """A path whose pattern characters mean themselves to Spark's readers."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def arrow_path(root: str) -> str:
    """A path without scheme and store."""
    below = root.split("://", 1)[1].partition("/")[2] if "://" in root else root.removeprefix("file:")
    return "/" + below.strip("/")


def arrow_store(root: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI for use in tasks, and the path on it. Names are taken
    as they are, not as encoded."""
    if "://" not in root:
        return pafs.LocalFileSystem(), posixpath.abspath(root.removeprefix("file:"))
    scheme, rest = root.split("://", 1)
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + rest.strip("/")
    host, _, path = rest.partition("/")
    found, base = pafs.FileSystem.from_uri(f"{scheme}://{host}/")
    return found, posixpath.join(base or "/", path).rstrip("/")


def by_layout(base: str, paths: Iterable[str]) -> list[list[str]]:
    """Paths by the partition columns in the names of their folders below ``base``. Spark's
    reader takes files of one such layout at a time and passes over the others."""
    root = arrow_path(base) + "/"
    found: dict[tuple[str, ...], list[str]] = {}
    for path in paths:
        folders = path.split(root, 1)[-1].split("/")[:-1]
        found.setdefault(tuple(f.split("=", 1)[0] for f in folders if "=" in f), []).append(path)
    return list(found.values())


def read_files(spark: SparkSession, base: str, paths: Iterable[str]) -> DataFrame:
    """The rows of these parquet files with their partition values, columns joined by name.
    Fails where a column has different types."""
    parts = []
    for group in by_layout(base, paths):
        reader = spark.read.option("basePath", base).option("mergeSchema", "true")
        parts.append(reader.parquet(*[as_literal(path) for path in group]))
    types: dict[str, T.DataType] = {}
    for field in (field for part in parts for field in part.schema.fields):
        if types.setdefault(field.name, field.dataType) != field.dataType:
            raise ValueError(f"CANNOT_MERGE: {field.name} is {types[field.name].simpleString()} and {field.dataType.simpleString()}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def files_frame(spark: SparkSession, files: Iterable[Listed]) -> DataFrame:
    return spark.createDataFrame([tuple(file) for file in files], FILES_SCHEMA)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame | None:
    """A parquet folder; a missing or empty one gives no rows, or None without a schema."""
    found = Folder(spark, path).children()
    if found:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.parquet(*found)
    return empty_frame(spark, schema) if schema is not None else None


def has_rows(df: DataFrame | None) -> bool:
    return df is not None and not df.isEmpty()


def empty_frame(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame([], schema)
