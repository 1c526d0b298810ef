"""Parquet files whose columns have different types, read as one table.

The footers are read by tasks; files of equal schema form a group. Each column gets the
narrowest type all groups widen to. A group with a column that does not widen to what most
files have is set aside: its rows are kept as text, with the reason.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagewise.functions.names import column
from stagewise.sources.files import Listed, arrow_store, by_layout, read_files

_WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
#: Decimal digits before the point that whole types need.
_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}
SET_ASIDE_SCHEMA = "file string, row string, reason string"


def widened(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The narrowest type that holds all values of both without loss; None if there is none."""
    if a == b:
        return a
    if a in _WHOLE and b in _WHOLE:
        return max(a, b, key=_WHOLE.index)
    fractions = (T.FloatType(), T.DoubleType())
    if a in fractions and b in fractions:
        return T.DoubleType()
    for x, y in ((a, b), (b, a)):
        if x in _WHOLE[:3] and y == T.DoubleType():
            return y
        if x in _WHOLE[:2] and y == T.FloatType():
            return y
        if isinstance(y, T.DecimalType) and (x in _WHOLE or isinstance(x, T.DecimalType)):
            p, s = (x.precision, x.scale) if isinstance(x, T.DecimalType) else (_DIGITS[x.simpleString()], 0)
            scale = max(s, y.scale)
            digits = max(p - s, y.precision - y.scale) + scale
            return T.DecimalType(digits, scale) if digits <= 38 else None
    return None


def read_together(spark: SparkSession, base: str, files: Sequence[Listed]) -> tuple[DataFrame, DataFrame | None]:
    """The rows of these files, and those that were set aside as ``file, row, reason``."""
    try:
        return read_files(spark, base, [file.path for file in files]), None
    except Exception as error:  # noqa: BLE001 - raised again unless it says that schemas differ
        if "CANNOT_MERGE" not in str(error):
            raise
    groups = _groups(spark, base, [file.path for file in files])
    schemas = [read_files(spark, base, paths[:1]).schema for paths in groups]
    weights = [len(paths) for paths in groups]
    wanted, reasons = {}, [[] for _ in groups]
    for name in dict.fromkeys(f.name for schema in schemas for f in schema.fields):
        has = {i: schema[name].dataType for i, schema in enumerate(schemas) if name in schema.names}
        often = Counter()
        for i, kind in has.items():
            often[kind] += weights[i]
        # Most files first; the widest type that the types before it lead to.
        kind = reduce(lambda a, b: widened(a, b) or a, [k for k, _ in often.most_common()])
        wanted[name] = kind
        for i, own in has.items():
            if widened(own, kind) != kind:
                reasons[i].append(f"{name} is {own.simpleString()}, not {kind.simpleString()}")
    parts, aside = [], []
    for paths, schema, reason in zip(groups, schemas, reasons):
        rows = read_files(spark, base, paths)
        if reason:
            texts = F.to_json(F.struct(*[column(name) for name in schema.names]), {"ignoreNullFields": "false"})
            aside.append(rows.select(F.col("_metadata.file_path").alias("file"), texts.alias("row"), F.lit("; ".join(reason)).alias("reason")))
        else:
            parts.append(rows.select(*[column(name).cast(wanted[name]).alias(name) for name in schema.names]))
    together = lambda dfs: reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
    if not parts:
        raise ValueError("no two staged files agree: " + "; ".join(r for reason in reasons for r in reason))
    return together(parts), together(aside) if aside else None


def _groups(spark: SparkSession, base: str, paths: Sequence[str]) -> list[list[str]]:
    """Paths by layout and by the schema in their footers; the largest group first."""
    def footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for path in batch.column("path").to_pylist():
                store, at = arrow_store(path)
                found.append(str(pq.read_schema(at, filesystem=store).remove_metadata()))
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(found, pa.string())], names=["path", "schema"])
    names = spark.createDataFrame([(path,) for path in paths], "path string")
    parts = max(1, min(len(paths) // 16 + 1, 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    rows = names.repartition(parts, "path").mapInArrow(footers, "path string, schema string").toArrow()
    found: dict[str, list[str]] = {}
    for path, schema in sorted(zip(rows.column("path").to_pylist(), rows.column("schema").to_pylist())):
        found.setdefault(schema, []).append(path)
    return sorted((group for same in found.values() for group in by_layout(base, same)), key=len, reverse=True)
