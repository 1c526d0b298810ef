"""Type enforcement: all-text rows become typed rows, or are set aside as failed.

One projection casts every declared column and lists the bad ones; a row passes
when none is bad. Passing rows carry the declared columns only, in type-group order;
failing rows keep all their raw columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.functions.casts import TYPE_GROUPS, is_bad, strict_cast, type_group
from stagewise.functions.names import column, columns

# Verdict column and its two values.
VERDICT = "Exception"
PASS = "Pass"
FAIL = "Fail"

BAD_COLUMNS = "_bad_columns"


def declared_types(spec: Mapping[str, str] | Sequence[Sequence[str]] | DataFrame) -> dict[str, str]:
    """Column name to type group, in output order.

    Accepts a name-to-type mapping, six name lists (one per type group, in the order
    string, int, bigint, double, float, timestamp), or a two-column schema table.
    """
    if isinstance(spec, DataFrame):
        # One row per column of a table: as small as the table's own schema.
        spec = {name: kind for name, kind in spec.collect()}
    if isinstance(spec, Mapping):
        named = {name: type_group(kind) for name, kind in spec.items()}
        return {name: kind for group in TYPE_GROUPS for name, kind in named.items() if kind == group}
    if len(spec) != len(TYPE_GROUPS):
        raise ValueError(f"expected {len(TYPE_GROUPS)} name lists, got {len(spec)}")
    return {name: group for group, names in zip(TYPE_GROUPS, spec, strict=True) for name in names}


def bad_columns(types: Mapping[str, str]) -> Column:
    """Names of the columns whose text does not spell their type, in declared order."""
    checks = [
        F.when(is_bad(column(name), strict_cast(column(name), group)), F.lit(name))
        for name, group in types.items()
        if group != "string"
    ]
    return F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")


def typed_columns(types: Mapping[str, str]) -> list[Column]:
    """The declared columns cast to their types, without a verdict."""
    return [strict_cast(column(name), group).alias(name) for name, group in types.items()]


def with_verdict(df: DataFrame, spec) -> DataFrame:
    """Every input row with its bad columns and ``Pass`` or ``Fail``."""
    bad = bad_columns(declared_types(spec))
    return df.withColumn(BAD_COLUMNS, bad).withColumn(
        VERDICT, F.when(F.size(BAD_COLUMNS) == 0, PASS).otherwise(FAIL)
    )


def enforce(df: DataFrame, spec, distinct: bool = True) -> tuple[DataFrame, DataFrame]:
    """Typed passing rows and raw failing rows of ``df``, duplicates removed first.

    Each of the two evaluates ``df``; to keep both, :func:`write_enforced` does so once.
    """
    checked, passing, failing = _checked(df, spec, distinct)
    return checked.filter(~F.col("_failed")).select(*passing), checked.filter("_failed").select(*failing)


def write_enforced(df: DataFrame, spec, path: str, distinct: bool = True) -> None:
    """Check all rows in one job and write them to one folder, partitioned by verdict.

    A row fills either its typed or its raw half; the empty half takes no space.
    """
    checked, passing, failing = _checked(df, spec, distinct)
    halves = checked.select(
        F.when(~F.col("_failed"), F.struct(*passing)).alias("passed"),
        F.when(F.col("_failed"), F.struct(*failing)).alias("failed"),
        F.when(F.col("_failed"), FAIL).otherwise(PASS).alias("verdict"),
    )
    halves.write.mode("errorifexists").partitionBy("verdict").parquet(path)


def read_enforced(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Typed passing rows and raw failing rows written by :func:`write_enforced`."""
    rows = spark.read.parquet(path)
    return tuple(
        rows.filter(F.col("verdict") == verdict).select(f"{half}.*") for half, verdict in (("passed", PASS), ("failed", FAIL))
    )


def _checked(df: DataFrame, spec, distinct: bool) -> tuple[DataFrame, list[Column], list[Column]]:
    """Rows with casts and a ``_failed`` flag, and the columns of both outcomes."""
    types = declared_types(spec)
    rows = df.distinct() if distinct else df
    typed = {name: f"_typed_{name}" for name in types}
    casts = {typed[name]: strict_cast(column(name), group) for name, group in types.items()}
    bad = {name: is_bad(column(name), column(typed[name])) for name in types if types[name] != "string"}

    # A filter on the verdict would be pushed below the projection and repeat every cast
    # there. It cannot be pushed below a generator, so the verdict is passed through one.
    any_bad = reduce(lambda a, b: a | b, bad.values(), F.lit(False))
    checked = rows.withColumns(casts).withColumn("_failed", F.explode(F.array(any_bad)))

    passing = [column(typed[name]).alias(name) for name in types]
    names = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in bad.items()]))
    failing = [*columns(df.columns), names.cast("array<string>").alias(BAD_COLUMNS), F.lit(FAIL).alias(VERDICT)]
    return checked, passing, failing


def cast_projection(spec) -> list[str]:
    """SQL cast expressions for a schema table, in its order; unknown types mean string.

    Timestamps stay text, as no SQL cast takes their formats; ``enforce`` parses them.
    """
    if isinstance(spec, DataFrame):
        spec = {name: kind for name, kind in spec.collect()}
    expressions = []
    for name, kind in spec.items():
        quoted = "`" + name.replace("`", "``") + "`"
        group = type_group(kind)
        target = "string" if group == "timestamp" else group
        expressions.append(f"try_cast({quoted} as {target}) as {quoted}")
    return expressions


def typed_projection(spec) -> list[Column]:
    """The columns of a schema table in its order, cast strictly; timestamp texts are parsed
    in any of the known formats. Unknown types mean string."""
    if isinstance(spec, DataFrame):
        spec = {name: kind for name, kind in spec.collect()}
    return [strict_cast(column(name), type_group(kind)).alias(name) for name, kind in spec.items()]
