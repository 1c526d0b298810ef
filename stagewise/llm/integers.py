"""Vectors as integers, and exact sums of any size over a table."""

from __future__ import annotations

from collections.abc import Iterable
from math import floor, isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Sums travel in digits of this base; most have one.
_BASE = 1 << 62
SUMS = "slot int, digit int, n long"


def finite_rows(column: pa.Array) -> np.ndarray:
    """Which lists are not null and hold finite numbers only."""
    good = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False) >= 0
    values = column.flatten()
    bad = ~np.isfinite(values.to_numpy(zero_copy_only=False).astype(float)) if len(values) else np.zeros(0, bool)
    # flatten() leaves null lists out.
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(column)), lengths)
    good[owner[bad]] = False
    return good


def scaled(column: pa.Array, dims: int, scale: int) -> np.ndarray:
    """``floor(scale * x)`` of the components of lists of ``dims`` finite numbers each, ``scale``
    a power of two: as int64 where squared distances and products of such vectors fit,
    otherwise as Python's integers."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), dims)
    with np.errstate(over="ignore"):
        whole = np.floor(values * scale)
    if not values.size or np.abs(whole).max() <= limit(dims):
        return whole.astype(np.int64)
    exact = [floor(x * scale) if abs(x) < 2.0**60 else int(x) * scale for x in values.ravel().tolist()]
    out = np.empty(len(exact), object)
    out[:] = exact
    return out.reshape(values.shape)


def limit(dims: int) -> int:
    """Greatest component for which int64 holds every sum that is formed."""
    return isqrt(2**58 // max(1, dims))


def matched(*arrays: np.ndarray) -> list[np.ndarray]:
    """The arrays, all as Python's integers if one of them is."""
    wide = any(a.dtype == object for a in arrays)
    return [a.astype(object) if wide else a for a in arrays]


def as_array(rows: list[list[int]], dims: int) -> np.ndarray:
    """Integer rows, as int64 where ``limit`` allows it."""
    out = np.empty((len(rows), dims), object)
    for i, row in enumerate(rows):
        out[i] = row
    return out.astype(np.int64) if not out.size or max(abs(x) for x in out.ravel()) <= limit(dims) else out


def long_or_null(values: np.ndarray) -> pa.Array:
    return pa.array([int(x) if x < 2**63 else None for x in values] if values.dtype == object else values, pa.int64())


def digit_rows(sums: dict[int, int]) -> Iterable[pa.RecordBatch]:
    """Sums by slot as rows of ``SUMS``; the last digit has the sign."""
    slots, digits, numbers = [], [], []
    for slot, x in sums.items():
        digit = 0
        while x:
            x, low = (0, x) if -_BASE <= x < _BASE else divmod(x, _BASE)
            slots.append(slot)
            digits.append(digit)
            numbers.append(low)
            digit += 1
    if slots:
        yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int32()), pa.array(digits, pa.int32()), pa.array(numbers, pa.int64())], names=["slot", "digit", "n"])


def total_sums(parts: DataFrame) -> dict[int, int]:
    """The sums over all tasks' ``SUMS`` rows; the caller bounds the number of slots."""
    total = parts.groupBy("slot", "digit").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"))
    out: dict[int, int] = {}
    for row in total.collect():
        out[row.slot] = out.get(row.slot, 0) + int(row.n) * _BASE**row.digit
    return out
