"""Brute-force models the Spark results are compared with, and small helpers."""

from collections import defaultdict
from datetime import datetime, timedelta

START = datetime(2024, 1, 1)


def day(n):
    return None if n is None else START + timedelta(days=n)


def descending(values):
    """Sort key for descending order with nulls last."""
    return tuple((v is None, _negated(v)) for v in values)


def _negated(value):
    if value is None:
        return 0
    if isinstance(value, datetime):
        return -(value - START).total_seconds()
    if isinstance(value, str):
        return tuple(-ord(ch) for ch in value) + (1,)
    return -value


def ranked(rows, keys, order):
    """Rows with their rank per key; ``rows`` are dicts."""
    groups = defaultdict(list)
    for row in rows:
        groups[tuple(row[k] for k in keys)].append(row)
    out = []
    for group in groups.values():
        group.sort(key=lambda r: descending([r[c] for c in order]))
        out += [(row, n) for n, row in enumerate(group, 1)]
    return out


def as_multiset(df, names=None):
    names = names or sorted(df.columns)
    return sorted((tuple(row[n] for n in names) for row in df.collect()), key=repr)


def exchanges(df):
    """Number of shuffles in the physical plan before adaptive execution changes it."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning")
