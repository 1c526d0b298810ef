from datetime import datetime

import pytest
from support import as_multiset, day

from stagewise.operators import upsert as up

TARGET = "k int, g string, v string, w double, ModifiedOn timestamp_ntz, own string"
SOURCE = "k int, g string, v string, w double"
BATCH = datetime(2024, 5, 1, 12)
NAMES = ["k", "g", "v", "w", "ModifiedOn", "own", "_action"]

TARGET_ROWS = [
    (1, "x", "a", 1.0, day(0), "o1"),
    (2, "x", None, 2.0, None, "o2"),
    (3, "x", "c", None, day(0), "o3"),
    (4, "x", "d", 4.0, day(0), "o4"),
    (None, "x", "n", 5.0, day(0), "o5"),
]
SOURCE_ROWS = [
    (1, "x", "a", 1.0),
    (2, "x", None, 2.0),
    (3, "x", None, None),
    (5, "x", "e", 5.0),
    (None, "x", "n", 9.0),
]
WANT = [
    (1, "x", "a", 1.0, day(0), "o1", "UNCHANGED"),
    (2, "x", None, 2.0, None, "o2", "UNCHANGED"),
    (3, "x", None, None, BATCH, "o3", "UPDATE"),
    (4, "x", "d", 4.0, day(0), "o4", "TARGET_ONLY"),
    (5, "x", "e", 5.0, None, None, "INSERT"),
    (None, "x", "n", 5.0, day(0), "o5", "TARGET_ONLY"),
    (None, "x", "n", 9.0, None, None, "INSERT"),
]


@pytest.fixture
def tables(spark):
    return spark.createDataFrame(TARGET_ROWS, TARGET), spark.createDataFrame(SOURCE_ROWS, SOURCE)


@pytest.mark.parametrize("unique", [False, True])
def test_upsert(tables, unique):
    got = up.upsert(*tables, "[k],[g]", batch_time=BATCH, target_unique=unique)
    assert got.columns == NAMES
    assert as_multiset(got, NAMES) == sorted(WANT, key=repr)


def test_null_keys_can_be_set_aside(tables):
    target, source = tables
    got = up.upsert(target, source, ["k", "g"], batch_time=BATCH, insert_null_keys=False)
    assert got.count() == len(WANT) - 1
    assert as_multiset(up.null_key_rows(source, ["k", "g"]), ["v", "w"]) == [("n", 9.0)]


def test_actions(tables):
    merged = up.upsert(*tables, ["k", "g"], batch_time=BATCH)
    assert as_multiset(up.action_counts(merged), ["action", "n_rows"]) == [("INSERT", 2), ("UPDATE", 1)]
    assert tuple(up.action_totals(merged).first()) == (2, 1)


def test_rerun_changes_nothing_for_complete_keys(tables):
    target, source = tables
    source = source.filter("k is not null")
    once = up.upsert(target, source, ["k", "g"], batch_time=BATCH).drop("_action")
    again = up.upsert(once, source, ["k", "g"], batch_time=day(99))
    assert as_multiset(again.drop("_action")) == as_multiset(once)
    assert up.action_counts(again).count() == 0


@pytest.mark.parametrize("unique", [False, True])
def test_duplicate_source_keys_fail(tables, unique):
    target, source = tables
    doubled = source.union(source.filter("k = 1"))
    assert as_multiset(up.duplicate_keys(doubled, ["k", "g"]), ["k", "n_rows"]) == [(1, 2)]
    with pytest.raises(Exception, match="more than one source row, such as"):
        up.upsert(target, doubled, ["k", "g"], batch_time=BATCH, target_unique=unique).collect()


def test_repeated_target_keys_are_all_updated(spark, tables):
    target, source = tables
    repeated = target.union(spark.createDataFrame([(3, "x", "zz", 7.0, None, "o9")], TARGET))
    got = up.upsert(repeated, source, ["k", "g"], batch_time=BATCH).filter("k = 3")
    assert as_multiset(got, ["own", "v", "_action"]) == [("o3", None, "UPDATE"), ("o9", None, "UPDATE")]


def test_parts(tables):
    target, source = tables
    values = ["v", "w"]
    assert as_multiset(up.updates(target, source, ["k", "g"], values), ["k", "v", "w"]) == [(3, None, None)]
    new = up.inserts(target, source, ["k", "g"], values)
    assert new.columns == ["v", "w", "k", "g"]
    assert as_multiset(new, ["k", "v"]) == sorted([(5, "e"), (None, "n")], key=repr)
    seen = up.changes(target, source, ["k", "g"], values)
    assert as_multiset(seen, ["k", "changed"]) == [(1, False), (2, False), (3, True)]


def test_audit_column_in_the_value_list_is_ignored(tables):
    got = up.upsert(*tables, ["k", "g"], values=["v", "w", "ModifiedOn"], batch_time=BATCH)
    assert as_multiset(got, NAMES) == sorted(WANT, key=repr)


def test_unknown_columns_are_refused(tables):
    target, source = tables
    with pytest.raises(ValueError, match="not in the target: extra"):
        up.upsert(target, source.withColumn("extra", source.k), ["k", "g"])
