"""Copying whatever lies at the source, and files whose types differ."""

from datetime import datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import types as T

from stagewise.plans.load import TableLoad, load_table, set_aside
from stagewise.sources import copy as cp
from stagewise.sources.current import CurrentTable
from stagewise.sources.files import Folder
from stagewise.sources.reconcile import widened


def write(path, **columns):
    path.parent.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.table(columns), path)


def stored(spark, target):
    """Contents by path of all files the manifest names."""
    rows = cp.copied_manifest(spark, target).collect()
    return {r.path: open(f"{target}/data/{r.stored}", "rb").read() for r in rows}


def test_any_file_any_name(spark, tmp_path):
    source, target = tmp_path / "s o", str(tmp_path / "t")
    write(source / "a b.parquet", v=pa.array([1, 2]))
    write(source / "p=x y" / "c[1]{2}%20*.parquet", v=pa.array([3]))
    (source / "notes.txt").write_bytes(b"hello\n" * 3_000_000)
    (source / "deep" / "er").mkdir(parents=True)
    (source / "deep" / "er" / "empty").write_bytes(b"")
    for hidden in ("_SUCCESS", ".part.crc"):
        (source / hidden).write_bytes(b"x")
    assert cp.copy_new_files(spark, str(source), target) == 4
    assert stored(spark, target) == {str(p.relative_to(source)): p.read_bytes() for p in source.rglob("*") if p.is_file() and p.name[0] not in "_."}
    read = lambda: sorted((r.v, r.p) for r in cp.read_copy(spark, target).collect())
    assert read() == [(1, None), (2, None), (3, "x y")]
    assert cp.copy_new_files(spark, str(source), target) == 0
    write(source / "a b.parquet", v=pa.array([], pa.int64()))
    assert cp.copy_new_files(spark, str(source), target) == 1 and read() == [(3, "x y")]
    # A file gone from the source stays; what it replaced can be removed.
    (source / "notes.txt").unlink()
    assert cp.copy_new_files(spark, str(source), target) == 0 and len(stored(spark, target)) == 4
    assert cp.remove_replaced(spark, target) == 1 and cp.remove_replaced(spark, target) == 0 and read() == [(3, "x y")]
    assert Folder(spark, f"{target}/runs").children() == []


def test_readers_never_see_half_a_copy(spark, tmp_path, monkeypatch):
    source, target = tmp_path / "s", str(tmp_path / "t")
    for i in range(3):
        write(source / f"{i}.parquet", v=pa.array([i]))
    cp.copy_new_files(spark, str(source), target)
    for i in range(3):
        write(source / f"{i}.parquet", v=pa.array([i + 10, i]))
    monkeypatch.setattr(CurrentTable, "switch_to", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        cp.copy_new_files(spark, str(source), target)
    monkeypatch.undo()
    read = lambda: sorted(r.v for r in cp.read_copy(spark, target).collect())
    assert read() == [0, 1, 2]
    assert cp.copy_new_files(spark, str(source), target) == 3 and read() == [0, 1, 2, 10, 11, 12]


def test_nothing_to_copy(spark, tmp_path):
    assert cp.copy_new_files(spark, str(tmp_path / "none"), str(tmp_path / "t")) == 0
    assert cp.read_copy(spark, str(tmp_path / "t")) is None


I, L, S, D, F_ = T.IntegerType(), T.LongType(), T.ShortType(), T.DoubleType(), T.FloatType()


@pytest.mark.parametrize("a, b, want", [
    (I, L, L), (S, I, I), (F_, D, D), (I, D, D), (S, F_, F_), (I, F_, None), (L, D, None), (I, T.StringType(), None),
    (T.DecimalType(10, 2), T.DecimalType(8, 4), T.DecimalType(12, 4)), (L, T.DecimalType(5, 2), T.DecimalType(21, 2)),
    (T.DecimalType(38, 0), T.DecimalType(38, 10), None), (T.DateType(), T.TimestampNTZType(), None),
])
def test_widened(a, b, want):
    assert widened(a, b) == widened(b, a) == want


def test_files_of_different_types(spark, tmp_path):
    stage = tmp_path / "stage"
    at = pa.array([datetime(2024, 1, 1)], pa.timestamp("us"))
    for i, v in enumerate([pa.array([5], pa.int32()), pa.array([1 << 40]), pa.array([7], pa.int16()), pa.array(["text"]), pa.array([2.5])]):
        write(stage / f"p=a b/{i}.parquet", id=pa.array([i]), d=at, v=v, **({"only": pa.array([i])} if i == 2 else {}))
    write(stage / "p=a b/9.parquet", id=pa.array([9]), d=at, v=pa.array([9]))
    load = TableLoad("1", str(stage), str(tmp_path / "now"), "id", "d", buckets=2)
    outcome = load_table(spark, load)
    assert outcome.error_message is None and outcome.rows_inserted == 4
    table = CurrentTable(spark, load.current_path, "id", 2)
    assert dict(table.read().dtypes)["v"] == "bigint"
    assert sorted((r.id, r.v, r.only, r.p) for r in table.read().collect()) == [(0, 5, None, "a b"), (1, 1 << 40, None, "a b"), (2, 7, 2, "a b"), (9, 9, None, "a b")]
    aside = {r.reason: r.row for r in set_aside(spark, table).collect()}
    assert set(aside) == {"v is string, not bigint", "v is double, not bigint"} and '"v":"text"' in aside["v is string, not bigint"]
    assert Folder(spark, str(stage)).files() == []


def test_staged_files_beside_partition_folders(spark, tmp_path):
    stage, at = tmp_path / "stage", pa.array([datetime(2024, 1, 1)], pa.timestamp("us"))
    write(stage / "root.parquet", id=pa.array([1]), d=at)
    write(stage / "p=x" / "in.parquet", id=pa.array([2], pa.int32()), d=at)
    write(stage / "p=y" / "q=3" / "deep.parquet", id=pa.array([3]), d=at)
    load = TableLoad("1", str(stage), str(tmp_path / "now"), "id", "d")
    assert load_table(spark, load).rows_inserted == 3
    assert sorted((r.id, r.p, r.q) for r in CurrentTable(spark, load.current_path, "id").read().collect()) == [(1, None, None), (2, "x", None), (3, "y", 3)]
