"""Cases in which rows, types or updates were once lost."""

from datetime import datetime

import pytest

from stagewise.operators.rows import split_to_rows
from stagewise.operators.upsert import upsert
from stagewise.plans.config import parameter_rows, update_watermarks
from stagewise.plans.load import TableLoad, load_table
from stagewise.sources.copy import copy_new_files, read_copy
from stagewise.sources.current import CurrentTable
from stagewise.streaming.arrivals import merge_arrivals


def test_second_writer_from_the_same_version_fails(spark, tmp_path):
    table = CurrentTable(spark, str(tmp_path / "t"), "k")
    table.replace(spark.createDataFrame([(1,)], "k int"))
    before = table.last_number()
    table.replace(spark.createDataFrame([(1,), (3,)], "k int"), after=before)
    with pytest.raises(Exception, match="(?i)exist"):
        table.replace(spark.createDataFrame([(1,), (4,)], "k int"), after=before)
    assert sorted(r.k for r in table.read().collect()) == [1, 3]


def test_nested_names_survive(spark, tmp_path):
    table = CurrentTable(spark, str(tmp_path / "t"), "k")
    rows = spark.sql("SELECT 1 AS k, named_struct('a b', array(named_struct('c`d', 2))) AS s")
    table.replace(rows)
    assert table.read().collect() == rows.collect()


def test_partitioned_and_differing_stage_files(spark, tmp_path):
    stage = str(tmp_path / "stage")
    spark.createDataFrame([(1, datetime(2024, 1, 1), "x")], "id int, d timestamp_ntz, p string").write.partitionBy("p").parquet(stage)
    spark.createDataFrame([(2, datetime(2024, 1, 1), 7, "y")], "id int, d timestamp_ntz, more int, p string").write.mode("append").partitionBy("p").parquet(stage)
    outcome = load_table(spark, TableLoad("1", stage, str(tmp_path / "now"), "id", "d"))
    assert outcome.error_message is None
    got = CurrentTable(spark, str(tmp_path / "now"), "id").read()
    assert sorted((r.id, r.p, r.more) for r in got.collect()) == [(1, "x", None), (2, "y", 7)]


def test_reload_by_bounded_batches_keeps_every_file(spark, tmp_path):
    stage, schema = str(tmp_path / "stage"), "id int, d timestamp_ntz"
    for i in range(3):
        spark.createDataFrame([(i, datetime(2024, 1, 1))], schema).coalesce(1).write.mode("append").parquet(stage)
    load = TableLoad("1", stage, str(tmp_path / "now"), "id", "d", source_watermark="1900-01-01 00:00:00")
    merge_arrivals(spark, load, schema, str(tmp_path / "progress"), files_per_batch=1)
    read = lambda: sorted(r.id for r in CurrentTable(spark, load.current_path, "id").read().collect())
    assert read() == [0, 1, 2]
    spark.createDataFrame([(9, datetime(2024, 1, 1))], schema).write.mode("append").parquet(stage)
    merge_arrivals(spark, load, schema, str(tmp_path / "progress"))
    assert read() == [0, 1, 2, 9]


def test_upsert_keeps_the_target_schema(spark):
    target = spark.createDataFrame([(1, 5, None)], "k int, v int, ModifiedOn timestamp_ntz")
    source = spark.createDataFrame([(1, "6"), (2, "7")], "k long, v string")
    for unique in (False, True):
        got = upsert(target, source, ["k"], ["v"], target_unique=unique)
        assert got.drop("_action").schema.simpleString() == target.schema.simpleString()
        assert sorted((r.k, r.v) for r in got.collect()) == [(1, 6), (2, 7)]
    with pytest.raises(Exception, match="does not fit"):
        upsert(target, spark.createDataFrame([(1 << 40, "x")], "k long, v string"), ["k"], ["v"]).collect()


def test_malformed_parameters_fail(spark):
    df = lambda text: spark.createDataFrame([(text,)], "j string")
    assert parameter_rows(df(None), "j").count() == parameter_rows(df(" "), "j").count() == 0
    with pytest.raises(Exception, match="malformed parameter list"):
        parameter_rows(df('[{"EtlConfigKey": "1"'), "j").collect()


def test_null_watermark_keeps_the_old(spark):
    config = spark.createDataFrame([("a", "old")], "SourceName string, SourceMaxEffectiveDate string")
    marks = spark.createDataFrame([("a", None)], "SourceName string, SourceMaxEffectiveDate string")
    assert update_watermarks(config, marks, "SourceName", datetime(2024, 1, 1)).first().SourceMaxEffectiveDate == "old"


@pytest.mark.parametrize("separator", ["||", "^", ".", "\\", "a", "]"])
def test_separator_is_literal(spark, separator):
    df = spark.createDataFrame([(separator.join(["1", "2", "", "3"]),)], "t string")
    assert [r.part for r in split_to_rows(df, "t", separator).collect()] == ["1", "2", "", "3"]


def test_copy_takes_changed_emptied_and_unnamed_files(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    source, target = tmp_path / "s", str(tmp_path / "t")
    source.mkdir()
    write = lambda name, **columns: pq.write_table(pa.table(columns), source / name)
    write("one.parquet", v=pa.array([1, 2]))
    write("unnamed", v=pa.array([3]), more=pa.array(["m"]))
    read = lambda: sorted((r.v, r.more) for r in read_copy(spark, target).collect())
    assert copy_new_files(spark, str(source), target) == 2 and read() == [(1, None), (2, None), (3, "m")]
    write("one.parquet", v=pa.array([8, 9]))  # as large as before
    assert copy_new_files(spark, str(source), target) == 1 and read() == [(3, "m"), (8, None), (9, None)]
    write("one.parquet", v=pa.array([], pa.int64()))
    assert copy_new_files(spark, str(source), target) == 1 and read() == [(3, "m")]
    assert copy_new_files(spark, str(source), target) == 0
