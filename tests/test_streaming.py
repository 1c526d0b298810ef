from support import as_multiset, day

from stagewise.plans.load import TableLoad
from stagewise.sources.current import CurrentTable
from stagewise.streaming.arrivals import merge_arrivals

SCHEMA = "k int, at timestamp_ntz, v string"


def put(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_arrivals_are_merged_once(spark, tmp_path):
    load = TableLoad("1", f"{tmp_path}/Stage", f"{tmp_path}/Active", "k", "at", buckets=2)
    progress = f"{tmp_path}/progress"
    put(spark, load.stage_path, [(1, day(0), "a"), (2, day(0), "b")])
    first = merge_arrivals(spark, load, SCHEMA, progress)
    assert [(o.rows_inserted, o.rows_updated) for o in first] == [(2, 0)]
    assert merge_arrivals(spark, load, SCHEMA, progress) == []

    put(spark, load.stage_path, [(1, day(1), "c")])
    put(spark, load.stage_path, [(3, day(1), "d"), (2, None, "stale")])
    more = merge_arrivals(spark, load, SCHEMA, progress, files_per_batch=1)
    assert len(more) == 2
    assert (sum(o.rows_inserted for o in more), sum(o.rows_updated for o in more)) == (1, 1)
    table = CurrentTable(spark, load.current_path, "k", 2)
    assert as_multiset(table.read(), ["k", "v"]) == [(1, "c"), (2, "b"), (3, "d")]


def test_a_batch_handed_out_again_changes_nothing(spark, tmp_path):
    load = TableLoad("1", f"{tmp_path}/Stage", f"{tmp_path}/Active", "k", "at")
    put(spark, load.stage_path, [(1, day(0), "a")])
    assert len(merge_arrivals(spark, load, SCHEMA, f"{tmp_path}/p1")) == 1
    put(spark, load.stage_path, [(2, day(0), "b")])
    # A new progress folder hands out the old file once more, with the new one.
    again = merge_arrivals(spark, load, SCHEMA, f"{tmp_path}/p2")
    assert [o.rows_inserted for o in again] == [1]
    assert as_multiset(CurrentTable(spark, load.current_path, "k").read(), ["k", "v"]) == [(1, "a"), (2, "b")]
