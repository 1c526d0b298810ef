import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from support import as_multiset, day

from stagewise.operators.merge import merge_into_current
from stagewise.plans import load as ld
from stagewise.plans.config import parameter_rows
from stagewise.plans.log import as_json_array, read_log
from stagewise.sources import current as cur
from stagewise.sources.copy import copy_new_files, read_copy
from stagewise.sources.current import CurrentTable, publish_table
from stagewise.sources.files import Folder, has_rows, read_parquet

SCHEMA = "k int, at timestamp_ntz, v string"


@pytest.fixture
def base(tmp_path):
    return str(tmp_path)


def put(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def job(base, **options):
    return ld.TableLoad("7", f"{base}/Stage", f"{base}/Active", "[k]", "at", **options)


def rows_of(spark, load):
    table = CurrentTable(spark, load.current_path, load.keys, load.buckets)
    return as_multiset(table.read(), ["k", "at", "v"])


@pytest.mark.parametrize("buckets", [None, 4])
def test_load_cycle(spark, base, buckets):
    load = job(base, buckets=buckets)
    put(spark, load.stage_path, [(1, day(0), "a"), (1, day(1), "b"), (2, day(0), "c"), (None, day(0), "n")])
    first = ld.load_table(spark, load)
    assert first.error_message is None
    assert first.steps == ["merge", "publish", "clear"]
    assert (first.rows_inserted, first.rows_updated, first.max_effective_date) == (3, 0, day(1))
    assert Folder(spark, load.stage_path).children() == []

    put(spark, load.stage_path, [(1, day(2), "d"), (1, day(3), "e"), (2, day(0), "c2"), (3, day(1), "f"),
                                 (None, day(5), "n2"), (4, None, "g")])
    second = ld.load_table(spark, load)
    assert second.error_message is None
    assert (second.rows_inserted, second.rows_updated, second.rows_updated_rank2) == (2, 3, 2)
    assert rows_of(spark, load) == sorted(
        [(1, day(3), "e"), (2, day(0), "c2"), (3, day(1), "f"), (4, None, "g"), (None, day(5), "n2")], key=repr
    )

    idle = ld.load_table(spark, load)
    assert (idle.rows_inserted, idle.rows_updated, idle.max_effective_date, idle.error_message) == (0, 0, None, None)


def test_bucketed_current_side_is_not_shuffled(spark, base):
    load = job(base, buckets=4)
    put(spark, load.stage_path, [(n, day(0), "a") for n in range(50)])
    ld.load_table(spark, load)
    current = CurrentTable(spark, load.current_path, "k", 4).read()
    stage = spark.createDataFrame([(1, day(1), "b")], SCHEMA)
    plan = merge_into_current(stage, current, "k", "at")._jdf.queryExecution().executedPlan().toString()
    joined = plan[plan.index("SortMergeJoin"):]
    # The first scan below the join's current side is bucketed; what is shuffled
    # before it is the staged side.
    before_scan = joined[: joined.index("FileScan")]
    assert "FullOuter" in before_scan
    assert before_scan.count("Exchange hashpartitioning") == 1
    assert "Bucketed: true" in joined[joined.index("FileScan"):].split("\n")[0]


def test_bucketed_version_is_readable_without_its_catalog_entry(spark, base):
    load = job(base, buckets=4)
    put(spark, load.stage_path, [(1, day(0), "a")])
    ld.load_table(spark, load)
    table = CurrentTable(spark, load.current_path, "k", 4)
    spark.sql(f"DROP TABLE {table._catalog_name(table.latest().path)}")
    assert as_multiset(table.read(), ["k", "v"]) == [(1, "a")]


def test_full_reload_starts_from_stage(spark, base):
    put(spark, f"{base}/Stage", [(1, day(0), "a"), (2, day(0), "b")])
    ld.load_table(spark, job(base))
    put(spark, f"{base}/Stage", [(3, day(0), "c")])
    outcome = ld.load_table(spark, job(base, source_watermark="1900-01-01 00:00:00"))
    assert (outcome.rows_inserted, outcome.rows_updated) == (1, 0)
    assert rows_of(spark, job(base)) == [(3, day(0), "c")]


def test_failure_before_the_switch_keeps_the_old_version(spark, base, monkeypatch):
    put(spark, f"{base}/Stage", [(1, day(0), "a")])
    ld.load_table(spark, job(base))
    put(spark, f"{base}/Stage", [(1, day(1), "b")])
    monkeypatch.setattr(cur.CurrentTable, "switch_to", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
    failed = ld.load_table(spark, job(base))
    assert failed.error_message == "OSError: lost"
    assert failed.steps == []
    monkeypatch.undo()
    assert rows_of(spark, job(base)) == [(1, day(0), "a")]
    assert len(Folder(spark, f"{base}/Stage").children()) > 0
    again = ld.load_table(spark, job(base))
    assert (again.rows_updated, rows_of(spark, job(base))) == (1, [(1, day(1), "b")])


def test_failed_publish_is_repaired_by_a_rerun(spark, base, monkeypatch):
    put(spark, f"{base}/Stage", [(1, day(0), "a")])
    load = job(base, publish_as="published_t")
    monkeypatch.setattr(ld, "publish_view", lambda *a: (_ for _ in ()).throw(OSError("no catalog")))
    assert ld.load_table(spark, load).steps == ["merge"]
    monkeypatch.undo()
    assert ld.load_table(spark, load).succeeded
    assert spark.table("published_t").count() == 1


@pytest.mark.parametrize("publish", ["view", "table"])
def test_publish(spark, base, publish):
    load = job(base, publish_as=f"pub_{publish}", publish=publish)
    for n in range(2):
        put(spark, load.stage_path, [(1, day(n), f"v{n}")])
        assert ld.load_table(spark, load).succeeded
    assert as_multiset(spark.table(load.publish_as), ["k", "v"]) == [(1, "v1")]
    spark.sql(f"DROP {publish} {load.publish_as}")


def test_torn_commit_and_second_writer(spark, base):
    table = CurrentTable(spark, f"{base}/t", "k")
    assert table.read() is None
    rows = spark.createDataFrame([(1, day(0), "a")], SCHEMA)
    table.replace(rows)
    Folder(spark, f"{base}/t/commits").create_file("000000000002.json", '{"number": 2, "pa')
    assert table.latest().number == 1
    assert table.replace(rows).number == 3
    with pytest.raises(Exception, match="exist"):
        Folder(spark, f"{base}/t/commits").create_file("000000000003.json", "{}")


def test_clear_and_old_versions(spark, base):
    table = CurrentTable(spark, f"{base}/t", "k")
    for n in range(3):
        table.replace(spark.createDataFrame([(n, day(0), "a")], SCHEMA))
    assert table.remove_old_versions(keep=1) == 2
    assert as_multiset(table.read(), ["k"]) == [(2,)]
    table.clear()
    assert table.read().count() == 0
    assert not has_rows(table.read())


def test_missing_paths_are_empty(spark, base):
    assert read_parquet(spark, f"{base}/nothing") is None
    assert read_parquet(spark, f"{base}/nothing", SCHEMA).count() == 0
    assert ld.load_table(spark, job(base)).succeeded


def test_several_tables_and_one_failure(spark, base):
    parameters = json.dumps(
        [
            {"EtlConfigKey": str(n), "SourceSchema": "s", "SourceTable": f"t{n}", "SourceEffectiveDateColumn": "at",
             "SourceMaxEffectiveDate": "2024-01-01", "KeyColumns": ["[missing]", "[k]", "[k]", None][n]}
            for n in range(4)
        ]
    )
    config = parameter_rows(spark.createDataFrame([(parameters,)], "p string"), "p")
    loads = ld.loads_from_config(config, base)
    for load in loads:
        put(spark, load.stage_path, [(1, day(0), "a"), (2, day(1), "b")])
    outcomes = ld.run_all(spark, loads)
    assert [o.succeeded for o in outcomes] == [False, True, True, False]
    assert outcomes[3].error_message == "ValueError: NULL in config: KeyColumns"

    ld.log_outcomes(spark, outcomes, f"{base}/log")
    log = read_log(spark, f"{base}/log")
    assert as_multiset(log, ["EtlConfigKey", "RowsInserted"]) == [
        ("0", 0), ("1", 2), ("2", 2), ("3", 0)
    ]
    text = as_json_array(log.select("EtlConfigKey", "RowsInserted", "ErrorMessage"), "EtlConfigKey").first()[0]
    parsed = json.loads(text)
    assert [row["EtlConfigKey"] for row in parsed] == ["0", "1", "2", "3"]
    assert "missing" in parsed[0]["ErrorMessage"] and parsed[1]["ErrorMessage"] is None


def test_upsert_table(spark, base):
    table = CurrentTable(spark, f"{base}/t", "k")
    target = "k int, v string, at timestamp_ntz, ModifiedOn timestamp_ntz"
    table.replace(spark.createDataFrame([(1, "a", day(0), None), (2, "b", day(0), None)], target))
    spark.createDataFrame([(2, "c", day(3)), (3, "d", day(1))], "k int, v string, at timestamp_ntz") \
        .createOrReplaceTempView("incoming")
    config = ld.TableUpsert("9", "SELECT * FROM incoming", f"{base}/t", "k", effective_date="at")
    outcome = ld.upsert_table(spark, config, datetime(2024, 2, 2))
    assert outcome.error_message is None
    assert (outcome.rows_inserted, outcome.rows_updated, outcome.max_effective_date) == (1, 1, day(3))
    assert as_multiset(table.read(), ["k", "v", "ModifiedOn"]) == [
        (1, "a", None), (2, "c", datetime(2024, 2, 2)), (3, "d", None)
    ]
    again = ld.upsert_table(spark, config, datetime(2024, 2, 3))
    assert (again.rows_inserted, again.rows_updated) == (0, 0)


def test_run_upsert(spark, base):
    spark.createDataFrame(
        [(2, "c", "Feb  3 2024 1:05PM"), (3, "d", "2024-02-01T10:00:30+00:00")], "id int, name string, changed string"
    ).createOrReplaceTempView("staged_people")
    query = "SELECT id AS k, name AS v, timestamp_ntz'2024-02-03 13:05:00' AS at FROM staged_people"
    config_schema = (
        "SourceName string, DestinationTable string, DestinationName string, MergeColumns string, KeyColumns string, "
        "SourceQuery string, SourceEffectiveDateColumn string, DestinationEffectiveDateColumn string, "
        "ProcessUserKey int, SourceMaxEffectiveDate timestamp_ntz, DestinationMaxEffectiveDate timestamp_ntz, "
        "ModifiedOn timestamp_ntz"
    )
    rows = [
        (name, "people", "dbo.people", "v,at", "k", text, "changed", "at", 5, day(0), day(0), day(0))
        for name, text in (("staged_people", query), ("staged_nothing", None))
    ]
    config = CurrentTable(spark, f"{base}/config", "SourceName")
    config.replace(spark.createDataFrame(rows, config_schema))
    people = CurrentTable(spark, f"{base}/people", "k")
    target = "k int, v string, at timestamp_ntz, ModifiedOn timestamp_ntz"
    people.replace(spark.createDataFrame([(1, "a", day(0), None), (2, "b", day(0), None)], target))

    batch = datetime(2024, 3, 1)
    outcome = ld.run_upsert(spark, config, "staged_people", base, {"PipelineName": "p"}, f"{base}/log", batch)
    assert (outcome.error_message, outcome.steps) == (None, ["merge", "watermarks"])
    assert as_multiset(people.read(), ["k", "v", "ModifiedOn"]) == [(1, "a", None), (2, "c", batch), (3, "d", None)]
    marks = as_multiset(
        config.read(), ["SourceName", "SourceMaxEffectiveDate", "DestinationMaxEffectiveDate", "ModifiedOn"]
    )
    newest = datetime(2024, 2, 3, 13, 5)
    assert marks == [("staged_nothing", day(0), day(0), day(0)), ("staged_people", newest, newest, batch)]
    logged = read_log(spark, f"{base}/log").first()
    assert (logged.RowsInserted, logged.RowsUpdated, logged.DestinationName) == (1, 1, "dbo.people")
    with pytest.raises(ValueError, match="NULL in config: SourceQuery"):
        ld.run_upsert(spark, config, "staged_nothing", base, {}, f"{base}/log")
    with pytest.raises(Exception, match="0 config rows for unknown"):
        ld.run_upsert(spark, config, "unknown", base, {}, f"{base}/log")


def test_overwriting_a_published_table(spark):
    publish_table(spark.range(3).toDF("k"), "pub_plain")
    publish_table(spark.range(2).toDF("k"), "pub_plain")
    assert spark.table("pub_plain").count() == 2
    spark.sql("DROP TABLE pub_plain")


def test_incremental_copy(spark, base):
    source, target = f"{base}/from", f"{base}/to"
    put(spark, f"{source}/d=1", [(1, day(0), "a"), (2, day(0), "b")])
    assert copy_new_files(spark, source, target) == 1
    assert copy_new_files(spark, source, target) == 0
    put(spark, f"{source}/d=2", [(3, day(0), "c")])
    assert copy_new_files(spark, source, target) == 1
    assert as_multiset(read_copy(spark, target), ["k", "v", "d"]) == [(1, "a", 1), (2, "b", 1), (3, "c", 2)]
    # A file that changed in place replaces its earlier copy, also without a manifest entry.
    changed = spark.createDataFrame([(9, day(0), "changed-and-longer" * 9)], SCHEMA)
    path = Folder(spark, f"{source}/d=2").children()[0]
    changed.coalesce(1).write.parquet(f"{base}/tmp")
    new = Folder(spark, f"{base}/tmp").children()[0]
    import shutil

    shutil.copyfile(new.removeprefix("file:"), path.removeprefix("file:"))
    (Folder(spark, f"{source}/d=2")).remove(f"{source}/d=2/." + path.rsplit("/", 1)[1] + ".crc")
    assert copy_new_files(spark, source, target) == 1
    assert as_multiset(read_copy(spark, target), ["k", "d"]) == [(1, 1), (2, 1), (9, 2)]
    assert read_copy(spark, target).filter(F.col("v").startswith("changed")).count() == 1
