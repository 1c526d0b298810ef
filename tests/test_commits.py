"""Commits of bucket files, consumed files, one-sided upserts, change feeds and continued loads."""

import random
import re
import threading
import time
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from support import day, ranked

from stagewise.operators.feed import apply_changes
from stagewise.operators.merge import merge_into_current
from stagewise.operators.upsert import one_sided_upsert, upsert
from stagewise.plans import load as ld
from stagewise.plans import log as lg
from stagewise.sources import current as cur
from stagewise.sources.current import CurrentTable, publish_table, publish_view
from stagewise.sources.files import Folder
from stagewise.streaming import arrivals
from stagewise.streaming.arrivals import merge_arrivals

SCHEMA = "k int, at timestamp_ntz, v string"
BUCKETS = 4


def put(spark, path, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def job(base, **options):
    return ld.TableLoad("7", f"{base}/Stage", f"{base}/Active", "k", "at", **{"buckets": BUCKETS, **options})


def table_of(spark, load):
    return CurrentTable(spark, load.current_path, load.keys, load.buckets)


def rows_of(df, names=("k", "at", "v")):
    return Counter(tuple(r[n] for n in names) for r in df.collect())


def load(spark, job_, rows, schema=SCHEMA):
    put(spark, job_.stage_path, rows, schema)
    outcome = ld.load_table(spark, job_)
    assert outcome.error_message is None, outcome.error_message
    return outcome


def above_scan(df):
    """Names of the operators from the scan of a current table up to the nearest join, after the query has run."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan
    lines = plan[plan.index("== Final Plan =="):].splitlines()
    at = lambda line: len(line) - len(line.lstrip(" :+-"))
    i = next(i for i, line in enumerate(lines) if "FileScan" in line and "current_" in line)
    depth, names = at(lines[i]), []
    for line in reversed(lines[:i]):
        if at(line) < depth:
            depth = at(line)
            names.append(re.sub(r"^\*\(\d+\) ", "", line.strip(" :+-")).split(" ")[0])
            if "Join" in names[-1]:
                break
    return names


def test_only_touched_buckets_are_written(spark, tmp_path):
    t = job(str(tmp_path))
    load(spark, t, [(n, day(0), "a") for n in range(200)])
    table = table_of(spark, t)
    first = table.latest()
    assert sorted(first.files) == ["0", "1", "2", "3"]
    outcome = load(spark, t, [(7, day(1), "b")])
    assert (outcome.rows_inserted, outcome.rows_updated, outcome.max_effective_date) == (0, 1, day(1))
    second = table.latest()
    changed = [b for b in first.files if first.files[b] != second.files[b]]
    assert len(changed) == 1
    new = Folder(spark, second.path).files()
    assert len(new) == 2 and {f.path.split("_action=")[1].split("/")[0] for f in new} == {"UPDATE", "KEEP"}
    # Old commits stay readable, also where their files lie beside newer ones.
    assert rows_of(table.read_version(first)) == Counter((n, day(0), "a") for n in range(200))
    assert rows_of(table.read())[(7, day(1), "b")] == 1 and table.read().count() == 200
    # Superseded files are not opened.
    for file in first.files[changed[0]]:
        Folder(spark, str(tmp_path)).remove(f"{t.current_path}/versions/{file}")
    assert table.read().count() == 200


def test_the_current_side_is_neither_shuffled_nor_sorted(spark, tmp_path):
    t = job(str(tmp_path))
    load(spark, t, [(n, day(0), "a") for n in range(200)])
    load(spark, t, [(n, day(1), "b") for n in range(3)])
    table = table_of(spark, t)
    stage = spark.createDataFrame([(5, day(2), "c"), (5, day(1), "d"), (900, day(2), "e")], SCHEMA)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        touched = ld.touched_buckets(table, stage)
        merged = merge_into_current(stage, table.read_version(table.latest(), sorted(touched)), "k", "at", buckets=BUCKETS, null_keys=False, hash_stage=True)
        assert all(not nulls for _, nulls in touched.values()) and sum(n for n, _ in touched.values()) == 3
        paths = [above_scan(merged)]
        source = spark.createDataFrame([(5, "x"), (901, "y")], "k int, v string")
        upserted = one_sided_upsert(table.read_version(table.latest()), source, "k", ["v"], datetime(2024, 1, 1), buckets=BUCKETS)
        paths.append(above_scan(upserted))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(paths) == 2
    for names in paths:
        assert names[-1] == "ShuffledHashJoin" and not {"Exchange", "Sort"} & set(names), names
    assert merged.count() < 200


@pytest.mark.parametrize("kind", ["load", "upsert"])
def test_written_plans_leave_the_target_where_it_lies(spark, tmp_path, monkeypatch, kind):
    """The rows that load_table, upsert_table and run_upsert write: no shuffle or sort of the target."""
    t = job(str(tmp_path))
    load(spark, t, [(n, day(0), "a") for n in range(200)])
    seen, write = [], CurrentTable.write_version
    monkeypatch.setattr(CurrentTable, "write_version", lambda self, df, placed=False: (placed and seen.append(above_scan(df)), write(self, df, placed))[1])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        if kind == "load":
            load(spark, t, [(3, day(1), "b")])
        else:
            sent = spark.createDataFrame([(3, "b"), (1000, "n")], "k int, v string")
            assert ld.upsert_table(spark, ld.TableUpsert("9", sent, t.current_path, "k", ["v"])).rows_updated == 1
            sent.selectExpr("k", "v", "'2024-02-01T10:00:30+00:00' AS changed").createOrReplaceTempView("people_source")
            fields = ["SourceName", *ld.UPSERT_FIELDS, "ProcessUserKey"]
            row = ["people_source", "Active", "people", "v", "k", "SELECT k, concat(v, '!') AS v FROM people_source", "changed", "at", 5]
            marks = ", SourceMaxEffectiveDate timestamp_ntz, DestinationMaxEffectiveDate timestamp_ntz"
            config = CurrentTable(spark, f"{tmp_path}/config", "SourceName")
            config.replace(spark.createDataFrame([(*row, None, None)], ", ".join(f"{f} {'int' if f == 'ProcessUserKey' else 'string'}" for f in fields) + marks))
            seen.clear()
            outcome = ld.run_upsert(spark, config, "people_source", str(tmp_path), {}, f"{tmp_path}/log")
            assert (outcome.error_message, outcome.rows_inserted, outcome.rows_updated, outcome.max_effective_date) == (None, 0, 2, day(0))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(seen) == 1 and seen[0][-1] == "ShuffledHashJoin" and not {"Exchange", "Sort"} & set(seen[0])


def test_loads_against_a_model(spark, tmp_path):
    """Repeated loads with null keys, ties, null dates and a column that comes later."""
    rnd = random.Random(4)
    t, seen, before = job(str(tmp_path)), [], []
    table = table_of(spark, t)
    for step in range(5):
        rows = [(rnd.choice([None, *range(12)]), day(rnd.choice([None, *range(6)])), f"v{rnd.randrange(9)}", step if step > 2 else None)
                for _ in range(rnd.choice([1, 12]))]
        wide = step > 2
        outcome = load(spark, t, [r if wide else r[:3] for r in rows], SCHEMA + (", more int" if wide else ""))
        stage = [dict(zip(("k", "at", "v", "more", "side"), (*r, 1))) for r in rows]
        both = [*({**r, "side": 0} for r in before), *stage]
        order = ["at", "side", "v", "more"]
        top = [r for r, n in ranked(both, ["k"], order) if n == 1]
        had = {r["k"] for r in before}
        assert outcome.rows_inserted == len({r["k"] for r in stage} - had)
        assert outcome.rows_updated == sum(r["side"] == 1 and r["k"] in had for r in top)
        before = top
        dates = [r["at"] for r in top if r["at"] is not None]
        assert outcome.max_effective_date == max(dates, default=None)
        names = ("k", "at", "v", "more") if wide else ("k", "at", "v")
        assert rows_of(table.read(), names) == Counter(tuple(r[n] for n in names) for r in top)
        seen.append((table.latest(), top))
    for commit, top in seen[:3]:
        assert rows_of(table.read_version(commit)) == Counter((r["k"], r["at"], r["v"]) for r in top)
    # The feed from any version on leads to the newest one.
    for commit, _ in seen[:-1]:
        got = apply_changes(table.read_version(commit), table.changes(commit.number), "k")
        assert rows_of(got) == rows_of(table.read())
    assert table.changes(seen[-1][0].number).count() == 0


def test_a_feed_fails_across_a_replaced_table(spark, tmp_path):
    t = job(str(tmp_path))
    load(spark, t, [(1, day(0), "a")])
    table = table_of(spark, t)
    table.replace(spark.createDataFrame([(2, day(0), "b")], SCHEMA))
    load(spark, t, [(3, day(0), "c")])
    with pytest.raises(ValueError, match=r"without change rows: \[2\]"):
        table.changes(1)
    assert rows_of(table.changes(2), ("k", "_action", "_commit")) == {(3, "INSERT", 3): 1}
    # Marks of a commit without them come from the column.
    assert load(spark, t, [(4, None, "d")]).max_effective_date == day(0)


def test_other_buckets_or_types_rewrite_the_table(spark, tmp_path):
    load(spark, job(str(tmp_path)), [(n, day(0), "a") for n in range(20)])
    wider = job(str(tmp_path), buckets=8)
    load(spark, wider, [(1, day(1), "b")])
    assert table_of(spark, wider).latest().buckets == 8 and table_of(spark, wider).read().count() == 20
    load(spark, wider, [(2, day(1), "c")], "k long, at timestamp_ntz, v string")
    got = table_of(spark, wider).read()
    assert dict(got.dtypes)["k"] == "bigint" and rows_of(got)[(2, day(1), "c")] == 1 and got.count() == 20


def test_versions_that_are_still_referred_to_stay(spark, tmp_path):
    t = job(str(tmp_path))
    load(spark, t, [(n, day(0), "a") for n in range(50)])
    for n in range(1, 4):
        load(spark, t, [(n, day(n), "b")])
    table = table_of(spark, t)
    table.remove_old_versions(keep=1)
    entries = spark.catalog.listTables(pattern=f"current_{table._root_hash()}_*")
    assert len(entries) <= 1 and len(table.commits()) == 1 and table.read().count() == 50
    load(spark, t, [(9, day(9), "c")])
    assert table.read().count() == 50 and table.latest().number == 5
    publish_view(spark, table, "view_of_buckets")
    assert rows_of(spark.table("view_of_buckets")) == rows_of(table.read())
    spark.sql("DROP VIEW view_of_buckets")


def test_reserved_names_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="no column names"):
        CurrentTable(spark, str(tmp_path), "k").replace(spark.createDataFrame([(1, "x")], "k int, _version string"))


def test_a_file_that_arrives_during_a_load_is_kept(spark, tmp_path, monkeypatch):
    t, merge = job(str(tmp_path)), ld.merge_stage
    stage = lambda rows: spark.createDataFrame(rows, SCHEMA + ", p string").coalesce(1).write.mode("append").partitionBy("p").parquet(t.stage_path)
    stage([(1, day(0), "a", "x y")])

    def slow(*args, **kwargs):
        done = merge(*args, **kwargs)
        stage([(2, day(0), "b", "x y")])
        return done
    monkeypatch.setattr(ld, "merge_stage", slow)
    assert ld.load_table(spark, t).succeeded
    monkeypatch.undo()
    assert rows_of(table_of(spark, t).read()) == {(1, day(0), "a"): 1}
    assert len(Folder(spark, t.stage_path).files()) == 1
    assert ld.load_table(spark, t).rows_inserted == 1
    assert rows_of(table_of(spark, t).read(), ("k", "v", "p")) == {(1, "a", "x y"): 1, (2, "b", "x y"): 1}
    assert Folder(spark, t.stage_path).files() == []


def test_consumed_files_are_merged_once_and_cleared_alone(spark, tmp_path, monkeypatch):
    t = job(str(tmp_path))
    put(spark, t.stage_path, [(1, day(0), "a")])
    monkeypatch.setattr(Folder, "remove", lambda *a: (_ for _ in ()).throw(OSError("store is down")))
    first = ld.load_table(spark, t)
    assert first.steps == ["merge", "publish"] and "store is down" in first.error_message
    monkeypatch.undo()
    # More arrives, and the same name is written anew before the files are cleared.
    old = Folder(spark, t.stage_path).files()[0]
    put(spark, t.stage_path, [(2, day(0), "b")])
    second = ld.load_table(spark, t)
    assert (second.rows_inserted, second.rows_updated, second.steps) == (1, 0, ["merge", "publish", "clear"])
    assert Folder(spark, t.stage_path).files() == []
    table = table_of(spark, t)
    assert table.latest().number == 2 and table.ledger(table.latest()) > {old}
    assert ld.load_table(spark, t).steps == [] and table.latest().number == 2


def test_a_rewritten_file_is_not_cleared(spark, tmp_path):
    t = job(str(tmp_path))
    put(spark, t.stage_path, [(1, day(0), "a")])
    table, folder = table_of(spark, t), Folder(spark, t.stage_path)
    file = folder.files()[0]
    older = file._replace(length=file.length + 1)
    commit = table.replace(spark.createDataFrame([(1, day(0), "a")], SCHEMA), {"ledger": table.write_ledger([older]), "steps": ["clear"]})
    assert ld.clearable(table, commit, folder) == []
    assert ld.load_table(spark, t).steps == ["merge", "publish", "clear"]


@pytest.mark.parametrize("stream", [False, True])
def test_a_stop_between_commit_and_publish_ends_published(spark, tmp_path, monkeypatch, stream):
    t = job(str(tmp_path), publish_as=f"continued_{stream}".lower())
    put(spark, t.stage_path, [(1, day(0), "a")])
    run = (lambda: merge_arrivals(spark, t, SCHEMA, f"{tmp_path}/progress")) if stream else (lambda: [ld.load_table(spark, t)])
    monkeypatch.setattr(ld, "publish_view", lambda *a: (_ for _ in ()).throw(OSError("no catalog")))
    if stream:
        with pytest.raises(Exception, match="no catalog"):
            run()
    else:
        assert run()[0].steps == ["merge"]
    monkeypatch.undo()
    assert not spark.catalog.tableExists(t.publish_as)
    again = run()
    assert [o.steps for o in again] == [["publish"] if stream else ["publish", "clear"]]
    assert spark.table(t.publish_as).count() == 1 and table_of(spark, t).latest().number == 1
    assert table_of(spark, t).unfinished(table_of(spark, t).latest()) == []
    spark.sql(f"DROP VIEW {t.publish_as}")


def test_one_sided_equals_general_upsert(spark):
    rnd = random.Random(6)
    target = spark.createDataFrame([(rnd.choice([None, *range(8)]), rnd.choice([None, 1]), f"v{rnd.randrange(3)}", None) for _ in range(40)],
                                   "a int, b int, v string, ModifiedOn timestamp_ntz")
    source = spark.createDataFrame([(a, b, f"v{rnd.randrange(3)}") for a in [None, *range(4, 12)] for b in (None, 1)], "a long, b int, v string")
    for keep_nulls in (True, False):
        settings = (["a", "b"], ["v"], datetime(2024, 1, 1), "ModifiedOn", keep_nulls)
        got, want = one_sided_upsert(target, source, *settings, buckets=3), upsert(target, source, *settings)
        assert got.schema.simpleString() == want.schema.simpleString()
        assert Counter(got.collect()) == Counter(want.collect())
    with pytest.raises(Exception, match="more than one source row"):
        one_sided_upsert(target, source.union(source), ["a", "b"], ["v"]).collect()


def test_a_failed_write_leaves_the_published_table(spark):
    publish_table(spark.range(3).toDF("k"), "pub_safe")
    broken = spark.range(2).select(F.when(F.col("id") == 1, F.raise_error(F.lit("bad row")).cast("bigint")).otherwise(F.col("id")).alias("k"))
    with pytest.raises(Exception, match="bad row"):
        publish_table(broken, "pub_safe")
    assert spark.table("pub_safe").count() == 3
    publish_table(spark.range(2).selectExpr("id AS k", "'x' AS more"), "pub_safe")
    assert sorted((r.k, r.more) for r in spark.table("pub_safe").collect()) == [(0, "x"), (1, "x")]
    publish_table(spark.range(5).selectExpr("cast(id AS string) AS other"), "pub_safe")
    assert spark.table("pub_safe").columns == ["other"]
    spark.sql("DROP TABLE pub_safe")


def test_a_run_is_logged_once_and_runs_are_gathered(spark, tmp_path):
    path = f"{tmp_path}/log"
    outcome = lambda key: ld.Outcome(key, "d", day(0), day(1), rows_inserted=2)
    for key in "abab":
        ld.log_outcomes(spark, [outcome(key)], path, f"run-{key}")
    assert rows_of(lg.read_log(spark, path), ("EtlConfigKey",)) == {("a",): 1, ("b",): 1}
    # A run whose writing broke off counts for nothing until it is written again.
    Folder(spark, path).remove(f"{path}/run=run-b/_SUCCESS")
    assert lg.read_log(spark, path).count() == 1
    ld.log_outcomes(spark, [outcome("b")], path, "run-b")
    ld.log_outcomes(spark, [outcome("c")], path)
    assert lg.compact_log(spark, path) == 3
    assert rows_of(lg.read_log(spark, path), ("EtlConfigKey",)) == {("a",): 1, ("b",): 1, ("c",): 1}
    ld.log_outcomes(spark, [outcome("a")], path, "run-a")
    ld.log_outcomes(spark, [outcome("d")], path, "run-d")
    assert lg.read_log(spark, path).count() == 4 and lg.compact_log(spark, path) == 1 and lg.read_log(spark, path).count() == 4
    assert len([c for c in Folder(spark, path).children() if "run=" in c]) == 0


def test_a_slow_load_is_cancelled_beside_a_good_one(spark, tmp_path):
    loads = [job(f"{tmp_path}/{n}") for n in "ab"]
    for t in loads:
        put(spark, t.stage_path, [(1, day(0), "a")])

    def run(session, t):
        if t is loads[0]:
            slow = ld.Outcome("7", t.current_path, ld.now())
            try:
                for _ in range(100):
                    session.range(4).repartition(4).selectExpr("java_method('java.lang.Thread', 'sleep', 3000L)").collect()
                    slow.check_time()
            except Exception as error:  # noqa: BLE001
                slow.failed(error)
            slow.ended_on = ld.now()
            return slow
        return ld.load_table(session, t)
    start = time.time()
    outcomes = ld.run_all(spark, loads, run=run, limit=20)
    assert time.time() - start < 60
    assert [o.succeeded for o in outcomes] == [False, True]
    logged = ld.outcome_rows(spark, outcomes).collect()
    assert logged[0].ErrorMessage == "TimeoutError: the load is over its time limit [cancelled]" and logged[1].ErrorMessage is None
    assert threading.active_count() < 50


def test_a_load_over_its_time_changes_nothing(spark, tmp_path):
    t = job(str(tmp_path))
    put(spark, t.stage_path, [(1, day(0), "a")])
    outcome = ld.run_all(spark, [t], limit=0.01)[0]
    assert outcome.error_kind == "TimeoutError" and table_of(spark, t).latest() is None
    assert len(Folder(spark, t.stage_path).files()) == 1 and ld.load_table(spark, t).succeeded


def test_every_outcome_of_an_upsert_run_is_logged(spark, tmp_path, monkeypatch):
    schema = ", ".join(f"{n} string" for n in ("SourceName", *ld.UPSERT_FIELDS)) + ", ProcessUserKey int, SourceMaxEffectiveDate timestamp_ntz, DestinationMaxEffectiveDate timestamp_ntz"
    spark.createDataFrame([(1, "a", "2024-02-01T10:00:30+00:00")], "k int, v string, changed string").createOrReplaceTempView("log_source")
    row = ("t", "dbo.t", "v", "k", "SELECT k, v FROM log_source", "changed", "at", 5, None, None)
    config = CurrentTable(spark, f"{tmp_path}/config", "SourceName")
    config.replace(spark.createDataFrame([("log_source", *row), ("unknown table", *row)], schema))
    CurrentTable(spark, f"{tmp_path}/t", "k").replace(spark.createDataFrame([(1, day(0), "b")], SCHEMA))
    run = lambda name: ld.run_upsert(spark, config, name, str(tmp_path), {}, f"{tmp_path}/log")
    with pytest.raises(Exception, match="0 config rows"):
        run("nobody")
    with pytest.raises(Exception, match="unknown table"):
        run("unknown table")  # merged, but its watermark can't be read
    assert run("log_source").succeeded
    monkeypatch.setattr(ld, "upsert", lambda *a, **k: (_ for _ in ()).throw(ValueError("refused")))
    assert not run("log_source").succeeded
    texts = {(r.SourceName, r.ErrorMessage and r.ErrorMessage.split(":")[0]) for r in lg.read_log(spark, f"{tmp_path}/log").collect()}
    assert ("log_source", None) in texts and ("log_source", "Failure; ValueError") in texts
    assert {name for name, text in texts if text} == {"nobody", "unknown table", "log_source"}


def test_stream_replay_of_a_finished_batch_does_nothing(spark, tmp_path, monkeypatch):
    t = job(str(tmp_path), publish_as="replayed_view")
    put(spark, t.stage_path, [(1, day(0), "a")])
    finish, stop = arrivals.follow_up, []

    def follow(*args):
        finish(*args)
        if not stop:
            stop.append(1)
            raise OSError("driver lost")
    monkeypatch.setattr(arrivals, "follow_up", follow)
    with pytest.raises(Exception, match="driver lost"):
        merge_arrivals(spark, t, SCHEMA, f"{tmp_path}/p")
    assert merge_arrivals(spark, t, SCHEMA, f"{tmp_path}/p") == []
    assert table_of(spark, t).latest().number == 1
    spark.sql("DROP VIEW replayed_view")


def test_values_stored_with_a_commit(spark):
    for value in (None, 3, 2.5, "x", True, datetime(2024, 1, 2, 3, 4, 5, 6), datetime(2024, 1, 1).date()):
        assert cur.restored(cur.stored(value)) == value
