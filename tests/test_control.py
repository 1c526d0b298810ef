import json

import pytest
from pyspark.sql import functions as F
from support import as_multiset, day

from stagewise.functions import text as tx
from stagewise.functions.names import key_list
from stagewise.operators.rows import first_row_text, rows_to_text
from stagewise.plans import config as cf
from stagewise.plans import log as lg
from stagewise.plans.errors import Rule, classify


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).first())


def test_text(spark):
    assert key_list("[a], [b],") == ["a", "b"]
    got = one(
        spark,
        tx.null_tokens_to_null(F.lit(r"\N")), tx.null_tokens_to_null(F.lit("")), tx.null_tokens_to_null(F.lit("N")),
        tx.uuid_or_null(F.lit("ABCDEF00-1111-2222-3333-444455556666")), tx.uuid_or_null(F.lit("ABCDEF00-1111")),
    )
    assert got == (None, None, "N", "abcdef00-1111-2222-3333-444455556666", None)


def test_rows_to_text(spark):
    rows = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x"), ("a", 1, "b"), ("a", 3, None), ("a", None, "z"), (None, 1, "n"), ("e", 1, None)], "k string, i int, t string")
    got = {r.k: r.text for r in rows_to_text(rows, ["k"], F.col("t"), [F.col("i")], "|").collect()}
    assert got == {"a": "b|x|y|z", None: "n"}


def test_parameter_rows_and_maps(spark):
    text = json.dumps([{"EtlConfigKey": "1", "KeyColumns": "[k]"}, {"EtlConfigKey": "2"}])
    rows = cf.parameter_rows(spark.createDataFrame([(text,)], "p string"), "p")
    assert rows.columns == list(cf.PARAMETER_FIELDS)
    runs = cf.run_parameters(rows, "some/path").collect()
    assert [(r.path, r.timeout) for r in runs] == [("some/path", 3600)] * 2
    assert [(r.parameters["etlConfigKey"], r.parameters["keyColumns"]) for r in runs] == [("1", "[k]"), ("2", None)]
    bad = cf.invalid_rows(rows, ["EtlConfigKey", "KeyColumns"]).first()
    assert (bad.EtlConfigKey, bad.missing, bad.message) == ("2", ["KeyColumns"], "NULL in config: KeyColumns")


def test_lookup(spark):
    config = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "SourceName string, v int")
    assert cf.lookup(config, "a").collect() == [("a", 1)]
    for name, message in (("b", "2 config rows for b"), ("c", "0 config rows for c")):
        with pytest.raises(Exception, match=message):
            cf.lookup(config, name).collect()
    asked = spark.createDataFrame([("a",), ("b",), ("c",), ("a",)], "SourceName string")
    assert as_multiset(cf.lookup_many(config, asked), ["SourceName", "n_rows", "usable"]) == [
        ("a", 1, True), ("b", 2, False), ("c", 0, False)
    ]


def test_watermark_updates_leave_silent_sources(spark):
    config = spark.createDataFrame(
        [(1, day(0), day(0), day(0)), (2, day(0), day(0), day(0))],
        "k int, SourceMaxEffectiveDate timestamp_ntz, DestinationMaxEffectiveDate timestamp_ntz, ModifiedOn timestamp_ntz",
    )
    marks = spark.createDataFrame([(2, day(5))], "k int, SourceMaxEffectiveDate timestamp_ntz")
    got = cf.update_watermarks(config, marks, "k", day(9))
    assert as_multiset(got, config.columns) == [(1, day(0), day(0), day(0)), (2, day(5), day(0), day(9))]


def test_log_records(spark):
    outcomes = spark.createDataFrame(
        [("1", "/d", 3, 4, day(0), day(1), None, None)],
        "EtlConfigKey string, DestinationName string, RowsInserted bigint, RowsUpdated bigint, "
        "StartedOn timestamp_ntz, EndedOn timestamp_ntz, ErrorMessage string, MaxEffectiveDate timestamp_ntz",
    )
    records = lg.log_records(outcomes, day(2))
    assert ", ".join(f"{n} {t}" for n, t in records.dtypes) == lg.LOG_SCHEMA
    row = records.first()
    assert (row.CreatedOn, float(row.ProcessSeconds), row.MaxEffectiveDate) == (day(2), 86400.0, None)
    assert json.loads(lg.as_json(records).first().record)["ErrorMessage"] is None

    wide = outcomes.withColumns({"ProcessUserKey": F.lit(5), "SourceName": F.lit("s")})
    logged = lg.upsert_log_records(wide, {"PipelineName": "nightly"}, {"ProcessName": "p"})
    assert len(logged.columns) == 18
    row = logged.first()
    assert (row.PipelineName, row.DataFactoryName, row.ProcessName, row.RowsDeleted) == ("nightly", None, "p", 0)


def test_classify(spark):
    rules = [Rule("io", "a", "; a -> x", True), Rule("io", "b", "; b -> y", True), Rule("db", "a", "a -> x")]
    rows = [("custom", "m"), ("io", "ab"), ("io", "b"), ("io", "z"), ("db", "a"), ("db", "b"), ("other", "a")]
    df = spark.createDataFrame(rows, "kind string, m string")
    got = [r[0] for r in df.select(classify(F.col("kind"), F.col("m"), rules)).collect()]
    assert got == ["Failure; m", "ab; a -> x", "b; b -> y", "z", "a -> x", "b", "Unhandled Excpetion...a"]


def test_first_row(spark):
    df = spark.createDataFrame([(2, None), (1, "x")], "k int, v string")
    assert first_row_text(df, [F.col("k").desc()]).first()[0] == "(k,2), (v,null)"
    assert first_row_text(df.filter("k > 9"), [F.col("k")]).count() == 0
