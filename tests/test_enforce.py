from datetime import datetime

import pytest
from pyspark.sql import functions as F
from support import as_multiset, exchanges

from stagewise.functions.casts import is_bad, strict_cast
from stagewise.functions.timestamps import (
    DECLARED_FORMATS,
    elapsed_seconds,
    format_timestamp,
    or_sentinel,
    parse_timestamp,
    strip_offset,
    watermark_text,
)
from stagewise.operators import enforce as en
from stagewise.operators.rows import rejoin_on_hash, row_hash, row_identity, split_to_rows

TEXTS = {
    "2020-03-08": datetime(2020, 3, 8),
    "20200308": datetime(2020, 3, 8),
    "2020/03/08": datetime(2020, 3, 8),
    "2020-03-08T02:30:00Z": datetime(2020, 3, 8, 2, 30),
    "2020-03-08T02:30:00.123+05:30": datetime(2020, 3, 7, 21, 0, 0, 123000),
    "2020-03-08T02:30:00.123Z": datetime(2020, 3, 8, 2, 30, 0, 123000),
    "2020-03-08T02:30:00.123-0800": datetime(2020, 3, 8, 10, 30, 0, 123000),
    "010704120856-0700": datetime(2001, 7, 4, 19, 8, 56),
    "200102102030+0000": datetime(2020, 1, 2, 10, 20, 30),
    "Wed, 4 Jul 2001 12:08:56 -0700": datetime(2001, 7, 4, 19, 8, 56),
    "02001.July.04 AD 12:08 PM": datetime(2001, 7, 4, 12, 8),
    "02001.Jul.04 AD 12:08 AM": datetime(2001, 7, 4, 0, 8),
    "2001.07.04 AD at 12:08:56 PDT": datetime(2001, 7, 4, 19, 8, 56),
    "2001/07/04T12:08:56Z": datetime(2001, 7, 4, 12, 8, 56),
    "2001/07/04T12:08:56.001+01:00": datetime(2001, 7, 4, 11, 8, 56, 1000),
    "2001/07/04T12:08:56.001+0100": datetime(2001, 7, 4, 11, 8, 56, 1000),
}
NOT_DATES = ["2020-13-45", "2020-02-30", "12/25/2020", "1577836800", "2020-03-08 ", "2020-03-08T25:00:00Z",
             "2001.07.04 AD at 12:08:56 XYZ", "Xxx, 4 Jul 2001 12:08:56 -0700", "", "x", None, "201302102030+0000"]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_every_format_in_any_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(t,) for t in [*TEXTS, *NOT_DATES]], "t string")
        rows = df.select("t", parse_timestamp(F.col("t")).alias("p")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    got = {row.t: row.p for row in rows}
    assert len(DECLARED_FORMATS) == 13
    for text, want in TEXTS.items():
        assert got[text] == want, text
    for text in NOT_DATES:
        assert got[text] is None, text


def test_two_digit_years(spark):
    df = spark.createDataFrame([("950704120856+0000",), ("010704120856+0000",), ("2095-01-01",)], "t string")
    years = df.select(F.year(parse_timestamp(F.col("t"), pivot_year=2050))).collect()
    assert [row[0] for row in years] == [1995, 2001, 2095]


def test_other_timestamp_functions(spark):
    df = spark.createDataFrame([("Jan  1 2020 12:05AM",), ("Dec 31 2019 1:07PM",), ("2020-03-08T02:30:59.123+00:00",)], "t string")
    marks = [r[0] for r in df.select(watermark_text(F.col("t"))).collect()]
    assert marks == [datetime(2020, 1, 1, 0, 5), datetime(2019, 12, 31, 13, 7), datetime(2020, 3, 8, 2, 30)]
    row = spark.range(1).select(
        strip_offset(F.lit("2020-03-08T02:30:59.5+05:30")).alias("a"),
        strip_offset(F.lit("nothing here")).alias("b"),
        format_timestamp(F.expr("timestamp_ntz'2020-03-08 02:30:59.5'")).alias("c"),
        or_sentinel(F.lit(None).cast("timestamp_ntz")).alias("d"),
        elapsed_seconds(F.expr("timestamp_ntz'2020-01-01 00:00:00'"), F.expr("timestamp_ntz'2020-01-01 00:00:01.239'")).alias("e"),
    ).first()
    assert (row.a, row.b, row.c) == (datetime(2020, 3, 8, 2, 30, 59, 500000), None, "2020-03-08T02:30:59Z")
    assert (row.d, str(row.e)) == (datetime(1900, 1, 1), "1.23")


CASTS = [
    ("int", "5", 5), ("int", "-2147483648", -2147483648), ("int", "2147483648", None), ("int", "1.5", None),
    ("int", " 5 ", None), ("int", "1e3", None), ("int", "+7", 7),
    ("bigint", "9223372036854775807", 9223372036854775807), ("bigint", "9223372036854775808", None),
    ("double", "1.5", 1.5), ("double", ".5", 0.5), ("double", "1e3", 1000.0), ("double", "1d", None),
    ("double", "NaN", None), ("double", "0x1p3", None), ("float", "2.5", 2.5), ("float", "x", None),
    ("string", "anything", "anything"),
]


def test_strict_casts(spark):
    for group in ("int", "bigint", "double", "float", "string"):
        cases = [(t, v) for g, t, v in CASTS if g == group]
        df = spark.createDataFrame([(t,) for t, _ in cases], "t string")
        rows = df.select("t", strict_cast(F.col("t"), group).alias("v"), is_bad(F.col("t"), strict_cast(F.col("t"), group)).alias("bad")).collect()
        assert [(r.t, r.v) for r in rows] == cases
        assert [r.bad for r in rows] == [v is None for _, v in cases]


RAW = "s string, i string, l string, d string, f string, t string, t2 string, extra string"
SPEC = (["s"], ["i"], ["l"], ["d"], ["f"], ["t", "t2"])
ROWS = [
    ("a", "1", "3000000000", "1.5", "2.5", "2020-01-01", None, "e"),
    ("a", "1", "3000000000", "1.5", "2.5", "2020-01-01", None, "e"),
    ("b", None, "", None, "", "", None, None),
    ("c", "x", "y", "1.5", "z", "bad", "2020-01-01", "e"),
    ("d", "1", "2", "3", "4", "nope", "2020-01-01", "e"),
]


def test_enforce_splits_rows(spark):
    raw = spark.createDataFrame(ROWS, RAW)
    passed, failed = en.enforce(raw, SPEC)
    assert [name for name, _ in passed.dtypes] == ["s", "i", "l", "d", "f", "t", "t2"]
    assert dict(passed.dtypes)["t"] == "timestamp_ntz"
    assert as_multiset(passed, ["s", "i", "l", "d", "f", "t"]) == sorted(
        [("a", 1, 3000000000, 1.5, 2.5, datetime(2020, 1, 1)), ("b", None, None, None, None, None)], key=repr
    )
    # A bad timestamp before a good one still fails the row; each row fails once.
    assert failed.columns == [*raw.columns, "_bad_columns", "Exception"]
    assert {r.s: r._bad_columns for r in failed.collect()} == {"c": ["i", "l", "f", "t"], "d": ["t"]}
    assert passed.count() + failed.count() == raw.distinct().count()


def test_enforce_plan_has_one_shuffle_and_no_python(spark):
    passed, failed = en.enforce(spark.createDataFrame(ROWS, RAW), SPEC)
    for df in (passed, failed):
        assert exchanges(df) == 1
        assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
        # Casts are evaluated in one place only.
        assert df._jdf.queryExecution().executedPlan().toString().count("try_to_timestamp(") <= 2 * 2 * 15


def test_both_outcomes_from_one_write(spark, tmp_path):
    raw = spark.createDataFrame(ROWS, RAW)
    want_passed, want_failed = en.enforce(raw, SPEC)
    en.write_enforced(raw, SPEC, f"{tmp_path}/checked")
    passed, failed = en.read_enforced(spark, f"{tmp_path}/checked")
    assert (passed.dtypes, failed.dtypes) == (want_passed.dtypes, want_failed.dtypes)
    assert as_multiset(passed) == as_multiset(want_passed)
    assert as_multiset(failed) == as_multiset(want_failed)


def test_specs(spark):
    by_name = {"t": "TimestampType", "s": "Anything", "i": "Integer"}
    assert en.declared_types(by_name) == {"s": "string", "i": "int", "t": "timestamp"}
    table = spark.createDataFrame(list(by_name.items()), "name string, type string")
    assert en.declared_types(table) == en.declared_types(by_name)
    with pytest.raises(ValueError):
        en.declared_types((["a"], ["b"]))
    assert en.cast_projection({"a.b": "Long", "c`d": "What"}) == [
        "try_cast(`a.b` as bigint) as `a.b`", "try_cast(`c``d` as string) as `c``d`"
    ]


def test_only_strings(spark):
    passed, failed = en.enforce(spark.createDataFrame([("a",)], "s string"), {"s": "String"})
    assert (passed.count(), failed.count()) == (1, 0)


def test_hashes(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), ("a,b", "c"), ("a", "b,c")], "x string, y string")
    assert df.select(row_hash(["x", "y"])).distinct().count() == 2
    assert df.select(row_identity(["x", "y"])).distinct().count() == 4
    keyed = df.withColumn("Hash", row_identity(["x", "y"]))
    joined = rejoin_on_hash(keyed.select("Hash", "x"), keyed.select("Hash", "y"))
    assert as_multiset(joined, ["x", "y"]) == as_multiset(df, ["x", "y"])


def test_split_to_rows(spark):
    df = spark.createDataFrame([(1, "a,b,"), (2, ""), (3, None)], "k int, t string")
    assert as_multiset(split_to_rows(df, "t", ",", ["k"]), ["k", "position", "part"]) == [
        (1, 0, "a"), (1, 1, "b"), (1, 2, ""), (2, 0, "")
    ]
    dotted = split_to_rows(spark.createDataFrame([("a.b",)], "t string"), "t", ".")
    assert as_multiset(dotted, ["part"]) == [("a",), ("b",)]
