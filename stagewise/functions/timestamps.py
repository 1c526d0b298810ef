"""Timestamp text in many declared formats, independent of the session zone.

Each accepted format is told apart by its shape, so a value is handed to exactly
one parser: no chain of failing parse attempts, and no format can shadow a longer
one. All results are ``timestamp_ntz`` holding UTC wall time.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted input formats, in their declared order.
DECLARED_FORMATS = (
    "yyyy-MM-dd",
    "yyyyMMdd",
    "yyyy/MM/dd",
    "yyyy-MM-dd'T'HH:mm:ss'Z'",
    "yyyy-MM-dd'T'HH:mm:ss.SSSXXX",
    "yyyy-MM-dd'T'HH:mm:ss.SSSZ",
    "yyMMddHHmmssZ",
    "EEE, d MMM yyyy HH:mm:ss Z",
    "yyyyy.MMMMM.dd GGG hh:mm aaa",
    "yyyy.MM.dd G 'at' HH:mm:ss z",
    "yyyy/MM/dd'T'HH:mm:ss'Z'",
    "yyyy/MM/dd'T'HH:mm:ss.SSSXXX",
    "yyyy/MM/dd'T'HH:mm:ss.SSSZ",
)

# Fixed value: stands for "no usable timestamp" where a default is asked for.
SENTINEL = "1900-01-01 00:00:00"

# Fixed value: output format of rendered timestamps.
OUTPUT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"

_OFFSET = r"[+-]\d{4}"
_CLOCK = r"\d{2}:\d{2}:\d{2}"
_WEEKDAY = r"(Mon|Tue|Wed|Thu|Fri|Sat|Sun)"


def wall_time(moment: datetime) -> Column:
    """A Python time as a ``timestamp_ntz`` literal; aware times are taken to UTC."""
    if moment.tzinfo is not None:
        moment = moment.astimezone(UTC).replace(tzinfo=None)
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def utc_wall_time(instant: Column) -> Column:
    """An instant as ``timestamp_ntz`` in UTC, whatever the session zone is."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))


def parse_utc(text: Column, pattern: str, has_zone: bool) -> Column:
    """Parse one pattern strictly; text the pattern does not match gives null."""
    if not has_zone:
        text, pattern = F.concat(text, F.lit("+00:00")), pattern + "XXX"
    return F.try_to_timestamp(text, F.lit(pattern))


def _local(text: Column) -> Column:
    """``2020-03-08`` or ``2020/03/08``, alone or with ``T02:30:00Z``; the Z is only a mark."""
    return F.left(F.translate(text, "/", "-"), F.lit(19)).try_cast("timestamp_ntz")


def _zoned(text: Column) -> Column:
    """Date and time with milliseconds and an offset."""
    return utc_wall_time(F.translate(text, "/", "-").try_cast("timestamp"))


def _digits(text: Column) -> Column:
    """``20200308``"""
    parts = [F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2)]
    return F.concat_ws("-", *parts).try_cast("timestamp_ntz")


def _pattern(pattern: str, has_zone: bool, strip: str | None = None) -> Callable[[Column], Column]:
    """Parse by pattern, after removing text Spark's parser has no letter for."""

    def read(text: Column) -> Column:
        value = F.regexp_replace(text, strip, "") if strip else text
        return utc_wall_time(parse_utc(value, pattern, has_zone))

    return read


# Shapes by their fifth character (0 for any digit), a cheap first test. Together they
# are the declared formats; the cast of the first five is Spark's fastest parser.
_FIVE_DIGIT_YEAR = r"^0(?=\d{4}\.)"
_SHORT_MONTH = (
    r"^0?\d{4}\.[A-Z][a-z]{2}\.\d{2} (AD|BC) \d{2}:\d{2} (AM|PM)$",
    _pattern("yyyy.MMM.dd G hh:mm a", False, _FIVE_DIGIT_YEAR),
)
_LONG_MONTH = (
    r"^0?\d{4}\.[A-Z][a-z]{3,}\.\d{2} (AD|BC) \d{2}:\d{2} (AM|PM)$",
    _pattern("yyyy.MMMM.dd G hh:mm a", False, _FIVE_DIGIT_YEAR),
)
SHAPES: dict[str, list[tuple[str, Callable[[Column], Column]]]] = {
    "-": [
        (rf"^\d{{4}}-\d{{2}}-\d{{2}}(T{_CLOCK}Z)?$", _local),
        (rf"^\d{{4}}-\d{{2}}-\d{{2}}T{_CLOCK}\.\d{{3}}(Z|[+-]\d{{2}}:?\d{{2}})$", _zoned),
    ],
    "/": [
        (rf"^\d{{4}}/\d{{2}}/\d{{2}}(T{_CLOCK}Z)?$", _local),
        (rf"^\d{{4}}/\d{{2}}/\d{{2}}T{_CLOCK}\.\d{{3}}(Z|[+-]\d{{2}}:?\d{{2}})$", _zoned),
    ],
    "0": [
        (r"^\d{8}$", _digits),
        (rf"^\d{{12}}{_OFFSET}$", _pattern("yyMMddHHmmssZ", True)),
        _SHORT_MONTH,
        _LONG_MONTH,
    ],
    ".": [
        (rf"^\d{{4}}\.\d{{2}}\.\d{{2}} (AD|BC) at {_CLOCK} \S+$", _pattern("yyyy.MM.dd G 'at' HH:mm:ss z", True)),
        _SHORT_MONTH,
        _LONG_MONTH,
    ],
    " ": [
        (
            rf"^{_WEEKDAY}, \d{{1,2}} [A-Z][a-z]{{2}} \d{{4}} {_CLOCK} {_OFFSET}$",
            _pattern("d MMM yyyy HH:mm:ss Z", True, r"^[A-Za-z]+, "),
        ),
    ],
}


def parse_timestamp(text: Column, pivot_year: int | None = None) -> Column:
    """Timestamp of text in any accepted format, or null.

    Two-digit years fall in 2000-2099; ``pivot_year`` (say 2050) moves those after
    it into the century before.
    """
    # As the body of a lambda the branches stay out of the generated row loop. With
    # several such columns that loop would outgrow what the JVM compiles.
    parsed = F.transform(F.array(text), _parse)[0]
    if pivot_year is not None:
        two_digit = text.rlike(rf"^\d{{12}}{_OFFSET}$") & (F.year(parsed) > pivot_year)
        parsed = F.when(two_digit, parsed - F.expr("INTERVAL 100 YEAR")).otherwise(parsed)
    return parsed


def _parse(text: Column) -> Column:
    fifth = F.substring(text, 5, 1)
    parsed = F
    for character, shapes in SHAPES.items():
        inner = F
        for regex, read in shapes:
            inner = inner.when(text.rlike(regex), read(text))
        parsed = parsed.when(fifth.between("0", "9") if character == "0" else fifth == character, inner)
    return parsed


def or_sentinel(parsed: Column) -> Column:
    """Replace a missing timestamp by the fixed sentinel."""
    return F.coalesce(parsed, F.expr(f"TIMESTAMP_NTZ'{SENTINEL}'"))


def format_timestamp(value: Column) -> Column:
    """Render as ``yyyy-MM-dd'T'HH:mm:ss'Z'`` from the wall time, free of the session zone."""
    return F.regexp_replace(value.cast("string"), r"^(\S+) (\d{2}:\d{2}:\d{2}).*$", "$1T$2Z")


def strip_offset(text: Column) -> Column:
    """Drop a trailing six-character UTC offset and keep the wall time before it."""
    return F.left(text, F.length(text) - F.lit(6)).try_cast("timestamp_ntz")


def watermark_text(text: Column) -> Column:
    """A source's effective-date text as a minute-precision timestamp.

    Text ending in ``M`` is the AM/PM form, padded with blanks by its producer;
    anything else is ISO text whose first 16 characters are kept.
    """
    am_pm = parse_utc(F.regexp_replace(F.trim(text), r"\s+", " "), "MMM d yyyy h:mma", False)
    iso = parse_utc(F.replace(F.left(text, F.lit(16)), F.lit("T"), F.lit(" ")), "yyyy-MM-dd HH:mm", False)
    return utc_wall_time(F.when(F.right(text, F.lit(1)) == "M", am_pm).otherwise(iso))


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Seconds between two times, rounded down to two places."""
    micros = F.timestamp_diff("MICROSECOND", start, end)
    return (F.floor(micros / F.lit(10_000)) / F.lit(100)).cast("decimal(18,2)")
