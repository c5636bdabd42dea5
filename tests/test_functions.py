import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltbed.functions import (
    check_delimiter,
    decode_text,
    field_at,
    field_count,
    hour_route,
    line_file_name,
    local_day,
    local_hour,
    path_prefix,
    strict_long,
    utf16_length,
)


def values(spark, texts, *columns):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")
    return [tuple(r)[1:] for r in frame.select("i", *columns).orderBy("i").collect()]


def split_without_trailing_empties(text):
    """Brute force: fields after trailing empty ones are removed; no delimiter means one field."""
    if "," not in text:
        return [text]
    fields = text.split(",")
    while fields and fields[-1] == "":
        fields.pop()
    return fields


@pytest.mark.parametrize(
    ("text", "count"),
    [("", 1), (",", 0), (",,,", 0), ("a", 1), ("a,b", 2), ("a,,", 1), (",,a", 3), ("a,,b,,,", 3), (None, None)],
)
def test_field_count(spark, text, count):
    assert values(spark, [text], field_count(F.col("value")).alias("n")) == [(count,)]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.text(alphabet="a,é😀 1", max_size=14), min_size=1, max_size=30))
def test_fields_match_brute_force(spark, texts):
    v = F.col("value")
    got = values(spark, texts, field_count(v), field_at(v, 0), field_at(v, 2))
    for text, (count, first, third) in zip(texts, got, strict=True):
        fields = split_without_trailing_empties(text)
        assert count == len(fields)
        assert first == (fields[0] if fields else None)
        assert third == (fields[2] if len(fields) > 2 else None)


def test_delimiter_is_one_ascii_character(spark):
    assert values(spark, ["a|b,c|"], field_count(F.col("value"), "|"), field_at(F.col("value"), 1, "|")) == [(2, "b,c")]
    for bad in ("", "::", "é"):
        with pytest.raises(ValueError):
            check_delimiter(bad)


@pytest.mark.parametrize(
    ("text", "number"),
    [
        ("1451577600000", 1451577600000),
        ("+12", 12),
        ("-1", -1),
        ("007", 7),
        (" 12 ", None),
        ("12\n", None),
        ("12.5", None),
        ("", None),
        ("+", None),
        ("1e3", None),
        ("0x1", None),
        ("9223372036854775807", 9223372036854775807),
        ("-9223372036854775808", -9223372036854775808),
        ("9223372036854775808", None),
        ("٣٤", None),
        (None, None),
    ],
)
def test_strict_long(spark, text, number):
    assert values(spark, [text], strict_long(F.col("value")).alias("n")) == [(number,)]


@pytest.mark.parametrize(
    ("ms", "hours", "day", "hour", "route"),
    [
        (1451577600000, 8, dt.date(2016, 1, 1), 0, "2016-1-1/0"),
        (1451577599999, 8, dt.date(2015, 12, 31), 23, "2015-12-31/23"),
        (-1, 8, dt.date(1970, 1, 1), 7, "1970-1-1/7"),
        (-28800001, 8, dt.date(1969, 12, 31), 23, "1969-12-31/23"),
        (12, 8, dt.date(1970, 1, 1), 8, "1970-1-1/8"),
        (0, -5, dt.date(1969, 12, 31), 19, "1969-12-31/19"),
    ],
)
def test_local_parts_ignore_session_time_zone(spark, ms, hours, day, hour, route):
    for zone in ("UTC", "America/New_York", "Asia/Shanghai"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        frame = spark.createDataFrame([(ms,)], "ms bigint").select(
            local_day(F.col("ms"), hours).alias("d"), local_hour(F.col("ms"), hours).alias("h")
        )
        row = frame.select("d", "h", hour_route(F.col("d"), F.col("h")).alias("r")).first()
        assert (row.d, row.h, row.r) == (day, hour, route)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")


def test_largest_supported_time_still_routes(spark):
    frame = spark.createDataFrame([(9223372036854775,), (-9223372036854775,)], "ms bigint")
    parts = frame.select(local_day(F.col("ms")).alias("d"), local_hour(F.col("ms")).alias("h"))
    routes = [r.r for r in parts.select(hour_route(F.col("d"), F.col("h")).alias("r")).collect()]
    assert routes == ["294247-1-10/12", "-290308-12-22/3"]


def test_utf16_length(spark):
    texts = ["", "abc", "é", "😀", "a😀é", None]
    expected = [0 if t is None else len(t.encode("utf-16-be")) // 2 for t in texts]
    assert [v for (v,) in values(spark, texts, utf16_length(F.col("value")).alias("n"))] == expected


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.lists(st.binary(max_size=8), min_size=1, max_size=40))
def test_decode_replaces_malformed_bytes(spark, data):
    frame = spark.createDataFrame([(i, bytearray(d)) for i, d in enumerate(data)], "i int, b binary")
    got = [r.t for r in frame.select("i", decode_text(F.col("b")).alias("t")).orderBy("i").collect()]
    assert got == [d.decode("utf-8", "replace") for d in data]


def test_paths(spark):
    for output in ("hdfs://x/out", "hdfs://x/out/"):
        prefix = path_prefix(output, F.lit("t"))
        name = line_file_name(prefix, F.lit("2016-1-5/7"), F.lit(3), F.lit(120))
        assert spark.range(1).select(name).first()[0] == "hdfs://x/out/t/2016-1-5/7-3.120.lzo"
