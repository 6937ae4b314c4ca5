import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.functions import (
    count_or_zero,
    month_of,
    null_if_token,
    parse_point,
    remove_literal,
    strict_cast,
    text_or_empty,
    timestamp_or_null,
    trailing_year,
    year_of,
)
from martwright.presets import NULL_TOKENS
from martwright.sources import typed

ANSI = "spark.sql.ansi.enabled"


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "v string").select(expression(F.col("v"))).first()[0]


def fails(spark, value, expression):
    with pytest.raises(Exception) as caught:
        one(spark, value, expression)
    return str(caught.value)


@pytest.fixture(params=["true", "false"])
def ansi(request, conf):
    conf(ANSI, request.param)


def test_null_tokens(spark):
    for token in NULL_TOKENS:
        assert one(spark, token, null_if_token) is None
    assert one(spark, "na", null_if_token) == "na"
    assert one(spark, None, null_if_token) is None
    assert len(NULL_TOKENS) == 17


def test_text_keeps_tokens(spark):
    assert one(spark, "NULL", text_or_empty) == "NULL"
    assert one(spark, None, text_or_empty) == ""


@pytest.mark.parametrize(
    "text, value", [("7", 7), (" 7 ", 7), ("-7", -7), ("007", 7), (None, None)]
)
def test_long(spark, ansi, text, value):
    assert one(spark, text, lambda c: strict_cast(c, T.LongType())) == value


@pytest.mark.parametrize("text", ["1.0", "1e3", "", "x", "9223372036854775808", "1,000"])
def test_bad_long(spark, ansi, text):
    message = fails(spark, text, lambda c: strict_cast(c, T.LongType(), "pack"))
    assert "pack" in message and text in message


@pytest.mark.parametrize(
    "text, value",
    [("1.5", 1.5), (" 1.5 ", 1.5), ("1e3", 1000.0), (".5", 0.5), ("-inf", float("-inf"))],
)
def test_double(spark, ansi, text, value):
    assert one(spark, text, lambda c: strict_cast(c, T.DoubleType())) == value


@pytest.mark.parametrize("text", ["$4.5", "1,000.5", "1.5f", "1.5D ", "0x1p3", "", "-"])
def test_bad_double(spark, ansi, text):
    assert "sale_dollars" in fails(
        spark, text, lambda c: strict_cast(c, T.DoubleType(), "sale_dollars")
    )


def at(spark, text, patterns):
    schema = T.StructType([T.StructField("at", T.TimestampNTZType())])
    return typed(spark.createDataFrame([(text,)], "at string"), schema, patterns).first().at


@pytest.mark.parametrize("text", ["1/2/2012", "01/02/2012", " 01/2/2012", "January 2 2012"])
def test_timestamp(spark, ansi, text):
    assert at(spark, text, ["M/d/yyyy", "MMMM d yyyy"]) == datetime.datetime(2012, 1, 2)


@pytest.mark.parametrize("text", ["2012-01-02", "13/02/2012", "1/2/2012 00:00", "1/2/12"])
def test_bad_timestamp(spark, ansi, text):
    with pytest.raises(Exception):
        at(spark, text, ["M/d/yyyy"])


@pytest.mark.parametrize("text", ["", "NA", "#N/A", "null", None])
def test_missing_timestamp(spark, ansi, text):
    assert at(spark, text, ["M/d/yyyy"]) is None


def test_timestamp_needs_a_pattern():
    with pytest.raises(ValueError):
        timestamp_or_null(None, [])


def test_calendar_ignores_the_session_zone(spark, conf):
    last = datetime.datetime(2012, 12, 31, 23, 59, 59)
    for zone in ("UTC", "Pacific/Kiritimati", "America/Los_Angeles"):
        conf("spark.sql.session.timeZone", zone)
        df = spark.createDataFrame([(last,)], "t timestamp_ntz")
        found = df.select(year_of(F.col("t")), month_of(F.col("t"))).first()
        assert tuple(found) == (2012, datetime.date(2012, 12, 1))


def test_population_repairs(spark, ansi):
    assert one(spark, "Polk County", lambda c: remove_literal(c, " County")) == "Polk"
    assert one(spark, "A County B County", lambda c: remove_literal(c, " County")) == "A B"
    assert one(spark, "A.County", lambda c: remove_literal(c, " County")) == "A.County"
    assert one(spark, "July 01 2012", trailing_year) == 2012
    assert one(spark, "812", trailing_year) == 812
    assert one(spark, "7500.9", count_or_zero) == 7500
    assert one(spark, None, count_or_zero) == 0
    for bad in (None, "", "July"):
        fails(spark, bad, trailing_year)
    fails(spark, "many", count_or_zero)


def test_point(spark, ansi):
    def lon_lat(text):
        point = one(spark, text, parse_point)
        return point and tuple(point)

    assert lon_lat("POINT (-93.5 41)") == (-93.5, 41.0)
    assert lon_lat(" point(1e1   .5 ) ") == (10.0, 0.5)
    assert lon_lat("") is None
    assert lon_lat(None) is None
    for bad in ("POINT (1)", "POINT (1 2 3)", "LINE (1 2)", "1 2"):
        assert bad in fails(spark, bad, parse_point)
