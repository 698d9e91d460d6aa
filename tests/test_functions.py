"""Column expressions on hand-made rows."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from marketlens.functions import dates, money, rounding, text

NTZ = "timestamp_ntz"


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def ts(literal):
    return F.lit(literal).cast(NTZ)


@pytest.mark.parametrize(
    "start, end, days",
    [
        ("2018-01-01 00:00:00", "2018-01-01 23:00:00", 0),
        ("2018-01-01 00:00:00", "2018-01-02 01:00:00", 1),
        ("2018-01-01 23:00:00", "2018-01-02 01:00:00", 0),
        ("2018-01-02 00:00:00", "2018-01-01 23:00:00", -1),
        ("2018-01-02 00:00:00", "2018-01-01 00:00:00", -1),
        ("2018-01-03 00:00:00", "2018-01-01 23:59:59", -2),
        ("2018-01-01 00:00:00", "2018-02-01 00:00:00", 31),
        (None, "2018-02-01 00:00:00", None),
    ],
)
def test_floor_days(spark, start, end, days):
    assert value(spark, dates.floor_days(ts(start), ts(end))) == days


def test_dates_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        # 2018-11-04 00:00 does not exist on the clocks of Sao Paulo.
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        before, after = ts("2018-11-03 12:00:00"), ts("2018-11-04 12:00:00")
        assert value(spark, dates.floor_days(before, after)) == 1
        midnight = spark.createDataFrame([("2018-11-04 00:00:00",)], "t string")
        parsed = midnight.select(dates.parse_timestamp("t").alias("t"))
        assert parsed.select(F.col("t").cast("string")).first()[0] == "2018-11-04 00:00:00"
        assert parsed.select(dates.month_start(F.col("t"))).first()[0] == dt.date(2018, 11, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize(
    "stamp, monday",
    [("2018-08-12 23:00:00", dt.date(2018, 8, 6)), ("2018-08-13 00:00:00", dt.date(2018, 8, 13))],
)
def test_week_start(spark, stamp, monday):
    assert value(spark, dates.week_start(ts(stamp))) == monday


def test_parse_timestamp(spark):
    rows = [("2017-10-02 10:56:33",), ("2017-10-02",), ("bad",), ("",), (None,)]
    parsed = spark.createDataFrame(rows, "t string").select(dates.parse_timestamp("t").alias("t"))
    assert [r.t for r in parsed.collect()] == [
        dt.datetime(2017, 10, 2, 10, 56, 33),
        dt.datetime(2017, 10, 2),
        None,
        None,
        None,
    ]
    slashed = spark.createDataFrame([("02/10/2017",), ("2017-10-02",)], "t string")
    got = slashed.select(dates.parse_timestamp("t", "dd/MM/yyyy").alias("t")).collect()
    assert [r.t for r in got] == [dt.datetime(2017, 10, 2), None]


def test_strip_lower(spark):
    assert value(spark, text.strip_lower(F.lit("\t São Paulo \n"))) == "são paulo"


def test_money(spark):
    df = spark.createDataFrame([(19.99,), (0.1,), (0.2,), (math.nan,), (None,)], "p double")
    assert [r[0] for r in df.select(money.cents("p")).collect()] == [1999, 10, 20, None, None]
    total = df.agg(money.from_cents(F.sum(money.cents("p"))).alias("v")).first().v
    assert total == 20.29


def test_half_even(spark):
    got = [value(spark, rounding.half_even_2(F.lit(v))) for v in (0.125, 0.375, 6.25, 8.0745)]
    assert got == [0.12, 0.38, 6.25, 8.07]
