"""Expressions against plain Python on many random values."""

import datetime as dt
import decimal
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlens.functions import dates, money, rounding
from marketlens.operators.clean import keep_first

N = 5000


@pytest.fixture
def rng():
    return random.Random(7)


def moment(rng):
    return dt.datetime(2016, 1, 1) + dt.timedelta(microseconds=rng.randrange(3 * 365 * 86_400_000_000))


def test_dates(spark, rng):
    rows = [(i, moment(rng), moment(rng)) for i in range(N)]
    df = spark.createDataFrame(rows, "i int, a timestamp_ntz, b timestamp_ntz")
    a, b = F.col("a"), F.col("b")
    got = df.select(
        "i",
        dates.floor_days(a, b).alias("days"),
        dates.week_start(a).alias("week"),
        dates.month_start(a).alias("month"),
        (dates.month_number(b.cast("date")) - dates.month_number(a.cast("date"))).alias("months"),
    ).collect()
    for r in got:
        _, a, b = rows[r.i]
        assert r.days == (b - a).days
        assert r.week == a.date() - dt.timedelta(days=a.weekday())
        assert r.month == a.date().replace(day=1)
        assert r.months == (b.year - a.year) * 12 + b.month - a.month


def test_rounding_like_numpy(spark, rng):
    rows = [(i, rng.randrange(1, 900), rng.randrange(900, 2000)) for i in range(N)]
    df = spark.createDataFrame(rows, "i int, late int, total int")
    got = df.select("i", rounding.half_even_2(F.col("late") / F.col("total") * 100).alias("v")).collect()
    for r in got:
        _, late, total = rows[r.i]
        assert r.v == np.round(np.float64(late) / np.float64(total) * 100, 2)


def test_money_sums_are_exact(spark, rng):
    amounts = [round(rng.uniform(-1000, 10000), 2) for _ in range(N)]
    df = spark.createDataFrame([(a,) for a in amounts], "p double")
    exact = float(sum(decimal.Decimal(str(a)) for a in amounts))
    for parts in (1, 3, 16):
        total = df.repartition(parts).agg(money.from_cents(F.sum(money.cents("p")))).first()[0]
        assert total == exact


def test_mean_of_fixed_does_not_depend_on_the_split(spark, rng):
    df = spark.createDataFrame([(rng.uniform(-100, 100),) for _ in range(N)], "v double")
    mean = rounding.mean_of_fixed(rounding.fixed_point(F.col("v")))
    results = {df.repartition(parts).agg(mean).first()[0] for parts in (1, 3, 16)}
    assert len(results) == 1
    assert abs(results.pop() - df.agg(F.avg("v")).first()[0]) < 1e-9


def test_keep_first_like_a_loop(spark, rng):
    rows = [(rng.choice([None, *range(300)]), rng.choice([None, 1, 2, 3]), rng.randrange(50)) for _ in range(N)]
    df = spark.createDataFrame(rows, "k int, a int, b int")
    expected = {}
    for k, a, b in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
        expected.setdefault(k, (a, b))
    assert {r.k: (r.a, r.b) for r in keep_first(df, ["k"]).collect()} == expected
