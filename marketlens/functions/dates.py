"""Date and time expressions. Timestamps carry no zone (TIMESTAMP_NTZ), so none of these depends on
the session time zone or on daylight saving."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_timestamp(name: str, fmt: str | None = None) -> Column:
    """Timestamp or NULL. Without a format, ISO text (date, or date and time) is read."""
    if fmt is None:
        return F.col(name).try_cast("timestamp_ntz")
    return F.try_to_timestamp(F.col(name), F.lit(fmt)).cast("timestamp_ntz")


def floor_days(start: Column, end: Column) -> Column:
    """Whole days from start to end, rounded down: +23h is 0, -1h is -1."""
    gap = end - start
    days = F.extract(F.lit("DAY"), gap)
    return (days - F.when(gap < F.make_dt_interval(days), 1).otherwise(0)).cast("int")


def week_start(ts: Column) -> Column:
    """Monday of the week that holds ts."""
    return F.trunc(ts.cast("date"), "week")


def month_start(ts: Column) -> Column:
    return F.trunc(ts.cast("date"), "month")


def month_number(date: Column) -> Column:
    return F.year(date) * 12 + F.month(date)
