"""Derived dimensions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dim_geography(customers: DataFrame) -> DataFrame:
    """One row per city. A city seen in several states takes the first in alphabetical order."""
    return (
        customers.filter(F.col("customer_city").isNotNull())
        .groupBy(F.col("customer_city").alias("city"))
        .agg(F.min("customer_state").alias("state"))
    )


def dim_calendar(orders: DataFrame) -> DataFrame:
    """Every day from the first to the last purchase. ``week`` is the ISO week number."""
    day = F.col("order_purchase_timestamp").cast("date")
    span = orders.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))
    days = span.filter(F.col("first_day").isNotNull()).select(
        F.explode(F.sequence("first_day", "last_day")).alias("date")
    )
    return days.select(
        "date",
        F.weekofyear("date").alias("week"),
        F.month("date").alias("month"),
        F.year("date").alias("year"),
    )
