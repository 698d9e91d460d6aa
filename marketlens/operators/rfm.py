"""Recency, frequency, monetary value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions.dates import floor_days
from marketlens.functions.money import from_cents
from marketlens.operators.marts import order_totals

# The day recency is counted to, and the amount above which a customer is "High".
SNAPSHOT = "2023-04-01"
HIGH_ABOVE = 300


def rfm_scores(orders: DataFrame, items: DataFrame, snapshot: str = SNAPSHOT) -> DataFrame:
    """Per customer, over the item rows of the orders: days since the last purchase, rows, price sum."""
    totals = order_totals(items).select("order_id", "n_rows", "price_sum")
    bought = orders.select("order_id", "customer_id", "order_purchase_timestamp")
    return rfm_scores_of_lines(totals.join(bought, "order_id"), snapshot)


def rfm_scores_of_lines(lines: DataFrame, snapshot: str = SNAPSHOT) -> DataFrame:
    """The same from the staged sales lines of the marts."""
    last = F.max("order_purchase_timestamp")
    return (
        lines.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            floor_days(last, F.lit(snapshot).cast("timestamp_ntz")).alias("Recency"),
            F.sum("n_rows").alias("Frequency"),
            F.coalesce(from_cents(F.sum("price_sum")), F.lit(0.0)).alias("Monetary"),
        )
    )


def rfm_segments(scores: DataFrame, high_above: float = HIGH_ABOVE) -> DataFrame:
    return scores.withColumn("Segment", F.when(F.col("Monetary") > high_above, "High").otherwise("Low"))


def segment_counts(segments: DataFrame) -> DataFrame:
    return segments.groupBy("Segment").agg(F.count(F.lit(1)).alias("customers"))
