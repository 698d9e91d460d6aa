"""Cohorts and retention.

A customer's cohort is the month of the first order. Per customer only the active months are kept, one row each, which
the calendar bounds, however many orders the customer has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions.dates import month_number, month_start
from marketlens.functions.rounding import fixed_point, half_even_2, mean_of_fixed
from marketlens.sources.readers import fetch_scalar

# Statuses that do not count as a purchase.
EXCLUDED_STATUSES = ["cancelled", "unavailable"]

FOLLOW_UP_MONTHS = [1, 2, 3]


def purchases(orders: DataFrame) -> DataFrame:
    """Orders that count as a purchase (a missing status does not): customer_id, order_date."""
    return orders.filter(~F.col("order_status").isin(EXCLUDED_STATUSES)).select(
        "customer_id", F.col("order_purchase_timestamp").cast("date").alias("order_date")
    )


def _active_months(rows: DataFrame, key: str) -> DataFrame:
    """The distinct months of each key with the key's first month. Rows have a ``month`` column.

    Repeated orders of a month are merged before the shuffle, and a key has no more rows than the calendar has months.
    """
    months = rows.groupBy(key, "month").agg(F.count(F.lit(1)).alias("n_rows")).drop("n_rows")
    return months.withColumn("cohort_month", F.min("month").over(Window.partitionBy(key)))


def _counts(active: DataFrame) -> DataFrame:
    return (
        active.filter(F.col("month").isNotNull())
        .groupBy("cohort_month", F.col("month").alias("order_month"))
        .agg(F.count(F.lit(1)).alias("n_customers"))
        .withColumn(
            "months_diff",
            month_number(F.col("order_month")) - month_number(F.col("cohort_month")),
        )
    )


def cohort_counts(orders: DataFrame) -> DataFrame:
    """Customers per cohort and month: cohort_month, order_month, n_customers, months_diff."""
    rows = purchases(orders).filter(F.col("customer_id").isNotNull())
    return _counts(_active_months(rows.withColumn("month", F.trunc("order_date", "month")), "customer_id"))


def cohort_counts_by_person(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """As ``cohort_counts``, for persons instead of customer ids.

    Deduplicating customers to one id per person drops the orders of the other ids, and with them the
    repeat purchases. So ``orders`` and ``customers`` here are the ones before that step.
    """
    rows = purchases(orders).select("customer_id", F.trunc("order_date", "month").alias("month"))
    identity = customers.filter(F.col("customer_unique_id").isNotNull())
    months = rows.distinct().join(
        identity.select("customer_id", "customer_unique_id").distinct(), "customer_id"
    )
    return _counts(_active_months(months, "customer_unique_id"))


def _sizes(counts: DataFrame, months: list[int]) -> DataFrame:
    """Per cohort: ``n_<k>`` customers active k months after the first one."""
    return counts.groupBy("cohort_month").agg(
        *[F.sum(F.when(F.col("months_diff") == k, F.col("n_customers"))).alias(f"n_{k}") for k in months]
    )


def cohort_retention(counts: DataFrame) -> DataFrame:
    """Per cohort: size and retention after 1, 2 and 3 months in percent; NULL where nobody came back."""
    rates = [
        half_even_2(F.col(f"n_{k}") / F.col("n_0") * 100).alias(f"retention_month_{k}")
        for k in FOLLOW_UP_MONTHS
    ]
    return _sizes(counts, [0, *FOLLOW_UP_MONTHS]).select(
        F.date_format("cohort_month", "yyyy-MM").alias("cohort_month"),
        F.col("n_0").alias("cohort_size"),
        *rates,
    )


def retention_display(retention: DataFrame) -> DataFrame:
    """The retention table with 0 instead of NULL."""
    return retention.na.fill(0.0, [f"retention_month_{k}" for k in FOLLOW_UP_MONTHS])


def retention_rates(counts: DataFrame) -> DataFrame:
    """Long form: cohort_month, months_diff, n_customers, cohort_size, rate in percent."""
    sizes = counts.filter(F.col("months_diff") == 0).select(
        "cohort_month", F.col("n_customers").alias("cohort_size")
    )
    return counts.join(sizes, "cohort_month").select(
        "cohort_month",
        "months_diff",
        "n_customers",
        "cohort_size",
        (F.col("n_customers") / F.col("cohort_size") * 100).alias("rate"),
    )


def retention_matrix(counts: DataFrame, last_month: int | None = None) -> DataFrame:
    """Heat-map data: one row per cohort, ``m0`` .. ``m<last_month>`` in percent, 0 where nobody came.

    ``last_month``: the largest ``months_diff`` of the counts, where it is known (the cohort job counts it while it stores
    them); otherwise it is looked up. A smaller one is an error when the query runs, as it would drop months.
    """
    if last_month is None:
        last = fetch_scalar(counts.agg(F.max("months_diff")))
        last_month = 0 if last is None else last
    months = list(range(last_month + 1))
    beyond = F.raise_error(F.concat(F.lit(f"last_month is {last_month}, but there are customers after months: "), F.col("months_diff")))
    known = F.when(F.col("months_diff") > last_month, beyond.cast("int")).otherwise(F.col("months_diff"))
    counts = counts.withColumn("months_diff", known)
    wide = counts.groupBy("cohort_month").pivot("months_diff", months).agg(F.sum("n_customers"))
    return wide.select(
        "cohort_month",
        *[F.coalesce(F.col(str(k)) / F.col("0") * 100, F.lit(0.0)).alias(f"m{k}") for k in months],
    )


def average_retention(retention: DataFrame) -> DataFrame:
    """Unweighted means over the cohorts, NULLs skipped, and whether all three are 0."""
    means = [
        mean_of_fixed(fixed_point(F.col(f"retention_month_{k}"), 100), 100).alias(
            f"avg_retention_month_{k}"
        )
        for k in FOLLOW_UP_MONTHS
    ]
    row = retention.agg(*means)
    zero = [F.col(f"avg_retention_month_{k}") == 0 for k in FOLLOW_UP_MONTHS]
    all_zero = F.coalesce(zero[0] & zero[1] & zero[2], F.lit(False))
    return row.withColumn("all_zero", all_zero)


def repeat_customers(orders: DataFrame, k: int | None = 10) -> DataFrame:
    """Customers with more than one order, most orders first: purchase days, orders, first and last day."""
    counted = orders.filter(~F.col("order_status").isin(EXCLUDED_STATUSES))
    per_day = counted.groupBy(
        "customer_id", F.col("order_purchase_timestamp").cast("date").alias("day")
    ).agg(F.count("order_id").alias("n"))
    found = (
        per_day.groupBy("customer_id")
        .agg(
            F.count("day").alias("purchase_days"),
            F.sum("n").alias("orders_count"),
            F.min("day").alias("first_purchase"),
            F.max("day").alias("last_purchase"),
        )
        .filter(F.col("orders_count") > 1)
    )
    return found if k is None else found.orderBy(F.col("orders_count").desc(), "customer_id").limit(k)


def has_repeat_customers(orders: DataFrame) -> DataFrame:
    """One row: whether any customer has more than one order."""
    counted = orders.filter(~F.col("order_status").isin(EXCLUDED_STATUSES))
    per_customer = counted.groupBy("customer_id").agg(F.count("order_id").alias("n"))
    return per_customer.agg(F.coalesce(F.max("n") > 1, F.lit(False)).alias("repeat_customers"))


def retention_m0_m1(orders: DataFrame) -> DataFrame:
    """Share of each cohort active in the month after the first; orders of every status count."""
    rows = orders.select("customer_id", month_start(F.col("order_purchase_timestamp")).alias("month"))
    known = F.col("customer_id").isNotNull()
    return (
        _active_months(rows, "customer_id")
        .groupBy("cohort_month")
        .agg(
            F.count_if(known & F.col("month").eqNullSafe(F.col("cohort_month"))).alias("cohort_size"),
            F.count_if(known & (F.col("month") == F.add_months("cohort_month", 1))).alias("retained_m1"),
        )
        .withColumn(
            "retention_rate_m1",
            F.round(F.col("retained_m1") * 100.0 / F.nullif("cohort_size", F.lit(0)), 2),
        )
    )
