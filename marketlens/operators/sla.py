"""Delivery service level: late shares, mean and median delivery days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions.money import per
from marketlens.functions.rounding import half_even_2
from marketlens.operators.marts import LATE_DAYS, categorised_items, delivery_figures, is_late

# Groups with fewer rows are left out.
MIN_CITY_ORDERS = 10
MIN_CATEGORY_ROWS = 5
# Rows that are handed to a quantile sketch at once.
SKETCH_RUN = 10_000


def _late_rate() -> Column:
    return half_even_2(F.col("late_orders") / F.nullif("total_orders", F.lit(0)) * 100)


def _city_of_customer(customers: DataFrame) -> DataFrame:
    return customers.filter(F.col("customer_city").isNotNull()).select("customer_id", "customer_city")


def _category_of_item(items: DataFrame, products: DataFrame) -> DataFrame:
    return (
        categorised_items(items, products)
        .filter(F.col("product_category_name").isNotNull())
        .select("order_id", "product_category_name")
    )


def sla_city(
    orders: DataFrame,
    customers: DataFrame,
    late_days: int = LATE_DAYS,
    min_orders: int = MIN_CITY_ORDERS,
) -> DataFrame:
    """Per customer city: orders, late orders, mean days (rounded and not), late rate."""
    per_customer = (
        delivery_figures(orders, late_days)
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("days").alias("days"), F.sum("late").alias("late"))
    )
    mean_days = per(F.col("days"), F.col("total_orders"))
    return (
        per_customer.join(_city_of_customer(customers), "customer_id")
        .groupBy("customer_city")
        .agg(
            F.sum("n").alias("total_orders"),
            F.sum("late").alias("late_orders"),
            F.sum("days").alias("days"),
        )
        .filter(F.col("total_orders") >= min_orders)
        .select(
            "customer_city",
            "total_orders",
            "late_orders",
            half_even_2(mean_days).alias("avg_delivery_days"),
            mean_days.alias("avg_delivery_days_not_null"),
            _late_rate().alias("late_delivery_rate"),
        )
    )


def sla_category(
    orders: DataFrame,
    items: DataFrame,
    products: DataFrame,
    late_days: int = LATE_DAYS,
    min_rows: int = MIN_CATEGORY_ROWS,
) -> DataFrame:
    """Per category, counting item rows: rows, late rows, mean days, late rate."""
    rows = _category_of_item(items, products).join(delivery_figures(orders, late_days), "order_id")
    return _sla_category(rows.withColumn("n_rows", F.lit(1).cast("bigint")), min_rows)


def sla_category_of_lines(lines: DataFrame, min_rows: int = MIN_CATEGORY_ROWS) -> DataFrame:
    """The same from the staged sales lines of the marts."""
    return _sla_category(_delivered_lines(lines), min_rows)


def _delivered_lines(lines: DataFrame) -> DataFrame:
    return lines.filter(F.col("days").isNotNull() & F.col("product_category_name").isNotNull())


def _sla_category(parts: DataFrame, min_rows: int) -> DataFrame:
    return (
        parts.groupBy("product_category_name")
        .agg(
            F.sum("n_rows").alias("total_orders"),
            F.sum(F.col("late") * F.col("n_rows")).alias("late_orders"),
            F.sum(F.col("days") * F.col("n_rows")).alias("days"),
        )
        .filter(F.col("total_orders") >= min_rows)
        .select(
            "product_category_name",
            "total_orders",
            "late_orders",
            half_even_2(per(F.col("days"), F.col("total_orders"))).alias("avg_delivery_days"),
            _late_rate().alias("late_delivery_rate"),
        )
    )


def sla_overall(orders: DataFrame, late_days: int = LATE_DAYS) -> DataFrame:
    """One row over all orders with known delivery days; rate and mean are 0 when there are none."""
    days = F.col("delivery_time_days").cast("bigint")
    return orders.agg(
        F.count("delivery_time_days").alias("total_orders"),
        F.count_if(is_late(late_days)).alias("late_orders"),
        F.sum(days).alias("days"),
    ).select(
        F.col("total_orders").alias("total_orders_with_delivery"),
        "late_orders",
        F.coalesce(_late_rate(), F.lit(0.0)).alias("late_delivery_rate"),
        F.coalesce(half_even_2(per(F.col("days"), F.col("total_orders"))), F.lit(0.0)).alias(
            "avg_delivery_days"
        ),
    )


def sla_combined(city: DataFrame, category: DataFrame) -> DataFrame:
    """City and category rows under a ``level`` tag; columns one side lacks are NULL."""
    return city.withColumn("level", F.lit("city")).unionByName(
        category.withColumn("level", F.lit("category")), allowMissingColumns=True
    )


def top_by_orders(sla: DataFrame, key: str, k: int = 15) -> DataFrame:
    return sla.orderBy(F.col("total_orders").desc(), key).limit(k)


def _median_days(histogram: DataFrame, key: str, accuracy: int = 0) -> DataFrame:
    """Median from (key, days, n).

    Exact: memory per group is bounded by its distinct day values. With ``accuracy`` a mergeable quantile sketch, whose
    size does not depend on the values: the rank of the result is off by at most 1 / accuracy of the group's rows.
    """
    counted = histogram.groupBy(key, "days").agg(F.sum("n").alias("n"))
    median = F.percentile("days", 0.5, F.col("n"))
    if accuracy:
        # The sketch counts values, so a day value comes in once per row, in runs of bounded length.
        runs = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / SKETCH_RUN)))
        rest = F.least(F.col("n") - F.col("run") * SKETCH_RUN, F.lit(SKETCH_RUN)).cast("int")
        counted = histogram.filter("n > 0").withColumn("run", runs).withColumn("n", F.explode(F.array_repeat(F.lit(1).cast("bigint"), rest)))
        median = F.percentile_approx("days", 0.5, accuracy).cast("double")
    return counted.groupBy(key).agg(F.sum("n").alias("total_orders"), median.alias("median_delivery_days"))


def median_by_city(orders: DataFrame, customers: DataFrame, accuracy: int = 0) -> DataFrame:
    per_customer = (
        delivery_figures(orders).groupBy("customer_id", "days").agg(F.count(F.lit(1)).alias("n"))
    )
    return _median_days(per_customer.join(_city_of_customer(customers), "customer_id"), "customer_city", accuracy)


def median_by_category(orders: DataFrame, items: DataFrame, products: DataFrame, accuracy: int = 0) -> DataFrame:
    rows = _category_of_item(items, products).join(delivery_figures(orders), "order_id")
    return _median_days(rows.withColumn("n", F.lit(1).cast("bigint")), "product_category_name", accuracy)


def median_by_category_of_lines(lines: DataFrame, accuracy: int = 0) -> DataFrame:
    """The same from the staged sales lines of the marts."""
    return _median_days(_delivered_lines(lines).withColumn("n", F.col("n_rows")), "product_category_name", accuracy)


def median_rank_check(medians: DataFrame, histogram: DataFrame, key: str, accuracy: int) -> DataFrame:
    """Whether each median lies as near to the middle rank as promised: key, total_orders, within_bound.

    ``histogram``: key, days, n. The ranks that a value stands for are those from the first to the last row that has it.
    """
    counted = histogram.groupBy(key, "days").agg(F.sum("n").alias("n"))
    value = medians.select(key, "total_orders", "median_delivery_days")
    placed = counted.join(value, key)
    day, median = F.col("days"), F.col("median_delivery_days")
    ranks = placed.groupBy(key, "total_orders").agg(
        F.sum(F.when(day < median, F.col("n")).otherwise(0)).alias("below"),
        F.sum(F.when(day <= median, F.col("n")).otherwise(0)).alias("up_to"),
    )
    middle, slack = F.col("total_orders") / 2, F.col("total_orders") / accuracy + 1
    within = (F.col("below") <= middle + slack) & (F.col("up_to") >= middle - slack)
    return ranks.select(key, "total_orders", within.alias("within_bound"))


def city_histogram(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """customer_city, days, n: rows by delivery days."""
    per_customer = delivery_figures(orders).groupBy("customer_id", "days").agg(F.count(F.lit(1)).alias("n"))
    return per_customer.join(_city_of_customer(customers), "customer_id").groupBy("customer_city", "days").agg(F.sum("n").alias("n"))


def late_versus_promised_orders(orders: DataFrame) -> DataFrame:
    """Orders with both figures known, and whether they took longer than promised."""
    both = F.col("delivery_time_days").isNotNull() & F.col("promised_time_days").isNotNull()
    return orders.filter(both).select(
        "order_id",
        "delivery_time_days",
        "promised_time_days",
        (F.col("delivery_time_days") > F.col("promised_time_days")).alias("is_late"),
    )
