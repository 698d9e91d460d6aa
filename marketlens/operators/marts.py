"""Gold marts.

``orders`` must be unique on order_id and ``products`` on product_id, as the cleaning step leaves them. Then distinct
orders become a row count once items are rolled up per order, every mart has at most one true distinct count left, and
no plan needs the row-multiplying Expand of several COUNT(DISTINCT ..).

Where a customer attribute is needed, order figures are first added up per customer, so that a customer with
very many orders meets the customer table as a handful of rows.

Items cross the network by order_id, and once more by product_id where the products are too many to broadcast; the
roll-up per order needs no further shuffle. Item joins by product and by order are joins of plain shuffles, so that
Spark splits a hot product or order at run time (AQE skew join).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions.dates import week_start
from marketlens.functions.money import cents, from_cents, per, percent

# Fixed value: more days than this is a late delivery.
LATE_DAYS = 30


def is_late(late_days: int = LATE_DAYS) -> Column:
    return F.col("delivery_time_days") > late_days


def measured_items(items: DataFrame) -> DataFrame:
    """Items with their amounts in cents; gross = price + freight, missing if either is."""
    return items.select(
        "order_id",
        "order_item_id",
        "product_id",
        cents("price").alias("price_cents"),
        (cents("price") + cents("freight_value")).alias("gross_cents"),
        cents("freight_value").alias("freight_cents"),
    )


def _narrow_items(items: DataFrame) -> DataFrame:
    """What measured items follow from, without what can be found again after a shuffle: the sum of two amounts, and the
    item number, of which only counts whether there is one."""
    numbered = F.col("order_item_id").isNotNull().alias("numbered")
    return items.select(
        "order_id", "product_id", cents("price").alias("price_cents"), cents("freight_value").alias("freight_cents"), numbered
    )


def _narrow_item_sums() -> list[Column]:
    """``item_sums`` of narrow items."""
    gross = F.col("price_cents") + F.col("freight_cents")
    return [
        F.count_if("numbered").alias("items"),
        F.sum(gross).alias("gross"),
        F.count(gross).alias("gross_rows"),
        F.sum("price_cents").alias("price_sum"),
        F.count("price_cents").alias("price_rows"),
        F.sum("freight_cents").alias("freight_sum"),
    ]


def item_sums() -> list[Column]:
    """Additive figures of a group of measured items."""
    return [
        F.count("order_item_id").alias("items"),
        F.sum("gross_cents").alias("gross"),
        F.count("gross_cents").alias("gross_rows"),
        F.sum("price_cents").alias("price_sum"),
        F.count("price_cents").alias("price_rows"),
        F.sum("freight_cents").alias("freight_sum"),
    ]


def order_totals(items: DataFrame) -> DataFrame:
    """Item figures per order; combined map-side, so an order with very many items stays cheap."""
    return measured_items(items).groupBy("order_id").agg(*item_sums(), F.count(F.lit(1)).alias("n_rows"))


def categorised_items(items: DataFrame, products: DataFrame) -> DataFrame:
    """Measured items with the category of their product.

    No broadcast hint: Spark broadcasts the products only while they are below its size threshold and
    otherwise shuffles, splitting a hot product at run time.
    """
    return measured_items(items).join(
        products.select("product_id", "product_category_name"), "product_id"
    )


def daily_category(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Sales per day and category."""
    lines = categorised_items(items, products).filter(F.col("product_category_name").isNotNull())
    days = orders.select(
        "order_id", "customer_id", F.col("order_purchase_timestamp").cast("date").alias("order_date")
    )
    per_order = (
        lines.join(days, "order_id")
        .groupBy("order_id", "customer_id", "order_date", "product_category_name")
        .agg(*item_sums())
    )
    return _daily_category(per_order.withColumn("orders", F.lit(1)))


def _daily_category(parts: DataFrame) -> DataFrame:
    return (
        parts.groupBy("order_date", "product_category_name")
        .agg(
            F.sum("orders").alias("orders_count"),
            F.countDistinct("customer_id").alias("customers_count"),
            F.sum("gross").alias("gross"),
            F.sum("items").alias("items_count"),
            F.sum("gross_rows").alias("gross_rows"),
        )
        .select(
            "order_date",
            "product_category_name",
            "orders_count",
            "customers_count",
            from_cents(F.col("gross")).alias("revenue"),
            "items_count",
            per(from_cents(F.col("gross")), F.col("gross_rows")).alias("avg_order_value"),
        )
    )


def weekly_city(orders: DataFrame, customers: DataFrame, items: DataFrame) -> DataFrame:
    """Sales per week (starting Monday) and customer city."""
    weeks = orders.select(
        "order_id", "customer_id", week_start(F.col("order_purchase_timestamp")).alias("week_start")
    )
    per_customer = (
        order_totals(items)
        .join(weeks, "order_id")
        .groupBy("customer_id", "week_start")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum("gross").alias("gross"),
            F.sum("gross_rows").alias("gross_rows"),
            F.sum("items").alias("items"),
        )
    )
    return _weekly_city(per_customer, customers)


def _weekly_city(per_customer: DataFrame, customers: DataFrame) -> DataFrame:
    cities = customers.filter(F.col("customer_city").isNotNull()).select(
        "customer_id", "customer_unique_id", "customer_city"
    )
    return (
        per_customer.join(cities, "customer_id")
        .groupBy("week_start", "customer_city")
        .agg(
            F.sum("orders").alias("orders_count"),
            F.countDistinct("customer_unique_id").alias("customers_count"),
            F.sum("gross").alias("gross"),
            F.sum("gross_rows").alias("gross_rows"),
            F.sum("items").alias("items_count"),
        )
        .select(
            "week_start",
            "customer_city",
            "orders_count",
            "customers_count",
            from_cents(F.col("gross")).alias("revenue"),
            per(from_cents(F.col("gross")), F.col("gross_rows")).alias("avg_order_value"),
            "items_count",
        )
    )


def product_performance(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Sales per product; products without a category stay. Categories join after the roll-up."""
    per_order = (
        measured_items(items)
        .join(orders.select("order_id", "customer_id"), "order_id")
        .groupBy("order_id", "customer_id", "product_id")
        .agg(*item_sums())
    )
    return _product_performance(per_order, products)


def _product_performance(per_order: DataFrame, products: DataFrame) -> DataFrame:
    per_product = per_order.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("orders_count"),
        F.countDistinct("customer_id").alias("customers_count"),
        F.sum("gross").alias("gross"),
        F.sum("price_sum").alias("price_sum"),
        F.sum("freight_sum").alias("freight_sum"),
        F.sum("price_rows").alias("price_rows"),
        F.sum("items").alias("items_sold"),
    )
    return per_product.join(
        products.select("product_id", "product_category_name"), "product_id"
    ).select(
        "product_id",
        "product_category_name",
        "orders_count",
        "customers_count",
        from_cents(F.col("gross")).alias("total_revenue"),
        from_cents(F.col("price_sum")).alias("product_revenue"),
        from_cents(F.col("freight_sum")).alias("freight_revenue"),
        per(from_cents(F.col("price_sum")), F.col("price_rows")).alias("avg_price"),
        "items_sold",
    )


def delivery_figures(orders: DataFrame, late_days: int = LATE_DAYS) -> DataFrame:
    """Orders with known delivery days: order_id, customer_id, days, late (0 or 1)."""
    return orders.filter(F.col("delivery_time_days").isNotNull()).select(
        "order_id",
        "customer_id",
        F.col("delivery_time_days").cast("bigint").alias("days"),
        is_late(late_days).cast("bigint").alias("late"),
    )


def delivery_analysis(
    orders: DataFrame,
    customers: DataFrame,
    items: DataFrame,
    products: DataFrame,
    late_days: int = LATE_DAYS,
) -> DataFrame:
    """Delivery per city and category. ``orders_count`` counts item rows, not orders."""
    lines = (
        categorised_items(items, products)
        .filter(F.col("product_category_name").isNotNull())
        .select("order_id", "product_category_name")
    )
    per_customer = (
        lines.join(delivery_figures(orders, late_days), "order_id")
        .groupBy("customer_id", "product_category_name")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.sum("days").alias("days"),
            F.sum("late").alias("late"),
        )
    )
    return _delivery_analysis(per_customer, customers)


def _delivery_analysis(per_customer: DataFrame, customers: DataFrame) -> DataFrame:
    cities = customers.filter(F.col("customer_city").isNotNull()).select("customer_id", "customer_city")
    return (
        per_customer.join(cities, "customer_id")
        .groupBy("customer_city", "product_category_name")
        .agg(
            F.sum("n_rows").alias("orders_count"),
            F.sum("days").alias("days"),
            F.sum("late").alias("late"),
        )
        .select(
            "customer_city",
            "product_category_name",
            "orders_count",
            per(F.col("days"), F.col("orders_count")).alias("avg_delivery_days"),
            percent(F.col("late"), F.col("orders_count")).alias("late_delivery_percent"),
        )
    )


# --- all marts from one staged table ---------------------------------------------------------------


def sales_lines(
    orders: DataFrame, items: DataFrame, products: DataFrame, late_days: int = LATE_DAYS
) -> DataFrame:
    """Sales per order and product, with all that the marts need.

    Joining items and orders is the one large shuffle behind every mart. Staged once, this table serves them
    all without repeating it. ``new_order`` is 1 on one line of each order and ``new_in_category`` on one line of
    each order and category (lines of unknown products apart), so distinct orders become plain sums. Both rest on the partitioning by order that the
    join leaves, and on one sort.
    """
    per_order = orders.select(
        "order_id",
        "customer_id",
        "order_purchase_timestamp",
        F.col("delivery_time_days").cast("bigint").alias("days"),
        is_late(late_days).cast("bigint").alias("late"),
    )
    categories = products.select("product_id", "product_category_name", F.lit(True).alias("known_product"))
    keys = ["order_id", *per_order.columns[1:], "product_id", "product_category_name", "known_product"]
    lines = (
        _narrow_items(items)
        .join(categories, "product_id", "left")
        .join(per_order.hint("merge"), "order_id")
        .groupBy(*keys)
        .agg(*_narrow_item_sums(), F.count(F.lit(1)).alias("n_rows"))
    )
    in_category = Window.partitionBy("order_id", "known_product", "product_category_name").orderBy("product_id")
    in_order = Window.partitionBy("order_id").orderBy("known_product", "product_category_name", "product_id")
    return lines.withColumns(
        {
            "new_in_category": (F.row_number().over(in_category) == 1).cast("int"),
            "new_order": (F.row_number().over(in_order) == 1).cast("int"),
        }
    )


def marts_of_lines(lines: DataFrame, customers: DataFrame, products: DataFrame) -> dict[str, DataFrame]:
    """The four marts from staged sales lines, equal to the ones built directly."""
    purchased = F.col("order_purchase_timestamp")
    in_category = lines.filter(F.col("product_category_name").isNotNull())
    daily = in_category.withColumnRenamed("new_in_category", "orders").withColumn(
        "order_date", purchased.cast("date")
    )
    weekly = lines.groupBy("customer_id", week_start(purchased).alias("week_start")).agg(
        F.sum("new_order").alias("orders"),
        F.sum("gross").alias("gross"),
        F.sum("gross_rows").alias("gross_rows"),
        F.sum("items").alias("items"),
    )
    delivery = (
        in_category.filter(F.col("days").isNotNull())
        .groupBy("customer_id", "product_category_name")
        .agg(
            F.sum("n_rows").alias("n_rows"),
            F.sum(F.col("days") * F.col("n_rows")).alias("days"),
            F.sum(F.col("late") * F.col("n_rows")).alias("late"),
        )
    )
    return {
        "mart_daily_category": _daily_category(daily),
        "mart_weekly_city": _weekly_city(weekly, customers),
        "mart_product_performance": _product_performance(lines.filter("known_product"), products),
        "mart_delivery_analysis": _delivery_analysis(delivery, customers),
    }
