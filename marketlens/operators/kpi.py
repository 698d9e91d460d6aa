"""KPI queries.

Several figures share a name in everyday use but are different numbers. They are kept apart here: AOV is GMV
per order (``overall``), mean of order totals (``order_total_summary``) or mean per item row
(``item_kpis``); ``top_products`` ranks products and shows their category; ``daily_sales`` counts an
order once per category.

Every top-k orders by its figure and then by its key, so that ties come out the same on each run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions.money import cents, from_cents, per, percent
from marketlens.functions.rounding import fixed_point, mean_of_fixed
from marketlens.operators.marts import (
    LATE_DAYS,
    categorised_items,
    is_late,
    order_totals,
)
from marketlens.sources.readers import has_columns

# Wording and number formats of the KPI report.
GMV_LINE = "GMV (Gross Merchandise Value): R$%,.2f"
AOV_LINE = "AOV (Average Order Value): R$%,.2f"
ORDERS_LINE = "Total Orders: %,d"
CUSTOMERS_LINE = "Unique Customers: %,d"
ORDERS_PER_CUSTOMER_LINE = "Orders per Customer: %.2f"
RETENTION_TITLE = " COHORT RETENTION:"
RETENTION_LINE = "M0 → M1 Retention: %s"
RETENTION_NOTE_LINE = "Note: %s"
DELIVERY_TITLE = " DELIVERY PERFORMANCE:"
LATE_LINE = "Late Delivery Rate (>30 days): %.2f%%"
CITIES_TITLE = "Average Delivery Time by Top Cities:"
CITY_LINE = "  %s: %.1f days (%,d orders)"
NO_CITIES_LINE = "Delivery time by city: Data not available"
CATEGORIES_TITLE = " TOP CATEGORIES BY REVENUE:"
CATEGORY_LINE = "%2d. %-30s R$%,12.2f"
NO_CATEGORIES_LINE = "No category data available"
RULE_LINE = "-" * 40
NO_REPEAT_NOTE = "All customers made only one purchase (no repeat buyers in dataset)"
REPEAT_NOTE = "Unweighted mean of the month-1 retention of all cohorts"


def _top(df: DataFrame, figure: str, key: str, k: int | None) -> DataFrame:
    return df if k is None else df.orderBy(F.col(figure).desc(), key).limit(k)


# --- sales ---------------------------------------------------------------------------------------


# ``of_lines`` variants start from the staged sales lines of the marts and need no join of items and orders.


def _orders_with_totals(orders: DataFrame, items: DataFrame) -> DataFrame:
    totals = order_totals(items).select("order_id", "gross", "gross_rows", F.lit(1).alias("new_order"))
    return totals.join(orders.select("order_id", "customer_id"), "order_id")


def _gmv(lines: DataFrame, *more: Column) -> DataFrame:
    return lines.agg(
        F.coalesce(F.sum("new_order"), F.lit(0)).alias("total_orders"),
        F.countDistinct("customer_id").alias("total_customers"),
        from_cents(F.sum("gross")).alias("gmv"),
        *more,
    )


def gmv_totals(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders with items, their customers, and GMV."""
    return _gmv(_orders_with_totals(orders, items))


def overall(orders: DataFrame, items: DataFrame, customers: DataFrame) -> DataFrame:
    """GMV and AOV (GMV per order, 0 without orders); customers are those of the dimension."""
    return overall_of_lines(_orders_with_totals(orders, items), customers)


def overall_of_lines(lines: DataFrame, customers: DataFrame) -> DataFrame:
    known = customers.agg(F.countDistinct("customer_unique_id")).scalar()
    average = F.when(F.col("total_orders") > 0, F.col("gmv") / F.nullif("total_orders", F.lit(0)))
    return _gmv(lines).select(
        "total_orders",
        known.alias("total_customers"),
        "gmv",
        average.otherwise(0.0).alias("aov"),
    )


def item_kpis(orders: DataFrame, items: DataFrame) -> DataFrame:
    """As ``gmv_totals``, with the mean amount per item row."""
    return item_kpis_of_lines(_orders_with_totals(orders, items))


def item_kpis_of_lines(lines: DataFrame) -> DataFrame:
    return _gmv(lines, per(from_cents(F.sum("gross")), F.sum("gross_rows")).alias("aov"))


def order_total_summary(orders: DataFrame, items: DataFrame) -> DataFrame:
    """All orders, with or without items: GMV, order and customer count, mean order total."""
    totals = order_totals(items).select("order_id", "gross")
    return (
        orders.select("order_id", "customer_id")
        .join(totals, "order_id", "left")
        .agg(
            from_cents(F.sum("gross")).alias("gmv"),
            F.count(F.lit(1)).alias("total_orders"),
            F.countDistinct("customer_id").alias("unique_customers"),
            per(from_cents(F.sum("gross")), F.count("gross")).alias("aov"),
        )
    )


def order_total_summary_of_lines(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """The same without a join: order totals from the lines, counts from the orders."""
    totals = lines.groupBy("order_id").agg(F.sum("gross").alias("gross"))
    counts = orders.agg(F.struct(F.count(F.lit(1)).alias("orders"), F.countDistinct("customer_id").alias("customers"))).scalar()
    sums = totals.agg(from_cents(F.sum("gross")).alias("gmv"), per(from_cents(F.sum("gross")), F.count("gross")).alias("aov"))
    both = sums.withColumn("counts", counts)
    return both.select("gmv", F.col("counts.orders").alias("total_orders"), F.col("counts.customers").alias("unique_customers"), "aov")


def category_revenue(product_mart: DataFrame, k: int | None = 10) -> DataFrame:
    """Top categories, rolled up from the product mart."""
    sums = (
        product_mart.filter(F.col("product_category_name").isNotNull())
        .groupBy("product_category_name")
        .agg(from_cents(F.sum(cents("total_revenue"))).alias("revenue"))
    )
    return _top(sums, "revenue", "product_category_name", k)


def top_categories(
    orders: DataFrame, items: DataFrame, products: DataFrame, k: int | None = 10
) -> DataFrame:
    """Top categories with revenue and distinct orders; the missing category counts as one."""
    per_order = (
        categorised_items(items, products)
        .join(orders.select("order_id"), "order_id", "left_semi")
        .groupBy("order_id", "product_category_name")
        .agg(F.sum("gross_cents").alias("gross"))
    )
    return _category_sums(per_order.withColumn("new_in_category", F.lit(1)), k)


def top_categories_of_lines(lines: DataFrame, k: int | None = 10) -> DataFrame:
    return _category_sums(lines.filter("known_product"), k)


def _category_sums(parts: DataFrame, k: int | None) -> DataFrame:
    sums = parts.groupBy("product_category_name").agg(
        from_cents(F.sum("gross")).alias("revenue"),
        F.sum("new_in_category").alias("orders_count"),
    )
    return _top(sums, "revenue", "product_category_name", k)


def top_products(product_mart: DataFrame, k: int | None = 15) -> DataFrame:
    """Top products, each shown with its category."""
    rows = product_mart.filter(F.col("product_category_name").isNotNull()).select(
        "product_id",
        "product_category_name",
        F.col("total_revenue").alias("revenue"),
        "orders_count",
    )
    return _top(rows, "revenue", "product_id", k)


def daily_sales(daily_mart: DataFrame) -> DataFrame:
    return (
        daily_mart.filter(F.col("order_date").isNotNull())
        .groupBy("order_date")
        .agg(
            from_cents(F.sum(cents("revenue"))).alias("revenue"),
            F.sum("orders_count").alias("orders_count"),
        )
    )


def top_cities(weekly_mart: DataFrame, k: int | None = 15) -> DataFrame:
    sums = (
        weekly_mart.filter(F.col("customer_city").isNotNull())
        .groupBy("customer_city")
        .agg(
            from_cents(F.sum(cents("revenue"))).alias("revenue"),
            F.sum("orders_count").alias("orders_count"),
        )
    )
    return _top(sums, "revenue", "customer_city", k)


# --- delivery ------------------------------------------------------------------------------------


def delivery_kpis(orders: DataFrame, late_days: int = LATE_DAYS) -> DataFrame:
    """Mean delivery days and late share over all orders with known days."""
    days = F.col("delivery_time_days").cast("bigint")
    n = F.count("delivery_time_days")
    return orders.agg(
        per(F.sum(days), n).alias("avg_delivery_days"),
        percent(F.count_if(is_late(late_days)), n).alias("late_delivery_rate"),
    )


def late_percent(orders: DataFrame, late_days: int = LATE_DAYS) -> DataFrame:
    return delivery_kpis(orders, late_days).select(
        F.col("late_delivery_rate").alias("late_delivery_percent")
    )


def late_versus_promised(orders: DataFrame) -> DataFrame:
    """Share of orders slower than promised, in percent with two decimals."""
    both = F.col("delivery_time_days").isNotNull() & F.col("promised_time_days").isNotNull()
    slower = F.col("delivery_time_days") > F.col("promised_time_days")
    return orders.filter(both).agg(
        F.round(percent(F.count_if(slower), F.count(F.lit(1))), 2).alias("late_delivery_percent")
    )


def delivery_by_city(delivery_mart: DataFrame, k: int | None = 5) -> DataFrame:
    """Top cities by item rows, with the unweighted mean of their per-category means.

    Without the needed columns the result is empty.
    """
    if not has_columns(delivery_mart, "customer_city", "avg_delivery_days", "orders_count"):
        schema = "customer_city string, avg_delivery_days double, total_orders bigint"
        return delivery_mart.sparkSession.createDataFrame([], schema)
    known = F.col("customer_city").isNotNull() & F.col("avg_delivery_days").isNotNull()
    sums = (
        delivery_mart.filter(known)
        .groupBy("customer_city")
        .agg(
            mean_of_fixed(fixed_point(F.col("avg_delivery_days"))).alias("avg_delivery_days"),
            F.sum("orders_count").alias("total_orders"),
        )
    )
    return _top(sums, "total_orders", "customer_city", k)


# --- assembly ------------------------------------------------------------------------------------


def retention_record(average_retention: DataFrame, repeat_customers: DataFrame) -> DataFrame:
    """Month-1 retention as text, from the cohort averages. The note says that nobody came back only if that is so
    (``cohort.has_repeat_customers``): a retention of 0 can also mean that customers came back later, or the same month."""
    rate = F.coalesce(F.col("avg_retention_month_1"), F.lit(0.0))
    return average_retention.select(
        F.format_string("%.1f%%", rate).alias("retention_m0_m1"),
        F.when(repeat_customers.scalar(), REPEAT_NOTE).otherwise(NO_REPEAT_NOTE).alias("note"),
    )


def _ranked_list(df: DataFrame, figure: str, key: str) -> Column:
    """A short top-k result as one sorted array of structs."""
    order = Window.orderBy(F.col(figure).desc(), key)
    entry = F.struct(*df.columns)
    return (
        df.select(F.struct(F.row_number().over(order).alias("rank"), entry.alias("entry")).alias("e"))
        .agg(F.transform(F.array_sort(F.collect_list("e")), lambda e: e["entry"]))
        .scalar()
    )


def kpi_document(
    basics: DataFrame,
    categories: DataFrame,
    late: DataFrame,
    cities: DataFrame,
    retention: DataFrame,
) -> DataFrame:
    """All KPIs as one nested row, ready for a JSON sink. Each part has one row or at most k."""
    return basics.select(
        F.struct("*").alias("basics"),
        _ranked_list(categories, "revenue", "product_category_name").alias("top_categories"),
        late.scalar().alias("late_delivery_percent"),
        _ranked_list(cities, "total_orders", "customer_city").alias("delivery_by_city"),
        retention.select(F.struct("retention_m0_m1", "note")).scalar().alias("retention"),
    )


def kpi_long(document: DataFrame) -> DataFrame:
    """The KPI row as (section, rank, name, value)."""

    def entry(section: str, rank: Column, name: Column, value: Column) -> Column:
        return F.struct(
            F.lit(section).alias("section"),
            rank.cast("int").alias("rank"),
            name.cast("string").alias("name"),
            value.cast("double").alias("value"),
        )

    basics = F.array(
        *[
            entry("basics", F.lit(0), F.lit(name), F.col(f"basics.{name}"))
            for name in ("total_orders", "total_customers", "gmv", "aov")
        ],
        entry("basics", F.lit(0), F.lit("late_delivery_percent"), F.col("late_delivery_percent")),
    )
    categories = F.transform(
        "top_categories",
        lambda c, i: entry("top_categories", i + 1, c["product_category_name"], c["revenue"]),
    )
    days = F.transform(
        "delivery_by_city",
        lambda c, i: entry("city_avg_delivery_days", i + 1, c["customer_city"], c["avg_delivery_days"]),
    )
    counts = F.transform(
        "delivery_by_city",
        lambda c, i: entry("city_total_orders", i + 1, c["customer_city"], c["total_orders"]),
    )
    return document.select(F.inline(F.concat(basics, categories, days, counts)))


def kpi_report(document: DataFrame) -> DataFrame:
    """The KPI row as report lines: line_no, line."""
    total = F.col("basics.total_orders")
    buyers = F.col("basics.total_customers")
    city_lines = F.transform(
        "delivery_by_city",
        lambda c: F.format_string(CITY_LINE, c["customer_city"], c["avg_delivery_days"], c["total_orders"]),
    )
    category_lines = F.transform(
        "top_categories",
        lambda c, i: F.format_string(CATEGORY_LINE, i + 1, c["product_category_name"], c["revenue"]),
    )

    def texts(*values: Column | str) -> Column:
        return F.array(*[F.lit(v) if isinstance(v, str) else v for v in values])

    lines = F.concat(
        texts(
            F.format_string(GMV_LINE, "basics.gmv"),
            F.format_string(AOV_LINE, "basics.aov"),
            F.format_string(ORDERS_LINE, total),
            F.format_string(CUSTOMERS_LINE, buyers),
            F.format_string(ORDERS_PER_CUSTOMER_LINE, F.try_divide(total, buyers)),
            "",
            RETENTION_TITLE,
            RULE_LINE,
            F.format_string(RETENTION_LINE, "retention.retention_m0_m1"),
            F.format_string(RETENTION_NOTE_LINE, "retention.note"),
            "",
            DELIVERY_TITLE,
            RULE_LINE,
            F.format_string(LATE_LINE, "late_delivery_percent"),
            "",
        ),
        F.when(F.size("delivery_by_city") > 0, F.concat(texts(CITIES_TITLE), city_lines)).otherwise(
            texts(NO_CITIES_LINE)
        ),
        texts("", CATEGORIES_TITLE, RULE_LINE),
        F.when(F.size("top_categories") > 0, category_lines).otherwise(texts(NO_CATEGORIES_LINE)),
    )
    return document.select(F.posexplode(lines).alias("pos", "line")).select(
        (F.col("pos") + 1).alias("line_no"), "line"
    )


def metrics_summary(orders: DataFrame, items: DataFrame) -> DataFrame:
    """The short KPI summary as (metric, value)."""
    return _metrics_summary(order_total_summary(orders, items), orders)


def metrics_summary_of_lines(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """The same from the staged sales lines."""
    return _metrics_summary(order_total_summary_of_lines(lines, orders), orders)


def _metrics_summary(row: DataFrame, orders: DataFrame) -> DataFrame:
    promised = late_versus_promised(orders).scalar()
    names = ["gmv", "total_orders", "unique_customers", "aov", "late_delivery_share"]
    row = row.withColumn("late_delivery_share", promised)
    entries = [
        F.struct(F.lit(name).alias("metric"), F.col(name).cast("double").alias("value")) for name in names
    ]
    return row.select(F.inline(F.array(*entries)))
