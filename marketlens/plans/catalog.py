"""Named queries: (spark, folder of test tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens import jobs
from marketlens.operators import clean, cohort, dims, kpi, marts, quality, rfm, sla
from marketlens.session import apply_scale_settings, size_shuffles, work_dir
from marketlens.sources import adapter, bronze, readers, schemas, writers
from marketlens.sources.store import Store

# The orders of the test tables span 1995-01 to 2001-08.
RFM_SNAPSHOT = "2002-01-01"
# Ranks of approximate medians may be off by a hundredth of the rows.
MEDIAN_ACCURACY = 100
# The columns of the tables are packed some ten times denser than the rows that are shuffled.
INPUT_MB_OF_A_PARTITION = 4

TOP_CATEGORIES_SQL = """
SELECT p.product_category_name,
       CAST(SUM(CAST(i.price AS DECIMAL(18,2)) + CAST(i.freight_value AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
       COUNT(DISTINCT i.order_id) AS orders_count
FROM {items} i
JOIN {products} p ON i.product_id = p.product_id
LEFT SEMI JOIN {orders} o ON o.order_id = i.order_id
GROUP BY p.product_category_name
ORDER BY revenue DESC, p.product_category_name
LIMIT :top_n
"""


class Tables:
    """Raw, cleaned and mart tables of one folder of test tables, each built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = apply_scale_settings(spark), sf_dir
        size_shuffles(spark, adapter.input_gb(spark, sf_dir), INPUT_MB_OF_A_PARTITION)

    @cached_property
    def customers_raw(self) -> DataFrame:
        return adapter.customers_raw(self.spark, self.sf_dir)

    @cached_property
    def products_raw(self) -> DataFrame:
        return adapter.products_raw(self.spark, self.sf_dir)

    @cached_property
    def products(self) -> DataFrame:
        return clean.deduplicate_products(self.products_raw)

    @cached_property
    def items_raw(self) -> DataFrame:
        return adapter.items_raw(self.spark, self.sf_dir)

    @cached_property
    def orders_raw(self) -> DataFrame:
        return adapter.orders_raw(self.spark, self.sf_dir)

    @cached_property
    def sellers_raw(self) -> DataFrame:
        return adapter.sellers_raw(self.spark, self.sf_dir)

    @cached_property
    def customers(self) -> DataFrame:
        return clean.deduplicate_customers(self.customers_raw)

    @cached_property
    def items(self) -> DataFrame:
        return clean.transform_items(self.items_raw)

    @cached_property
    def orders(self) -> DataFrame:
        return clean.transform_orders(self.orders_raw, self.customers)

    @cached_property
    def orders_unfiltered(self) -> DataFrame:
        """Cleaned, but with the orders of removed customers."""
        return clean.transform_orders(self.orders_raw)

    @cached_property
    def rejected(self) -> DataFrame:
        return clean.rejected_orders(self.orders_raw, self.customers)

    @cached_property
    def daily_category(self) -> DataFrame:
        return marts.daily_category(self.orders, self.items, self.products)

    @cached_property
    def weekly_city(self) -> DataFrame:
        return marts.weekly_city(self.orders, self.customers, self.items)

    @cached_property
    def product_performance(self) -> DataFrame:
        return marts.product_performance(self.orders, self.items, self.products)

    @cached_property
    def delivery_analysis(self) -> DataFrame:
        return marts.delivery_analysis(self.orders, self.customers, self.items, self.products)

    @cached_property
    def lines(self) -> DataFrame:
        """The sales lines, which the mart job stores and from which the jobs' reports start."""
        return marts.sales_lines(self.orders, self.items, self.products)

    @cached_property
    def staged_marts(self) -> dict[str, DataFrame]:
        return marts.marts_of_lines(self.lines, self.customers, self.products)

    @cached_property
    def store(self) -> str:
        """The folder of the tables that the landing, cleaning and mart jobs store, filled when first asked for."""
        return self._stored()

    def _stored(self) -> str:
        base = work_dir(self.spark, "stored")
        bronze.land_frames(self.raw, base)
        jobs.store_silver(self.spark, base)
        jobs.store_marts(self.spark, base)
        return base

    @cached_property
    def updated_store(self) -> str:
        """The same after a later delivery of orders was merged into it."""
        base = self._stored()
        jobs.upsert_orders(self.spark, base, adapter.orders_delta(self.spark, self.sf_dir))
        return base

    @cached_property
    def landed(self) -> str:
        """The folder of a store into which raw files with unreadable values were landed."""
        folder, base = work_dir(self.spark, "raw-files"), work_dir(self.spark, "landed")
        adapter.write_raw_files(self.spark, self.sf_dir, folder)
        jobs.land_raw(self.spark, folder, base)
        return base

    @cached_property
    def cohort_counts(self) -> DataFrame:
        return cohort.cohort_counts(self.orders)

    @cached_property
    def cohort_retention(self) -> DataFrame:
        return cohort.cohort_retention(self.cohort_counts)

    @cached_property
    def sla_city(self) -> DataFrame:
        return sla.sla_city(self.orders, self.customers)

    @cached_property
    def sla_category(self) -> DataFrame:
        return sla.sla_category(self.orders, self.items, self.products)

    @cached_property
    def rfm_segments(self) -> DataFrame:
        return rfm.rfm_segments(rfm.rfm_scores(self.orders, self.items, RFM_SNAPSHOT))

    @cached_property
    def kpi_document(self) -> DataFrame:
        return self.kpi_document_of(self.orders)

    def kpi_document_of(self, orders: DataFrame) -> DataFrame:
        return kpi.kpi_document(
            kpi.overall(orders, self.items, self.customers),
            kpi.category_revenue(marts.product_performance(orders, self.items, self.products)),
            kpi.late_percent(orders),
            kpi.delivery_by_city(marts.delivery_analysis(orders, self.customers, self.items, self.products)),
            kpi.retention_record(
                cohort.average_retention(cohort.cohort_retention(cohort.cohort_counts(orders))), cohort.has_repeat_customers(orders)
            ),
        )

    @property
    def raw(self) -> dict[str, DataFrame]:
        return {
            "orders": self.orders_raw,
            "customers": self.customers_raw,
            "products": self.products_raw,
            "order_items": self.items_raw,
            "sellers": self.sellers_raw,
        }


def _items_with_orphans(t: Tables) -> DataFrame:
    """Items of which some point at a product that does not exist."""
    key = F.col("product_id")
    return t.items.withColumn("product_id", F.when(key % 500 == 3, -1).otherwise(key))


def _top_categories_by_sql(t: Tables) -> DataFrame:
    tables = {"items": t.items, "products": t.products, "orders": t.orders}
    return readers.query_tables(t.spark, TOP_CATEGORIES_SQL, tables, {"top_n": 5})


def _cohort_file(t: Tables) -> DataFrame:
    path = work_dir(t.spark, "cohort-csv")
    writers.save_csv(t.cohort_retention, path)
    return readers.read_published(t.spark, path, schemas.COHORT_FILE)


def _sla_file(t: Tables) -> DataFrame:
    path = work_dir(t.spark, "sla-csv")
    jobs.publish_sla(t.sla_city, t.sla_category, path)
    return readers.read_published(t.spark, path, schemas.SLA_FILE)


def _kpi_file(t: Tables) -> DataFrame:
    path, orders = work_dir(t.spark, "kpi-json"), work_dir(t.spark, "kpi-orders")
    # Six parts of the document read the cleaned orders; stored, they are cleaned once.
    t.orders.write.parquet(orders)
    document = t.kpi_document_of(t.spark.read.schema(t.orders.schema).parquet(orders))
    writers.save_json(document, path)
    return kpi.kpi_long(t.spark.read.schema(document.schema).json(path))


def _report_file(t: Tables) -> DataFrame:
    path = work_dir(t.spark, "dedup-report")
    writers.save_report(clean.dedup_report(t.customers_raw), path)
    return t.spark.read.text(path).select(F.col("value").alias("line"))


def _stored_tables(t: Tables) -> DataFrame:
    return jobs.stored_audit(t.spark, t.store)


def _stored(name: str) -> Callable[[Tables], DataFrame]:
    return lambda t: readers.read_stored(t.spark, t.store, name).drop("order_month")


def _updated(name: str) -> Callable[[Tables], DataFrame]:
    return lambda t: readers.read_stored(t.spark, t.updated_store, name).drop("order_month")


def _rejected(t: Tables) -> DataFrame:
    return jobs.rejected_rows(*[readers.read_stored(t.spark, t.store, name) for name in ("rejected_orders", "rejected_items")])


def _observed_item_rules(t: Tables) -> DataFrame:
    figures = Store(t.spark, t.store).tables()["fact_order_items"]["figures"]
    return t.spark.createDataFrame(clean.item_rule_report(figures), jobs.ITEM_RULES)


def _approximate_medians(t: Tables) -> DataFrame:
    medians = sla.median_by_city(t.orders, t.customers, MEDIAN_ACCURACY)
    return sla.median_rank_check(medians, sla.city_histogram(t.orders, t.customers), "customer_city", MEDIAN_ACCURACY)


def _schema_drift(t: Tables) -> DataFrame:
    store = Store(t.spark, t.store)
    return quality.schema_drift({name: store.read(name) for name in schemas.DECLARED if store.has(name)}, schemas.DECLARED)


BY_TABLES: dict[str, Callable[[Tables], DataFrame]] = {
    # cleaning
    "clean_customers": lambda t: t.customers,
    "dup_customers_flag": lambda t: clean.repeated_customers(t.customers_raw),
    "dup_customer_groups": lambda t: clean.repeated_groups(t.customers_raw, "customer_unique_id"),
    "potential_dup_city_zip": lambda t: clean.potential_duplicates(t.customers),
    "dedup_report_counts": lambda t: clean.dedup_counts(t.customers_raw),
    "dedup_report_lines": lambda t: clean.dedup_report(t.customers_raw),
    "dedup_items_pk": lambda t: clean.transform_items(t.items_raw, drop_repeated=True),
    "dedup_sellers": lambda t: clean.deduplicate_sellers(t.sellers_raw),
    "clean_orders": lambda t: t.orders,
    "clean_orders_days_missing": lambda t: clean.transform_orders(
        t.orders_raw, t.customers, undelivered="null"
    ).select("order_id", "delivery_time_days"),
    "status_counts": lambda t: t.orders.groupBy("order_status").agg(F.count(F.lit(1)).alias("n_orders")),
    "status_strict": lambda t: t.orders_raw.groupBy(
        clean.normalise_status(F.col("order_status"), strict=True).alias("order_status")
    ).agg(F.count(F.lit(1)).alias("n_orders")),
    "orders_rejected_fk": lambda t: clean.rejected_report(t.rejected),
    "orders_rejected_rows": lambda t: t.rejected.select("order_id", "customer_id"),
    "bad_dates_log": lambda t: clean.bad_dates(t.orders_raw),
    "clean_items": lambda t: t.items,
    "item_rule_counts": lambda t: clean.item_rule_counts(t.items_raw),
    "stage_audit": lambda t: clean.shape_audit(
        {"raw": t.raw, "clean": clean_tables(t)}
    ),
    # quality
    "dq_pk_dups": lambda t: quality.repeated_keys(t.orders_raw, ["order_id"]),
    "dq_pk_dups_clean": lambda t: quality.repeated_keys(t.orders, ["order_id"]),
    "dq_fk_customer": lambda t: quality.orders_without_customer(t.orders_unfiltered, t.customers),
    "dq_statuses": lambda t: quality.statuses(t.orders),
    "dq_unexpected_status": lambda t: quality.unexpected_statuses(t.orders_raw),
    "dq_summary": lambda t: quality.quality_summary(
        t.orders_unfiltered, t.customers, t.items_raw, t.products_raw
    ),
    "dq_ranges": lambda t: quality.range_report(t.items_raw, t.products),
    "dq_fk_items": lambda t: quality.item_reference_report(_items_with_orphans(t), t.orders, t.products),
    "dq_date_logic": lambda t: quality.delivered_before_purchase(t.orders),
    # dimensions
    "dim_geography": lambda t: dims.dim_geography(t.customers),
    "dim_calendar": lambda t: dims.dim_calendar(t.orders),
    # marts
    "mart_daily_category": lambda t: t.daily_category,
    "mart_weekly_city": lambda t: t.weekly_city,
    "mart_product_performance": lambda t: t.product_performance,
    "mart_delivery_analysis": lambda t: t.delivery_analysis,
    "mart_daily_category_staged": lambda t: t.staged_marts["mart_daily_category"],
    "mart_weekly_city_staged": lambda t: t.staged_marts["mart_weekly_city"],
    "mart_product_performance_staged": lambda t: t.staged_marts["mart_product_performance"],
    "mart_delivery_analysis_staged": lambda t: t.staged_marts["mart_delivery_analysis"],
    # KPIs
    "kpi_gmv_totals": lambda t: kpi.gmv_totals(t.orders, t.items),
    "kpi_overall_staged": lambda t: kpi.overall_of_lines(t.lines, t.customers),
    "kpi_item_aov_staged": lambda t: kpi.item_kpis_of_lines(t.lines),
    "kpi_top_n_categories_staged": lambda t: kpi.top_categories_of_lines(t.lines, 10),
    "kpi_overall": lambda t: kpi.overall(t.orders, t.items, t.customers),
    "kpi_item_aov": lambda t: kpi.item_kpis(t.orders, t.items),
    "kpi_aov_order_total": lambda t: kpi.order_total_summary(t.orders, t.items),
    "kpi_top_categories": lambda t: kpi.category_revenue(t.product_performance),
    "kpi_top_n_categories": lambda t: kpi.top_categories(t.orders, t.items, t.products, 10),
    "kpi_top_n_categories_sql": _top_categories_by_sql,
    "kpi_top_products": lambda t: kpi.top_products(t.product_performance),
    "kpi_top_products_chart": lambda t: kpi.top_products(t.product_performance, 10),
    "kpi_top_cities": lambda t: kpi.top_cities(t.weekly_city),
    "kpi_top_cities_chart": lambda t: kpi.top_cities(t.weekly_city, 10),
    "kpi_daily_sales": lambda t: kpi.daily_sales(t.daily_category),
    "kpi_late_pct": lambda t: kpi.late_percent(t.orders),
    "kpi_delivery": lambda t: kpi.delivery_kpis(t.orders),
    "kpi_delivery_by_city": lambda t: kpi.delivery_by_city(t.delivery_analysis),
    "kpi_late_vs_promised": lambda t: kpi.late_versus_promised(t.orders),
    "kpi_record": lambda t: kpi.kpi_long(t.kpi_document),
    "kpi_report_lines": lambda t: kpi.kpi_report(t.kpi_document),
    "kpi_summary": lambda t: kpi.metrics_summary(t.orders, t.items),
    # cohorts
    "cohort_sizes_retention": lambda t: t.cohort_retention,
    "cohort_display": lambda t: cohort.retention_display(t.cohort_retention),
    "cohort_matrix_long": lambda t: cohort.retention_rates(t.cohort_counts),
    "cohort_matrix_pivot": lambda t: cohort.retention_matrix(t.cohort_counts),
    "cohort_avg_retention": lambda t: cohort.average_retention(t.cohort_retention),
    "cohort_by_unique_customer": lambda t: cohort.cohort_retention(
        cohort.cohort_counts_by_person(t.orders_unfiltered, t.customers_raw)
    ),
    "repeat_customers": lambda t: cohort.repeat_customers(t.orders),
    "retention_m0_m1": lambda t: cohort.retention_m0_m1(t.orders),
    # RFM
    "rfm_scores": lambda t: rfm.rfm_scores(t.orders, t.items, RFM_SNAPSHOT),
    "rfm_scores_staged": lambda t: rfm.rfm_scores_of_lines(t.lines, RFM_SNAPSHOT),
    "rfm_segments": lambda t: t.rfm_segments,
    "rfm_segment_counts": lambda t: rfm.segment_counts(t.rfm_segments),
    # delivery service level
    "sla_city": lambda t: t.sla_city,
    "sla_category": lambda t: t.sla_category,
    "sla_overall": lambda t: sla.sla_overall(t.orders),
    "sla_combined": lambda t: sla.sla_combined(t.sla_city, t.sla_category),
    "sla_top_cities": lambda t: sla.top_by_orders(t.sla_city, "customer_city"),
    "sla_top_categories": lambda t: sla.top_by_orders(t.sla_category, "product_category_name", 20),
    "sla_median_city": lambda t: sla.median_by_city(t.orders, t.customers),
    "sla_median_category": lambda t: sla.median_by_category(t.orders, t.items, t.products),
    "sla_median_city_approx": _approximate_medians,
    "kpi_summary_staged": lambda t: kpi.metrics_summary_of_lines(t.lines, t.orders),
    "orders_with_dates": lambda t: readers.with_parsed_dates(t.orders_raw, *clean.DATE_COLUMNS).select("order_id", *clean.DATE_COLUMNS),
    "sla_category_staged": lambda t: sla.sla_category_of_lines(t.lines),
    "sla_median_category_staged": lambda t: sla.median_by_category_of_lines(t.lines),
    "late_vs_promised_orders": lambda t: sla.late_versus_promised_orders(t.orders),
    # sinks, written to the shared work folder and read back
    "cohort_csv_published": _cohort_file,
    "sla_csv_published": _sla_file,
    "kpi_json_published": _kpi_file,
    "dedup_report_published": _report_file,
    "stored_table_counts": _stored_tables,
    **{f"stored_{name}": _stored(name) for name in [*jobs.SILVER, *jobs.MARTS]},
    # what the jobs count, reject and report while they store
    "stored_audit_observed": lambda t: jobs.observed_audit(t.spark, t.store),
    "stored_row_check": lambda t: jobs.row_check(jobs.observed_audit(t.spark, t.store)),
    "stored_rejected_rows": _rejected,
    "stored_item_rules_observed": _observed_item_rules,
    "stored_schema_drift": _schema_drift,
    # raw files with unreadable values, landed
    "landed_bad_values": lambda t: jobs.landed_bad_values(t.spark, t.landed),
    "landed_items": lambda t: bronze.raw_rows(Store(t.spark, t.landed).change())["order_items"].drop(readers.FILE_ORDER),
    # after a later delivery of orders
    "upsert_fact_orders": _updated("fact_orders"),
    **{f"refresh_{name}": _updated(name) for name in jobs.MARTS},
}


def clean_tables(t: Tables) -> dict[str, DataFrame]:
    return {
        "orders": t.orders,
        "customers": t.customers,
        "products": t.products,
        "order_items": t.items,
        "sellers": clean.deduplicate_sellers(t.sellers_raw),
    }


_tables: WeakKeyDictionary[SparkSession, dict[str, Tables]] = WeakKeyDictionary()


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The tables of a session and folder. Most are plans, of which only the analysis is shared. The stores behind the
    ``stored_``, ``landed_``, ``upsert_`` and ``refresh_`` queries are written once per session and folder; these queries
    read them."""
    by_folder = _tables.setdefault(spark, {})
    if sf_dir not in by_folder:
        by_folder[sf_dir] = Tables(spark, sf_dir)
    return by_folder[sf_dir]


def _bind(build: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    # select("*") gives a new DataFrame each time, so that every action on it runs its plan in full (reading the stores
    # that Tables keeps, where it starts from one).
    return lambda spark, sf_dir: build(tables(spark, sf_dir)).select("*")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _bind(build) for name, build in BY_TABLES.items()}
