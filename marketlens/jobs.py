"""Batch jobs: raw files to stored tables, marts and published reports.

    main(["all", "--raw", "<folder>", "--store", "<folder>", "--input-gb", "100000"])

Every stage reads what the stage before it stored, so a lost executor costs the tasks it ran and a failed
job restarts at its own stage. The tables of a stage are replaced together or not at all.
"""

from __future__ import annotations

import argparse
import dataclasses

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.functions.dates import month_start
from marketlens.operators import clean, cohort, dims, kpi, marts, quality, rfm, sla
from marketlens.session import apply_scale_settings, build_session, size_shuffles
from marketlens.sources import bronze, schemas
from marketlens.sources.readers import CSV, FILE_ORDER, read_csv_source, read_stored
from marketlens.sources.store import NO_VALUE, Change, Store
from marketlens.sources.writers import save_csv, save_json, save_report

MARTS = [
    "mart_daily_category",
    "mart_weekly_city",
    "mart_product_performance",
    "mart_delivery_analysis",
]
SILVER = [
    "fact_orders",
    "fact_order_items",
    "dim_customers",
    "dim_products",
    "dim_geography",
    "dim_calendar",
]
# Stored only when there are sellers.
OPTIONAL_SILVER = ["dim_sellers"]
BRONZE = [bronze.table_name(source) for source in schemas.RAW_SOURCES]

# Every customer id once, for looking orders up.
CUSTOMER_IDS = "stage_customer_ids"
# Sales per order and product. The mart job stores them; marts and reports start from them.
SALES_LINES = "stage_sales_lines"
# Rows that failed a check, as the quality job found them.
OFFENDERS = "quality_offenders"
MONTH = "order_month"
ITEM_RULES = "input_rows bigint, removed_price bigint, removed_freight bigint, kept_rows bigint"
# Session setting: "true" if quoted values of the raw files may hold line breaks.
MULTI_LINE = "spark.marketlens.csv.multiLine"


@dataclasses.dataclass(frozen=True)
class Options:
    """Rules that a run may choose. The defaults are those of the documented cleaning rules in everyday use."""

    strict_status: bool = False  # unlisted statuses become "unknown"
    drop_repeated_items: bool = False  # one row per (order_id, order_item_id)
    undelivered: str = "zero"  # or "null": delivery days of orders that were not delivered
    late_days: int = marts.LATE_DAYS
    top_n: int = 5
    snapshot: str = rfm.SNAPSHOT
    median_accuracy: int = 0  # 0: exact medians; otherwise the rank may be off by 1 / accuracy of the rows


def land_raw(spark: SparkSession, folder: str, store: str) -> None:
    bronze.land(spark, folder, store, spark.conf.get(MULTI_LINE, "false") == "true")


def _count_rules(*rules: str) -> dict[str, Column]:
    return {rule: F.count_if(F.col(clean.RULE) == rule) for rule in rules}


def _store_flagged(
    change: Change, df: DataFrame, name: str, rejected: str, rules: list[str], by: list[str], rebalance: bool
) -> None:
    """Write accepted and rejected rows in one pass, counted by rule, and publish them as two tables."""
    written = change.write(df, name, [clean.RULE, *by], rebalance, **_count_rules(clean.ACCEPTED, *rules))
    accepted = written.figures.get(clean.ACCEPTED, 0)
    columns = [c for c in df.columns if c not in (clean.RULE, *by)]
    change.publish(name, written, written.where(clean.RULE, lambda r: r == clean.ACCEPTED), columns, accepted)
    refused = written.where(clean.RULE, lambda r: r != clean.ACCEPTED)
    change.publish(rejected, written, refused, [*columns, clean.RULE], written.figures.get("n_rows", 0) - accepted)


def _with_month(df: DataFrame, date: str = "order_purchase_timestamp") -> DataFrame:
    return df.withColumn(MONTH, month_start(F.col(date)))


def store_silver(spark: SparkSession, store: str, options: Options = Options()) -> None:
    """Clean the landed sources and replace the silver tables, all together.

    Orders and items are written once each, the rejected ones beside the accepted ones. Orders lie by month.
    """
    apply_scale_settings(spark)
    with Store(spark, store).change() as change:
        raw = bronze.raw_rows(change)
        change.replace("dim_customers", clean.deduplicate_customers(raw["customers"]).drop(FILE_ORDER))
        customers = change.read("dim_customers")
        change.replace(CUSTOMER_IDS, customers.select("customer_id").distinct())
        orders = clean.flagged_orders(
            raw["orders"], change.lookup(CUSTOMER_IDS), strict_status=options.strict_status, undelivered=options.undelivered
        )
        orders = _with_month(orders.drop(FILE_ORDER))
        _store_flagged(change, orders, "fact_orders", "rejected_orders", [clean.NO_CUSTOMER], [MONTH], True)
        items = clean.flagged_items(raw["order_items"], options.drop_repeated_items).drop(FILE_ORDER)
        rules = [clean.BAD_PRICE, clean.BAD_FREIGHT, clean.REPEATED_ITEM]
        # Few items are rejected, so they need no shuffle to lie apart.
        _store_flagged(change, items, "fact_order_items", "rejected_items", rules, [], False)
        change.replace("dim_products", clean.deduplicate_products(raw["products"]).drop(FILE_ORDER))
        change.tables.pop("dim_sellers", None)
        sellers = clean.deduplicate_sellers(raw.get("sellers"))
        if sellers is not None:
            change.replace("dim_sellers", sellers.drop(FILE_ORDER))
        change.replace("dim_geography", dims.dim_geography(customers))
        change.replace("dim_calendar", dims.dim_calendar(change.read("fact_orders")))


def rejected_rows(orders: DataFrame, items: DataFrame) -> DataFrame:
    """The rejected orders and items with the rule that each broke first."""
    found = [df.withColumn("source", F.lit(name)) for name, df in (("orders", orders), ("order_items", items))]
    columns = ["source", clean.RULE, "order_id", "customer_id", "order_item_id", "product_id", "price", "freight_value"]
    return found[0].unionByName(found[1], allowMissingColumns=True).select(*columns)


def observed_audit(spark: SparkSession, store: str) -> DataFrame:
    """Rows and columns of all tables, as counted while they were written: no table is read."""
    tables = Store(spark, store).tables()
    stages = {"bronze": BRONZE, "silver": [*SILVER, *OPTIONAL_SILVER], "mart": MARTS}
    rows = [
        (stage, name, tables[name]["rows"], len([f for f in tables[name]["schema"]["fields"] if f["name"][0] != "_"]))
        for stage, names in stages.items()
        for name in names
        if name in tables
    ]
    return spark.createDataFrame(rows, "stage string, table_name string, n_rows bigint, n_columns int")


def row_check(audit: DataFrame) -> DataFrame:
    """Whether every table has rows."""
    return audit.select("stage", "table_name", (F.col("n_rows") > 0).alias("passed"))


def require_rows(audit: DataFrame) -> None:
    """Fail when a table of the audit is empty."""
    empty = [row.table_name for row in audit.filter(F.col("n_rows") == 0).collect()]
    if empty:
        raise ValueError(f"empty tables: {', '.join(empty)}")


def landed_bad_values(spark: SparkSession, store: str) -> DataFrame:
    """What could not be read in the landed sources: source, row_key, column_name, raw_value, problem."""
    landed, parts = Store(spark, store), []
    for source, schema in schemas.RAW_SOURCES.items():
        if landed.has(bronze.table_name(source)):
            found = clean.bad_values(landed.read(bronze.table_name(source)), schema, schemas.KEYS[source])
            parts.append(found.select(F.lit(source).alias("source"), "*"))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def run_etl(
    spark: SparkSession, raw_folder: str, store: str, reports: str | None = None, options: Options = Options()
) -> None:
    """Land the raw files and build the silver tables. The reports follow from what is stored."""
    land_raw(spark, raw_folder, store)
    store_silver(spark, store, options)
    if reports is None:
        return
    base = Store(spark, store)
    tables = base.tables()
    raw = bronze.raw_rows(base.change())
    save_csv(clean.rejected_report(base.read("rejected_orders")), f"{reports}/rejected_orders")
    save_report(clean.dedup_report(raw["customers"]), f"{reports}/dedup_report")
    save_csv(clean.bad_dates(raw["orders"]), f"{reports}/bad_dates")
    save_csv(landed_bad_values(spark, store), f"{reports}/bad_values")
    rules = clean.item_rule_report(tables["fact_order_items"]["figures"])
    save_csv(spark.createDataFrame(rules, ITEM_RULES), f"{reports}/item_rules")
    save_csv(observed_audit(spark, store), f"{reports}/audit")


def _silver(spark: SparkSession, store: str) -> dict[str, DataFrame]:
    apply_scale_settings(spark)
    base = Store(spark, store)
    return {
        "orders": base.read("fact_orders"),
        "customers": base.lookup("dim_customers"),
        "items": base.read("fact_order_items"),
        "products": base.lookup("dim_products"),
    }


def _store_derived_marts(change: Change, built: dict[str, DataFrame]) -> None:
    for name, mart in built.items():
        if name != "mart_daily_category":
            change.replace(name, mart)


def store_marts(spark: SparkSession, store: str, options: Options = Options()) -> None:
    """Stage the sales lines, then replace the four marts. Lines and the daily mart lie by month."""
    t = _silver(spark, store)
    with Store(spark, store).change() as change:
        lines = marts.sales_lines(t["orders"], t["items"], t["products"], options.late_days)
        change.replace(SALES_LINES, _with_month(lines), by=[MONTH])
        built = marts.marts_of_lines(change.read(SALES_LINES), t["customers"], t["products"])
        change.replace("mart_daily_category", _with_month(built["mart_daily_category"], "order_date"), by=[MONTH])
        _store_derived_marts(change, built)


def merged(stored: DataFrame, delta: DataFrame, key: str) -> DataFrame:
    """Stored rows with those of ``delta`` put in the place of, or added to, the ones with their keys."""
    return stored.join(delta.select(key), key, "left_anti").select(*stored.columns).unionByName(delta)


def touched_months(stored: DataFrame, delta: DataFrame) -> list[str]:
    """The months (as in the folder names) that hold a row of the delta's orders, before or after."""
    before = _with_month(stored.join(delta.select("order_id"), "order_id", "left_semi")).select(MONTH)
    found = before.unionByName(_with_month(delta).select(MONTH)).distinct().collect()
    return [str(row[MONTH]) if row[MONTH] is not None else NO_VALUE for row in found]


def upsert_orders(spark: SparkSession, store: str, delta: DataFrame, options: Options = Options()) -> list[str]:
    """Merge new and changed raw orders into the stored ones by key, and refresh what follows from them.

    Only the months that hold one of these orders, before or after, are read and written again: of the orders, of the
    sales lines and of the daily mart. The marts without months follow from the lines. All of it is published together.
    Orders of unknown customers are rejected and leave the stored order as it is. Returns the months.
    """
    apply_scale_settings(spark)
    base = Store(spark, store)
    with base.change() as change:
        flagged = clean.flagged_orders(
            delta, change.lookup(CUSTOMER_IDS), strict_status=options.strict_status, undelivered=options.undelivered
        )
        # Stored once, as it is used several times.
        staged = change.write(flagged.drop(FILE_ORDER), "stage_order_delta", [clean.RULE])
        change.publish("stage_order_delta", staged)
        new = change.lookup("stage_order_delta", lambda v: v[clean.RULE] == clean.ACCEPTED).drop(clean.RULE)
        months = touched_months(change.read("fact_orders"), new)

        def touched(values: dict[str, str]) -> bool:
            return values[MONTH] in months

        orders = merged(change.read("fact_orders", touched), new, "order_id")
        change.replace_partitions("fact_orders", _with_month(orders).withColumn(clean.RULE, F.lit(clean.ACCEPTED)), touched)
        if SALES_LINES in change.tables:
            _refresh_marts(change, touched, options)
        change.replace("dim_calendar", dims.dim_calendar(change.read("fact_orders")))
        del change.tables["stage_order_delta"]
    return months


def _refresh_marts(change: Change, touched, options: Options) -> None:
    orders, products = change.read("fact_orders", touched), change.lookup("dim_products")
    lines = marts.sales_lines(orders, change.read("fact_order_items"), products, options.late_days)
    change.replace_partitions(SALES_LINES, _with_month(lines), touched)
    customers = change.lookup("dim_customers")
    daily = marts.marts_of_lines(change.read(SALES_LINES, touched), customers, products)["mart_daily_category"]
    change.replace_partitions("mart_daily_category", _with_month(daily, "order_date"), touched)
    _store_derived_marts(change, marts.marts_of_lines(change.read(SALES_LINES), customers, products))


def stored_audit(spark: SparkSession, store: str) -> DataFrame:
    """Rows and columns of all stored tables, counted by reading them."""
    base = Store(spark, store)
    stages = {"silver": {name: base.read(name) for name in SILVER}, "mart": {name: base.read(name) for name in MARTS}}
    return clean.shape_audit(stages)


def run_quality(spark: SparkSession, store: str, reports: str) -> None:
    """Quality checks of the silver tables. The offending rows are found once and stored; counts and examples come from them."""
    t = _silver(spark, store)
    with Store(spark, store).change() as change:
        change.replace(OFFENDERS, quality.offenders(t["orders"], t["customers"], t["items"], t["products"]))
    save_csv(quality.summary_of_offenders(read_stored(spark, store, OFFENDERS), t["items"]), f"{reports}/quality")
    require_rows(observed_audit(spark, store))


def run_kpis(spark: SparkSession, store: str, reports: str, options: Options = Options()) -> None:
    """KPI record as JSON and as a text report, and the short summary."""
    t = _silver(spark, store)
    lines = read_stored(spark, store, SALES_LINES)
    retention = cohort.cohort_retention(cohort.cohort_counts(t["orders"]))
    document = kpi.kpi_document(
        kpi.overall_of_lines(lines, t["customers"]),
        kpi.category_revenue(read_stored(spark, store, "mart_product_performance")),
        kpi.late_percent(t["orders"]),
        kpi.delivery_by_city(read_stored(spark, store, "mart_delivery_analysis")),
        kpi.retention_record(cohort.average_retention(retention), cohort.has_repeat_customers(t["orders"])),
    )
    save_json(document, f"{reports}/kpi_record")
    stored = spark.read.schema(document.schema).json(f"{reports}/kpi_record")
    save_report(kpi.kpi_report(stored), f"{reports}/kpi_report")
    save_csv(kpi.metrics_summary_of_lines(lines, t["orders"]), f"{reports}/kpi_summary")
    save_csv(cohort.retention_m0_m1(t["orders"]).orderBy("cohort_month"), f"{reports}/retention_m0_m1")
    save_csv(kpi.top_categories_of_lines(lines, options.top_n), f"{reports}/top_categories")


def run_dashboard(spark: SparkSession, store: str, reports: str, options: Options = Options()) -> None:
    """The figures behind a sales and logistics dashboard."""
    t = _silver(spark, store)
    daily = kpi.daily_sales(read_stored(spark, store, "mart_daily_category"))
    save_csv(daily.orderBy("order_date"), f"{reports}/daily_sales")
    products = read_stored(spark, store, "mart_product_performance")
    save_csv(kpi.top_products(products), f"{reports}/top_products")
    save_csv(kpi.top_cities(read_stored(spark, store, "mart_weekly_city")), f"{reports}/top_cities")
    save_csv(kpi.item_kpis_of_lines(read_stored(spark, store, SALES_LINES)), f"{reports}/item_kpis")
    save_csv(kpi.delivery_kpis(t["orders"]), f"{reports}/delivery")


def run_cohorts(spark: SparkSession, store: str, reports: str, options: Options = Options()) -> None:
    """Cohort tables and the heat-map matrix. The counts (cohorts by months) are stored once; all else follows from them."""
    orders = read_stored(spark, store, "fact_orders")
    with Store(spark, store).change() as change:
        written = change.replace("cohort_counts", cohort.cohort_counts(orders), last=F.max("months_diff"))
        counts = change.read("cohort_counts")
        last = written.figures.get("last")
    retention = cohort.cohort_retention(counts)
    save_csv(retention.orderBy("cohort_month"), f"{reports}/cohort_retention")
    published = spark.read.schema(schemas.COHORT_FILE).options(**CSV)
    averages = cohort.average_retention(published.csv(f"{reports}/cohort_retention"))
    save_csv(averages, f"{reports}/cohort_averages")
    matrix = cohort.retention_matrix(counts, 0 if last is None else last)
    save_csv(matrix.orderBy("cohort_month"), f"{reports}/cohort_matrix")
    save_csv(cohort.repeat_customers(orders), f"{reports}/repeat_customers")


def run_person_cohorts(spark: SparkSession, store: str, reports: str, options: Options = Options()) -> None:
    """Retention of persons. It needs the orders of all their customer ids, so it starts from the landed rows."""
    raw = bronze.raw_rows(Store(spark, store).change())
    counts = cohort.cohort_counts_by_person(clean.transform_orders(raw["orders"]), raw["customers"])
    retention = cohort.cohort_retention(counts)
    save_csv(retention.orderBy("cohort_month"), f"{reports}/cohort_retention_by_person")


def run_rfm(spark: SparkSession, store: str, reports: str, options: Options = Options()) -> None:
    apply_scale_settings(spark)
    lines = read_stored(spark, store, SALES_LINES)
    with Store(spark, store).change() as change:
        change.replace("rfm_segments", rfm.rfm_segments(rfm.rfm_scores_of_lines(lines, options.snapshot)))
    counts = rfm.segment_counts(read_stored(spark, store, "rfm_segments"))
    save_csv(counts.orderBy(F.col("customers").desc(), "Segment"), f"{reports}/rfm_segment_counts")


def publish_sla(city: DataFrame, category: DataFrame, path: str) -> bool:
    """Write city and category rows as one CSV, unless one of the two is empty.

    They hold one row per city or category; persisting them spares the emptiness check a second run.
    """
    frames = [df.persist() for df in (city, category)]
    try:
        if any(df.isEmpty() for df in frames):
            return False
        order = [F.col("level").desc(), F.col("total_orders").desc(), "customer_city", "product_category_name"]
        save_csv(sla.sla_combined(*frames).orderBy(*order), path)
        return True
    finally:
        for df in frames:
            df.unpersist()


def run_sla(spark: SparkSession, store: str, reports: str, options: Options = Options()) -> None:
    """Delivery service level per city and category, their top slices, and medians."""
    t = _silver(spark, store)
    save_csv(sla.sla_overall(t["orders"]), f"{reports}/sla_overall")
    lines = read_stored(spark, store, SALES_LINES)
    with Store(spark, store).change() as change:
        change.replace("sla_city", sla.sla_city(t["orders"], t["customers"], options.late_days))
        change.replace("sla_category", sla.sla_category_of_lines(lines))
    city, category = read_stored(spark, store, "sla_city"), read_stored(spark, store, "sla_category")
    publish_sla(city, category, f"{reports}/sla_city_category")
    save_csv(sla.top_by_orders(city, "customer_city"), f"{reports}/sla_top_cities")
    save_csv(sla.top_by_orders(category, "product_category_name", 20), f"{reports}/sla_top_categories")
    accuracy = options.median_accuracy
    save_csv(sla.median_by_city(t["orders"], t["customers"], accuracy), f"{reports}/sla_median_city")
    save_csv(sla.median_by_category_of_lines(lines, accuracy), f"{reports}/sla_median_category")


def run_all(spark: SparkSession, raw_folder: str, store: str, reports: str, options: Options = Options()) -> None:
    apply_scale_settings(spark)
    run_etl(spark, raw_folder, store, reports, options)
    run_quality(spark, store, reports)
    store_marts(spark, store, options)
    require_rows(observed_audit(spark, store))
    for job in (run_kpis, run_dashboard, run_cohorts, run_person_cohorts, run_rfm, run_sla):
        job(spark, store, reports, options)


JOBS = {
    "etl": lambda spark, a, o: run_etl(spark, a.raw, a.store, a.reports, o),
    "quality": lambda spark, a, o: run_quality(spark, a.store, a.reports),
    "marts": lambda spark, a, o: store_marts(spark, a.store, o),
    "kpis": lambda spark, a, o: run_kpis(spark, a.store, a.reports, o),
    "dashboard": lambda spark, a, o: run_dashboard(spark, a.store, a.reports, o),
    "cohorts": lambda spark, a, o: run_cohorts(spark, a.store, a.reports, o),
    "person-cohorts": lambda spark, a, o: run_person_cohorts(spark, a.store, a.reports, o),
    "rfm": lambda spark, a, o: run_rfm(spark, a.store, a.reports, o),
    "sla": lambda spark, a, o: run_sla(spark, a.store, a.reports, o),
    "upsert-orders": lambda spark, a, o: upsert_orders(spark, a.store, _delta_orders(spark, a.raw), o),
    "clean-store": lambda spark, a, o: Store(spark, a.store).clean(),
    "all": lambda spark, a, o: run_all(spark, a.raw, a.store, a.reports, o),
}


def _delta_orders(spark: SparkSession, folder: str) -> DataFrame:
    multi_line = spark.conf.get(MULTI_LINE, "false") == "true"
    return read_csv_source(spark, f"{folder.rstrip('/')}/orders.csv", schemas.ORDERS, file_order=True, multi_line=multi_line)


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="marketlens.jobs")
    parser.add_argument("job", choices=list(JOBS))
    parser.add_argument("--raw", help="folder of the raw CSV files (etl, upsert-orders, all)")
    parser.add_argument("--store", required=True, help="folder of the stored tables")
    parser.add_argument("--reports", help="folder of the reports; default <store>/reports")
    parser.add_argument("--input-gb", type=float, default=0, help="size of the raw files, sizes the shuffles")
    parser.add_argument("--strict-status", action="store_true", help="unlisted order statuses become unknown")
    parser.add_argument("--drop-repeated-items", action="store_true", help="keep one row per order and item number")
    parser.add_argument("--undelivered", choices=["zero", "null"], default="zero", help="delivery days of undelivered orders")
    parser.add_argument("--late-days", type=int, default=marts.LATE_DAYS, help="more days than this are late")
    parser.add_argument("--top-n", type=int, default=5, help="categories in the top list")
    parser.add_argument("--snapshot", default=rfm.SNAPSHOT, help="day from which RFM counts back")
    parser.add_argument("--median-accuracy", type=int, default=0, help="0 for exact medians, else approximate ones")
    given = parser.parse_args(arguments)
    given.reports = given.reports or f"{given.store.rstrip('/')}/reports"
    if given.job in ("etl", "upsert-orders", "all") and given.raw is None:
        parser.error(f"--raw is needed for {given.job}")
    spark = apply_scale_settings(build_session())
    if given.input_gb:
        size_shuffles(spark, given.input_gb)
    options = Options(**{field.name: getattr(given, field.name) for field in dataclasses.fields(Options)})
    JOBS[given.job](spark, given, options)


if __name__ == "__main__":
    main()
