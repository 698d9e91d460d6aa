"""Physical plans: what must be in them and what must not."""

import re

import pytest
from compare import TESTDATA
from pyspark.sql import functions as F

from marketlens.operators import clean, marts
from marketlens.plans import catalog

SF_DIR = f"{TESTDATA}/sf0.001"
# These write files and read them back; the matrix looks its number of months up.
RUN_AT_BUILD = {
    "cohort_matrix_pivot",
    "cohort_csv_published",
    "sla_csv_published",
    "kpi_json_published",
    "dedup_report_published",
}
# So do the queries on stores that jobs fill.
STORED = ("stored_", "landed_", "upsert_", "refresh_")
LAZY = sorted(name for name in catalog.queries() if name not in RUN_AT_BUILD and not name.startswith(STORED))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_row_multiplying_or_python_nodes(spark, name):
    text = plan(catalog.queries()[name](spark, SF_DIR))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Expand", "Python", "Pandas"):
        assert node not in text, node


def test_building_a_query_runs_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "plans only")
    try:
        for name in LAZY:
            catalog.queries()[name](spark, SF_DIR)
        assert list(tracker.getJobIdsForGroup("building")) == []
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_scans_read_only_what_they_need(spark):
    t = catalog.Tables(spark, SF_DIR)
    text = t.sla_category._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    schemas = re.findall(r"ReadSchema: struct<(.*)>", text)
    part = [s for s in schemas if "p_partkey" in s]
    # The order in which the first of repeated products is kept takes in the length of the name.
    assert part == ["p_partkey:bigint,p_name:string,p_type:string"]
    assert "PushedFilters: [IsNotNull(p_partkey)" in text


def test_the_kpi_file_cleans_the_orders_once(spark, monkeypatch):
    written = []
    save = catalog.writers.save_json
    monkeypatch.setattr(catalog.writers, "save_json", lambda df, path: (written.append(df), save(df, path)))
    assert catalog.queries()["kpi_json_published"](spark, SF_DIR).count() > 0
    # Only the raw orders need the shipping dates of the items.
    assert "l_shipdate" not in plan(written[0])


def test_keep_first_limits_groups_before_the_shuffle(spark):
    text = plan(catalog.Tables(spark, SF_DIR).customers)
    assert re.search(r"WindowGroupLimit .* Partial", text)
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_top_k_does_not_sort_everything(spark):
    text = plan(catalog.queries()["kpi_top_products"](spark, SF_DIR))
    assert "TakeOrderedAndProject" in text


@pytest.fixture
def no_broadcast(spark):
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)


def test_items_cross_the_network_once_for_the_daily_mart(spark, no_broadcast, tmp_path):
    """Stored tables: items by product, items and orders by order, then two combined aggregations."""
    t = catalog.Tables(spark, SF_DIR)
    frames = {}
    for name in ("orders", "items", "products"):
        getattr(t, name).write.parquet(str(tmp_path / name))
        frames[name] = spark.read.parquet(str(tmp_path / name))
    text = plan(marts.daily_category(**frames))
    shuffles = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
    keys = sorted(re.sub(r"#\d+L?|, \d+$", "", s) for s in shuffles)
    assert keys == [
        "order_date, product_category_name",
        "order_date, product_category_name, customer_id",
        "order_id",
        "order_id",
        "product_id",
        "product_id",
    ]


def test_sales_lines_shuffle_the_items_once(spark, no_broadcast, tmp_path):
    t = catalog.Tables(spark, SF_DIR)
    frames = {}
    for name in ("orders", "items", "products"):
        getattr(t, name).write.parquet(str(tmp_path / name))
        frames[name] = spark.read.parquet(str(tmp_path / name))
    text = plan(marts.sales_lines(**frames))
    # Items and products by product, items and orders by order; roll-up and both windows add none.
    assert text.count("Exchange") == 4
    assert text.count("Window") == 2
    lines_path = str(tmp_path / "lines")
    marts.sales_lines(**frames).write.parquet(lines_path)
    lines = spark.read.parquet(lines_path)
    built = marts.marts_of_lines(lines, t.customers, frames["products"])
    assert "order_id" not in plan(built["mart_daily_category"])
    direct = t.daily_category
    assert built["mart_daily_category"].select(direct.columns).exceptAll(direct).count() == 0
    assert direct.exceptAll(built["mart_daily_category"].select(direct.columns)).count() == 0


def test_sales_lines_cross_by_order_once_even_where_the_orders_are_few(spark, tmp_path):
    """Were the orders broadcast, the roll-up and the windows would shuffle all lines, twice."""
    t = catalog.Tables(spark, SF_DIR)
    frames = {}
    for name in ("orders", "items", "products"):
        getattr(t, name).write.parquet(str(tmp_path / name))
        frames[name] = spark.read.parquet(str(tmp_path / name))
    text = plan(marts.sales_lines(**frames))
    keys = [re.sub(r"#\d+L?|, \d+$", "", s) for s in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)]
    assert keys == ["order_id", "order_id"]
    assert "gross_cents" not in text


def test_bucketed_tables_join_without_a_shuffle(spark, no_broadcast):
    from marketlens.sources.writers import save_catalog_table

    t = catalog.Tables(spark, SF_DIR)
    save_catalog_table(t.orders, "bucketed_orders", "order_id", 4)
    save_catalog_table(t.items, "bucketed_items", "order_id", 4)
    orders, items = spark.table("bucketed_orders"), spark.table("bucketed_items")
    joined = marts.order_totals(items).join(orders.select("order_id", "customer_id"), "order_id")
    assert "Exchange" not in plan(joined)
    direct = marts.order_totals(t.items).join(t.orders.select("order_id", "customer_id"), "order_id")
    assert joined.count() == direct.count()
    save_catalog_table(t.orders.limit(3), "bucketed_orders")
    assert spark.table("bucketed_orders").count() == 3


def test_marts_need_no_session_setting(spark):
    """The library sets only runtime options that keep Spark free to re-plan."""
    from marketlens.session import SCALE_SETTINGS

    assert all(key.startswith("spark.sql.adaptive.") for key in SCALE_SETTINGS)
    assert all(spark.conf.get(key) == value for key, value in SCALE_SETTINGS.items())


def test_status_map_is_a_literal(spark):
    df = spark.createDataFrame([("x",)], "s string").select(clean.normalise_status(F.col("s")))
    assert "PythonUDF" not in plan(df)
