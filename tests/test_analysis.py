"""Marts, KPIs, cohorts, RFM, SLA and checks on hand-made rows, including empty input."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketlens.operators import cohort, dims, kpi, marts, quality, rfm, sla

ORDER = (
    "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, "
    "delivery_time_days int, promised_time_days int"
)
ITEM = "order_id string, order_item_id int, product_id string, price double, freight_value double"
CUSTOMER = "customer_id string, customer_unique_id string, customer_city string, customer_state string"
PRODUCT = "product_id string, product_category_name string"


def when(text):
    return dt.datetime.fromisoformat(text)


@pytest.fixture
def shop(spark):
    orders = [
        ("o1", "c1", "delivered", when("2017-12-31 23:00:00"), 30, 30),
        ("o2", "c1", "delivered", when("2018-01-01 00:00:00"), 31, 30),
        ("o3", "c2", "unknown", when("2018-01-02 10:00:00"), 0, None),
        ("o4", "c3", "cancelled", when("2018-01-02 11:00:00"), 5, 4),
        ("o5", "c4", None, None, 2, 9),
    ]
    items = [
        ("o1", 1, "p1", 10.0, 1.0),
        ("o1", 2, "p2", 20.0, None),
        ("o2", 1, "p1", 300.0, 0.01),
        ("o3", 1, "p3", 5.5, 0.5),
        ("o4", 1, "p1", None, 3.0),
        ("zz", 1, "p1", 99.0, 9.0),
    ]
    customers = [
        ("c1", "u1", "franca", "SP"),
        ("c2", "u2", "franca", "MG"),
        ("c3", "u3", None, "SP"),
        ("c4", "u3", "osasco", "SP"),
    ]
    products = [("p1", "toys"), ("p2", "toys"), ("p3", None)]
    return {
        "orders": spark.createDataFrame(orders, ORDER),
        "items": spark.createDataFrame(items, ITEM),
        "customers": spark.createDataFrame(customers, CUSTOMER),
        "products": spark.createDataFrame(products, PRODUCT),
    }


@pytest.fixture
def empty(spark):
    return {
        "orders": spark.createDataFrame([], ORDER),
        "items": spark.createDataFrame([], ITEM),
        "customers": spark.createDataFrame([], CUSTOMER),
        "products": spark.createDataFrame([], PRODUCT),
    }


def found(df, *key):
    return {tuple(r[k] for k in key): r for r in df.collect()}


def test_daily_category(shop):
    rows = found(marts.daily_category(shop["orders"], shop["items"], shop["products"]), "order_date")
    first = rows[(dt.date(2017, 12, 31),)]
    # The item without freight counts as an item but not in revenue or mean.
    assert (first.orders_count, first.customers_count, first.items_count) == (1, 1, 2)
    assert (first.revenue, first.avg_order_value) == (11.0, 11.0)
    assert rows[(dt.date(2018, 1, 2),)].revenue is None
    assert len(rows) == 3


def test_weekly_city(shop):
    rows = found(marts.weekly_city(shop["orders"], shop["customers"], shop["items"]), "week_start", "customer_city")
    assert set(rows) == {(dt.date(2017, 12, 25), "franca"), (dt.date(2018, 1, 1), "franca")}
    later = rows[(dt.date(2018, 1, 1), "franca")]
    assert (later.orders_count, later.customers_count, later.revenue, later.items_count) == (2, 2, 306.01, 2)


def test_product_performance(shop):
    rows = found(marts.product_performance(shop["orders"], shop["items"], shop["products"]), "product_id")
    assert rows[("p3",)].product_category_name is None
    p1 = rows[("p1",)]
    assert (p1.orders_count, p1.customers_count, p1.items_sold) == (3, 2, 3)
    assert (p1.total_revenue, p1.product_revenue, p1.freight_revenue, p1.avg_price) == (311.01, 310.0, 4.01, 155.0)


def test_delivery_analysis_counts_item_rows(shop):
    rows = marts.delivery_analysis(shop["orders"], shop["customers"], shop["items"], shop["products"]).collect()
    (row,) = rows
    assert (row.customer_city, row.product_category_name, row.orders_count) == ("franca", "toys", 3)
    assert row.avg_delivery_days == 91 / 3
    assert row.late_delivery_percent == 100.0 / 3


def test_kpis(shop):
    overall = kpi.overall(shop["orders"], shop["items"], shop["customers"]).first()
    assert tuple(overall) == (4, 3, 317.01, 317.01 / 4)
    items = kpi.item_kpis(shop["orders"], shop["items"]).first()
    assert tuple(items) == (4, 3, 317.01, 317.01 / 3)
    totals = kpi.order_total_summary(shop["orders"], shop["items"]).first()
    assert tuple(totals) == (317.01, 5, 4, 317.01 / 3)
    assert kpi.late_percent(shop["orders"]).first()[0] == 20.0
    assert kpi.late_versus_promised(shop["orders"]).first()[0] == 50.0
    top = kpi.top_categories(shop["orders"], shop["items"], shop["products"]).collect()
    assert [tuple(r) for r in top] == [("toys", 311.01, 3), (None, 6.0, 1)]


def test_daily_and_city_marts_agree_with_gmv(shop):
    products = shop["products"].fillna({"product_category_name": "none"})
    daily = marts.daily_category(shop["orders"], shop["items"], products)
    gmv = kpi.gmv_totals(shop["orders"], shop["items"]).first().gmv
    assert daily.agg(F.round(F.sum("revenue"), 2)).first()[0] == gmv


def test_staged_lines_give_the_same_figures(shop):
    orders, items, products = shop["orders"], shop["items"], shop["products"]
    lines = marts.sales_lines(orders, items, products).persist()
    pairs = [
        (kpi.overall(orders, items, shop["customers"]), kpi.overall_of_lines(lines, shop["customers"])),
        (kpi.item_kpis(orders, items), kpi.item_kpis_of_lines(lines)),
        (kpi.top_categories(orders, items, products), kpi.top_categories_of_lines(lines)),
        (rfm.rfm_scores(orders, items), rfm.rfm_scores_of_lines(lines)),
        (sla.sla_category(orders, items, products, min_rows=1), sla.sla_category_of_lines(lines, min_rows=1)),
        (sla.median_by_category(orders, items, products), sla.median_by_category_of_lines(lines)),
    ]
    for direct, staged in pairs:
        assert direct.columns == staged.columns
        assert sorted(map(str, direct.collect())) == sorted(map(str, staged.collect()))
    lines.unpersist()


def test_kpis_of_nothing(empty):
    overall = kpi.overall(empty["orders"], empty["items"], empty["customers"]).first()
    assert tuple(overall) == (0, 0, None, 0.0)
    assert kpi.late_percent(empty["orders"]).first()[0] is None
    assert tuple(sla.sla_overall(empty["orders"]).first()) == (0, 0, 0.0, 0.0)
    averages = cohort.average_retention(cohort.cohort_retention(cohort.cohort_counts(empty["orders"])))
    assert tuple(averages.first()) == (None, None, None, False)
    nobody = cohort.has_repeat_customers(empty["orders"])
    assert tuple(kpi.retention_record(averages, nobody).first()) == ("0.0%", kpi.NO_REPEAT_NOTE)


def test_the_note_on_repeat_customers_is_true(spark):
    """Somebody came back, but not in the month after the first: no retention, yet not only single purchases."""
    rows = [(1, 7, "delivered", dt.datetime(2018, 1, 2)), (2, 7, "delivered", dt.datetime(2018, 1, 20)), (3, 8, "cancelled", dt.datetime(2018, 1, 2))]
    orders = spark.createDataFrame(rows, "order_id int, customer_id int, order_status string, order_purchase_timestamp timestamp_ntz")
    averages = spark.createDataFrame([(None,)], "avg_retention_month_1 double")
    assert tuple(kpi.retention_record(averages, cohort.has_repeat_customers(orders)).first()) == ("0.0%", kpi.REPEAT_NOTE)
    once = orders.filter("order_id != 2")
    assert tuple(kpi.retention_record(averages, cohort.has_repeat_customers(once)).first()) == ("0.0%", kpi.NO_REPEAT_NOTE)


def test_delivery_by_city_needs_its_columns(spark):
    mart = spark.createDataFrame([("franca", "toys")], "customer_city string, product_category_name string")
    assert kpi.delivery_by_city(mart).count() == 0


def document(spark, categories, cities):
    basics = spark.createDataFrame(
        [(95378, 96096, 15349564.09, 160.93401088301286)],
        "total_orders bigint, total_customers bigint, gmv double, aov double",
    )
    late = spark.createDataFrame([(4.171869796869797,)], "late_delivery_percent double")
    averages = spark.createDataFrame([(0.0,)], "avg_retention_month_1 double")
    return kpi.kpi_document(
        basics,
        spark.createDataFrame(categories, "product_category_name string, revenue double"),
        late,
        spark.createDataFrame(cities, "customer_city string, avg_delivery_days double, total_orders bigint"),
        kpi.retention_record(averages, spark.createDataFrame([(False,)], "repeat_customers boolean")),
    )


def test_report_text(spark):
    doc = document(
        spark,
        [("cama_mesa_banho", 1177158.42), ("beleza_saude", 1405543.95)],
        [("rio de janeiro", 13.176134845147322, 7404), ("sao paulo", 6.788855394043674, 16822)],
    )
    lines = [r.line for r in kpi.kpi_report(doc).orderBy("line_no").collect()]
    assert lines == [
        "GMV (Gross Merchandise Value): R$15,349,564.09",
        "AOV (Average Order Value): R$160.93",
        "Total Orders: 95,378",
        "Unique Customers: 96,096",
        "Orders per Customer: 0.99",
        "",
        " COHORT RETENTION:",
        "-" * 40,
        "M0 → M1 Retention: 0.0%",
        "Note: All customers made only one purchase (no repeat buyers in dataset)",
        "",
        " DELIVERY PERFORMANCE:",
        "-" * 40,
        "Late Delivery Rate (>30 days): 4.17%",
        "",
        "Average Delivery Time by Top Cities:",
        "  sao paulo: 6.8 days (16,822 orders)",
        "  rio de janeiro: 13.2 days (7,404 orders)",
        "",
        " TOP CATEGORIES BY REVENUE:",
        "-" * 40,
        " 1. beleza_saude                   R$1,405,543.95",
        " 2. cama_mesa_banho                R$1,177,158.42",
    ]


def test_report_text_without_lists(spark):
    lines = [r.line for r in kpi.kpi_report(document(spark, [], [])).collect()]
    assert "Delivery time by city: Data not available" in lines
    assert "No category data available" in lines


def test_cohorts(shop):
    counts = cohort.cohort_counts(shop["orders"])
    rows = found(counts, "cohort_month", "order_month")
    december, january = dt.date(2017, 12, 1), dt.date(2018, 1, 1)
    assert {k: (r.n_customers, r.months_diff) for k, r in rows.items()} == {
        (december, december): (1, 0),
        (december, january): (1, 1),
        (january, january): (1, 0),
    }
    table = found(cohort.cohort_retention(counts), "cohort_month")
    assert tuple(table[("2017-12",)]) == ("2017-12", 1, 100.0, None, None)
    assert tuple(table[("2018-01",)]) == ("2018-01", 1, None, None, None)
    averages = cohort.average_retention(cohort.cohort_retention(counts)).first()
    assert tuple(averages) == (100.0, None, None, False)
    matrix = found(cohort.retention_matrix(counts, 1), "cohort_month")
    assert tuple(matrix[(january,)]) == (january, 100.0, 0.0)
    display = found(cohort.retention_display(cohort.cohort_retention(counts)), "cohort_month")
    assert tuple(display[("2018-01",)]) == ("2018-01", 1, 0.0, 0.0, 0.0)


def test_cohorts_by_person(spark, shop):
    orders = spark.createDataFrame(
        [
            ("a", "c3", "delivered", when("2018-01-05 00:00:00"), 1, None),
            ("b", "c4", "delivered", when("2018-02-05 00:00:00"), 1, None),
        ],
        ORDER,
    )
    by_id = cohort.cohort_retention(cohort.cohort_counts(orders)).collect()
    assert len(by_id) == 2
    (person,) = cohort.cohort_retention(cohort.cohort_counts_by_person(orders, shop["customers"])).collect()
    assert tuple(person) == ("2018-01", 1, 100.0, None, None)


def test_all_zero_retention(spark):
    table = spark.createDataFrame(
        [("2018-01", 5, 0.0, 0.0, 0.0)],
        "cohort_month string, cohort_size bigint, retention_month_1 double, retention_month_2 double, retention_month_3 double",
    )
    assert cohort.average_retention(table).first().all_zero is True


def test_repeat_customers(shop):
    (row,) = cohort.repeat_customers(shop["orders"]).collect()
    assert tuple(row) == ("c1", 2, 2, dt.date(2017, 12, 31), dt.date(2018, 1, 1))


def test_retention_m0_m1_counts_every_status(shop):
    rows = found(cohort.retention_m0_m1(shop["orders"]), "cohort_month")
    assert tuple(rows[(dt.date(2017, 12, 1),)])[1:] == (1, 1, 100.0)
    assert tuple(rows[(dt.date(2018, 1, 1),)])[1:] == (2, 0, 0.0)
    assert tuple(rows[(None,)])[1:] == (1, 0, 0.0)


def test_rfm(spark):
    orders = spark.createDataFrame(
        [
            ("a", "low", "delivered", when("2023-03-31 12:00:00"), 1, None),
            ("b", "high", "delivered", when("2023-03-30 00:00:00"), 1, None),
            ("c", "free", "delivered", None, 1, None),
            ("d", None, "delivered", when("2023-03-30 00:00:00"), 1, None),
        ],
        ORDER,
    )
    items = spark.createDataFrame(
        [("a", 1, "p", 300.0, 0.0), ("b", 1, "p", 300.0, 0.0), ("b", 2, "p", 0.01, 0.0), ("c", 1, "p", None, 0.0), ("d", 1, "p", 1.0, 0.0)],
        ITEM,
    )
    segments = rfm.rfm_segments(rfm.rfm_scores(orders, items))
    rows = found(segments, "customer_id")
    assert {k[0]: tuple(r)[1:] for k, r in rows.items()} == {
        "low": (0, 1, 300.0, "Low"),
        "high": (2, 2, 300.01, "High"),
        "free": (None, 1, 0.0, "Low"),
    }
    assert found(rfm.segment_counts(segments), "Segment")[("Low",)].customers == 2


def test_sla_thresholds(spark):
    def orders_of(city, n):
        return [(f"{city}{i}", f"c-{city}", "delivered", when("2018-01-01 00:00:00"), 31 if i == 0 else 30, None) for i in range(n)]

    orders = spark.createDataFrame(orders_of("nine", 9) + orders_of("ten", 10), ORDER)
    customers = spark.createDataFrame([("c-nine", "u", "nine", "S"), ("c-ten", "v", "ten", "S")], CUSTOMER)
    (city,) = sla.sla_city(orders, customers).collect()
    assert tuple(city) == ("ten", 10, 1, 30.1, 30.1, 10.0)
    items = spark.createDataFrame(
        [(f"nine{i}", 1, "p4", 1.0, 1.0) for i in range(4)] + [(f"ten{i}", 1, "p5", 1.0, 1.0) for i in range(5)], ITEM
    )
    products = spark.createDataFrame([("p4", "four"), ("p5", "five")], PRODUCT)
    category = sla.sla_category(orders, items, products)
    assert [tuple(r) for r in category.collect()] == [("five", 5, 1, 30.2, 20.0)]
    combined = found(sla.sla_combined(sla.sla_city(orders, customers), category), "level")
    assert combined[("city",)].product_category_name is None
    assert combined[("category",)].customer_city is None
    assert combined[("category",)].avg_delivery_days_not_null is None
    medians = found(sla.median_by_city(orders, customers), "customer_city")
    assert (medians[("nine",)].median_delivery_days, medians[("ten",)].total_orders) == (30.0, 10)


def test_median_of_an_even_group(spark, shop):
    medians = found(sla.median_by_category(shop["orders"], shop["items"], shop["products"]), "product_category_name")
    # toys: 30, 30, 31 and 5 days
    assert medians[("toys",)].median_delivery_days == 30.0


def test_promised(shop):
    rows = found(sla.late_versus_promised_orders(shop["orders"]), "order_id")
    assert {k[0]: r.is_late for k, r in rows.items()} == {"o1": False, "o2": True, "o4": True, "o5": False}


def test_dimensions(shop, empty):
    geography = found(dims.dim_geography(shop["customers"]), "city")
    assert {k[0]: r.state for k, r in geography.items()} == {"franca": "MG", "osasco": "SP"}
    calendar = dims.dim_calendar(shop["orders"]).orderBy("date").collect()
    assert [tuple(r) for r in calendar] == [
        (dt.date(2017, 12, 31), 52, 12, 2017),
        (dt.date(2018, 1, 1), 1, 1, 2018),
        (dt.date(2018, 1, 2), 1, 1, 2018),
    ]
    assert dims.dim_calendar(empty["orders"]).count() == 0


def test_quality(spark, shop):
    repeated = shop["orders"].union(shop["orders"].filter("order_id = 'o1'"))
    assert [tuple(r) for r in quality.repeated_keys(repeated, ["order_id"]).collect()] == [("o1", 2)]
    few = shop["customers"].filter("customer_id != 'c1'")
    assert [r.order_id for r in quality.orders_without_customer(shop["orders"], few).collect()] == ["o1", "o2"]
    assert [r.order_status for r in quality.unexpected_statuses(shop["orders"]).collect()] == [None]
    links = found(quality.item_reference_report(shop["items"], shop["orders"], shop["products"]), "relation")
    assert links[("items->orders",)].orphan_rows == 1
    assert links[("items->products",)].orphan_rows == 0
    weights = spark.createDataFrame([("p1", 0), ("p2", 5), ("p3", None)], "product_id string, product_weight_g int")
    ranges = found(quality.range_report(shop["items"], weights), "column_name")
    assert {k[0]: (r.n_bad, r.n_missing) for k, r in ranges.items()} == {
        "price": (0, 1),
        "freight_value": (0, 1),
        "product_weight_g": (1, 1),
    }


def test_quality_summary(shop):
    few = shop["customers"].filter("customer_id != 'c1'")
    rows = found(quality.quality_summary(shop["orders"], few, shop["items"], shop["products"]), "check_name")
    assert rows[("fk_customer",)].sample == "o1, o2"
    assert not rows[("fk_customer",)].passed
    assert rows[("pk_order_id",)].passed
    assert (rows[("allowed_status",)].n_bad, rows[("allowed_status",)].sample) == (1, "null")
    assert rows[("fk_item_order",)].sample == "zz"


def test_quality_summary_runs_the_checks_once(shop):
    summary = quality.quality_summary(shop["orders"], shop["customers"], shop["items"], shop["products"])
    summary.collect()
    text = summary._jdf.queryExecution().executedPlan().toString()
    assert text.split("== Initial Plan ==")[0].count("Union") == 1


def test_sales_lines_add_up_missing_amounts_and_item_numbers(spark):
    amounts = [(1, 1.0, 0.5), (None, 2.0, None), (3, None, 4.0), (4, None, None)]
    rows = [(1, number, product, price, freight) for product in (7, 8, None) for number, price, freight in amounts]
    rows += [(2, None, 7, 1.5, 0.25), (None, 1, 7, 9.0, 9.0), (3, 1, 7, 9.0, 9.0)]
    items = spark.createDataFrame(rows, "order_id long, order_item_id int, product_id long, price double, freight_value double")
    orders = spark.createDataFrame(
        [(1, 5, None, 40), (2, None, None, None), (None, 6, None, 1)],
        "order_id long, customer_id long, order_purchase_timestamp timestamp_ntz, delivery_time_days int",
    )
    products = spark.createDataFrame([(7, "a"), (8, None)], "product_id long, product_category_name string")
    figures = ["items", "gross", "gross_rows", "price_sum", "price_rows", "freight_sum", "n_rows"]
    lines = marts.sales_lines(orders, items, products).select("order_id", "product_id", *figures, "new_order", "new_in_category")
    found = sorted(map(tuple, lines.collect()), key=str)
    whole = (3, 150, 1, 300, 2, 450, 4)
    assert [row[:9] for row in found] == [(1, 7, *whole), (1, 8, *whole), (1, None, *whole), (2, 7, 0, 175, 1, 150, 1, 25, 1)]
    assert sum(row[9] for row in found) == 2
    assert [row[10] for row in found] == [1, 1, 1, 1]
    direct = marts.measured_items(items).groupBy("order_id", "product_id").agg(*marts.item_sums(), F.count(F.lit(1)).alias("n_rows"))
    assert set(map(tuple, lines.select("order_id", "product_id", *figures).collect())) <= set(map(tuple, direct.collect()))
