"""Cleaning rules on hand-made rows."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from marketlens.operators import clean
from marketlens.operators.skew import members_of_repeated_groups
from marketlens.sources.readers import FILE_ORDER

CUSTOMER = f"customer_id int, customer_unique_id string, {FILE_ORDER} int"


@pytest.fixture
def customers(spark):
    rows = [(1, "a", 1), (2, "a", 2), (3, "b", 3), (4, None, 4), (5, None, 5)]
    return spark.createDataFrame(rows, CUSTOMER)


def ids(df, name="customer_id"):
    return sorted(r[name] for r in df.collect())


def test_keep_first_keeps_the_first_row_of_every_key(customers):
    assert ids(clean.deduplicate_customers(customers)) == [1, 3, 4]


def test_keep_first_follows_the_file_order(spark):
    rows = [(1, "a", 2), (2, "a", 1)]
    assert ids(clean.deduplicate_customers(spark.createDataFrame(rows, CUSTOMER))) == [2]


def test_repeated_members_and_groups(customers):
    assert ids(clean.repeated_customers(customers)) == [1, 2, 4, 5]
    groups = clean.repeated_groups(customers, "customer_unique_id").collect()
    assert [tuple(r) for r in groups] == [("a", 2)]


def test_repeated_members_with_hot_and_cold_keys(spark):
    hot = spark.range(3000).select(F.lit(-1).cast("bigint").alias("k"), F.col("id").alias("v"))
    cold = spark.range(4000).select((F.col("id") / 2).cast("bigint").alias("k"), F.col("id").alias("v"))
    single = spark.range(10000, 12000).select(F.col("id").alias("k"), F.col("id").alias("v"))
    df = hot.union(cold).union(single)
    found = members_of_repeated_groups(df, ["k"])
    assert found.count() == 7000
    assert found.filter("k = -1").count() == 3000
    assert found.filter("k >= 10000").count() == 0


def place_frame(spark, rows):
    columns = "customer_id int, customer_unique_id string, customer_zip_code_prefix int, customer_city string"
    return spark.createDataFrame(rows, columns)


def test_dedup_report(spark):
    rows = [
        (1, "x", 9790, "Franca"),
        (2, "x", 9790, "Franca"),
        (3, "y", 9790, " franca\t"),
        (4, "z", 1, None),
        (5, "w", 1, None),
        (6, "v", 2, "osasco"),
    ]
    df = place_frame(spark, rows)
    lines = [r.line for r in clean.dedup_report(df).orderBy("line_no").collect()]
    assert lines == [
        "Exact duplicates by customer_unique_id: 2 records",
        "  Affected unique customers: 1",
        "  Example duplicates: {'x': 2}",
        "Potential duplicates by city+zip: 4 records",
        "  Example: Franca 9790",
        "  Example:  franca\t 9790",
        "  Example: nan 1",
        "  Example: nan 1",
        "Removed duplicates: 1",
        "Final customer count: 5",
    ]
    kept = clean.deduplicate_customers(df)
    assert clean.potential_duplicates(kept).columns == df.columns
    counts = clean.dedup_counts(df).first()
    # Removed rows are the duplicate rows minus one kept row per duplicate key.
    assert counts.removed == counts.duplicate_rows - counts.duplicate_keys


def test_dedup_report_without_duplicates_or_place_columns(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "customer_id int, customer_unique_id string")
    lines = [r.line for r in clean.dedup_report(df).orderBy("line_no").collect()]
    assert lines == ["Removed duplicates: 0", "Final customer count: 2"]
    assert clean.potential_duplicates(df).count() == 0


def test_sellers_are_optional(spark):
    assert clean.deduplicate_sellers(None) is None
    sellers = spark.createDataFrame([("s", 1), ("s", 2), ("t", 1)], "seller_id string, n int")
    assert sorted(tuple(r) for r in clean.deduplicate_sellers(sellers).collect()) == [("s", 1), ("t", 1)]


@pytest.mark.parametrize(
    "raw, standard, strict",
    [
        ("CANCELED", "cancelled", "cancelled"),
        ("Processing", "approved", "approved"),
        ("invoiced", "approved", "approved"),
        ("created", "approved", "approved"),
        ("unavailable", "unknown", "unknown"),
        (None, "unknown", "unknown"),
        ("foo", "foo", "unknown"),
        ("Delivered", "delivered", "delivered"),
    ],
)
def test_status(spark, raw, standard, strict):
    df = spark.createDataFrame([(raw,)], "s string")
    row = df.select(
        clean.normalise_status(F.col("s")).alias("a"),
        clean.normalise_status(F.col("s"), strict=True).alias("b"),
    ).first()
    assert (row.a, row.b) == (standard, strict)


ORDER = (
    "order_id string, customer_id string, order_status string, "
    "order_purchase_timestamp string, order_delivered_customer_date string"
)


@pytest.fixture
def orders(spark):
    rows = [
        ("o1", "c1", "delivered", "2018-01-01 00:00:00", "2018-01-01 23:00:00"),
        ("o2", "c1", "delivered", "2018-01-01 00:00:00", "2018-01-02 01:00:00"),
        ("o3", "c2", "delivered", "2018-01-02 00:00:00", "2018-01-01 23:00:00"),
        ("o4", "c2", "shipped", "2018-01-02 00:00:00", None),
        ("o5", "c9", "shipped", "oops", "never"),
        ("o1", "c1", "shipped", "2018-01-05 00:00:00", None),
    ]
    return spark.createDataFrame(rows, ORDER)


@pytest.fixture
def known(spark):
    return spark.createDataFrame([("c1",), ("c2",)], "customer_id string")


def test_transform_orders(orders, known):
    rows = {r.order_id: r for r in clean.transform_orders(orders, known).collect()}
    assert sorted(rows) == ["o1", "o2", "o3", "o4"]
    assert {k: r.delivery_time_days for k, r in rows.items()} == {"o1": 0, "o2": 1, "o3": -1, "o4": 0}
    assert rows["o1"].order_purchase_timestamp == dt.datetime(2018, 1, 1)
    assert rows["o1"].order_status == "delivered"


def test_transform_orders_options(orders):
    rows = {r.order_id: r for r in clean.transform_orders(orders, undelivered="null").collect()}
    assert len(rows) == 5
    assert rows["o4"].delivery_time_days is None
    assert rows["o5"].order_purchase_timestamp is None
    with pytest.raises(ValueError):
        clean.transform_orders(orders, undelivered="skip")
    without_dates = clean.transform_orders(orders.drop("order_delivered_customer_date"))
    assert "delivery_time_days" not in without_dates.columns


def test_rejected_orders(orders, known, spark):
    rejected = clean.rejected_orders(orders, known)
    assert [r.order_id for r in rejected.collect()] == ["o5"]
    assert tuple(clean.rejected_report(rejected).first()) == (1, "c9")
    many = spark.range(11).select(F.col("id").cast("string").alias("customer_id"))
    assert tuple(clean.rejected_report(many).first()) == (11, None)
    assert tuple(clean.rejected_report(many.limit(0)).first()) == (0, None)


def test_bad_dates(orders):
    found = sorted(tuple(r) for r in clean.bad_dates(orders).collect())
    assert found == [
        ("o5", "order_delivered_customer_date", "never"),
        ("o5", "order_purchase_timestamp", "oops"),
    ]


def test_items(spark):
    rows = [
        (1, -1.0, 1.0),
        (2, 0.0, 1.0),
        (3, 0.01, 1.0),
        (4, None, 1.0),
        (5, math.nan, 1.0),
        (6, 5.0, -0.01),
        (7, 5.0, 1000.01),
        (8, 5.0, 0.0),
        (9, 5.0, 1000.0),
        (10, 5.0, None),
        (11, 0.0, 2000.0),
    ]
    items = spark.createDataFrame(rows, "order_item_id int, price double, freight_value double")
    kept = clean.transform_items(items)
    assert ids(kept, "order_item_id") == [3, 4, 5, 8, 9, 10]
    assert kept.filter("order_item_id = 5").first().price is None
    counts = clean.item_rule_counts(items).first()
    assert tuple(counts) == (11, 3, 2, 6)
    assert clean.transform_items(items.select("order_item_id")).count() == 11


def test_repeated_items(spark):
    rows = [("o", 1, "p", 2.0), ("o", 1, "p", 1.0), ("o", 2, "p", 1.0)]
    items = spark.createDataFrame(rows, "order_id string, order_item_id int, product_id string, price double")
    kept = clean.transform_items(items, drop_repeated=True)
    assert sorted((r.order_item_id, r.price) for r in kept.collect()) == [(1, 1.0), (2, 1.0)]


def test_shape_audit(spark, customers):
    rows = clean.shape_audit({"raw": {"c": customers}, "clean": {"c": customers.limit(2)}}).collect()
    assert sorted(tuple(r) for r in rows) == [("clean", "c", 2, 2), ("raw", "c", 5, 2)]
