"""One key holds a third of all rows: results stay exact and no single task gets the key."""

import pytest
from pyspark.sql import functions as F

from marketlens.operators import clean, marts, skew

N_ORDERS = 60_000
N_ITEMS = 240_000
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    # Hot partitions are split between map outputs; keep as many of those as a real job has.
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def small_thresholds(spark):
    saved = {key: spark.conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key, value in saved.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def third(column, hot):
    """``hot`` for every third row."""
    return F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(column)


@pytest.fixture
def shop(spark, tmp_path):
    row = F.col("id")
    frames = {
        "orders": spark.range(0, N_ORDERS, 1, 8).select(
            row.alias("order_id"),
            third(row % 5000, 7).cast("bigint").alias("customer_id"),
            F.lit("delivered").alias("order_status"),
            F.concat(F.lit("2018-01-"), F.lpad((row % 28 + 1).cast("string"), 2, "0")).alias(
                "order_purchase_timestamp"
            ),
            F.lit("2018-03-01").alias("order_delivered_customer_date"),
        ),
        "items": spark.range(0, N_ITEMS, 1, 8).select(
            third(row % N_ORDERS, 11).cast("bigint").alias("order_id"),
            (row % 1000).cast("int").alias("order_item_id"),
            F.when(row % 3 == 1, 5).otherwise(row % 2000).cast("bigint").alias("product_id"),
            ((F.xxhash64("id") % 500_000 + 500_001) / 100).alias("price"),
            F.lit(1.0).alias("freight_value"),
        ),
        "products": spark.range(0, 2000, 1, 4).select(
            row.alias("product_id"), F.concat(F.lit("cat"), row % 7).alias("product_category_name")
        ),
        "customers": spark.range(0, 4000, 1, 4).select(
            row.alias("customer_id"),
            row.alias("customer_unique_id"),
            F.concat(F.lit("city"), row % 9).alias("customer_city"),
            F.lit("SP").alias("customer_state"),
        ),
    }
    for name, df in frames.items():
        df.write.parquet(str(tmp_path / name))
    return {name: spark.read.parquet(str(tmp_path / name)) for name in frames}


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_customer_splits(spark, shop, small_thresholds):
    orders = clean.transform_orders(shop["orders"], shop["customers"])
    text = final_plan(orders)
    assert "skew=true" in text
    known = shop["orders"].filter("customer_id < 4000").count()
    assert orders.count() == known
    # Not even when the operator above could have reused the partitioning.
    by_customer = orders.groupBy("customer_id").agg(F.max("order_id"))
    assert "skew=true" in final_plan(by_customer)


def test_hot_order_and_hot_product_split(spark, shop, small_thresholds):
    orders = clean.transform_orders(shop["orders"])
    orders.write.parquet((path := f"{spark.conf.get('spark.checkpoint.dir')}/skew-orders"), mode="overwrite")
    stored = spark.read.parquet(path)
    daily = marts.daily_category(stored, shop["items"], shop["products"])
    text = final_plan(daily)
    assert text.count("skew=true") >= 2
    joined = (
        shop["items"]
        .join(shop["products"], "product_id")
        .join(stored.select("order_id", "customer_id", "order_purchase_timestamp"), "order_id")
    )
    plain = joined.groupBy(
        F.col("order_purchase_timestamp").cast("date").alias("order_date"), "product_category_name"
    ).agg(
        F.countDistinct("order_id").alias("orders_count"),
        F.countDistinct("customer_id").alias("customers_count"),
        F.round(F.sum(F.col("price") + F.col("freight_value")), 2).alias("revenue"),
        F.count("order_item_id").alias("items_count"),
    )
    columns = plain.columns
    got = sorted(tuple(r) for r in daily.select(columns).collect())
    assert got == sorted(tuple(r) for r in plain.collect())


def test_hot_customer_meets_the_customer_table_as_few_rows(shop, small_thresholds):
    orders = clean.transform_orders(shop["orders"])
    weekly = marts.weekly_city(orders, shop["customers"], shop["items"])
    text = final_plan(weekly)
    assert "skew=true" not in text
    expected = (
        shop["items"]
        .join(orders, "order_id")
        .join(shop["customers"], "customer_id")
        .agg(F.round(F.sum(F.col("price") + F.col("freight_value")), 2))
        .first()[0]
    )
    assert weekly.agg(F.round(F.sum("revenue"), 2)).first()[0] == expected


def test_hot_keys_are_few(spark):
    counts = spark.range(100_000).select(F.col("id").alias("k"), F.lit(1).alias("n"))
    assert skew.hot_keys(counts, "n").count() == 0
    one_hot = counts.union(spark.createDataFrame([(-1, 50_000)], "k bigint, n int"))
    assert [r.k for r in skew.hot_keys(one_hot, "n").collect()] == [-1]


def test_hot_key_of_first_rows(spark):
    rows = spark.range(0, 90_000, 1, 8).select(
        third(F.col("id"), -1).alias("customer_unique_id"), F.col("id").alias("customer_id")
    )
    kept = clean.deduplicate_customers(rows)
    assert kept.count() == 60_001
    assert kept.filter("customer_unique_id = -1").first().customer_id == 0


def test_all_copies_of_one_row_are_flagged(spark):
    rows = spark.range(3000).select(F.lit("u").alias("customer_unique_id"), F.lit(1).alias("customer_id"))
    other = spark.range(6000).select(F.col("id").cast("string"), F.col("id").cast("int"))
    flagged = clean.repeated_customers(rows.union(other))
    assert flagged.count() == 3000
    assert flagged.distinct().count() == 1
