"""The TPC-H-like test tables seen as raw marketplace sources.

The test tables are clean: no NULLs, no orphans, no repeated orders or sellers. So the adapter keeps every
row and writes dirt into some of them by fixed arithmetic on the keys: shared customer identities,
padded and upper-case cities, missing categories, prices, statuses and delivery dates, unreadable
timestamps, items without number or of unknown products, and second copies of some orders and products and of all
sellers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.sources.store import Folder

# The columns used here. Naming them spares Spark the job that would look them up in the files.
COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_nationkey int",
    "supplier": "s_suppkey bigint, s_name string",
    "part": "p_partkey bigint, p_name string, p_type string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_extendedprice double, "
    "l_discount double, l_shipdate timestamp_ntz",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def input_gb(spark: SparkSession, sf_dir: str) -> float:
    """Size of the files of the tables used here. Only their lengths are looked up."""
    folder = Folder(spark, sf_dir)
    return sum(folder.size(f"{name}.parquet") for name in COLUMNS) / 2**30


def customers_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    places = _table(spark, sf_dir, "nation").join(
        _table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        _table(spark, sf_dir, "customer")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            key.alias("customer_id"),
            F.when(key % 33 == 32, key - 1).otherwise(key).alias("customer_unique_id"),
            (key % 40).cast("int").alias("customer_zip_code_prefix"),
            F.when(key % 50 == 49, None)
            .when(key % 2 == 0, F.concat(F.lit("  "), F.upper("n_name")))
            .otherwise(F.col("n_name"))
            .alias("customer_city"),
            F.col("r_name").alias("customer_state"),
        )
    )


def products_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    category = F.when(key % 50 == 49, None).otherwise(F.col("p_type"))
    copies = F.when(key % 40 == 7, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        _table(spark, sf_dir, "part")
        .withColumn("copy", F.explode(copies))
        .select(
            key.alias("product_id"),
            F.when(F.col("copy") == 0, category)
            .otherwise(F.concat(category, F.lit(" (second entry)")))
            .alias("product_category_name"),
            (F.length("p_name") + 100 * F.col("copy")).alias("product_name_length"),
        )
    )


def items_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.when(~((F.col("l_orderkey") % 37 == 5) & (F.col("l_linenumber") == 2)), F.col("l_linenumber")).alias(
            "order_item_id"
        ),
        F.when(F.col("l_partkey") % 211 == 9, -F.col("l_partkey")).otherwise(F.col("l_partkey")).alias("product_id"),
        F.when(F.col("l_partkey") % 97 == 5, None)
        .otherwise(F.col("l_extendedprice") - 1000)
        .alias("price"),
        (F.floor(F.col("l_extendedprice") * F.col("l_discount") * F.lit(10.0)) / F.lit(100.0)).alias(
            "freight_value"
        ),
    )


def orders_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    last_shipment = (
        _table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey"))
        .agg(F.max("l_shipdate").alias("last_shipdate"))
    )
    status = (
        F.when(key % 60 == 7, None)
        .when(key % 20 == 1, "Canceled")
        .when(key % 20 == 2, "INVOICED")
        .when(key % 20 == 3, "unavailable")
        .when(F.col("o_orderstatus") == "F", "Delivered")
        .when(F.col("o_orderstatus") == "O", "shipped")
        .otherwise("processing")
    )
    purchased = F.col("o_orderdate") + F.make_dt_interval(hours=(key % 24).cast("int"))
    copies = F.when(key % 50 == 13, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        _table(spark, sf_dir, "orders")
        .join(last_shipment, F.col("l_orderkey") == key, "left")
        .withColumn("copy", F.explode(copies))
        .select(
            key.alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            status.alias("order_status"),
            F.when(key % 101 == 100, "not-a-date")
            .otherwise(purchased.cast("string"))
            .alias("order_purchase_timestamp"),
            F.when(F.col("o_orderstatus") != "P", F.col("last_shipdate").cast("string")).alias(
                "order_delivered_customer_date"
            ),
            ((key * 37) % 1500 + F.col("copy") * 1500).cast("int").alias("promised_time_days"),
        )
    )


def sellers_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _table(spark, sf_dir, "supplier")
        .withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
        .select(
            F.col("s_suppkey").alias("seller_id"),
            F.when(F.col("copy") == 0, F.col("s_name"))
            .otherwise(F.concat(F.col("s_name"), F.lit(" (second entry)")))
            .alias("seller_name"),
        )
    )


# --- the same sources as CSV files, and a later delivery of orders ------------------------------------


def raw_lines(spark: SparkSession, sf_dir: str) -> list[tuple[str, str, DataFrame]]:
    """(source, header, lines) of raw files with values that cannot be read.

    Items come under two headers. By fixed arithmetic on the keys, numbers are words, infinite, NaN or fractions of
    whole numbers, and lines have too few or too many fields.
    """

    def line(*values) -> F.Column:
        return F.array_join(F.array(*[F.coalesce(v.cast("string"), F.lit("")) for v in values]), ",")

    items = items_raw(spark, sf_dir).filter("order_item_id IS NOT NULL")
    order, number, product = (F.col(c) for c in ("order_id", "order_item_id", "product_id"))
    price = (
        F.when(order % 97 == 11, "n/a").when(order % 89 == 7, "1e999").when(order % 83 == 3, "NaN").otherwise(F.col("price").cast("string"))
    )
    freight = F.col("freight_value")
    whole = line(order, number, product, price, freight)
    odd_line = (number == 1) & (order % 2 == 0)
    first = F.when(odd_line & (order % 51 == 9), line(order, number)).when(
        odd_line & (order % 53 == 9), line(order, number, product, F.lit("1.5"), F.lit("2.5"), F.lit("extra"))
    )
    customers = customers_raw(spark, sf_dir)
    key = F.col("customer_id")
    zip_code = F.when(key % 77 == 3, "unknown").otherwise(F.col("customer_zip_code_prefix").cast("string"))
    orders = orders_raw(spark, sf_dir)
    promised = F.when(order % 71 == 5, "soon").otherwise(F.col("promised_time_days").cast("string"))
    products = products_raw(spark, sf_dir)
    length = F.when(product % 61 == 4, "12.5").otherwise(F.col("product_name_length").cast("string"))
    names = {df: df.columns for df in (customers, orders, products)}
    return [
        ("order_items", "order_id,order_item_id,product_id,price,freight_value", items.filter(order % 2 == 0).select(F.coalesce(first, whole).alias("line"))),
        ("order_items", "product_id,order_id,order_item_id,freight_value,price", items.filter(order % 2 == 1).select(line(product, order, number, freight, price).alias("line"))),
        ("customers", ",".join(names[customers]), customers.select(line(key, F.col("customer_unique_id"), zip_code, F.col("customer_city"), F.col("customer_state")).alias("line"))),
        ("orders", ",".join(names[orders]), orders.select(line(*[F.col(c) for c in names[orders][:-1]], promised).alias("line"))),
        ("products", ",".join(names[products]), products.select(line(product, F.col("product_category_name"), length).alias("line"))),
    ]


def write_raw_files(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """The raw files of ``raw_lines`` as ``<folder>/<source>.csv``, a folder of files with a header each. No sellers."""
    plain = {"header": True, "sep": "\u0001", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    for source, header, lines in raw_lines(spark, sf_dir):
        lines.select(F.col("line").alias(header)).write.mode("append").options(**plain).csv(f"{folder}/{source}.csv")


def orders_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later delivery: every tenth order was delivered and moved by 40 days, every twentieth has a new order beside it."""
    orders = _table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    bought = F.col("o_orderdate") + F.make_dt_interval(days=F.lit(40))

    def delivery(order_id) -> list:
        return [
            order_id.alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.lit("Delivered").alias("order_status"),
            bought.cast("string").alias("order_purchase_timestamp"),
            (bought + F.make_dt_interval(days=F.lit(5))).cast("string").alias("order_delivered_customer_date"),
            F.lit(100).alias("promised_time_days"),
        ]

    changed = orders.filter(key % 10 == 3).select(*delivery(key))
    return changed.unionByName(orders.filter(key % 20 == 5).select(*delivery(key + 1_000_000_000)))
