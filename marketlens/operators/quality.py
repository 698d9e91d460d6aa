"""Data-quality checks. Every check returns its offending rows, all of them; callers limit."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from marketlens.functions.money import nan_to_null
from marketlens.operators.clean import MAX_FREIGHT
from marketlens.sources.readers import has_columns

# Statuses a cleaned order may have.
ALLOWED_STATUSES = ["delivered", "cancelled", "approved", "shipped", "unknown"]

# The checks of the summary, in its order, but for the ranges, which depend on the columns of the items.
CHECKS = [
    "pk_order_id",
    "pk_customer_id",
    "pk_product_id",
    "pk_order_item",
    "fk_customer",
    "fk_item_order",
    "fk_item_product",
    "allowed_status",
    "delivered_before_purchase",
]


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Primary-key check: keys that occur more than once, with their count ``c``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > 1)


def missing_reference(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Foreign-key check: child rows without a parent (a NULL key has none)."""
    return child.join(parent.select(key), key, "left_anti")


def orders_without_customer(orders: DataFrame, customers: DataFrame, limit: int | None = 5) -> DataFrame:
    found = missing_reference(orders, customers, "customer_id").select("order_id")
    return found if limit is None else found.orderBy("order_id").limit(limit)


def missing_reference_counts(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Orphan keys with their number of child rows, added up before the join."""
    per_key = child.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    return per_key.join(parent.select(key), key, "left_anti")


def item_reference_report(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Items without order and items without product: relation, orphan_keys, orphan_rows."""

    def summed(parent: DataFrame, key: str, relation: str) -> DataFrame:
        return missing_reference_counts(items, parent, key).agg(
            F.lit(relation).alias("relation"),
            F.count(F.lit(1)).alias("orphan_keys"),
            F.coalesce(F.sum("n_rows"), F.lit(0)).alias("orphan_rows"),
        )

    return summed(orders, "order_id", "items->orders").unionByName(
        summed(products, "product_id", "items->products")
    )


def statuses(orders: DataFrame) -> DataFrame:
    return orders.select("order_status").distinct()


def unexpected_statuses(orders: DataFrame) -> DataFrame:
    """Statuses outside the allowed set; a missing status is unexpected too."""
    allowed = F.coalesce(F.col("order_status").isin(ALLOWED_STATUSES), F.lit(False))
    return statuses(orders).filter(~allowed)


def _range_rules(items: DataFrame) -> dict[str, Column]:
    price, freight = nan_to_null(F.col("price")), nan_to_null(F.col("freight_value"))
    rules = {}
    if has_columns(items, "price"):
        rules["price"] = price <= 0
    if has_columns(items, "freight_value"):
        rules["freight_value"] = (freight < 0) | (freight > MAX_FREIGHT)
    return rules


def range_report(items: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """Out-of-range values per column: column_name, n_bad, n_missing.

    ``product_weight_g`` is checked when the products have it.
    """

    def counted(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
        figures = [
            F.struct(
                F.lit(name).alias("column_name"),
                F.count_if(bad).alias("n_bad"),
                F.count_if(nan_to_null(F.col(name)).isNull()).alias("n_missing"),
            )
            for name, bad in rules.items()
        ]
        return df.agg(F.array(*figures).alias("f")).select(F.inline("f"))

    report = counted(items, _range_rules(items))
    if products is not None and "product_weight_g" in products.columns:
        weight = nan_to_null(F.col("product_weight_g").cast("double"))
        products = products.withColumn("product_weight_g", weight)
        report = report.unionByName(counted(products, {"product_weight_g": F.col("product_weight_g") <= 0}))
    return report


def delivered_before_purchase(orders: DataFrame) -> DataFrame:
    """Date-logic check: orders delivered before they were bought."""
    return orders.filter(F.col("delivery_time_days") < 0).select("order_id", "delivery_time_days")


def offenders(orders: DataFrame, customers: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """All rows and keys that fail a check: check_name, example (the offender as text)."""

    def shown(df: DataFrame, name: str | Column, *columns: str) -> DataFrame:
        parts = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns]
        return df.select(F.lit(name).alias("check_name"), F.concat_ws("/", *parts).alias("example"))

    keys = {"order_id": orders, "customer_id": customers, "product_id": products}
    found = [
        *[shown(repeated_keys(df, [key]), f"pk_{key}", key) for key, df in keys.items()],
        shown(repeated_keys(items, ["order_id", "order_item_id"]), "pk_order_item", "order_id", "order_item_id"),
        shown(orders_without_customer(orders, customers, None), "fk_customer", "order_id"),
        shown(missing_reference_counts(items, orders, "order_id"), "fk_item_order", "order_id"),
        shown(missing_reference_counts(items, products, "product_id"), "fk_item_product", "product_id"),
        shown(unexpected_statuses(orders), "allowed_status", "order_status"),
        shown(delivered_before_purchase(orders), "delivered_before_purchase", "order_id"),
    ]
    ranges = {f"range_{name}": bad for name, bad in _range_rules(items).items()}
    if ranges:
        flags = F.array(*[F.when(bad, F.lit(name)) for name, bad in ranges.items()])
        bad_items = items.select("order_id", "order_item_id", F.explode(F.array_compact(flags)).alias("rule"))
        found.append(shown(bad_items, F.col("rule"), "order_id", "order_item_id"))
    return reduce(DataFrame.unionByName, found)


def summary_of_offenders(offending: DataFrame, items: DataFrame, examples: int = 5) -> DataFrame:
    """One row per check: check_name, passed, n_bad, sample (first few offenders as text).

    One aggregation counts the offenders and one, limited per check before the shuffle, shows the first. Both start from
    one exchange of the offenders, which Spark runs once, so the checks are not run again.
    """
    offending = offending.hint("rebalance", F.col("check_name"), F.col("example"))
    rank = F.row_number().over(Window.partitionBy("check_name").orderBy("example"))
    counts = offending.groupBy("check_name").agg(F.count(F.lit(1)).alias("n_bad"))
    firsts = (
        offending.withColumn("rank", rank)
        .filter(F.col("rank") <= examples)
        .groupBy("check_name")
        .agg(F.array_join(F.array_sort(F.collect_list("example")), ", ").alias("sample"))
    )
    checks = [*CHECKS, *[f"range_{name}" for name in _range_rules(items)]]
    names = offending.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, checks))).alias("check_name"))
    n_bad = F.coalesce("n_bad", F.lit(0))
    return (
        names.join(counts, "check_name", "left")
        .join(firsts, "check_name", "left")
        .select("check_name", (n_bad == 0).alias("passed"), n_bad.alias("n_bad"), F.coalesce("sample", F.lit("")).alias("sample"))
    )


def quality_summary(
    orders: DataFrame,
    customers: DataFrame,
    items: DataFrame,
    products: DataFrame,
    examples: int = 5,
) -> DataFrame:
    """The summary without a stored table in between."""
    return summary_of_offenders(offenders(orders, customers, items, products), items, examples)


def schema_drift(tables: dict[str, DataFrame], declared: dict[str, str]) -> DataFrame:
    """Where stored tables differ from their declared columns (DDL): table_name, column_name, problem, declared, found.

    The columns that are there come from the catalog. Problems: missing, extra, retyped; a table that is not there lacks
    all its columns.
    """
    spark = next(iter(tables.values())).sparkSession
    found = []
    for name, df in tables.items():
        view = f"drift_{name}"
        df.createOrReplaceTempView(view)
        found += [(name, c.name, c.dataType) for c in spark.catalog.listColumns(view)]
        spark.catalog.dropTempView(view)
    wanted = [(name, f.name, f.dataType.simpleString()) for name, ddl in declared.items() for f in _parse_datatype_string(ddl).fields]
    names = "table_name string, column_name string"
    there = spark.createDataFrame(found, f"{names}, found string")
    asked = spark.createDataFrame(wanted, f"{names}, declared string")
    problem = (
        F.when(F.col("found").isNull(), "missing").when(F.col("declared").isNull(), "extra").when(F.col("found") != F.col("declared"), "retyped")
    )
    both = asked.join(there, ["table_name", "column_name"], "full").withColumn("problem", problem)
    return both.filter("problem IS NOT NULL").select("table_name", "column_name", "problem", "declared", "found")
