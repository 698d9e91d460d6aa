"""Cleaning and conforming: deduplication, order and item rules, reject reports.

How these keep to one pass of bounded work per task when one key holds a large share of the rows:

* "keep first" is ``row_number() = 1``; Spark limits every group to one row before the shuffle
  (WindowGroupLimit), so a hot key sends one row per map task.
* "all members of repeated groups" treats hot keys apart, see ``skew``.
* Looking orders up among the customers is a shuffle join of two plain shuffles, the shape in which Spark
  splits a hot key at run time (AQE skew join), or a broadcast while the customers are below Spark's
  size threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from marketlens.functions.dates import floor_days, parse_timestamp
from marketlens.functions.money import nan_to_null
from marketlens.functions.text import strip_lower
from marketlens.operators.skew import members_of_repeated_groups
from marketlens.sources.readers import BAD_ROW, FILE_ORDER, has_columns

# Raw order status -> standard status. Other values stay as they are.
STATUS_MAP = {
    "canceled": "cancelled",
    "processing": "approved",
    "invoiced": "approved",
    "created": "approved",
    "unavailable": "unknown",
}
# Statuses the cleaning rules know; in strict mode all others become "unknown".
KNOWN_STATUSES = ["delivered", "cancelled", "shipped", "approved"]

# Fixed value: highest freight accepted as normal.
MAX_FREIGHT = 1000

# Wording of the deduplication report.
DUPLICATES_LINE = "Exact duplicates by customer_unique_id: %d records"
AFFECTED_LINE = "  Affected unique customers: %d"
EXAMPLES_LINE = "  Example duplicates: {%s}"
PLACES_LINE = "Potential duplicates by city+zip: %d records"
PLACE_LINE = "  Example: %s %s"
REMOVED_LINE = "Removed duplicates: %d"
FINAL_LINE = "Final customer count: %d"

# Fixed value: the reject report lists example customer ids up to this many rejected orders.
SHOW_REJECTED_UP_TO = 10

DATE_COLUMNS = ["order_purchase_timestamp", "order_delivered_customer_date"]


# --- deduplication -------------------------------------------------------------------------------


def row_order(df: DataFrame, keys: list[str]) -> list[str]:
    """Columns that fix which row of a group is first: file position if known, else all other columns."""
    if FILE_ORDER in df.columns:
        return [FILE_ORDER]
    return [name for name in df.columns if name not in keys] or keys


def keep_first(df: DataFrame, keys: list[str], order_by: list[str] | None = None) -> DataFrame:
    """One row per key (NULL is a key too): the first in ``order_by``."""
    order = order_by or row_order(df, keys)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def repeated_groups(df: DataFrame, key: str) -> DataFrame:
    """Key and size of every group with more than one row; NULL keys left out."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("n_rows") > 1)
    )


def deduplicate_customers(customers: DataFrame) -> DataFrame:
    return keep_first(customers, ["customer_unique_id"])


def deduplicate_products(products: DataFrame) -> DataFrame:
    """One row per product, which joins with products rely on."""
    return keep_first(products, ["product_id"])


def deduplicate_sellers(sellers: DataFrame | None) -> DataFrame | None:
    """Sellers are an optional source: None passes through."""
    return None if sellers is None else keep_first(sellers, ["seller_id"])


def repeated_customers(customers: DataFrame) -> DataFrame:
    return members_of_repeated_groups(customers, ["customer_unique_id"])


def has_city_and_zip(customers: DataFrame) -> bool:
    return has_columns(customers, "customer_city", "customer_zip_code_prefix")


def _with_place(customers: DataFrame) -> DataFrame:
    return customers.withColumn("city_normalized", strip_lower(F.col("customer_city")))


PLACE = ["city_normalized", "customer_zip_code_prefix"]


def potential_duplicates(kept_customers: DataFrame) -> DataFrame:
    """Customers, after deduplication, that share city and zip with another one. Reported only."""
    if not has_city_and_zip(kept_customers):
        return kept_customers.limit(0)
    return members_of_repeated_groups(_with_place(kept_customers), PLACE).drop("city_normalized")


def dedup_counts(customers: DataFrame) -> DataFrame:
    """The numbers of the deduplication report as one row."""
    more_than_one = F.col("_n") > 1
    by_identity = (
        customers.groupBy("customer_unique_id")
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("initial_count"),
            F.coalesce(F.sum(F.when(more_than_one, F.col("_n"))), F.lit(0)).alias("duplicate_rows"),
            F.count(F.when(more_than_one, F.col("customer_unique_id"))).alias("duplicate_keys"),
            F.count(F.lit(1)).alias("final_count"),
        )
        .withColumn("removed", F.col("initial_count") - F.col("final_count"))
    )
    if not has_city_and_zip(customers):
        return by_identity.withColumn("potential_duplicates", F.lit(0).cast("bigint"))
    shared_places = (
        _with_place(deduplicate_customers(customers))
        .groupBy(*PLACE)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(more_than_one)
        .agg(F.coalesce(F.sum("_n"), F.lit(0)))
    )
    return by_identity.withColumn("potential_duplicates", shared_places.scalar())


def _shown(df: DataFrame, name: str) -> Column:
    """A key as the report shows it: text in quotes, numbers bare."""
    text = F.col(name).cast("string")
    return F.concat(F.lit("'"), text, F.lit("'")) if dict(df.dtypes)[name] == "string" else text


def dedup_report(customers: DataFrame, key_examples: int = 3, place_examples: int = 5) -> DataFrame:
    """Report lines (``line_no``, ``line``). Lines about duplicates appear only if there are any."""
    groups = repeated_groups(customers, "customer_unique_id")
    example = F.concat(_shown(groups, "customer_unique_id"), F.lit(": "), F.col("n_rows"))
    listed = (
        groups.orderBy("customer_unique_id")
        .limit(key_examples)
        .agg(F.array_sort(F.collect_list(F.struct("customer_unique_id", example.alias("text")))).alias("e"))
        .select(F.array_join(F.col("e.text"), ", "))
    )
    numbers = dedup_counts(customers).withColumn("examples", listed.scalar())

    def line(number: int, text: Column) -> Column:
        return F.struct(F.lit(number).alias("line_no"), text.alias("line"))

    def when_any(count: str, text: Column) -> Column:
        return F.when(F.col(count) > 0, text)

    last = 5 + place_examples
    fixed_lines = numbers.select(
        F.inline(
            F.array(
                line(1, when_any("duplicate_rows", F.format_string(DUPLICATES_LINE, "duplicate_rows"))),
                line(2, when_any("duplicate_rows", F.format_string(AFFECTED_LINE, "duplicate_keys"))),
                line(3, when_any("duplicate_rows", F.format_string(EXAMPLES_LINE, "examples"))),
                line(4, when_any("potential_duplicates", F.format_string(PLACES_LINE, "potential_duplicates"))),
                line(last, F.format_string(REMOVED_LINE, "removed")),
                line(last + 1, F.format_string(FINAL_LINE, "final_count")),
            )
        )
    ).filter(F.col("line").isNotNull())
    if not has_city_and_zip(customers):
        return fixed_lines
    kept = deduplicate_customers(customers)
    order = row_order(kept, [])
    sample = potential_duplicates(kept).orderBy(*order).limit(place_examples)
    ranked = sample.withColumn("_rank", F.row_number().over(Window.orderBy(*order)))
    place_lines = ranked.select(
        (F.col("_rank") + 4).alias("line_no"),
        F.format_string(
            PLACE_LINE,
            F.coalesce(F.col("customer_city"), F.lit("nan")),
            F.coalesce(F.col("customer_zip_code_prefix").cast("string"), F.lit("nan")),
        ).alias("line"),
    )
    return fixed_lines.unionByName(place_lines)


# --- orders --------------------------------------------------------------------------------------


def normalise_status(col: Column, strict: bool = False) -> Column:
    """Lower-case standard status; NULL is ``unknown``. Strict: unlisted values are ``unknown`` too."""
    lowered = F.coalesce(F.lower(col), F.lit("unknown"))
    mapping = F.create_map(*[F.lit(part) for pair in STATUS_MAP.items() for part in pair])
    mapped = F.coalesce(mapping[lowered], lowered)
    return F.when(mapped.isin(KNOWN_STATUSES), mapped).otherwise("unknown") if strict else mapped


def bad_dates(orders: DataFrame, fmt: str | None = None) -> DataFrame:
    """One row per date value that is present but unreadable: order_id, column_name, raw_value."""
    values = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col(name).cast("string").alias("raw_value"),
            parse_timestamp(name, fmt).isNull().alias("unreadable"),
        )
        for name in DATE_COLUMNS
        if name in orders.columns
    ]
    found = F.filter(F.array(*values), lambda v: v["raw_value"].isNotNull() & v["unreadable"])
    return (
        orders.select("order_id", F.explode(found).alias("v"))
        .select("order_id", "v.column_name", "v.raw_value")
    )


def conform_orders(
    orders: DataFrame,
    fmt: str | None = None,
    strict_status: bool = False,
    undelivered: str = "zero",
) -> DataFrame:
    """Orders with parsed dates and standard status, one row per order_id, and delivery days.

    ``undelivered="zero"`` gives orders without both dates 0 delivery days; ``"null"`` leaves NULL.
    """
    if undelivered not in ("zero", "null"):
        raise ValueError("undelivered must be 'zero' or 'null'")
    dates = {name: parse_timestamp(name, fmt) for name in DATE_COLUMNS if name in orders.columns}
    status = normalise_status(F.col("order_status"), strict_status)
    rows = keep_first(orders.withColumns({**dates, "order_status": status}), ["order_id"])
    if "order_delivered_customer_date" not in orders.columns:
        return rows
    days = floor_days(F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date"))
    return rows.withColumn(
        "delivery_time_days", F.coalesce(days, F.lit(0)) if undelivered == "zero" else days
    )


def transform_orders(orders: DataFrame, customers: DataFrame | None = None, **options) -> DataFrame:
    """Silver orders (options as ``conform_orders``). With ``customers``, orders of others are left out."""
    rows = conform_orders(orders, **options)
    if customers is None:
        return rows
    return rows.join(customers.select("customer_id"), "customer_id", "left_semi").select(*rows.columns)


# The rule that a row breaks, as a column of flagged rows; of several the first.
RULE, ACCEPTED = "rule", "accepted"
NO_CUSTOMER, BAD_PRICE, BAD_FREIGHT, REPEATED_ITEM = "unknown_customer", "price", "freight_value", "repeated_item"


def flagged_orders(orders: DataFrame, customer_ids: DataFrame, **options) -> DataFrame:
    """All orders, cleaned, with the rule they break. ``customer_ids`` holds every known customer id once.

    One pass gives accepted and rejected rows. The join is one of plain shuffles (or a broadcast below Spark's size
    threshold), in which Spark splits a customer with very many orders at run time.
    """
    rows = conform_orders(orders, **options)
    known = customer_ids.select("customer_id", F.lit(True).alias("_known"))
    rule = F.when(F.col("_known"), ACCEPTED).otherwise(NO_CUSTOMER)
    return rows.join(known, "customer_id", "left").select(*rows.columns, rule.alias(RULE))


def rejected_orders(orders: DataFrame, customers: DataFrame, **options) -> DataFrame:
    """The orders that ``transform_orders`` leaves out."""
    rows = conform_orders(orders, **options)
    return rows.join(customers.select("customer_id"), "customer_id", "left_anti").select(*rows.columns)


def rejected_report(
    rejected: DataFrame, show_up_to: int = SHOW_REJECTED_UP_TO, examples: int = 5
) -> DataFrame:
    """One row: how many orders were rejected, and example customer ids if there are only a few."""
    sample = (
        rejected.select(F.col("customer_id").cast("string").alias("id"))
        .distinct()
        .orderBy("id")
        .limit(examples)
        .agg(F.array_join(F.array_sort(F.collect_list("id")), ", "))
    )
    shown = (F.col("rejected_orders") > 0) & (F.col("rejected_orders") <= show_up_to)
    return rejected.agg(F.count(F.lit(1)).alias("rejected_orders")).withColumn(
        "example_customer_ids", F.when(shown, sample.scalar())
    )


# --- items ---------------------------------------------------------------------------------------


def _bad_price() -> Column:
    return F.coalesce(nan_to_null(F.col("price")) <= 0, F.lit(False))


def _bad_freight() -> Column:
    freight = nan_to_null(F.col("freight_value"))
    return F.coalesce((freight < 0) | (freight > MAX_FREIGHT), F.lit(False))


def transform_items(items: DataFrame, drop_repeated: bool = False) -> DataFrame:
    """Silver items: no price <= 0, no freight below 0 or above 1000; missing values stay.

    ``drop_repeated`` also keeps one row per (order_id, order_item_id).
    """
    rows = items
    if "price" in items.columns:
        rows = rows.filter(~_bad_price()).withColumn("price", nan_to_null(F.col("price")))
    if "freight_value" in items.columns:
        rows = rows.filter(~_bad_freight()).withColumn(
            "freight_value", nan_to_null(F.col("freight_value"))
        )
    return keep_first(rows, ["order_id", "order_item_id"]) if drop_repeated else rows


def flagged_items(items: DataFrame, drop_repeated: bool = False) -> DataFrame:
    """All items with the rule they break. ``drop_repeated``: only the first accepted row per (order_id, order_item_id)
    stays, the others are flagged too. Equal rows are told apart by their place in the scan that ``items`` is."""
    rule = F.lit(ACCEPTED)
    if "freight_value" in items.columns:
        rule = F.when(_bad_freight(), BAD_FREIGHT).otherwise(rule)
    if "price" in items.columns:
        rule = F.when(_bad_price(), BAD_PRICE).otherwise(rule)
    amounts = {c: nan_to_null(F.col(c)) for c in ("price", "freight_value") if c in items.columns}
    rows = items.withColumn(RULE, rule).withColumns(amounts)
    if not drop_repeated:
        return rows
    keys = ["order_id", "order_item_id"]
    rows = rows.withColumn("_row", F.monotonically_increasing_id())
    # The first row is found by an aggregation, so a key with very many rows is combined before the shuffle.
    order = F.struct(*row_order(items, keys), "_row")
    first = rows.filter(F.col(RULE) == ACCEPTED).groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.min(order).alias("_first"))
    same = F.col("order_id").eqNullSafe(F.col("_order_id")) & F.col("order_item_id").eqNullSafe(F.col("_order_item_id"))
    later = (F.col(RULE) == ACCEPTED) & ~order.eqNullSafe(F.col("_first"))
    return rows.join(first, same, "left").select(*items.columns, F.when(later, REPEATED_ITEM).otherwise(F.col(RULE)).alias(RULE))


def item_rule_report(figures: dict[str, int]) -> list[tuple]:
    """The one row of ``item_rule_counts`` from figures counted while the items were written."""
    price, freight, kept = (figures.get(k, 0) for k in (BAD_PRICE, BAD_FREIGHT, ACCEPTED))
    repeated = figures.get(REPEATED_ITEM, 0)
    return [(price + freight + kept + repeated, price, freight, kept + repeated)]


def bad_values(rows: DataFrame, schema: StructType, keys: list[str]) -> DataFrame:
    """What cannot be read in rows of text: row_key, column_name, raw_value, problem.

    One row per number that is present but unreadable, or infinite; and one per row that has not as many fields as its
    header (column_name NULL, raw_value the line). NaN is a missing value. Dates are reported by ``bad_dates``.
    """

    def entry(name: Column, value: Column, problem: Column) -> Column:
        return F.struct(name.cast("string").alias("column_name"), value.cast("string").alias("raw_value"), problem.alias("problem"))

    found = []
    for field in schema.fields:
        if field.name not in rows.columns or field.dataType == StringType() or rows.schema[field.name].dataType != StringType():
            continue
        raw = F.col(field.name)
        value = raw.try_cast(field.dataType)
        problem = F.when(raw.isNotNull() & value.isNull(), "unreadable")
        if field.dataType.typeName() == "double":
            problem = problem.when(F.abs(value) == float("inf"), "infinite")
        found.append(entry(F.lit(field.name), raw, problem))
    if BAD_ROW in rows.columns:
        found.append(entry(F.lit(None), F.col(f"{BAD_ROW}.line"), F.col(f"{BAD_ROW}.problem")))
    if not found:
        return rows.limit(0).select(*[F.lit(None).cast("string").alias(c) for c in ("row_key", "column_name", "raw_value", "problem")])
    row_key = F.concat_ws("/", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys if k in rows.columns])
    listed = F.filter(F.array(*found), lambda e: e["problem"].isNotNull())
    return rows.select(row_key.alias("row_key"), F.explode(listed).alias("e")).select("row_key", "e.*")


def item_rule_counts(items: DataFrame) -> DataFrame:
    """One row: input rows, rows removed by each rule in turn, rows kept."""
    bad_price = _bad_price() if "price" in items.columns else F.lit(False)
    bad_freight = _bad_freight() if "freight_value" in items.columns else F.lit(False)
    return items.agg(
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(bad_price).alias("removed_price"),
        F.count_if(~bad_price & bad_freight).alias("removed_freight"),
        F.count_if(~bad_price & ~bad_freight).alias("kept_rows"),
    )


# --- audit ---------------------------------------------------------------------------------------


def shape_audit(stages: dict[str, dict[str, DataFrame]]) -> DataFrame:
    """Rows and columns of every table of every stage: stage, table_name, n_rows, n_columns."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(stage).alias("stage"),
            F.lit(name).alias("table_name"),
            F.col("n_rows"),
            F.lit(len([c for c in df.columns if c != FILE_ORDER])).alias("n_columns"),
        )
        for stage, tables in stages.items()
        for name, df in tables.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
