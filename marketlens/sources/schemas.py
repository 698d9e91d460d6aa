"""Column types of the raw sources and of the published files.

Timestamps stay text in the raw orders: the cleaning step parses them and reports what it cannot read.
"""

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind(), True) for name, kind in fields.items()])


ORDERS = _struct(
    order_id=StringType,
    customer_id=StringType,
    order_status=StringType,
    order_purchase_timestamp=StringType,
    order_delivered_customer_date=StringType,
    promised_time_days=IntegerType,
)
CUSTOMERS = _struct(
    customer_id=StringType,
    customer_unique_id=StringType,
    customer_zip_code_prefix=IntegerType,
    customer_city=StringType,
    customer_state=StringType,
)
PRODUCTS = _struct(
    product_id=StringType,
    product_category_name=StringType,
    product_name_length=IntegerType,
)
ORDER_ITEMS = _struct(
    order_id=StringType,
    order_item_id=IntegerType,
    product_id=StringType,
    price=DoubleType,
    freight_value=DoubleType,
)
SELLERS = _struct(seller_id=StringType)

RAW_SOURCES = {
    "orders": ORDERS,
    "customers": CUSTOMERS,
    "products": PRODUCTS,
    "order_items": ORDER_ITEMS,
    "sellers": SELLERS,
}

# What tells the rows of a source apart.
KEYS = {
    "orders": ["order_id"],
    "customers": ["customer_id"],
    "products": ["product_id"],
    "order_items": ["order_id", "order_item_id"],
    "sellers": ["seller_id"],
}

# The columns that the documented star schema declares, with the types the ids have in the test tables.
DECLARED = {
    "dim_customers": "customer_id bigint, customer_unique_id bigint, customer_city string, customer_state string",
    "dim_products": "product_id bigint, product_category_name string, product_name_length int",
    "dim_geography": "city string, state string",
    "dim_calendar": "date date, week int, month int, year int",
    "fact_orders": "order_id bigint, customer_id bigint, order_status string, order_purchase_timestamp timestamp, "
    "price double, freight_value double, delivery_time_days int",
    "fact_order_items": "order_id bigint, order_item_id int, product_id bigint, price double, freight_value double",
}

COHORT_FILE = _struct(
    cohort_month=StringType,
    cohort_size=LongType,
    retention_month_1=DoubleType,
    retention_month_2=DoubleType,
    retention_month_3=DoubleType,
)
SLA_FILE = _struct(
    customer_city=StringType,
    total_orders=LongType,
    late_orders=LongType,
    avg_delivery_days=DoubleType,
    avg_delivery_days_not_null=DoubleType,
    late_delivery_rate=DoubleType,
    level=StringType,
    product_category_name=StringType,
)
