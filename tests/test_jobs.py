"""Sources, sinks and the batch jobs on CSV files."""

import json
import pathlib

import pytest
from pyspark.errors import AnalysisException

from marketlens import jobs
from marketlens.plans import catalog
from marketlens.session import apply_scale_settings, size_shuffles, work_dir
from marketlens.sources import adapter, bronze, readers, schemas, writers
from marketlens.sources.store import Store

FILES = {
    # Columns in another order than the schema, and one the schema does not know.
    "orders": """order_status,order_id,customer_id,order_purchase_timestamp,order_delivered_customer_date,promised_time_days,channel
Delivered,o1,c1,2018-01-02 10:00:00,2018-01-12 09:00:00,20,web
CANCELED,o2,c2,2018-01-03 10:00:00,,20,web
shipped,o1,c1,2018-01-09 10:00:00,,20,app
Delivered,o3,c3,2018-02-03 10:00:00,2018-03-30 09:00:00,20,web
Delivered,o4,c9,2018-02-03 10:00:00,2018-03-30 09:00:00,20,web
Delivered,o5,c3,soon,2018-03-30 09:00:00,20,web
""",
    "customers": """customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state
c1,u1,09790,franca,SP
c2,u2,1151,"sao paulo",SP
c3,u3,9790, Franca,SP
c4,u1,1151,osasco,SP
""",
    "products": """product_id,product_category_name,product_name_length
p1,toys,5
p2,,7
""",
    "order_items": """order_id,order_item_id,product_id,price,freight_value
o1,1,p1,100.10,10.01
o1,2,p2,50,5
o2,1,p1,NaN,1
o3,1,p1,-1,1
o3,2,p1,30,1000.5
o3,3,p1,30,2
o4,1,p1,30,2
""",
}


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    for name, content in FILES.items():
        (folder / f"{name}.csv").write_text(content)
    return folder


def test_csv_source(spark, raw):
    orders = readers.read_csv_source(spark, f"{raw}/orders.csv", schemas.ORDERS)
    assert orders.columns[0] == "order_status" and orders.columns[-1] == "channel"
    assert dict(orders.dtypes)["promised_time_days"] == "int"
    assert dict(orders.dtypes)["channel"] == "string"
    customers = readers.read_csv_source(spark, f"{raw}/customers.csv", schemas.CUSTOMERS)
    assert customers.filter("customer_id = 'c1'").first().customer_zip_code_prefix == 9790
    items = readers.read_csv_source(spark, f"{raw}/order_items.csv", schemas.ORDER_ITEMS)
    assert items.filter("order_id = 'o2'").first().price is None
    with pytest.raises(AnalysisException):
        readers.read_csv_source(spark, f"{raw}/nothing.csv", schemas.ORDERS)


def test_csv_folder_with_several_headers(spark, tmp_path):
    folder = tmp_path / "a folder [x]" / "customers.csv"
    folder.mkdir(parents=True)
    (folder / "1.csv").write_text("customer_id,customer_city,customer_zip_code_prefix\nc1,rio,1\n")
    (folder / "2.csv").write_text("customer_city,customer_zip_code_prefix,customer_id,note\nlima,2,c2,n\n")
    (folder / "3.csv").write_text("customer_id,customer_city,customer_zip_code_prefix\nc3,oslo,3\n")
    (folder / "4.csv").write_text("")
    for file_order in (False, True):
        path = str(folder).replace("[", "\\[").replace("]", "\\]")
        df = readers.read_csv_source(spark, path, schemas.CUSTOMERS, file_order=file_order)
        rows = {(r.customer_id, r.customer_city, r.customer_zip_code_prefix, r.note) for r in df.collect()}
        assert rows == {("c1", "rio", 1, None), ("c2", "lima", 2, "n"), ("c3", "oslo", 3, None)}
        assert (readers.FILE_ORDER in df.columns) == file_order


def test_csv_round_trip_of_quotes_and_line_breaks(spark, tmp_path):
    import csv

    cities = ['sao "x", paulo', "two\nlines", 'back\\slash"', " blank ", "plain"]
    path = str(tmp_path / "out.csv")
    df = spark.createDataFrame([(str(i), c) for i, c in enumerate(cities)], "customer_id string, customer_city string")
    writers.save_csv(df.coalesce(1), path)
    (part,) = pathlib.Path(path).glob("part-*")
    with part.open(newline="") as file:
        assert [r["customer_city"] for r in csv.DictReader(file)] == cities
    back = readers.read_csv_source(spark, path, schemas.CUSTOMERS, multi_line=True)
    assert {r.customer_city for r in back.collect()} == set(cities)
    published = readers.read_published(spark, path, df.schema)
    assert {r.customer_city for r in published.collect()} == set(cities)


def test_optional_source(spark, raw):
    assert readers.read_optional_source(spark, f"{raw}/sellers.csv", schemas.SELLERS) is None
    (raw / "sellers.csv").write_text("seller_id,seller_city\ns1,x\ns1,y\n")
    sellers = readers.read_optional_source(spark, f"{raw}/sellers.csv", schemas.SELLERS)
    assert sellers.count() == 2


def test_file_order_over_split_files(spark, raw):
    """The first row in the file wins, also when the file is read in many pieces."""
    from marketlens.operators.clean import keep_first

    lines = "".join(f"k{i % 50},{i}\n" for i in range(20_000))
    (raw / "big.csv").write_text("customer_unique_id,customer_id\n" + lines)
    saved = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        df = readers.read_csv_source(spark, f"{raw}/big.csv", schemas.CUSTOMERS, file_order=True)
        assert df.rdd.getNumPartitions() > 4
        kept = keep_first(df, ["customer_unique_id"])
        assert sorted(int(r.customer_id) for r in kept.collect()) == list(range(50))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", saved)


def lines(path):
    parts = sorted(pathlib.Path(path).glob("part-*"))
    return [line for part in parts for line in part.read_text().splitlines()]


def test_all_jobs(spark, raw, tmp_path):
    store, reports = str(tmp_path / "store"), str(tmp_path / "reports")
    jobs.main(["all", "--raw", str(raw), "--store", store, "--reports", reports])

    orders = {r.order_id: r for r in readers.read_stored(spark, store, "fact_orders").collect()}
    # o4 has no customer; o1 keeps its first row in the file although another sorts before it.
    assert sorted(orders) == ["o1", "o2", "o3", "o5"]
    assert (orders["o1"].order_status, orders["o1"].channel) == ("delivered", "web")
    assert orders["o1"].delivery_time_days == 9
    customers = readers.read_stored(spark, store, "dim_customers")
    assert sorted(r.customer_id for r in customers.collect()) == ["c1", "c2", "c3"]
    assert readers.FILE_ORDER not in customers.columns
    assert "dim_sellers" not in Store(spark, store).tables()
    items = readers.read_stored(spark, store, "fact_order_items")
    assert items.count() == 5
    daily = readers.read_stored(spark, store, "mart_daily_category").collect()
    assert {r.order_month.isoformat() for r in daily} == {"2018-01-01", "2018-02-01"}

    assert lines(f"{reports}/dedup_report") == [
        "Exact duplicates by customer_unique_id: 2 records",
        "  Affected unique customers: 1",
        "  Example duplicates: {'u1': 2}",
        "Potential duplicates by city+zip: 2 records",
        "  Example: franca 9790",
        "  Example:  Franca 9790",
        "Removed duplicates: 1",
        "Final customer count: 3",
    ]
    record = json.loads(lines(f"{reports}/kpi_record")[0])
    assert record["basics"] == {"total_orders": 3, "total_customers": 3, "gmv": 197.11, "aov": 197.11 / 3}
    assert record["top_categories"] == [{"product_category_name": "toys", "revenue": 142.11}]
    assert record["retention"]["retention_m0_m1"] == "0.0%"
    assert lines(f"{reports}/kpi_report")[0] == "GMV (Gross Merchandise Value): R$197.11"
    rejected = spark.read.option("header", True).csv(f"{reports}/rejected_orders").first()
    assert tuple(rejected) == ("1", "c9")
    bad = spark.read.option("header", True).csv(f"{reports}/bad_dates").first()
    assert tuple(bad) == ("o5", "order_purchase_timestamp", "soon")
    cohorts = readers.read_published(spark, f"{reports}/cohort_retention", schemas.COHORT_FILE)
    assert sorted(tuple(r) for r in cohorts.collect()) == [
        ("2018-01", 1, None, None, None),
        ("2018-02", 1, None, None, None),
    ]
    persons = readers.read_published(spark, f"{reports}/cohort_retention_by_person", schemas.COHORT_FILE)
    assert sorted(tuple(r)[:2] for r in persons.collect()) == [("2018-01", 1), ("2018-02", 1)]
    # Too few orders per city and category: nothing is published.
    assert not pathlib.Path(f"{reports}/sla_city_category").exists()
    assert readers.read_stored(spark, store, "rfm_segments").count() == 3

    rules = spark.read.option("header", True).csv(f"{reports}/item_rules").first()
    assert tuple(rules) == ("7", "1", "1", "5")
    audit = {(r.stage, r.table_name): (int(r.n_rows), int(r.n_columns)) for r in spark.read.option("header", True).csv(f"{reports}/audit").collect()}
    assert audit["bronze", "bronze_orders"] == (6, 7) and audit["silver", "fact_orders"] == (4, 8)
    assert readers.read_stored(spark, store, "rejected_orders").select("order_id", "rule").collect() == [("o4", "unknown_customer")]
    rejected = readers.read_stored(spark, store, "rejected_items").select("order_item_id", "rule").collect()
    assert sorted(map(tuple, rejected)) == [(1, "price"), (2, "freight_value")]
    matrix = spark.read.option("header", True).csv(f"{reports}/cohort_matrix")
    assert matrix.columns == ["cohort_month", "m0"] and matrix.count() == 2
    quality = {r.check_name: r.passed for r in spark.read.option("header", True).csv(f"{reports}/quality").collect()}
    assert quality["fk_customer"] == "true" and quality["pk_order_id"] == "true"

    # A second run replaces all tables.
    (raw / "sellers.csv").write_text("seller_id\ns1\ns1\n")
    jobs.main(["etl", "--raw", str(raw), "--store", store])
    assert readers.read_stored(spark, store, "fact_orders").count() == 4
    assert readers.read_stored(spark, store, "dim_sellers").count() == 1


def test_empty_tables_fail(spark):
    audit = spark.createDataFrame([("silver", "fact_orders", 0, 3)], "stage string, table_name string, n_rows bigint, n_columns int")
    with pytest.raises(ValueError, match="fact_orders"):
        jobs.require_rows(audit)


def test_published_file_may_be_missing(spark, tmp_path):
    missing = readers.read_published(spark, str(tmp_path / "no.csv"), schemas.SLA_FILE)
    assert missing.count() == 0 and missing.schema == schemas.SLA_FILE


def test_csv_keeps_blanks(spark, tmp_path):
    df = spark.createDataFrame([("  a ", None)], "customer_city string, level string")
    writers.save_csv(df, str(tmp_path / "out"))
    assert tuple(spark.read.option("header", True).csv(str(tmp_path / "out")).first()) == ("  a ", None)


def test_sql_with_parameters_and_scalars(spark):
    df = spark.range(10)
    top = readers.query_tables(spark, "SELECT id FROM {t} ORDER BY id DESC LIMIT :n", {"t": df}, {"n": 2})
    assert [r.id for r in top.collect()] == [9, 8]
    assert readers.fetch_scalar(df.selectExpr("count(*)")) == 10
    assert readers.fetch_scalar(df.limit(0)) is None
    assert readers.has_columns(df, "id") and not readers.has_columns(df, "id", "x")
    parsed = readers.with_parsed_dates(spark.createDataFrame([("2018-01-02",)], "d string"), "d")
    assert dict(parsed.dtypes)["d"] == "timestamp_ntz"


def test_work_dir_uses_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = work_dir(spark, "x"), work_dir(spark, "x")
    assert first.startswith(shared) and first != second


def test_shuffles_follow_the_input_size(spark):
    saved = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffles(spark, 0.001) == int(saved)
        assert size_shuffles(spark, 1024) == 4097
        assert spark.conf.get("spark.sql.shuffle.partitions") == "4097"
        assert size_shuffles(spark, 100 * 1024) == 409_601
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", saved)


@pytest.mark.parametrize("key", ["spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes"])
def test_blocks_of_a_task_are_bounded(spark, key):
    saved = spark.conf.get(key)
    try:
        spark.conf.set(key, "128m")
        apply_scale_settings(spark)
        assert int(spark.conf.get(key)) <= 16 << 20
        spark.conf.set(key, "64k")
        apply_scale_settings(spark)
        assert spark.conf.get(key) == "64k"
    finally:
        spark.conf.set(key, saved)


def test_queries_size_their_shuffles(spark, tmp_path, monkeypatch):
    (tmp_path / "orders.parquet").write_bytes(b"x" * 1000)
    (tmp_path / "lineitem.parquet").mkdir()
    (tmp_path / "lineitem.parquet" / "part-0").write_bytes(b"x" * 500)
    assert adapter.input_gb(spark, str(tmp_path)) == 1500 / 2**30
    saved = spark.conf.get("spark.sql.shuffle.partitions")
    monkeypatch.setattr(adapter, "input_gb", lambda *_: 2.0)
    try:
        catalog.Tables(spark, str(tmp_path))
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) == 513
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", saved)


def test_raw_files_are_read_once(spark, raw, tmp_path, monkeypatch):
    """Every raw file has one scan, at landing; all later jobs work without the raw folder."""
    store, reports = str(tmp_path / "store"), str(tmp_path / "reports")
    scanned = []
    whole = readers._scan
    monkeypatch.setattr(readers, "_scan", lambda *a: scanned.extend(a[2]) or whole(*a))
    land = jobs.land_raw

    def land_and_hide(*given):
        land(*given)
        raw.rename(tmp_path / "gone")

    monkeypatch.setattr(jobs, "land_raw", land_and_hide)
    jobs.main(["all", "--raw", str(raw), "--store", store, "--reports", reports])
    assert sorted(path.rsplit("/", 1)[1] for path in scanned) == sorted(f"{name}.csv" for name in FILES)
    assert readers.read_stored(spark, store, "fact_orders").count() == 4


def test_job_options(spark, raw, tmp_path):
    store, reports = str(tmp_path / "store"), str(tmp_path / "reports")
    (raw / "order_items.csv").write_text(FILES["order_items"] + "o1,1,p1,70,1\no1,1,p1,70,1\n")
    (raw / "orders.csv").write_text(FILES["orders"] + "lost,o6,c3,2018-02-04 10:00:00,,20,web\n")
    options = ["--drop-repeated-items", "--strict-status", "--undelivered", "null", "--late-days", "5", "--top-n", "1", "--median-accuracy", "1000"]
    jobs.main(["all", "--raw", str(raw), "--store", store, "--reports", reports, *options])
    items = readers.read_stored(spark, store, "fact_order_items")
    assert items.filter("order_id = 'o1'").count() == 2 and items.filter("price = 70").count() == 0
    assert readers.read_stored(spark, store, "rejected_items").filter("rule = 'repeated_item'").count() == 2
    orders = {r.order_id: r for r in readers.read_stored(spark, store, "fact_orders").collect()}
    assert orders["o6"].order_status == "unknown" and orders["o2"].delivery_time_days is None
    assert spark.read.option("header", True).csv(f"{reports}/top_categories").count() == 1
    line = readers.read_stored(spark, store, "stage_sales_lines").filter("order_id = 'o1'").first()
    assert line.late == 1  # nine days


def test_empty_sources(spark, raw, tmp_path):
    """Files with a header only: tables without rows, and a failure that names them."""
    for name, content in FILES.items():
        (raw / f"{name}.csv").write_text(content.splitlines()[0] + "\n")
    store = str(tmp_path / "store")
    jobs.main(["etl", "--raw", str(raw), "--store", store])
    assert readers.read_stored(spark, store, "fact_orders").count() == 0
    assert readers.read_stored(spark, store, "rejected_items").columns[-1] == "rule"
    with pytest.raises(ValueError, match="fact_orders"):
        jobs.require_rows(jobs.observed_audit(spark, store))
