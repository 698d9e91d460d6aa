"""Landing raw files: each once, with what cannot be read."""

import os

import pytest
from pyspark.errors import AnalysisException

from marketlens import jobs
from marketlens.operators import clean
from marketlens.sources import bronze, readers, schemas
from marketlens.sources.store import Store

ITEMS = "order_id,order_item_id,product_id,price,freight_value\n"


def put(folder, source, name, text):
    path = folder / f"{source}.csv"
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text(text)


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw files [1]"
    put(folder, "orders", "1.csv", "order_id,customer_id,order_status,order_purchase_timestamp\no1,c1,shipped,2018-01-02 10:00:00\n")
    put(folder, "customers", "1.csv", "customer_id,customer_unique_id\nc1,u1\n")
    put(folder, "products", "1.csv", "product_id,product_category_name\np1,toys\n")
    put(folder, "order_items", "1.csv", ITEMS + "o1,1,p1,10,1\n")
    return folder


def path_of(folder):
    return readers.as_path(str(folder))


def items(spark, base):
    return sorted((r.order_id, r.order_item_id, r.price) for r in bronze.raw_rows(Store(spark, base).change())["order_items"].collect())


def test_only_new_files_are_landed(spark, raw, tmp_path, monkeypatch):
    base, scanned = str(tmp_path / "store"), []
    whole = readers._scan
    monkeypatch.setattr(readers, "_scan", lambda *a: scanned.extend(p.rsplit("/", 1)[1] for p in a[2] if "order_items" in p) or whole(*a))
    jobs.land_raw(spark, path_of(raw), base)
    put(raw, "order_items", "2.csv", "price,order_id,order_item_id,note\n20,o1,2,x\n")
    jobs.land_raw(spark, path_of(raw), base)
    jobs.land_raw(spark, path_of(raw), base)
    assert scanned == ["1.csv", "2.csv"]
    assert items(spark, base) == [("o1", 1, 10.0), ("o1", 2, 20.0)]
    table = Store(spark, base).tables()["bronze_order_items"]
    assert table["rows"] == 2 and [f["name"] for f in table["schema"]["fields"]][-1] == "note"
    assert Store(spark, base).read("bronze_files").count() == 5

    # A landed file that changes brings its source in anew.
    put(raw, "order_items", "1.csv", ITEMS + "o1,1,p1,11,1\no1,3,p1,12,1\n")
    jobs.land_raw(spark, path_of(raw), base)
    assert scanned[2:] == ["1.csv", "2.csv"]
    assert items(spark, base) == [("o1", 1, 11.0), ("o1", 2, 20.0), ("o1", 3, 12.0)]
    os.remove(raw / "order_items.csv" / "2.csv")
    jobs.land_raw(spark, path_of(raw), base)
    assert items(spark, base) == [("o1", 1, 11.0), ("o1", 3, 12.0)]


def test_sellers_may_be_missing_and_others_not(spark, raw, tmp_path):
    base = str(tmp_path / "store")
    jobs.land_raw(spark, path_of(raw), base)
    assert not Store(spark, base).has("bronze_sellers")
    put(raw, "sellers", "1.csv", "seller_id\ns1\n")
    jobs.land_raw(spark, path_of(raw), base)
    assert Store(spark, base).read("bronze_sellers").count() == 1
    os.rename(raw / "products.csv", raw / "elsewhere")
    with pytest.raises(AnalysisException):
        jobs.land_raw(spark, path_of(raw), base)
    assert Store(spark, base).read("bronze_products").count() == 1


def test_headers_take_as_many_jobs_for_many_files_as_for_few(spark, tmp_path):
    tracker, jobs_run = spark.sparkContext.statusTracker(), []
    for n in (3, 40):
        folder = tmp_path / f"files{n}"
        folder.mkdir()
        for k in range(n):
            header = ["a,b", "b,a", "\n  \na,b,c"][k % 3]
            (folder / f"{k}.csv").write_text(f"{header}\n1,2\n")
        (folder / "empty.csv").write_text("")
        spark.sparkContext.setJobGroup(f"headers{n}", "headers")
        found = readers.files_by_header(spark, [str(folder)], readers.CSV)
        spark.sparkContext._jsc.clearJobGroup()
        assert sorted(tuple(h) for h, _ in found) == [("a", "b"), ("a", "b", "c"), ("b", "a")]
        assert sum(len(files) for _, files in found) == n
        jobs_run.append(len(tracker.getJobIdsForGroup(f"headers{n}")))
    # One over all files, and one per distinct header.
    assert jobs_run[0] == jobs_run[1] <= 10
    assert spark.conf.get("spark.sql.files.openCostInBytes") != str(1 << 60)


def bad(spark, folder, source="order_items"):
    rows = readers.scan_text(spark, [f"{path_of(folder)}/{source}.csv"], file_order=True)
    return rows, sorted(map(tuple, clean.bad_values(rows, schemas.RAW_SOURCES[source], schemas.KEYS[source]).collect()), key=str)


def test_unreadable_values_and_rows(spark, raw):
    text = ITEMS + 'o1,1,p1,ten,1\no1,2.5,p1,10,Infinity\no1,3,p1,NaN,\no2,1\no2,2,p1,1,2,3\no2,3,p1,1,2,\n"o3,x",1,p1,-1e400,1\n'
    put(raw, "order_items", "1.csv", text)
    rows, found = bad(spark, raw)
    assert found == sorted(
        [
            ("o1/1", "price", "ten", "unreadable"),
            ("o1/2.5", "order_item_id", "2.5", "unreadable"),
            ("o1/2.5", "freight_value", "Infinity", "infinite"),
            ("o2/1", None, "o2,1", "too few fields"),
            ("o2/2", None, "o2,2,p1,1,2,3", "too many fields"),
            ("o2/3", None, "o2,3,p1,1,2,", "too many fields"),
            ("o3,x/1", "price", "-1e400", "infinite"),
        ],
        key=str,
    )
    kept = readers.typed(rows, schemas.ORDER_ITEMS)
    assert sorted((r.order_id, r.order_item_id) for r in kept.collect() if r.order_id != "o1") == [("o2", 1), ("o3,x", 1)]
    short = kept.filter("order_id = 'o2'").first()
    assert (short.product_id, short.price) == (None, None)


def test_line_breaks_in_quotes_are_reported_or_read(spark, raw, tmp_path):
    put(raw, "customers", "1.csv", 'customer_id,customer_unique_id,customer_city\nc1,u1,"two\nlines"\nc2,u2,"quoted ""x"""\n')
    _, found = bad(spark, raw, "customers")
    assert [problem for *_, problem in found] and all(problem == "too few fields" for *_, problem in found)
    rows = readers.scan_text(spark, [f"{path_of(raw)}/customers.csv"], multi_line=True)
    assert rows.filter("_bad_row IS NOT NULL").count() == 0
    assert sorted(r.customer_city for r in rows.collect()) == ['quoted "x"', "two\nlines"]


def test_flagged_items_keep_the_first_of_repeated_rows(spark):
    rows = [("o1", 1, 5.0, 1.0), ("o1", 1, 4.0, 1.0), ("o1", 1, 4.0, 1.0), ("o1", 1, -4.0, 1.0), ("o2", None, 1.0, 2000.0), ("o2", None, 1.0, None)]
    df = spark.createDataFrame(rows, "order_id string, order_item_id int, price double, freight_value double")
    path_rows = clean.flagged_items(df, drop_repeated=True)
    assert sorted((r.order_id, r.price, r.rule) for r in path_rows.collect()) == sorted(
        [("o1", 4.0, "accepted"), ("o1", 4.0, "repeated_item"), ("o1", 5.0, "repeated_item"), ("o1", -4.0, "price"), ("o2", 1.0, "freight_value"), ("o2", 1.0, "accepted")]
    )
    plain = clean.flagged_items(df)
    assert plain.filter("rule = 'accepted'").drop("rule").exceptAll(clean.transform_items(df)).count() == 0


def test_flagged_orders_match_the_two_joins(spark):
    orders = [(f"o{i}", f"c{i % 4}" if i % 5 else None, "shipped", "2018-01-02 10:00:00") for i in range(20)]
    df = spark.createDataFrame(orders, "order_id string, customer_id string, order_status string, order_purchase_timestamp string")
    customers = spark.createDataFrame([("c1",), ("c2",)], "customer_id string")
    flagged = clean.flagged_orders(df, customers)
    for rule, direct in (("accepted", clean.transform_orders(df, customers)), ("unknown_customer", clean.rejected_orders(df, customers))):
        found = flagged.filter(f"rule = '{rule}'").drop("rule")
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, direct.collect()))
