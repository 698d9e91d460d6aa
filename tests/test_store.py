"""Stored tables that change together: pointers, partitions, upserts, incremental refresh."""

import pathlib

import pytest
from compare import TESTDATA
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from marketlens import jobs
from marketlens.operators import marts
from marketlens.plans.catalog import Tables
from marketlens.sources import bronze, readers
from marketlens.sources.store import Change, ConcurrentChange, Store


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def test_tables_change_together_or_not_at_all(spark, store):
    with store.change() as change:
        change.replace("a", spark.range(3))
        change.replace("b", spark.range(4))
    with pytest.raises(RuntimeError), store.change() as change:
        change.replace("a", spark.range(30))
        assert change.read("a").count() == 30
        raise RuntimeError("killed between two tables")
    assert (store.read("a").count(), store.read("b").count()) == (3, 4)
    assert {t: store.tables()[t]["rows"] for t in "ab"} == {"a": 3, "b": 4}
    with store.change() as change:
        change.replace("a", spark.range(5))
    assert (store.read("a").count(), store.read("b").count()) == (5, 4)


def test_a_killed_job_leaves_the_old_tables(spark, store, monkeypatch):
    """The second table cannot be written: the first one is not replaced either."""
    t = Tables(spark, f"{TESTDATA}/sf0.001")
    bronze.land_frames(t.raw, store.base)
    jobs.store_silver(spark, store.base)
    before = {name: values(store.read(name)) for name in ("dim_customers", "fact_orders")}
    bronze.land_frames({**t.raw, "customers": t.customers_raw.limit(10)}, store.base)
    monkeypatch.setattr(jobs.clean, "flagged_orders", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError, match="killed"):
        jobs.store_silver(spark, store.base)
    assert {name: values(store.read(name)) for name in before} == before


def test_missing_tables_and_versions(spark, store):
    with pytest.raises(AnalysisException) as error:
        store.read("nothing")
    assert error.value.getCondition() == "PATH_NOT_FOUND"
    for n in range(4):
        with store.change() as change:
            change.replace("a", spark.range(n))
    assert store.pointers() == [1, 2, 3, 4]
    gone = store.clean(keep=2)
    assert len(gone) == 2 and store.pointers() == [3, 4]
    assert store.read("a").count() == 3 and store.open(store.tables(3)["a"]).count() == 2


def test_only_one_of_two_changes_is_published(spark, store):
    first, second = store.change(), store.change()
    first.replace("a", spark.range(1))
    second.replace("a", spark.range(2))
    second.commit()
    with pytest.raises(ConcurrentChange):
        first.commit()
    assert store.read("a").count() == 2


def test_partitions(spark, store):
    df = spark.range(20).withColumn("part", F.when(F.col("id") % 4 < 3, F.concat(F.lit("p/"), F.col("id") % 4)))
    with store.change() as change:
        written = change.replace("t", df, by=["part"], even=F.count_if(F.col("id") % 2 == 0))
        assert written.figures == {"n_rows": 20, "even": 10} and len(written.folders) == 4
    assert values(store.read("t")) == values(df)
    assert {r.id % 4 for r in store.read("t", lambda v: v["part"] == "p%2F1").collect()} == {1}
    kept = {p for p in pathlib.Path(store.base).rglob("*.parquet") if "part=p%2F1" not in str(p)}
    with store.change() as change:
        change.replace_partitions("t", spark.createDataFrame([(99, "p/1")], df.schema), lambda v: v["part"] == "p%2F1")
        with pytest.raises(ValueError, match="not replaced"):
            change.replace_partitions("t", df, lambda v: v["part"] == "p%2F1")
    assert store.tables()["t"]["rows"] == 16
    assert values(store.read("t")) == values(df.filter("part IS NULL OR part != 'p/1'").unionByName(spark.createDataFrame([(99, "p/1")], df.schema)))
    assert kept <= set(pathlib.Path(store.base).rglob("*.parquet"))


def test_append_adds_rows_and_columns(spark, store):
    with store.change() as change:
        change.append("t", spark.range(2), big=F.count_if(F.col("id") > 0))
        change.append("t", spark.range(2).withColumn("x", F.lit("new")), big=F.count_if(F.col("id") > 0))
    assert values(store.read("t")) == [(0, "new"), (0, None), (1, "new"), (1, None)]
    assert (store.tables()["t"]["rows"], store.tables()["t"]["figures"]) == (4, {"big": 2})


def test_writing_nothing(spark, store):
    with store.change() as change:
        change.replace("t", spark.range(5).filter("id > 9").withColumn("part", F.col("id")), by=["part"], n=F.count_if(F.col("id") > 0))
        change.replace("u", spark.createDataFrame([], "a int, b string"))
    assert store.read("t").count() == 0 and store.read("u").columns == ["a", "b"]
    assert store.tables()["u"]["rows"] == 0


@pytest.fixture(scope="module")
def updated(spark, tmp_path_factory):
    """A store before and after ten orders moved to other months."""
    base = str(tmp_path_factory.mktemp("updated"))
    t = Tables(spark, f"{TESTDATA}/sf0.001")
    bronze.land_frames(t.raw, base)
    jobs.store_silver(spark, base)
    jobs.store_marts(spark, base)
    before = Store(spark, base).tables()
    ids = [r.order_id for r in t.orders.filter("order_purchase_timestamp < '1995-06-01'").orderBy("order_id").limit(10).collect()]
    moved = F.when(F.col("order_id") % 2 == 0, F.lit("1995-09-05 10:00:00")).otherwise(F.lit("unreadable"))
    delta = t.orders_raw.filter(F.col("order_id").isin(ids)).withColumn("order_purchase_timestamp", moved)
    months = jobs.upsert_orders(spark, base, delta)
    return base, before, t, delta, months


def test_upsert_equals_a_full_rebuild(spark, updated):
    base, _, t, delta, _ = updated
    rest = t.orders.join(delta.select("order_id"), "order_id", "left_anti").select(*t.orders.columns)
    new = jobs.clean.transform_orders(delta, t.customers)
    orders = rest.unionByName(new)
    assert values(readers.read_stored(spark, base, "fact_orders")) == values(orders)
    lines = marts.sales_lines(orders, t.items, t.products)
    built = marts.marts_of_lines(lines, t.customers, t.products)
    for name, mart in built.items():
        assert values(readers.read_stored(spark, base, name).select(*mart.columns)) == values(mart), name
    assert Store(spark, base).tables()["fact_orders"]["rows"] == orders.count()


def test_untouched_months_keep_their_files(spark, updated):
    base, before, _, _, months = updated
    assert "1995-09-01" in months and "__HIVE_DEFAULT_PARTITION__" in months and len(months) <= 7
    after = Store(spark, base).tables()
    for name in ("fact_orders", "stage_sales_lines", "mart_daily_category"):
        old = {f.split("order_month=")[1]: f for f in before[name]["folders"]}
        new = {f.split("order_month=")[1]: f for f in after[name]["folders"]}
        assert {m for m in old if old[m] != new.get(m)} <= set(months) and len(old) > len(months)
        assert all(old[m] == new[m] for m in old if m not in months)
    assert "stage_order_delta" not in after


def test_upsert_reads_touched_months_only(spark, updated):
    base, _, _, delta, _ = updated
    store = Store(spark, base)
    one = store.read("fact_orders", lambda v: v["order_month"] == "1996-01-01")
    assert len(one.inputFiles()) < len(store.read("fact_orders").inputFiles())
    assert {str(r.m) for r in one.select(F.trunc("order_purchase_timestamp", "month").alias("m")).distinct().collect()} == {"1996-01-01"}


def test_orders_of_unknown_customers_are_not_merged(spark, store):
    t = Tables(spark, f"{TESTDATA}/sf0.001")
    bronze.land_frames(t.raw, store.base)
    jobs.store_silver(spark, store.base)
    before = values(store.read("fact_orders"))
    delta = t.orders_raw.limit(5).withColumn("customer_id", F.lit(-7).cast("bigint"))
    assert jobs.upsert_orders(spark, store.base, delta) == []
    assert values(store.read("fact_orders")) == before


def test_stored_files_are_packed_densely(spark, store, tmp_path):
    with store.change() as change:
        change.replace("a", spark.range(30))
        change.replace("b", spark.range(30).withColumn("part", F.col("id") % 2), by=["part"])
    files = [path.name for path in (tmp_path / "store").rglob("*.parquet")]
    assert files and all(name.endswith(".zstd.parquet") for name in files)
    assert (store.read("a").count(), store.read("b").count()) == (30, 30)


@pytest.fixture
def most_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    saved = spark.conf.get(key)
    spark.conf.set(key, "600k")
    yield
    spark.conf.set(key, saved)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


MANY = 100_000


def test_many_rows_in_small_files_are_not_broadcast(spark, store, most_broadcast):
    ids = spark.range(MANY).withColumnRenamed("id", "key")
    with store.change() as change:
        change.replace("many", ids)
        change.replace("few", ids.limit(100))
        assert "SortMergeJoin" in plan(spark.range(MANY).join(change.lookup("many"), F.col("id") == F.col("key"), "left"))
    assert store.folder.size("many") < 600 << 10 < MANY * 16
    asked = spark.range(0, 2 * MANY, 2)

    def joined(found, kind="left_semi"):
        return asked.join(found, F.col("id") == F.col("key"), kind)

    assert "BroadcastHashJoin" in plan(joined(store.read("many")))
    for kind in ("left", "left_semi", "left_anti", "inner"):
        assert "SortMergeJoin" in plan(joined(store.lookup("many").select("key"), kind)), kind
        assert "BroadcastHashJoin" in plan(joined(store.lookup("few"), kind)), kind
    assert joined(store.lookup("many")).count() == MANY // 2 and joined(store.lookup("few")).count() == 50
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert "hint" not in store.lookup("many")._jdf.queryExecution().logical().toString().lower()


@pytest.fixture
def large_store(spark, store, most_broadcast, monkeypatch):
    """A store with many customers and products, and the plan of every table as it is written."""
    plans = {}
    write = Change.write

    def planned(change, df, root, *args, **kwargs):
        plans[root] = plan(df)
        return write(change, df, root, *args, **kwargs)

    monkeypatch.setattr(Change, "write", planned)
    row = F.col("id")
    raw = {
        "orders": _orders(spark.range(MANY)),
        "customers": spark.range(MANY).select(
            row.alias("customer_id"),
            row.alias("customer_unique_id"),
            (row % 9).cast("int").alias("customer_zip_code_prefix"),
            F.concat(F.lit("city"), row % 9).alias("customer_city"),
            F.lit("state").alias("customer_state"),
        ),
        "products": spark.range(MANY).select(
            row.alias("product_id"), F.concat(F.lit("cat"), row % 7).alias("product_category_name"), F.lit(5).alias("product_name_length")
        ),
        "order_items": spark.range(MANY).select(
            row.alias("order_id"), F.lit(1).alias("order_item_id"), row.alias("product_id"), F.lit(1.5).alias("price"), F.lit(0.5).alias("freight_value")
        ),
    }
    bronze.land_frames(raw, store.base)
    jobs.store_silver(spark, store.base)
    return store, plans


def _orders(ids):
    row = F.col("id")
    return ids.select(
        row.alias("order_id"),
        (row % (MANY + 10)).alias("customer_id"),
        F.lit("delivered").alias("order_status"),
        F.lit("2018-01-05 10:00:00").alias("order_purchase_timestamp"),
        F.lit("2018-01-09 10:00:00").alias("order_delivered_customer_date"),
        F.lit(7).alias("promised_time_days"),
    )


def test_store_jobs_send_no_large_table_through_the_driver(spark, large_store):
    store, plans = large_store
    assert "BroadcastExchange" not in plans["fact_orders"] and "SortMergeJoin" in plans["fact_orders"]
    jobs.store_marts(spark, store.base)
    for name in ("stage_sales_lines", *jobs.MARTS):
        assert "BroadcastExchange" not in plans[name], name
    assert store.tables()["fact_orders"]["rows"] == store.tables()["stage_sales_lines"]["rows"] == MANY


def test_upsert_sends_no_large_table_through_the_driver(spark, large_store):
    store, plans = large_store
    jobs.store_marts(spark, store.base)
    plans.clear()
    # As many new orders as stored ones, ten of them of unknown customers.
    jobs.upsert_orders(spark, store.base, _orders(spark.range(10, MANY + 10)))
    for name in ("stage_order_delta", "fact_orders", "stage_sales_lines", *jobs.MARTS):
        assert "BroadcastExchange" not in plans[name], name
    assert store.tables()["fact_orders"]["rows"] == store.read("fact_orders").count() == MANY
    assert store.read("mart_product_performance").count() == MANY
