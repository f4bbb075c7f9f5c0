"""Shuffle files go once they are spent, wide rows are dealt before they are wide, and ids stand for the keys made from them."""

import time

from pyspark.sql import functions as F

from orderloom.functions.columns import slim, surrogate_key
from orderloom.operators import analysis, facts, staging
from orderloom.operators.facts import made_keys
from orderloom.plans.build import full_build, incremental_build
from orderloom.session import SPENT, pinned, spent_shuffles
from orderloom.sources.store import Store, bucket_of, by_month
from tests.conftest import AS_OF, CALENDAR, CUSTOMERS, ITEMS, ORDERS, PRODUCTS, at, make_sources


def shuffle_files(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}


def gone(spark, before: set[str]) -> bool:
    """Files are removed in the background."""
    for _ in range(50):
        if not shuffle_files(spark) - before:
            return True
        time.sleep(0.1)
    return False


def test_stored_frames_leave_no_shuffle_files(spark, tmp_path):
    def rows():
        return spark.range(1000).groupBy((F.col("id") % 7).cast("int").alias("k")).agg(F.count(F.lit(1)).alias("n"))

    before, setting = shuffle_files(spark), spark.conf.get(SPENT, None)
    stored = pinned(rows())
    assert gone(spark, before)
    store = Store(spark, str(tmp_path))
    store.note("n", rows())
    store.write(rows(), "t")
    store.write(rows(), "m", F.col("k"))
    assert gone(spark, before)
    assert stored.count() == store.read("t").count() == store.read("m").count() == 7
    assert spark.conf.get(SPENT, None) == setting


def test_the_setting_holds_until_the_last_write(spark):
    setting = spark.conf.get(SPENT, None)
    with spent_shuffles(spark):
        with spent_shuffles(spark):
            pass
        assert spark.conf.get(SPENT) == "true"
    assert spark.conf.get(SPENT, None) == setting


def test_slim_rows_come_back_whole(spark):
    """Keys made from ids travel as nothing, others as they are."""
    made = "0123456789abcdef0123456789abcdef"
    rows = spark.createDataFrame([("A", None, made), ("B", made, None), ("C", "own", made + "\n"), (None, "é", made.upper()), ("E", None, "")],
                                 "order_id string, order_key string, other_key string")
    rows = rows.withColumn("order_key", F.when(F.col("order_id").isin("A", "E"), surrogate_key("order_id")).otherwise(F.col("order_key")))
    light, back = slim(rows, made_keys("fact_orders", rows.columns))
    assert back(light).schema == rows.schema
    assert sorted(map(str, back(light).collect())) == sorted(map(str, rows.collect()))
    sent = {r.order_id: r for r in light.collect()}
    assert sent["A"].order_key is None and len(sent["A"].other_key) == 17


def test_facts_are_dealt_before_they_are_wide(spark, warehouse):
    seen = []

    def deal(rows):
        seen.append(rows.columns)
        return by_month(rows, "order_date")

    raw = warehouse.raw
    lines = facts.fact_order_line(staging.numbered_items(raw["raw_order_items"]), raw["raw_orders"], warehouse.dim_customer, warehouse.product_links,
                                  warehouse.loaded_at, lambda items: staging.priced_items(items, warehouse.lookups), deal)
    orders = facts.fact_orders(raw["raw_orders"], warehouse.order_items_agg, warehouse.dim_customer, warehouse.loaded_at, deal)
    history = facts.fact_orders_scd2(raw["raw_orders"], warehouse.order_items_agg, warehouse.dim_customer, warehouse.loaded_at, deal)
    for fact, whole in ((lines, warehouse.fact_order_line), (orders, warehouse.fact_orders), (history, warehouse.fact_orders_scd2)):
        assert fact.schema == whole.schema
        assert sorted(map(str, fact.collect())) == sorted(map(str, whole.collect()))
    assert len(seen) == 3 and not [c for columns in seen for c in columns if c.endswith("_key") or c == "order_year"]


def test_keys_that_are_not_made_from_ids_stay(spark, warehouse):
    customers = warehouse.dim_customer.withColumn("customer_key", F.concat(F.lit("c"), "customer_id"))
    raw = warehouse.raw
    orders = facts.fact_orders(raw["raw_orders"], warehouse.order_items_agg, customers, warehouse.loaded_at)
    whole = warehouse.fact_orders.select("order_id", "customer_key").collect()
    known = {r.customer_key: f"c{r.customer_id}" for r in warehouse.dim_customer.collect()}
    assert {r.order_id: r.customer_key for r in orders.collect()} == {r.order_id: known.get(r.customer_key) for r in whole}


def test_product_sales_count_ids(spark, warehouse):
    lines = warehouse.fact_order_line
    by_id, by_key = analysis.product_sales(lines), analysis.product_sales(lines.drop("order_id", "customer_id"))
    assert sorted(map(str, by_id.collect())) == sorted(map(str, by_key.collect()))
    narrow = analysis.product_sales(lines.drop("order_key", "customer_key"))
    assert sorted(map(str, narrow.collect())) == sorted(map(str, by_key.collect()))


def test_an_incremental_run_deals_new_facts_once(spark, sources, tmp_path, monkeypatch):
    tables = ["dim_customer", "dim_product", "fact_orders", "fact_order_line", "fact_orders_scd2"]
    cut = at("2024-02-29T15:00")
    early = [[r for r in rows if r[-1] <= cut] for rows in (CUSTOMERS, PRODUCTS, ORDERS, ITEMS)]
    store, whole, dealt = Store(spark, str(tmp_path / "s")), Store(spark, str(tmp_path / "whole")), {}
    full_build(make_sources(spark, *early), store, cut.date(), CALENDAR, tables=tables)
    replace_keys = Store.replace_keys
    monkeypatch.setattr(Store, "replace_keys", lambda self, name, *a, **b: dealt.update({name: b.get("dealt")}) or replace_keys(self, name, *a, **b))
    incremental_build(sources, store, AS_OF, CALENDAR, tables=tables)
    full_build(sources, whole, AS_OF, CALENDAR, tables=tables)
    for name in tables[2:]:
        stamps = ["fact_created_at", "fact_updated_at"]
        assert dealt[name]
        assert sorted(map(str, store.read(name).drop(*stamps).collect())) == sorted(map(str, whole.read(name).drop(*stamps).collect()))


def test_keys_of_an_upsert_stay_texts(spark, tmp_path):
    """Rows leave by a key that is a text of 32 digits, whatever else travels packed."""
    def rows(*numbers):
        made = surrogate_key("number")
        return spark.createDataFrame([(n,) for n in numbers], "number int").select(made.alias("customer_key"), made.alias("other_key"), "number")

    store = Store(spark, str(tmp_path))
    store.write(rows(1, 2, 3), "t", bucket_of("customer_key"))
    store.replace_keys("t", rows(3).withColumn("number", F.lit(5)), ["customer_key"], bucket_of("customer_key"), rows(3))
    assert store.read("t").columns == ["customer_key", "other_key", "number"]
    assert sorted(r.number for r in store.read("t").collect()) == [1, 2, 5]
    assert sorted(map(str, store.read("t").where("number < 3").collect())) == sorted(map(str, rows(1, 2).collect()))
