import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderloom.plans.build import (TABLES, apply_changes, build, full_build, incremental_build, newest_per_key,
                                   rows_after_watermark)
from orderloom.plans.catalog import AUDIT_COLUMNS
from orderloom.sources.lookups import Lookups
from orderloom.sources.store import Store
from orderloom.sources.tables import RAW_TABLES, raw_table, read_sources, table_stats
from orderloom.streaming.ingest import keep_up_to_date, stream_raw_table
from tests.conftest import AS_OF, CALENDAR, CUSTOMERS, ITEMS, ORDERS, PRODUCTS, at, make_sources


def same(a: Store, b: Store, tables) -> None:
    for name in tables:
        dropped = [*AUDIT_COLUMNS, *(["created_at"] if name == "daily_metrics" else [])]
        left, right = (s.read(name).drop(*dropped) for s in (a, b))
        rows = [sorted(map(str, f.select(*left.columns).collect())) for f in (left, right)]
        assert rows[0] == rows[1], name


@pytest.fixture(scope="module")
def complete(spark, sources, tmp_path_factory):
    store = Store(spark, str(tmp_path_factory.mktemp("full")))
    full_build(sources, store, AS_OF, CALENDAR)
    return store


def test_two_loads_equal_one(spark, sources, complete, tmp_path):
    cut = at("2024-02-29T15:00")
    early = make_sources(spark, *[[r for r in rows if r[-1] <= cut] for rows in (CUSTOMERS, PRODUCTS, ORDERS, ITEMS)])
    store = Store(spark, str(tmp_path))
    full_build(early, store, cut.date(), CALENDAR)
    incremental_build(sources, store, AS_OF, CALENDAR)
    same(complete, store, [*RAW_TABLES, *TABLES])


def test_nothing_new_changes_nothing(spark, sources, tmp_path):
    tables = ["dim_customer", "fact_orders", "order_trend_base", "customer_purchases", "analysis_order_trends"]
    store, again = Store(spark, str(tmp_path / "a")), Store(spark, str(tmp_path / "b"))
    for s in (store, again):
        full_build(sources, s, AS_OF, CALENDAR, tables=tables)
    incremental_build(sources, again, AS_OF, CALENDAR, tables=tables)
    same(store, again, [*RAW_TABLES, *tables])


def test_out_of_order_and_repeated_rows(spark, sources, complete, tmp_path):
    """Changes may come late, twice, and before the rows they belong to."""
    late = [ORDERS[1], ORDERS[5]]  # the completed rows of A and C
    first = make_sources(spark, CUSTOMERS[1:], PRODUCTS[:3], [r for r in ORDERS if r not in late], ITEMS[1:])
    store = Store(spark, str(tmp_path))
    full_build(first, store, AS_OF, CALENDAR)
    rest = make_sources(spark, CUSTOMERS[:1], PRODUCTS[3:], late + late[:1], ITEMS[:1])
    changes = {name: raw_table(rest.named()[source], name) for name, (source, _, _) in RAW_TABLES.items()}
    apply_changes(store, changes, Lookups(), AS_OF, CALENDAR)
    same(complete, store, [*RAW_TABLES, *TABLES])
    replayed = ["fact_orders_scd2", "daily_order_state"]
    apply_changes(store, changes, Lookups(), AS_OF, CALENDAR, tables=replayed)
    same(complete, store, [*RAW_TABLES, *replayed])


def test_streaming_equals_batch(spark, sources, complete, tmp_path):
    first = make_sources(spark, orders=ORDERS[:4])
    tables = ["dim_customer", "fact_orders_scd2", "daily_order_state", "metric_daily_orders"]
    store = Store(spark, str(tmp_path / "store"))
    full_build(first, store, AS_OF, CALENDAR, tables=tables)
    inbox = str(tmp_path / "inbox")
    for chunk in (ORDERS[4:8], ORDERS[8:], ORDERS[2:3]):
        make_sources(spark, orders=chunk).orders.coalesce(1).write.mode("append").parquet(inbox)
    stream = stream_raw_table(spark, inbox, "raw_orders", files_per_batch=2)
    query = keep_up_to_date(stream, "raw_orders", store, Lookups(), str(tmp_path / "progress"), CALENDAR,
                            today=lambda: AS_OF, tables=tables)
    query.awaitTermination()
    same(complete, store, ["raw_orders", *tables])


def test_watermark(spark):
    rows = spark.createDataFrame([(1, at("2024-01-01")), (2, at("2024-01-02")), (3, at("2024-01-03"))],
                                 "id int, created_at timestamp_ntz")
    target = rows.where("id <= 2")
    assert [r.id for r in rows_after_watermark(rows, target).collect()] == [3]
    assert rows_after_watermark(rows, target.limit(0)).count() == 3  # an empty target takes everything
    again = rows_after_watermark(rows, target, lookback=dt.timedelta(days=1))
    assert sorted(r.id for r in again.collect()) == [2, 3]


def test_newest_per_key(spark):
    rows = spark.createDataFrame([(1, "old", at("2024-01-01")), (1, "new", at("2024-01-02"))],
                                 "id int, v string, created_at timestamp_ntz")
    assert [r.v for r in newest_per_key(rows, ["id"]).collect()] == ["new"]


def test_upsert_moves_rows_between_months(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    kind = "id int, v string, at timestamp_ntz"
    store.write(spark.createDataFrame([(1, "a", at("2024-01-05")), (2, "b", at("2024-02-05"))], kind), "t", "at")
    store.replace_keys("t", spark.createDataFrame([(1, "c", at("2024-02-07")), (3, "d", at("2024-03-01"))], kind),
                       ["id"], "at")
    assert sorted(map(tuple, store.read("t").select("id", "v").collect())) == [(1, "c"), (2, "b"), (3, "d")]
    # a key that loses all its rows
    store.replace_keys("t", spark.createDataFrame([], kind), ["id"], "at",
                       changed=spark.createDataFrame([(3,)], "id int"))
    assert sorted(r.id for r in store.read("t").collect()) == [1, 2]
    with pytest.raises(ValueError, match="schema of t changed"):
        store.replace_keys("t", spark.createDataFrame([(1, 2, at("2024-02-07"))], "id int, v int, at timestamp_ntz"),
                           ["id"], "at")


def test_composite_upsert_and_versions(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.write(spark.createDataFrame([(1, "x", 1), (1, "y", 2)], "d int, m string, v int"), "m")
    before = store.read("m")
    store.replace_keys("m", spark.createDataFrame([(1, "y", 5), (2, "x", 7)], "d int, m string, v int"), ["d", "m"])
    assert sorted(map(tuple, store.read("m").collect())) == [(1, "x", 1), (1, "y", 5), (2, "x", 7)]
    assert before.count() == 2  # a reader of the previous version is not disturbed


def test_modes_and_stats(spark, sources, tmp_path):
    for name, frame in sources.named().items():
        frame.write.parquet(str(tmp_path / "in" / name))
    read = read_sources(spark, str(tmp_path / "in"))
    counts = {r.table_name: r.row_count for r in table_stats(read.named()).collect()}
    assert counts == {"source_customers": 3, "source_products": 4, "source_orders": 11, "source_order_items": 7}
    store = Store(spark, str(tmp_path / "out"))
    build(read, store, AS_OF, CALENDAR, tables=["dim_customer", "fact_orders"])  # an empty store is built in full
    build(read, store, AS_OF, CALENDAR, mode="full", tables=["dim_customer", "fact_orders"])
    assert store.read("fact_orders").count() == 6
    assert store.read("fact_orders").agg(F.sum("order_amount")).first()[0] == Decimal("1249.98")
    with pytest.raises(ValueError):
        build(read, store, AS_OF, CALENDAR, mode="other")


@pytest.mark.parametrize("fails_at", ["fact_orders", "daily_order_state", "metric_daily_orders"])
def test_a_run_that_stops_is_finished_by_the_next(spark, sources, tmp_path, monkeypatch, fails_at):
    cut = at("2024-02-29T15:00")
    early = make_sources(spark, *[[r for r in rows if r[-1] <= cut] for rows in (CUSTOMERS, PRODUCTS, ORDERS, ITEMS)])
    store, tables = Store(spark, str(tmp_path / "s")), ["dim_customer", "dim_product", "fact_orders", "fact_orders_scd2",
                                                         "daily_order_state", "metric_daily_orders"]
    full_build(early, store, cut.date(), CALENDAR, tables=tables)
    replace_keys, write = Store.replace_keys, Store.write

    def failing(original):
        def call(self, first, second, *args, **kwargs):
            if fails_at in (first, second):
                raise RuntimeError("stopped")
            return original(self, first, second, *args, **kwargs)
        return call

    with monkeypatch.context() as m:
        m.setattr(Store, "replace_keys", failing(replace_keys))
        m.setattr(Store, "write", failing(write))
        with pytest.raises(RuntimeError, match="stopped"):
            incremental_build(sources, store, AS_OF, CALENDAR, tables=tables)
    assert store.pending()
    incremental_build(sources, store, AS_OF, CALENDAR, tables=tables)
    assert not store.pending()
    whole = Store(spark, str(tmp_path / "whole"))
    full_build(sources, whole, AS_OF, CALENDAR, tables=tables)
    same(whole, store, ["raw_orders", *tables])
