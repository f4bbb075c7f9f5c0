"""Order facts from bucketed storage: no exchange on the order id, and the rows of the plain way."""

import re

import pytest
from pyspark.sql import functions as F

from orderloom.plans import buckets
from orderloom.plans.build import full_build
from orderloom.plans.warehouse import Warehouse
from orderloom.sources.store import Store
from tests.conftest import AS_OF, CALENDAR, ITEMS, ORDERS, at, make_sources

FACTS = ["fact_orders", "fact_order_line", "fact_orders_scd2"]


def rows(frame):
    return sorted(map(str, frame.collect()))


def exchanges(frame):
    """Hash exchanges of a plan on the order id or anything made of it."""
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if re.search(r"Exchange hashpartitioning\([^)]*order_id", line)]


@pytest.fixture
def joined_by_shuffle(spark):
    """Small tables are joined as large ones are."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", FACTS)
def test_no_exchange_on_the_order_id(warehouse, name):
    assert exchanges(getattr(warehouse, name)) and not exchanges(buckets.fact(buckets.by_order(warehouse, 4), name))


@pytest.mark.parametrize("name", FACTS)
def test_no_exchange_on_the_order_id_with_many_customers(warehouse, joined_by_shuffle, name):
    """Order rows that met their customers by a shuffle return to the order id before they meet the lines; the lines stay."""
    parts = buckets.by_order(warehouse, 4)
    assert len(parts) == 1
    assert len(exchanges(buckets.fact(parts, name))) == (name == "fact_order_line") < len(exchanges(getattr(warehouse, name)))
    assert "SelectedBucketsCount: 4 out of 4" in buckets.fact(parts, name)._jdf.queryExecution().executedPlan().toString()


def test_facts_are_those_of_plain_tables(warehouse):
    parts = buckets.by_order(warehouse, 3)
    for name in FACTS:
        assert rows(buckets.fact(parts, name)) == rows(getattr(warehouse, name))


def test_crowded_orders_are_kept_apart(spark):
    """An order with most rows of a table, and rows without an order id."""
    orders = ORDERS + [(100 + k, "A", 1, at("2024-01-10T07:30"), "pending", ORDERS[0][5], at(f"2024-01-21T07:{k:02d}")) for k in range(9)]
    orders += [(200, None, 2, at("2024-01-10T07:30"), "pending", ORDERS[0][5], at("2024-01-10T07:30"))]
    items = ITEMS + [(100 + k, "C", 1, 1, ITEMS[0][4], at("2024-02-29T12:07")) for k in range(9)]
    items += [(300 + k, None, 1, 1, ITEMS[0][4], at("2024-02-29T12:07")) for k in range(9)]
    w = Warehouse(make_sources(spark, orders=orders, items=items), AS_OF, CALENDAR)
    parts = buckets.by_order(w, 4, most=5)
    assert len(parts) == 2
    assert {r[0] for r in parts[1].raw["raw_order_items"].select("order_id").distinct().collect()} == {"A", "C", None}
    for name in FACTS:
        assert rows(buckets.fact(parts, name)) == rows(getattr(w, name))


def test_build_over_buckets(spark, sources, tmp_path):
    stores = [Store(spark, str(tmp_path / kind)) for kind in ("plain", "buckets")]
    for store, count in zip(stores, (None, 4)):
        full_build(sources, store, AS_OF, CALENDAR, tables=["dim_customer", "dim_product", *FACTS], buckets=count)
    for name in FACTS:
        assert rows(stores[0].read(name)) == rows(stores[1].read(name))


def test_empty_tables(spark, warehouse):
    w = Warehouse(make_sources(spark, orders=[], items=[]), AS_OF, CALENDAR)
    parts = buckets.by_order(w, 2)
    assert all(buckets.fact(parts, name).count() == 0 for name in FACTS)


def test_one_file_per_bucket(spark, warehouse):
    stored = buckets.bucketed(warehouse.raw["raw_orders"], "order_id", 3)
    files = stored.select(F.input_file_name().alias("f"), "order_id").distinct().collect()
    assert len({r.f for r in files}) <= 3 and len({r.order_id for r in files}) == len(files)
