"""Registered queries against their DuckDB twins on the smallest data set."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import TABLES, compare
from oracle.queries import ORACLE
from orderloom.functions import labels
from orderloom.plans.catalog import registered

FOLDER = "/root/testdata/sf0.001"
# ``check.py`` compares every query; these cover each layer once
NAMES = ["stg_products", "stg_order_items", "dim_date", "dim_customer", "dim_product", "fact_orders", "fact_order_line",
         "fact_orders_scd2", "scd2_status_journey", "daily_status_population", "metrics_dashboard", "order_trends",
         "customer_behavior", "product_performance"]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test data not present")


@pytest.fixture(scope="module")
def connection():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    return c


def test_every_query_has_a_twin():
    assert registered().keys() == ORACLE.keys()
    assert set(oracle_sql()) <= set(queries())


def test_a_changed_threshold_shows(spark, connection, monkeypatch):
    monkeypatch.setattr(labels, "LINE_VALUE_TIER", [(60, "Low Value Line"), *labels.LINE_VALUE_TIER[1:]])
    verdict = compare(spark, connection, FOLDER, "stg_order_items", queries()["stg_order_items"], ORACLE["stg_order_items"])
    assert verdict.startswith("VALUES") and "line_value_tier" in verdict


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, connection, name):
    verdict = compare(spark, connection, FOLDER, name, queries()[name], oracle_sql()[name])
    assert verdict.startswith("ok"), verdict


def test_entry(spark):
    assert entry(spark).columns[0] == "metric_date"
