"""Rows of an order are shuffled once, and narrow."""

import datetime as dt

import pytest

from orderloom.operators import staging
from orderloom.plans.warehouse import Warehouse
from orderloom.sources import adapter
from orderloom.sources.lookups import Lookups


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("star"))
    day = dt.datetime(2000, 1, 3)
    rows = {
        "region": [(1, "ASIA")], "nation": [(1, "JAPAN", 1)], "customer": [(1, "Customer#1", 1)],
        "part": [(1, "ring", 900.0), (2, "bolt", 999.9)],
        "orders": [(1, 1, "F", day), (2, 1, "O", day), (5, 7, "P", day), (None, 1, "F", day)],
        "lineitem": [(1, 1, 1, 1, 3.0, 10.0, 0.05), (1, 1, 1, 1, 3.0, 10.0, 0.05), (1, 2, 1, 2, 4.0, 10.0, 0.0),
                     (2, 9, 1, 1, 1.0, 1.0, 0.1), (3, 1, 1, 1, 1.0, 1.0, 0.1), (None, 1, 1, 1, 1.0, 1.0, 0.1)]}
    for name, values in rows.items():
        spark.createDataFrame(values, adapter.SCHEMAS[name]).write.parquet(f"{root}/{name}.parquet")
    return root


def exchanges(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().replace("BroadcastExchange", "").count("Exchange ")


def test_items_are_shuffled_once_until_they_are_numbered(spark, folder):
    """Lines and orders meet by the text of the order key, and the window needs no exchange of its own."""
    w = Warehouse(adapter.star_schema_sources(spark, folder), dt.date(2001, 9, 1))
    assert exchanges(w.stg_order_items) == 1      # orders are few here and broadcast


def test_order_amounts_are_whole_sums(spark, folder):
    """Equal lines count each, orders without priced lines have 0, and a null key meets nothing."""
    found = {r.record_id: str(r.total_amount) for r in adapter.star_schema_sources(spark, folder).orders.collect()}
    # 1 + 3 pieces at 6 * 0.95 twice, 1 + 4 pieces at 605.40
    assert found[11] == found[12] == "3072.60"
    assert found[21] == found[51] == found[54] == found[None] == "0.00"


def test_derived_columns_are_not_numbered(sources, monkeypatch):
    seen = []
    monkeypatch.setattr(staging, "sequence_rows", lambda df, *a, **k: seen.append(df.columns) or df.selectExpr("*", "1 AS item_sequence"))
    staging.stg_order_items(sources.order_items, Lookups())
    assert seen == [staging.ITEM_COLUMNS]


def test_tasks_of_lines_follow_the_file(spark, folder, monkeypatch):
    monkeypatch.setattr(adapter, "LINES_BYTES", 100)
    items = adapter.star_schema_sources(spark, folder).order_items
    assert items.rdd.getNumPartitions() > int(spark.conf.get("spark.sql.shuffle.partitions"))
