"""Queries that read lines, keys and stored rows several times move and store them once, and narrow."""

import datetime as dt

import pytest

from orderloom.operators import intervals
from orderloom.operators.quality import Expectations, key_report
from orderloom.plans import build as plans
from orderloom.plans import catalog
from orderloom.plans.build import full_build, incremental_build
from orderloom.plans.expectations import SUITE
from orderloom.plans.warehouse import Warehouse
from orderloom.sources import adapter
from orderloom.sources.store import Store
from tests.conftest import AS_OF, CALENDAR, CUSTOMERS, ITEMS, ORDERS, PRODUCTS, at, make_sources
from tests.test_less_shuffled import exchanges, folder  # noqa: F401


def test_lines_are_stored_once_for_those_who_read_them_again(spark, folder):  # noqa: F811
    kept = []
    again = adapter.star_schema_sources(spark, folder, lambda df: kept.append(df) or catalog.pinned(df))
    once = adapter.star_schema_sources(spark, folder)
    assert len(kept) == 1
    for name in ("orders", "order_items"):
        assert sorted(map(str, getattr(again, name).collect())) == sorted(map(str, getattr(once, name).collect()))


def test_checked_tables_are_stored_once(spark, sources, monkeypatch):
    """No table of the report is stored a second time, and the line fact without the columns that nobody reads."""
    seen = []
    monkeypatch.setattr(catalog, "pinned", lambda df, keep=catalog.pinned: seen.append(tuple(df.columns)) or keep(df))
    monkeypatch.setattr("orderloom.operators.quality.pinned", lambda df: pytest.fail("stored again"))
    assert catalog._quality(Warehouse(sources, AS_OF)).count() > 300
    assert len(seen) == len(set(seen))
    line = next(c for c in seen if "order_line_key" in c)
    assert set(SUITE["fact_order_line"].columns(list(line))) <= set(line) and "order_total_amount" not in line


@pytest.mark.parametrize("key", ["0123456789abcdef" * 2, "0123456789ABCDEF" * 2, "x" * 16, "x" * 15, "x" * 17, "", "é" * 8])
def test_packed_keys_stay_apart(spark, key):
    """Digits travel as half as many bytes; they equal no text of those bytes, nor digits of the other case."""
    other = bytes.fromhex(key).decode("latin-1") if len(key) == 32 else key + " "
    rows = [(key,), (key,), (other,), (key.swapcase() + "-",)]
    found = key_report({"t": spark.createDataFrame(rows, "k string")}, {"t": Expectations(unique="k")}).collect()
    assert [r.failures for r in found] == [1]
    found = key_report({"t": spark.createDataFrame(rows[:1] + rows[2:], "k string")}, {"t": Expectations(unique="k")}).collect()
    assert [r.failures for r in found] == [0]


def test_new_rows_are_not_compared_with_whole_stored_rows(spark, sources, tmp_path, monkeypatch):
    """Without a stored row of the same key only keys are looked up: the newest of the fresh rows is found once."""
    cut = at("2024-02-29T15:00")
    early = [[r for r in rows if r[-1] <= cut] for rows in (CUSTOMERS, PRODUCTS, ORDERS, ITEMS)]
    store, calls = Store(spark, str(tmp_path / "s")), []
    tables = ["dim_customer", "fact_orders_scd2"]
    full_build(make_sources(spark, *early), store, cut.date(), CALENDAR, tables=tables)
    newest = plans.newest_per_key
    monkeypatch.setattr(plans, "newest_per_key", lambda rows, *a, **k: calls.append(rows.columns) or newest(rows, *a, **k))
    incremental_build(sources, store, AS_OF, CALENDAR, tables=tables)
    assert len(calls) == 4 and not any("_stored" in c for c in calls)
    assert store.read("raw_orders").count() == len(ORDERS)


def test_stored_items_are_summed_after_one_exchange(spark, sources, tmp_path):
    w = full_build(sources, Store(spark, str(tmp_path / "s")), AS_OF, CALENDAR, tables=[])
    assert exchanges(w.order_items_agg) == 1
    derived = Warehouse(sources, AS_OF).order_items_agg
    assert sorted(map(str, w.order_items_agg.collect())) == sorted(map(str, derived.collect()))


def test_wider_steps_of_width_look_into_fewer_bins(spark, monkeypatch):
    """Sixteenfold classes send fewer rows per point and give the same pairs."""
    start = dt.datetime(2024, 1, 1)
    spans = spark.createDataFrame([(n, start, start + dt.timedelta(seconds=4 ** n)) for n in range(12)], "n int, low timestamp_ntz, high timestamp_ntz")
    points = spark.createDataFrame([(n, start + dt.timedelta(seconds=7 ** n)) for n in range(9)], "p int, at timestamp_ntz")
    both = [intervals.interval_join(points, spans, "at", "low", "high", bits=b) for b in (2, 4)]
    assert sorted(map(str, both[0].collect())) == sorted(map(str, both[1].collect()))
    lists = [max(len(x.split(",")) for x in df._jdf.queryExecution().analyzed().toString().split("explode(cast(array(")[1:]) for df in both]
    assert lists[1] < lists[0]
