from decimal import Decimal

import pytest

from orderloom.operators import quality
from orderloom.plans import build as plans
from orderloom.plans.build import ChecksFailed, build, full_build, incremental_build
from orderloom.plans.expectations import SUITE
from orderloom.sources.store import Store
from tests.conftest import AS_OF, CALENDAR, CUSTOMERS, ITEMS, ORDERS, PRODUCTS, at, make_sources

KNOWN = dict(orders=[r for r in ORDERS if r[2] not in (99, None)], items=[r for r in ITEMS if r[2] != 77 and r[1] != "E"])
TABLES = ["dim_customer", "dim_product", "fact_orders", "order_trend_base"]


def results(store):
    return {(r.table_name, r.test, r.column_name): r.failures for r in store.read("dq_gate").collect()}


def test_gate_counts_like_the_report(spark, sources, tmp_path, monkeypatch):
    """The same numbers as a separate pass, without one: row tests run no job of their own."""
    store = Store(spark, str(tmp_path))
    monkeypatch.setattr(quality, "row_checks", lambda *a: pytest.fail("a second pass"))
    w = full_build(sources, store, AS_OF, CALENDAR, tables=TABLES, checks="record")
    monkeypatch.undo()
    tables = [*w.raw, "dim_customer", "dim_product", "fact_orders"]
    frames = {**w.raw, **{t: getattr(w, t) for t in tables if t not in w.raw}}
    report = quality.report({**frames, "dim_date": w.dim_date}, {**{t: SUITE[t] for t in tables}, "dim_date": quality.Expectations("date_key")})
    got = results(store)
    assert got == {(r.table_name, r.test, r.column_name): r.failures for r in report.where("table_name != 'dim_date'").collect()}
    assert got["raw_orders", "not_null", "customer_id"] == 1 and got["raw_orders", "relationships", "customer_id"] == 1


@pytest.mark.parametrize("bad, table, check", [
    (dict(products=[*PRODUCTS, (5, "Free", "Dresses", Decimal("0.00"), at("2024-01-01"))]), "raw_products", ("accepted_range", "price")),
    (dict(customers=[*CUSTOMERS, (4, "Dup", "ann@x", "Germany", CUSTOMERS[0][4], at("2024-01-01"))]), "raw_customers", ("unique", "email"))])
def test_a_failure_stops_what_follows(spark, tmp_path, bad, table, check):
    store = Store(spark, str(tmp_path))
    with pytest.raises(ChecksFailed) as stopped:
        build(make_sources(spark, **{**KNOWN, **bad}), store, AS_OF, CALENDAR, tables=TABLES, checks="stop")
    assert (table, *check, 1) in stopped.value.failures and table in str(stopped.value)
    assert store.exists(table) and not any(store.exists(t) for t in TABLES)
    assert results(store)[(table, *check)] == 1
    build(make_sources(spark, **{**KNOWN, **bad}), store, AS_OF, CALENDAR, mode="full", tables=TABLES, checks="record")
    assert all(store.exists(t) for t in TABLES)


def test_a_clean_build_passes_and_a_bad_load_is_held_back(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path))
    build(make_sources(spark, **KNOWN), store, AS_OF, CALENDAR, tables=TABLES, checks="stop")
    assert not any(results(store).values())
    before = sorted(map(str, store.read("fact_orders").collect()))
    suite = {**SUITE, "fact_orders": quality.Expectations("order_key", accepted={"order_status": ["pending", "completed", "refunded", "cancelled"]})}
    monkeypatch.setattr(plans.Gate.__init__, "__defaults__", (None, suite))
    odd = (40, "B", 2, at("2024-01-13T23:10"), "lost", Decimal("0.00"), at("2024-03-20T00:00"))
    late = make_sources(spark, **{**KNOWN, "orders": [*KNOWN["orders"], odd]})
    with pytest.raises(ChecksFailed, match="fact_orders.order_status: accepted_values fails 1 times"):
        incremental_build(late, store, AS_OF, CALENDAR, tables=TABLES, checks="stop")
    assert store.pending() and sorted(map(str, store.read("fact_orders").collect())) == before
    incremental_build(late, store, AS_OF, CALENDAR, tables=TABLES, checks="record")
    assert not store.pending() and store.read("fact_orders").where("order_status = 'lost'").count() == 1
    with pytest.raises(ValueError, match="unknown mode of checks"):
        full_build(late, store, AS_OF, CALENDAR, checks="maybe")
