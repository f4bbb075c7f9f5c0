"""A build stores and notes only what it needs, and writes whole months once."""

from orderloom.plans import build as plans
from orderloom.plans.build import full_build, incremental_build
from orderloom.sources.store import MONTH, Store
from tests.conftest import AS_OF, CALENDAR, CUSTOMERS, ITEMS, ORDERS, PRODUCTS, at, make_sources

TABLES = ["dim_customer", "dim_product", "fact_order_line", "product_sales"]


def test_members_are_ids(spark, sources, tmp_path):
    """Members of a product are ids, not the 32 digits made from them."""
    store = Store(spark, str(tmp_path / "s"))
    full_build(sources, store, AS_OF, CALENDAR, tables=TABLES)
    members = store.read("product_sales_members")
    assert members.columns == ["product_id", "kind", "member", "n"]
    assert {r.member for r in members.where("kind = 'order'").collect()} <= {i[1] for i in ITEMS}


def test_replaced_facts_are_noted_narrow_and_whole_months_make_a_version(spark, sources, tmp_path, monkeypatch):
    cut = at("2024-02-29T15:00")
    early = [[r for r in rows if r[-1] <= cut] for rows in (CUSTOMERS, PRODUCTS, ORDERS, ITEMS)]
    store, notes = Store(spark, str(tmp_path / "s")), {}
    full_build(make_sources(spark, *early), store, cut.date(), CALENDAR, tables=TABLES)
    note = Store.note
    monkeypatch.setattr(Store, "note", lambda self, name, df: notes.update({name: df.columns}) or note(self, name, df))
    incremental_build(sources, store, AS_OF, CALENDAR, tables=TABLES)
    assert notes["before_fact_order_line"] == plans.READ_BEFORE["fact_order_line"]
    # every month is touched: a new version instead of a copy that is copied back
    rows = store.read("fact_order_line")
    before = store._folder("fact_order_line")
    store.replace_keys("fact_order_line", rows.where("order_id = 'A'"), ["order_id"], "order_date", rows.select("order_id"))
    assert store._folder("fact_order_line") != before
    assert {r.order_id for r in store.read("fact_order_line").collect()} == {"A"} and MONTH not in store.read("fact_order_line").columns
