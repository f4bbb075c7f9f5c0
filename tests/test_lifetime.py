import random
from decimal import Decimal

import pytest

from orderloom.plans import build as plans
from orderloom.plans.build import apply_changes, full_build, incremental_build
from orderloom.sources.lookups import Lookups
from orderloom.sources.store import Store
from orderloom.sources.tables import RAW_TABLES, raw_table
from tests.conftest import AS_OF, CALENDAR, CUSTOMERS, ITEMS, ORDERS, PRODUCTS, at, make_sources
from tests.test_build import same

TOTALS = ["customer_purchases", "customer_preferences", "product_sales"]
TABLES = ["dim_customer", "dim_product", "fact_orders", "fact_order_line", *TOTALS, "analysis_customer_behavior"]


def apply(spark, store, **rows):
    given = make_sources(spark, **{**dict(customers=[], products=[], orders=[], items=[]), **rows})
    named = {name: raw_table(given.named()[source], name) for name, (source, _, _) in RAW_TABLES.items()}
    short = {"raw_customers": "customers", "raw_products": "products", "raw_orders": "orders", "raw_order_items": "items"}
    apply_changes(store, {n: f for n, f in named.items() if short[n] in rows}, Lookups(), AS_OF, CALENDAR, tables=TABLES)


def equal_to_full(spark, tmp_path, store, name, **rows):
    whole = Store(spark, str(tmp_path / name))
    full_build(make_sources(spark, **rows), whole, AS_OF, CALENDAR, tables=TABLES)
    same(whole, store, [*TABLES, *[f"{t}_members" for t in TOTALS], *[f"{t}_state" for t in TOTALS]])


def test_totals_follow_changes(spark, sources, tmp_path):
    """A status that changes and changes back, an item that loses its extreme price, a product that changes its category."""
    store = Store(spark, str(tmp_path / "s"))
    full_build(sources, store, AS_OF, CALENDAR, tables=TABLES)
    refunded = (20, "G", 3, at("2024-03-09T10:00"), "refunded", Decimal("0.00"), at("2024-03-10T10:00"))
    again = (21, "G", 3, at("2024-03-09T10:00"), "completed", Decimal("0.00"), at("2024-03-11T10:00"))
    apply(spark, store, orders=[refunded])
    assert "G" not in {r.order_id for r in store.read("fact_orders").where("order_status = 'completed'").collect()}
    apply(spark, store, orders=[again])
    cheaper = (2, "A", 2, 1, Decimal("20.00"), at("2024-01-11T00:00"))
    apply(spark, store, items=[cheaper])
    moved = (1, "Classic Signature Spring Holiday", "Shoes & Footwear", Decimal("49.99"), at("2024-03-20"))
    apply(spark, store, products=[moved])
    equal_to_full(spark, tmp_path, store, "whole", customers=CUSTOMERS, products=[moved, *PRODUCTS[1:]], orders=[*ORDERS, refunded, again],
                  items=[ITEMS[0], cheaper, *ITEMS[2:]])


def test_many_small_loads(spark, tmp_path):
    """Orders change hands between statuses and customers over several loads."""
    rng = random.Random(2)
    orders, items, record, item = {}, {}, 100, 100
    store = Store(spark, str(tmp_path / "s"))
    full_build(make_sources(spark, orders=[], items=[]), store, AS_OF, CALENDAR, tables=TABLES)
    for load in range(3):
        new_orders, new_items = [], []
        for _ in range(8):
            k, record = rng.randrange(10), record + 1
            placed = at(f"2024-0{1 + k % 3}-0{1 + k % 9}T{10 + k}:00")
            new_orders.append((record, f"o{k}", 1 + k % 3, placed, rng.choice(["pending", "completed", "cancelled", "refunded", "completed"]),
                               Decimal(50 + 10 * k), at(f"2024-03-1{load}T{rng.randrange(10, 24)}:{record % 60:02d}:00")))
        for _ in range(8):
            item, k = rng.choice([item + 1, rng.randint(101, max(item, 101))]), rng.randrange(10)
            if any(i[0] == item for i in new_items):
                continue
            new_items.append((item, f"o{k}", rng.randint(1, 4), rng.randint(1, 3), Decimal(rng.randint(5, 60)), at(f"2024-03-1{load}T12:{item % 60:02d}:30")))
        item = max([item, *[i[0] for i in new_items]])
        orders.update({r[0]: r for r in new_orders})
        items.update({r[0]: r for r in new_items})
        apply(spark, store, orders=new_orders, items=new_items)
    equal_to_full(spark, tmp_path, store, "whole", orders=list(orders.values()), items=list(items.values()))


@pytest.mark.parametrize("fails_at", ["product_sales_members", "product_sales_state", "product_sales"])
def test_a_change_is_not_counted_twice(spark, sources, tmp_path, monkeypatch, fails_at):
    """A run that stops between members, state and totals is finished with the values it had noted."""
    cut = at("2024-02-29T15:00")
    early = [[r for r in rows if r[-1] <= cut] for rows in (CUSTOMERS, PRODUCTS, ORDERS, ITEMS)]
    store, tables = Store(spark, str(tmp_path / "s")), ["dim_customer", "dim_product", "fact_order_line", "product_sales"]
    full_build(make_sources(spark, *early), store, cut.date(), CALENDAR, tables=tables)
    replace_keys = Store.replace_keys

    def failing(self, name, *args, **kwargs):
        done = replace_keys(self, name, *args, **kwargs)
        if name == fails_at:
            raise RuntimeError("stopped")
        return done

    with monkeypatch.context() as m:
        m.setattr(Store, "replace_keys", failing)
        with pytest.raises(RuntimeError, match="stopped"):
            incremental_build(sources, store, AS_OF, CALENDAR, tables=tables)
    incremental_build(sources, store, AS_OF, CALENDAR, tables=tables)
    whole = Store(spark, str(tmp_path / "whole"))
    full_build(sources, whole, AS_OF, CALENDAR, tables=tables)
    same(whole, store, [*tables, "product_sales_members", "product_sales_state"])


def test_facts_of_a_key_are_not_read_again(spark, sources, tmp_path, monkeypatch):
    """Totals come from the rows of touched orders only."""
    store = Store(spark, str(tmp_path / "s"))
    full_build(sources, store, AS_OF, CALENDAR, tables=TABLES)
    seen = {}
    changed = plans.lifetime.changed_members

    def spy(life, delta, pairs):
        seen[life.fact, len(life.sums)] = delta.select(*[c for c in delta.columns if c != "_members"]).count()
        return changed(life, delta, pairs)

    monkeypatch.setattr(plans.lifetime, "changed_members", spy)
    apply(spark, store, orders=[(30, "B", 2, at("2024-01-13T23:10"), "completed", Decimal("0.00"), at("2024-03-15T00:00"))])
    assert set(seen.values()) <= {0, 1, 2} and max(seen.values()) == 2      # order B before and after; it has no lines
