import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from orderloom.operators.delta import reach, row_changes
from orderloom.plans import build as plans
from orderloom.plans.build import apply_changes, full_build, incremental_build
from orderloom.sources.lookups import Lookups
from orderloom.sources.store import MONTH, Store
from orderloom.sources.tables import RAW_TABLES, raw_table
from tests.conftest import AS_OF, CALENDAR, CUSTOMERS, ITEMS, ORDERS, PRODUCTS, at, make_sources
from tests.test_build import same

KIND = "k int, part string, v int, w int, stamp int"


def test_row_changes(spark):
    old = spark.createDataFrame([(1, "a", 1, None, 0), (2, "a", None, 1, 0), (3, "a", 5, 5, 0), (None, "n", 1, 1, 0), (7, "g", 1, 1, 0)], KIND)
    new = spark.createDataFrame([(1, "a", 1, None, 9), (2, "a", 1, None, 9), (3, "b", 5, 5, 9), (None, "n", 1, 2, 9), (8, "g", 1, 1, 0)], KIND)
    got = {tuple(r) for r in row_changes(old, new, ["k", "part"], ["stamp"]).collect()}
    # a value that moves to another column is a change; another load time is none
    assert got == {(2, "a", "update"), (3, "a", "delete"), (3, "b", "insert"), (None, "n", "update"), (7, "g", "delete"), (8, "g", "insert")}
    assert row_changes(old, old, ["k", "part"]).count() == 0
    assert row_changes(old.limit(0), new, ["k", "part"]).count() == row_changes(new, old.limit(0), ["k", "part"]).count() == 5


@pytest.mark.parametrize("ahead, month", [(6, False), (7, True), (1, True)])
def test_reached_rows_suffice(spark, ahead, month):
    """Rows computed from the needed ones alone are right, and no other row has changed."""
    rng = random.Random(ahead)
    first = dt.date(2024, 1, 1)
    days = sorted(rng.sample(range(120), 80))
    old = {first + dt.timedelta(days=d): rng.randrange(100) for d in days}
    new = dict(old)
    for d in rng.sample(sorted(old), 3):
        del new[d]
    for d in rng.sample(range(120), 3):
        new[first + dt.timedelta(days=d)] = rng.randrange(100)

    def frame(values):
        return spark.createDataFrame(sorted(values.items()), "day date, v int")

    def windows(df):
        by_day = W.orderBy("day")
        out = df.select("day", F.sum("v").over(by_day.rowsBetween(-ahead, 0)).alias("s"), F.lag("v", ahead).over(by_day).alias("l"),
                        F.sum("v").over(W.partitionBy(F.trunc("day", "month")).orderBy("day")).alias("m"))
        return out if month else out.drop("m")

    before, after = ({r.day: r for r in windows(frame(x)).collect()} for x in (old, new))
    marks = reach(frame(new), row_changes(frame(old), frame(new), ["day"]), "day", ahead, month)
    dirty = {r.day for r in marks.where("dirty").collect()}
    assert {d for d in after if before.get(d) != after[d]} <= dirty and set(before) - set(after)
    near = windows(frame(new).join(marks.where("needed").select("day"), "day", "left_semi"))
    assert all(after[r.day] == r for r in near.collect() if r.day in dirty) and len(dirty) < len(after)


def early_and_late():
    cut = at("2024-02-29T15:00")
    return [[r for r in rows if r[-1] <= cut] for rows in (CUSTOMERS, PRODUCTS, ORDERS, ITEMS)]


def test_only_reached_days_are_rewritten(spark, sources, tmp_path):
    """A late item changes one day's products; only the days after it in reach and their months are written."""
    store = Store(spark, str(tmp_path / "s"))
    tables = ["dim_customer", "dim_product", "fact_orders", "fact_order_line", "fact_orders_scd2", "daily_order_state", "daily_customer_activity",
              "daily_product_base", "metric_daily_orders", "metric_daily_customers", "metric_daily_products", "daily_metrics"]
    full_build(make_sources(spark, items=ITEMS[:3] + ITEMS[4:]), store, AS_OF, CALENDAR, loaded_at=at("2024-05-01"), tables=tables)
    late = make_sources(spark, items=[ITEMS[3]])      # order D of March 2nd
    apply_changes(store, {"raw_order_items": raw_table(late.order_items, "raw_order_items")}, Lookups(), AS_OF, CALENDAR,
                  loaded_at=at("2024-05-02"), tables=tables)
    whole = Store(spark, str(tmp_path / "whole"))
    full_build(sources, whole, AS_OF, CALENDAR, tables=tables)
    same(whole, store, tables)

    def stamped(name, column="metrics_updated_at"):
        rows = store.read(name)
        return rows.where(F.col(column) == at("2024-05-02")), rows

    fresh, rows = stamped("metric_daily_products")
    assert {r.metric_date for r in fresh.collect()} == {r.metric_date for r in rows.collect() if r.metric_date >= dt.date(2024, 3, 2)}
    assert 0 < fresh.count() < rows.count()
    assert stamped("metric_daily_customers")[0].count() < stamped("metric_daily_customers")[1].count()
    fresh, rows = stamped("daily_metrics", "created_at")
    assert 0 < fresh.count() < rows.count() / 2 and store.read("daily_metrics_changes").count() == fresh.count()
    again = {name: store.read_with_month(name).inputFiles() for name in tables}
    incremental_build(sources, store, AS_OF, CALENDAR, loaded_at=at("2024-05-03"), tables=tables)
    written = {name for name in tables if store.read_with_month(name).inputFiles() != again[name]}
    assert not written & {*plans.DAY_METRICS, "daily_metrics"} and store.read("daily_metrics_changes").count() == 0


def test_full_build_after_a_run_that_stopped(spark, tmp_path, monkeypatch):
    """The notes of the stopped run are not followed later: they are older than the full build."""
    def named(name, day):
        return [(1, name, "ann@x", "UNITED STATES", dt.date(2021, 1, 3), at(day))] + CUSTOMERS[1:2]

    store, tables = Store(spark, str(tmp_path)), ["dim_customer", "fact_orders"]
    full_build(make_sources(spark, named("v1", "2021-01-03")), store, AS_OF, CALENDAR, tables=tables)
    with monkeypatch.context() as m:
        m.setattr(Store, "replace_keys", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError, match="stopped"):
            incremental_build(make_sources(spark, named("v2", "2024-03-01")), store, AS_OF, CALENDAR, tables=tables)
    assert store.pending()
    full_build(make_sources(spark, named("v3", "2024-03-02")), store, AS_OF, CALENDAR, tables=tables)
    assert not store.pending()
    later = named("v3", "2024-03-02") + [(9, "new", "n@x", "Germany", dt.date(2024, 3, 3), at("2024-03-03"))]
    incremental_build(make_sources(spark, later), store, AS_OF, CALENDAR, tables=tables)
    assert {r.id: r.name for r in store.read("raw_customers").collect()} == {1: "v3", 2: "Ben", 9: "new"}


@pytest.mark.parametrize("name", ["customers", "products", "orders", "items"])
def test_a_source_without_rows(spark, tmp_path, name):
    given = {"customers": CUSTOMERS, "products": PRODUCTS, "orders": ORDERS, "items": ITEMS}
    store, tables = Store(spark, str(tmp_path)), ["dim_customer", "dim_product", "fact_orders", "fact_order_line"]
    full_build(make_sources(spark, **{**given, name: []}), store, AS_OF, CALENDAR, tables=tables)
    incremental_build(make_sources(spark, **given), store, AS_OF, CALENDAR, tables=tables)
    whole = Store(spark, str(tmp_path / "whole"))
    full_build(make_sources(spark, **given), whole, AS_OF, CALENDAR, tables=tables)
    same(whole, store, [*RAW_TABLES, *tables])


def test_older_versions_do_not_win(spark, tmp_path):
    """Rows may arrive in any order: the newest one by its own time stays."""
    def version(n, day):
        return raw_table(make_sources(spark, [(1, f"v{n}", "ann@x", "Germany", dt.date(2021, 1, 3), at(day))]).customers, "raw_customers")

    store = Store(spark, str(tmp_path))
    full_build(make_sources(spark), store, AS_OF, CALENDAR, tables=[])
    for n, day in ((4, "2024-03-04"), (1, "2024-03-01"), (4, "2024-03-04")):
        apply_changes(store, {"raw_customers": version(n, day)}, Lookups(), AS_OF, CALENDAR, tables=[])
        assert {r.name for r in store.read("raw_customers").where("id = 1").collect()} == {"v4"}


def test_a_failed_rewrite_leaves_the_table(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    kind = "id int, at timestamp_ntz"
    store.write(spark.createDataFrame([(1, at("2024-01-05"))], kind), "t", "at")
    broken = spark.createDataFrame([(2, at("2024-01-05")), (3, at("2024-02-05"))], kind).withColumn(
        "id", F.when(F.col("id") == 3, F.raise_error(F.lit("broken")).cast("int")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="broken"):
        store.write(broken, "t", "at")
    assert [r.id for r in store.read("t").collect()] == [1]
    store.write(spark.createDataFrame([(4, at("2024-03-05"))], kind), "t", "at")
    assert [(r.id, r[MONTH]) for r in store.read_with_month("t").collect()] == [(4, 202403)]
