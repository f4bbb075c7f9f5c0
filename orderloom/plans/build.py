"""Build the stored warehouse, in full or from changed rows.

Both ways give the same rows.  Tables that grow with the data (raw tables, facts,
per-day, per-customer and per-product bases) are updated by key: every key touched
by a change is computed again from its whole history; totals per customer and product follow from the changed rows alone.  Daily metrics are computed again for the days whose
frames hold a changed row, and written by month.  Everything else with windows, ranks, "today" or labels is derived from the bases on
each run, which costs no more than one row per day, customer or product, and only rows that differ are written.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from orderloom.functions.columns import moment, slim
from orderloom.operators import analysis, delta, lifetime, metrics, quality, snapshot
from orderloom.operators.facts import made_keys
from orderloom.operators.lifetime import LIFETIMES
from orderloom.plans.buckets import by_order, fact
from orderloom.plans.expectations import SUITE
from orderloom.plans.warehouse import Warehouse
from orderloom.session import pinned, spent_shuffles
from orderloom.sources.lookups import Lookups
from orderloom.sources.store import MONTH, Store, bucket_of, by_month
from orderloom.sources.tables import RAW_TABLES, Sources, raw_table

DIMENSIONS = ["dim_date", "dim_customer", "dim_product"]
FACTS = ["fact_orders", "fact_order_line", "fact_orders_scd2"]  # stored by order month
# What bases read of the facts that a run replaces.
READ_BEFORE = {
    "fact_orders": ["order_id", "customer_key", "order_date_key", "order_date", "order_status", "order_amount", "total_line_items"],
    "fact_order_line": ["order_id", "product_id", "product_key", "customer_id", "customer_key", "order_date_key", "order_date",
                        "order_status", "quantity", "unit_price", "line_total", "item_sequence", "is_first_line_item",
                        "line_importance", "line_percentage_of_order"],
}
DAY_BASES = {"daily_customer_activity": "metric_date", "daily_product_base": "metric_date",
             "order_trend_base": "trend_date"}
BASES = ["daily_order_state", *DAY_BASES, *LIFETIMES]
RESULTS = ["metric_daily_orders", "metric_daily_customers", "metric_daily_products", "daily_metrics",
           "analysis_metrics_dashboard", "analysis_order_trends", "analysis_customer_behavior",
           "analysis_product_performance"]
# Key and attributes of members whose change reaches into bases.
WATCHED = {"dim_customer": ["customer_key", "customer_segment", "region"],
           "dim_product": ["product_key", "category", "category_group", "price_tier", "is_limited_edition"]}
TABLES = DIMENSIONS + FACTS + BASES + RESULTS
# Tables of one layer do not read each other, so their jobs may run side by side.
LAYERS = [DIMENSIONS, FACTS, BASES, RESULTS[:3], RESULTS[3:]]
SIDE_BY_SIDE = 8
LOAD_TIMES = ["created_at", "metrics_updated_at", "analysis_updated_at"]


@dataclass
class DayMetric:
    """A metric table: its day, its rows before windows, the windows, and how far those look back."""

    day: str
    base: str
    finish: Callable[[DataFrame, dt.datetime], DataFrame]
    ahead: int
    month: bool


DAY_METRICS = {
    "metric_daily_orders": DayMetric("order_date", "daily_order_base", metrics.metric_daily_orders, 6, False),
    "metric_daily_customers": DayMetric("metric_date", "daily_customer_base", metrics.metric_daily_customers, 6, True),
    "metric_daily_products": DayMetric("metric_date", "daily_product_base", metrics.metric_daily_products, 7, True),
}
# Keys of the other results, by which they are merged.
RESULT_KEYS = {
    "daily_metrics": ["date_key", "metric_domain", "metric_name", "dimension_type", "dimension_value"],
    "analysis_metrics_dashboard": ["metric_date"],
    "analysis_order_trends": ["period_type", "trend_period"],
    "analysis_customer_behavior": ["customer_key"],
    "analysis_product_performance": ["product_key"],
}
MONTHS = {**dict.fromkeys(FACTS, "order_date"), **{name: m.day for name, m in DAY_METRICS.items()}, "daily_metrics": "metric_date"}


def _month(name: str) -> str | None:
    return MONTHS.get(name)


def _key_and_attributes(name: str) -> tuple[str, list[str]]:
    return WATCHED[name][0], WATCHED[name][1:]


def _each(names: Iterable[str], work: Callable[[str], DataFrame]) -> dict[str, DataFrame]:
    names = list(names)
    with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
        return dict(zip(names, pool.map(work, names)))


class ChecksFailed(RuntimeError):
    """Checks that stopped a build: ``failures`` lists table, test, column and number of rows."""

    def __init__(self, failures: list[tuple[str, str, str, int]]):
        super().__init__("; ".join(f"{t}.{c}: {test} fails {n} times" for t, test, c, n in failures))
        self.failures = failures


class Gate:
    """Checks of a build's tables.  ``mode`` is "stop", "record" or None for no checks.

    Row tests are counted while a table is written; tests of keys read the stored key columns once its layer is written.  With "stop", a failure
    keeps all later layers from being built.  Results are in the stored table ``dq_gate`` either way.
    """

    def __init__(self, store: Store, mode: str | None = None, suite: dict = SUITE):
        if mode not in (None, "stop", "record"):
            raise ValueError(f"unknown mode of checks {mode!r}")
        self.store, self.mode, self.suite, self.results, self._watches = store, mode, suite, [], {}

    def watch(self, name: str) -> Callable[[DataFrame], DataFrame]:
        if self.mode is None or name not in self.suite:
            return lambda df: df
        self._watches[name] = quality.Watch(name, self.suite[name])
        return self._watches[name].over

    def close_layer(self, tables: Callable[[str], DataFrame]) -> None:
        """Gather what the written tables of a layer have shown, and compare their keys; ``tables`` finds a table by name."""
        seen = [row for watch in self._watches.values() for row in watch.results()]
        suite = {name: self.suite[name] for name in self._watches}
        parents = [parent for checks in suite.values() for parent, _ in checks.references.values()]
        keys = quality.key_report({t: tables(t) for t in {*suite, *parents}}, suite)
        self._watches = {}
        if keys is not None:      # one row per declared check
            with spent_shuffles(self.store.spark):
                seen += [tuple(r) for r in keys.collect()]
        self.results += seen
        failures = [row for row in seen if row[3]]
        if failures and self.mode == "stop":
            self.finish()
            raise ChecksFailed(failures)

    def finish(self) -> None:
        if self.mode:
            kind = "table_name string, test string, column_name string, failures bigint"
            report = self.store.spark.createDataFrame(self.results, kind).withColumn("passed", F.col("failures") == 0)
            self.store.write(report, "dq_gate")


def _write_layer(w: Warehouse, store: Store, names: Iterable[str], gate: Gate) -> None:
    """Write tables of one layer; later layers then read their stored form."""
    watches = {name: gate.watch(name) for name in names}
    dealt = [name for name in watches if name in FACTS and name not in vars(w)]     # not made yet
    if dealt:
        w.deal = lambda rows: by_month(rows, _month(dealt[0]))
    written = _each(watches, lambda name: store.write(getattr(w, name), name, month=_month(name), watch=watches[name], dealt=name in dealt))
    for name, table in written.items():
        w.pin(name, table)
    gate.close_layer(lambda name: w.raw[name] if name in w.raw else getattr(w, name))


def _stored_warehouse(store: Store, lookups: Lookups, as_of: dt.date, calendar, loaded_at) -> Warehouse:
    """Warehouse over the stored raw tables."""
    raw = {name: store.read(name) for name in RAW_TABLES}
    sources = Sources(raw["raw_customers"], raw["raw_products"], raw["raw_orders"], raw["raw_order_items"], lookups)
    w = Warehouse(sources, as_of, calendar, loaded_at)
    w.pin("raw", raw)
    w.pin("items_by_order", raw["raw_order_items"].repartition("order_id"))
    return w


def full_build(sources: Sources, store: Store, as_of: dt.date, calendar, loaded_at: dt.datetime | None = None,
               tables: list[str] = TABLES, checks: str | None = None, buckets: int | None = None) -> Warehouse:
    """Write the raw tables and ``tables`` in order; each is read back before the next uses it.

    With ``buckets``, orders and items are stored once more by order id, and all order facts read those without an exchange.

    ``checks="stop"`` ends the build with ``ChecksFailed`` after the first layer with a failing check; "record" only notes failures.
    """
    named, gate = sources.named(), Gate(store, checks)
    store.clear_notes()     # a run that stopped before has nothing left to finish
    watches = {name: gate.watch(name) for name in RAW_TABLES}
    _each(RAW_TABLES, lambda name: store.write(raw_table(named[RAW_TABLES[name][0]], name), name, "created_at", watch=watches[name]))
    w = _stored_warehouse(store, sources.lookups, as_of, calendar, loaded_at)
    gate.close_layer(lambda name: w.raw[name])
    for layer in LAYERS:
        facts = [t for t in FACTS if t in layer and t in tables]
        if buckets and facts:
            parts = by_order(w, buckets)
            for name in facts:
                w.pin(name, fact(parts, name))
        _write_layer(w, store, [t for t in layer if t in tables], gate)
    gate.finish()
    for name in LIFETIMES:
        if name in tables:
            _start_lifetime(w, store, name)
    return w


def _start_lifetime(w: Warehouse, store: Store, name: str) -> DataFrame:
    """Write the members and the state behind a table of totals."""
    life = LIFETIMES[name]
    rows = pinned(life.rows(getattr(w, life.fact), w.product_links))
    pairs = store.write(lifetime.member_counts(life, rows), f"{name}_members", bucket_of(*life.key))
    return store.write(lifetime.first_state(life, rows, pairs), f"{name}_state")


def rows_after_watermark(source: DataFrame, target: DataFrame, column: str = "created_at",
                         lookback: dt.timedelta = dt.timedelta(0)) -> DataFrame:
    """Source rows newer than the newest target row; all of them if the target is empty.

    The bound is fetched first and becomes a literal, so it prunes files and row groups.
    ``lookback`` reads that much again, for rows that arrive late.
    """
    newest = target.agg(F.max(column)).first()[0]
    if newest is None:
        return source
    return source.where(F.col(column) > moment(newest - lookback))


def newest_per_key(rows: DataFrame, keys: list[str], column: str = "created_at", prefer: str | None = None) -> DataFrame:
    """One row per key, the newest; ties are broken by content so that replays agree, and those of equal rows by ``prefer``."""
    content = F.xxhash64(*[c for c in rows.columns if c != prefer])
    order = W.partitionBy(*keys).orderBy(F.desc_nulls_last(column), content, *([F.desc(prefer)] if prefer else []))
    return rows.withColumn("_place", F.row_number().over(order)).where("_place = 1").drop("_place")


def _ids(*frames: DataFrame) -> DataFrame:
    return pinned(reduce(lambda a, b: a.unionByName(b), frames).distinct())


def _changed_attributes(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Keys whose attributes differ between two states of a dimension."""
    before = old.select(key, *[F.col(c).alias(f"_{c}") for c in columns])
    differs = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns])
    return new.select(key, *columns).join(before, key, "left").where(differs).select(key)


def apply_changes(store: Store, changes: dict[str, DataFrame], lookups: Lookups, as_of: dt.date, calendar,
                  loaded_at: dt.datetime | None = None, tables: list[str] = TABLES, checks: str | None = None) -> Warehouse:
    """Upsert changed raw rows and bring ``tables`` up to date, after finishing a run that stopped half-way.

    With ``checks="stop"`` the new rows of dimensions and facts are checked before facts are stored.  A run that they stop
    stays pending: ``checks="record"`` lets it through, and a full build of mended sources replaces it.
    """
    finish_pending(store, lookups, as_of, calendar, loaded_at, tables, checks)
    return _apply(store, changes, lookups, as_of, calendar, loaded_at, tables, checks)


def finish_pending(store: Store, lookups: Lookups, as_of: dt.date, calendar, loaded_at: dt.datetime | None = None,
                   tables: list[str] = TABLES, checks: str | None = None) -> None:
    if store.pending():
        _apply(store, {}, lookups, as_of, calendar, loaded_at, tables, checks)


def _apply(store: Store, changes: dict[str, DataFrame], lookups: Lookups, as_of: dt.date, calendar, loaded_at, tables,
           checks: str | None = None) -> Warehouse:
    gate = Gate(store, checks)
    key_of, known = {name: key for name, (_, key, _) in RAW_TABLES.items()}, {}

    def newest(name: str) -> DataFrame:
        if name not in changes:
            return store.read(name).limit(0)
        key = key_of[name]
        fresh = pinned(newest_per_key(changes[name], [key]))     # read twice, and the changes may be a long plan
        # Most changes are new rows: the stored keys alone tell, and whole stored rows move only if some of them meet.
        known[name] = pinned(store.read(name).select(key).join(fresh.select(key), key, "left_semi"))
        if known[name].isEmpty():
            return fresh
        stored = store.read(name).join(known[name], key, "left_semi")
        both = fresh.withColumn("_stored", F.lit(False)).unionByName(stored.withColumn("_stored", F.lit(True)))
        # What is stored already, or newer, stays.
        return newest_per_key(both, [key], prefer="_stored").where(~F.col("_stored")).drop("_stored")

    def overwritten(name: str, rows: DataFrame) -> DataFrame:
        """Stored rows that the changes replace."""
        key, stored = key_of[name], store.read(name)
        if name not in changes or known[name].isEmpty():
            return stored.limit(0)
        return stored.join(rows.select(key), key, "left_semi")

    # Everything the run must know of the state before it is noted first.  If the run stops, the next one finds the
    # notes and does the same steps again; each of them gives the same tables however often it runs.
    if not store.pending():
        store.clear_notes()
        fresh = _each(RAW_TABLES, lambda name: store.note(f"fresh_{name}", newest(name)))
        _each(RAW_TABLES, lambda name: store.note(f"replaced_{name}", overwritten(name, fresh[name])))
        for name, columns in WATCHED.items():
            if store.exists(name):
                store.note(f"old_{name}", store.read(name).select(*columns))
        store.seal_notes()
    fresh = {name: store.noted(f"fresh_{name}") for name in RAW_TABLES}
    replaced = {name: store.noted(f"replaced_{name}") for name in RAW_TABLES}
    old = {name: store.noted(f"old_{name}") for name in WATCHED if store.has_note(f"old_{name}")}
    _each(RAW_TABLES, lambda name: fresh[name] if fresh[name].isEmpty() else store.replace_keys(
        name, fresh[name], [key_of[name]], month="created_at", kept=True))
    w = _stored_warehouse(store, lookups, as_of, calendar, loaded_at)
    _write_layer(w, store, [d for d in DIMENSIONS if d in tables], gate)

    # orders with a new status or item, or of a new customer or product
    orders, items = w.raw["raw_orders"], w.raw["raw_order_items"]
    new_customers = fresh["raw_customers"].select(F.col("id").alias("customer_id"))
    new_products = fresh["raw_products"].select(F.col("id").alias("product_id"))
    reshaped = _ids(fresh["raw_order_items"].select("order_id"), replaced["raw_order_items"].select("order_id"),
                    orders.join(new_customers, "customer_id", "left_semi").select("order_id"),
                    items.join(new_products, "product_id", "left_semi").select("order_id"))
    status_rows = fresh["raw_orders"].unionByName(replaced["raw_orders"])
    touched = _ids(status_rows.select("order_id"), reshaped)

    part = Warehouse(Sources(w.raw["raw_customers"], w.raw["raw_products"], orders, items, lookups),
                     as_of, calendar, w.loaded_at)
    part.pin("raw", {**w.raw, "raw_orders": orders.join(touched, "order_id", "left_semi"),
                     "raw_order_items": items.join(touched, "order_id", "left_semi")})
    part.pin("items_by_order", w.items_by_order.join(touched, "order_id", "left_semi"))
    part.deal = lambda rows: by_month(rows, "order_date")
    wanted = [f for f in FACTS if f in tables]

    def read_before(name: str) -> DataFrame:
        rows, back = slim(store.read(name).select(*READ_BEFORE[name]), made_keys(name, READ_BEFORE[name]))
        return back(rows.join(touched, "order_id", "left_semi"))

    before = _each([f for f in wanted if f in READ_BEFORE], lambda name: store.noted(f"before_{name}") if store.has_note(f"before_{name}")
                   else store.note(f"before_{name}", read_before(name)))
    watches = {name: gate.watch(name) for name in wanted}
    after = _each(wanted, lambda name: pinned(watches[name](getattr(part, name))))
    gate.close_layer(lambda name: after[name] if name in after else w.raw[name] if name in w.raw else getattr(w, name))
    for name, table in _each(wanted, lambda name: store.replace_keys(
            name, after[name], ["order_id"], "order_date", touched, kept=True, dealt=True)).items():
        w.pin(name, table)

    updates = {"daily_order_state": lambda: _order_state(w, store, status_rows, reshaped),
               **_base_updates(w, store, before, after, old, tables)}
    for name, table in _each([b for b in BASES if b in tables], lambda name: updates[name]()).items():
        w.pin(name, table)
    for layer in LAYERS[3:]:
        for name, table in _each([t for t in layer if t in tables], lambda name: _refresh(w, store, name)).items():
            w.pin(name, table)
    gate.finish()
    store.clear_notes()
    return w


def _refresh(w: Warehouse, store: Store, name: str) -> DataFrame:
    """Write what differs in a result."""
    if not store.exists(name):
        return store.write(getattr(w, name), name, month=_month(name))
    if name in DAY_METRICS:
        return _refresh_days(w, store, name, DAY_METRICS[name])
    return store.merge(name, pinned(getattr(w, name)), RESULT_KEYS[name], _month(name), LOAD_TIMES, feed=name == "daily_metrics")


def _refresh_days(w: Warehouse, store: Store, name: str, metric: DayMetric) -> DataFrame:
    """Compute the days again whose frames hold a changed row, from those days and the rows their frames reach."""
    rows, stored = pinned(getattr(w, metric.base)), store.read(name)     # one row per calendar day
    changed = pinned(delta.row_changes(stored.select(*rows.columns), rows, [metric.day]))
    if changed.isEmpty():
        return stored
    reached = pinned(delta.reach(rows, changed, metric.day, metric.ahead, metric.month))
    dirty = reached.where("dirty").select(metric.day)
    near = rows.join(reached.where("needed").select(metric.day), metric.day, "left_semi")
    fresh = metric.finish(near, w.loaded_at).join(dirty, metric.day, "left_semi")
    return store.replace_keys(name, fresh, [metric.day], metric.day, changed=dirty.unionByName(changed.select(metric.day)))


def _order_state(w: Warehouse, store: Store, status_rows: DataFrame, reshaped: DataFrame) -> DataFrame:
    """Recompute the snapshot from the first day a change can be seen on."""
    name = "daily_order_state"
    start, end = w.calendar
    stored = store.read(name)
    starts = status_rows.select("created_at").unionByName(
        w.raw["raw_orders"].join(reshaped, "order_id", "left_semi").select("created_at"))
    first, last = starts.agg(F.min("created_at")).first()[0], stored.agg(F.max("day")).first()[0]
    days = [first.date()] if first else []
    if last and last + dt.timedelta(days=1) < end:
        days.append(last + dt.timedelta(days=1))  # the calendar may have grown
    if not days or min(days) >= end:
        return stored
    first_day = max(start, min(days))
    kept = stored.where((F.col("day") < F.lit(first_day)) & (F.col("day") >= F.lit(start)))
    rest = snapshot.daily_order_state(w.fact_orders_scd2, first_day, end)
    return store.write(kept.unionByName(rest), name)


def _base_updates(w: Warehouse, store: Store, before: dict, after: dict, old: dict, tables) -> dict[str, Callable]:
    """How to bring each per-day and per-key base up to date."""
    def changed_members(dimension: str, key: str, columns: list[str]) -> DataFrame | None:
        if dimension not in old or dimension not in tables:
            return None
        return pinned(_changed_attributes(old[dimension], getattr(w, dimension), key, columns))

    customers = changed_members("dim_customer", *_key_and_attributes("dim_customer"))
    products = changed_members("dim_product", *_key_and_attributes("dim_product"))

    def keys(fact: str, column: str, members: DataFrame | None = None, member_key: str = "") -> DataFrame:
        """Keys of changed facts, and of facts whose customer or product changed."""
        frames = [frame[fact].select(column) for frame in (before, after)]
        if members is not None:
            frames.append(getattr(w, fact).join(members, member_key, "left_semi").select(column))
        return _ids(*frames).dropna()

    def per_day(name: str, fact: str, compute, *members) -> DataFrame:
        numbers = [r[0] for r in keys(fact, "order_date_key", *members).collect()]  # calendar days: a short list
        if not numbers:
            return store.read(name)
        months = sorted({n // 100 for n in numbers})
        rows = store.read_with_month(fact).where(F.col(MONTH).isin(*months)).drop(MONTH)  # prunes partitions
        rows = rows.where(F.col("order_date_key").isin(*numbers))
        dates = [(dt.datetime.strptime(str(n), "%Y%m%d").date(),) for n in numbers]
        day = DAY_BASES[name]
        return store.replace_keys(name, compute(rows), [day],
                                  changed=store.spark.createDataFrame(dates, f"{day} date"))

    def totals(name: str, members: DataFrame | None = None) -> DataFrame:
        life, part = LIFETIMES[name], bucket_of(*LIFETIMES[name].key)
        state, stored, links = f"{name}_state", store.read(name), w.product_links
        if not store.exists(state):
            rows = life.finish(_start_lifetime(w, store, name))
            return store.write(_typed(rows, stored), name)
        went, came = before[life.fact], after[life.fact]
        if members is not None and not members.isEmpty():
            # Lines of changed products in orders that are not touched otherwise leave with the old and come with the new attributes.
            more = w.fact_order_line.join(members, "product_key", "left_semi").join(
                _ids(went.select("order_id"), came.select("order_id")), "order_id", "left_anti")
            went, came = went.unionByName(more.select(*went.columns)), came.unionByName(more)
        moved = pinned(life.rows(went, old.get("dim_product", links)).withColumn("_weight", F.lit(-1)).unionByName(
            life.rows(came, links).withColumn("_weight", F.lit(1))))
        buckets = [r[0] for r in moved.select(part).distinct().collect()]     # a fixed number at most
        pairs = store.read_with_month(f"{name}_members").where(F.col(MONTH).isin(*buckets)).drop(MONTH)
        new_members = store.note_once(f"members_{name}", lifetime.changed_members(life, moved, pairs))
        new_state = store.note_once(f"state_{name}", lifetime.changed_state(life, moved, new_members, pairs, store.read(state)))
        store.replace_keys(f"{name}_members", new_members.where("n > 0").drop("was"), [*life.key, *lifetime.MEMBER], part, new_members)
        held = new_state.where(F.col(lifetime.ROWS) > 0)
        store.replace_keys(state, held, life.key, changed=new_state)
        return store.replace_keys(name, _typed(life.finish(held), stored), life.key, changed=new_state)

    return {
        "daily_customer_activity": lambda: per_day(
            "daily_customer_activity", "fact_orders",
            lambda f: metrics.daily_customer_activity(f, w.dim_customer), customers, "customer_key"),
        "order_trend_base": lambda: per_day("order_trend_base", "fact_orders", analysis.order_trend_base),
        "daily_product_base": lambda: per_day(
            "daily_product_base", "fact_order_line",
            lambda f: metrics.daily_product_base(f, w.product_links), products, "product_key"),
        "customer_purchases": lambda: totals("customer_purchases"),
        "customer_preferences": lambda: totals("customer_preferences", products),
        "product_sales": lambda: totals("product_sales"),
    }


def _typed(rows: DataFrame, like: DataFrame) -> DataFrame:
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in like.schema.fields])


def incremental_build(sources: Sources, store: Store, as_of: dt.date, calendar, loaded_at: dt.datetime | None = None,
                      lookback: dt.timedelta = dt.timedelta(0), tables: list[str] = TABLES, checks: str | None = None) -> Warehouse:
    """Bring the store up to date with source rows created after those already loaded."""
    finish_pending(store, sources.lookups, as_of, calendar, loaded_at, tables, checks)   # it moves the watermark
    named, changes = sources.named(), {}
    for name, (source, _, _) in RAW_TABLES.items():
        changes[name] = rows_after_watermark(raw_table(named[source], name), store.newest_rows(name), lookback=lookback)
    return apply_changes(store, changes, sources.lookups, as_of, calendar, loaded_at, tables, checks)


def build(sources: Sources, store: Store, as_of: dt.date, calendar, mode: str = "incremental", **options) -> Warehouse:
    """``mode="full"`` rebuilds everything; ``"incremental"`` does so only for an empty store."""
    if mode not in ("full", "incremental"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "full" or not store.exists("raw_orders"):
        options.pop("lookback", None)
        return full_build(sources, store, as_of, calendar, **options)
    return incremental_build(sources, store, as_of, calendar, **options)
