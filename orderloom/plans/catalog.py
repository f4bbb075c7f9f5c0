"""Named queries over a warehouse, in the form in which they are compared and timed."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.functions.columns import moment
from orderloom.operators import analysis, dimensions, facts, lifecycle, metrics, quality, snapshot
from orderloom.plans import buckets
from orderloom.plans.build import DIMENSIONS, FACTS, full_build, incremental_build
from orderloom.plans.expectations import SUITE
from orderloom.plans.warehouse import Warehouse
from orderloom.session import ensure_checkpoint_dir, pinned
from orderloom.sources.adapter import AS_OF, star_schema_sources
from orderloom.sources.store import Store
from orderloom.sources.tables import table_stats

# Load times: they differ between runs, so comparisons leave them out.
AUDIT_COLUMNS = ["created_at_dim", "updated_at_dim", "dim_created_at", "dim_updated_at", "fact_created_at",
                 "fact_updated_at", "metrics_updated_at", "analysis_updated_at"]


def warehouse(spark: SparkSession, folder: str, again: bool = False) -> Warehouse:
    """The warehouse of a folder.  ``again`` stores the lines once, for queries that read orders and items several times."""
    return Warehouse(star_schema_sources(spark, folder, *[pinned] if again else []), AS_OF)


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, whole numbers as bigint, no load times."""
    def plain(field: T.StructField):
        if isinstance(field.dataType, T.DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, (T.IntegerType, T.ShortType, T.LongType)):
            return F.col(field.name).cast("bigint").alias(field.name)
        return F.col(field.name)

    return df.select(*[plain(f) for f in df.schema.fields if f.name not in AUDIT_COLUMNS])


def stored_tables(w: Warehouse) -> dict[str, DataFrame]:
    """Every table of the quality suite."""
    return {**w.sources.named(), **w.raw, **{t: getattr(w, t) for t in SUITE if not t.startswith(("source_", "raw_"))}}


# What product and day reports read of an order line.
LINE_COLUMNS = ["product_key", "product_id", "order_key", "customer_key", "order_date_key", "order_date",
                "order_status", "quantity", "unit_price", "line_total", "item_sequence", "is_first_line_item", "quantity_category",
                "line_importance", "line_percentage_of_order"]


# What the daily snapshot reads of the history.
HISTORY_COLUMNS = ["order_id", "customer_key", "order_status", "order_amount", "total_line_items", "total_quantity", "unique_products_count",
                   "order_size_category", "product_variety", "order_timing", "order_time_of_day", "status_effective_date", "status_end_date"]
ANALYSES = ["daily_metrics", "analysis_metrics_dashboard", "analysis_customer_behavior", "analysis_order_trends", "analysis_product_performance"]


def stored(w: Warehouse, *names: str, columns: list[str] | None = None) -> Warehouse:
    """Store tables that a query reads several times, as a build does, instead of deriving them each time."""
    for name in names:
        table = getattr(w, name)
        w.pin(name, pinned(table.select(*columns) if columns else table))
    return w


# What the day reports alone read of it: no ids but the product's.
DAY_LINE_COLUMNS = ["product_key", "order_date", "order_status", "quantity", "unit_price", "line_total", "quantity_category", "line_importance"]


# What the report of product sales reads: ids, which stand for the keys made from them.
SALES_COLUMNS = [{"order_key": "order_id", "customer_key": "customer_id"}.get(c, c) for c in LINE_COLUMNS]


def _with_lines(w: Warehouse, columns: list[str] = LINE_COLUMNS) -> Warehouse:
    return stored(w, "fact_order_line", columns=columns)


def _with_sources(w: Warehouse) -> Warehouse:
    """Store the orders and items too, where whole tables of them are written or checked."""
    return Warehouse(replace(w.sources, orders=pinned(w.sources.orders), order_items=pinned(w.sources.order_items)), w.as_of)


def _quality(w: Warehouse) -> DataFrame:
    w = _with_sources(w)
    stored(w, "dim_customer", "dim_product", "fact_orders")
    for name, more in {"fact_order_line": LINE_COLUMNS, "fact_orders_scd2": HISTORY_COLUMNS}.items():
        stored(w, name, columns=[*dict.fromkeys([*SUITE[name].columns(getattr(w, name).columns), *more])])
    stored(w, "metric_daily_orders", "metric_daily_customers", "metric_daily_products")
    # Each table is read twice, so those that are long plans still are stored as well, but none is stored again.
    return quality.report(stored_tables(stored(w, *ANALYSES)), SUITE)


def loaded_in_two_runs(w: Warehouse, tables: list[str], split: dt.datetime = dt.datetime(2000, 7, 1)) -> Store:
    """Store built from the rows up to ``split`` and then brought up to date with all rows."""
    store = Store(w.spark, f"{ensure_checkpoint_dir(w.spark)}/store-{uuid.uuid4().hex}")
    early = F.col("created_at") <= moment(split)
    w = _with_sources(w)
    s = w.sources
    first = replace(s, customers=s.customers.where(early), products=s.products.where(early),
                    orders=s.orders.where(early), order_items=s.order_items.where(early))
    full_build(first, store, split.date(), w.calendar, tables=tables)
    incremental_build(s, store, w.as_of, w.calendar, tables=tables)
    return store


# All that the long metric table is made of.
DAILY = ["dim_customer", "dim_product", "fact_orders", "fact_order_line", "fact_orders_scd2", "daily_order_state",
         "daily_customer_activity", "daily_product_base", "metric_daily_orders", "metric_daily_customers", "metric_daily_products",
         "daily_metrics"]

def checked_build(w: Warehouse) -> DataFrame:
    """What the checks of a build's raw tables, dimensions and facts have seen."""
    store = Store(w.spark, f"{ensure_checkpoint_dir(w.spark)}/store-{uuid.uuid4().hex}")
    full_build(w.sources, store, w.as_of, w.calendar, tables=DIMENSIONS + FACTS, checks="record")
    return store.read("dq_gate")


QUERIES: dict[str, Callable[[Warehouse], DataFrame]] = {
    "raw_customers": lambda w: w.raw["raw_customers"],
    "raw_products": lambda w: w.raw["raw_products"],
    "raw_orders": lambda w: w.raw["raw_orders"],
    "raw_order_items": lambda w: w.raw["raw_order_items"],
    "table_stats": lambda w: table_stats(w.sources.named()),
    "stg_customers": lambda w: w.stg_customers,
    "stg_products": lambda w: w.stg_products,
    "stg_orders": lambda w: w.stg_orders,
    "stg_order_items": lambda w: w.stg_order_items,
    "dim_date": lambda w: dimensions.days_with_orders(w.dim_date, w.raw["raw_orders"]),
    "dim_customer": lambda w: w.dim_customer,
    "dim_product": lambda w: w.dim_product,
    "product_price_bands": lambda w: dimensions.product_price_bands(w.stg_products),
    "order_items_agg": lambda w: w.order_items_agg,
    "latest_order_status": lambda w: facts.latest_order_status(w.raw["raw_orders"]),
    "fact_orders": lambda w: w.fact_orders,
    "fact_order_line": lambda w: w.fact_order_line,
    "fact_orders_scd2": lambda w: w.fact_orders_scd2,
    "fact_orders_scd2_bucketed": lambda w: buckets.fact(buckets.by_order(w), "fact_orders_scd2"),
    "scd2_current_snapshot": lambda w: lifecycle.current_snapshot(w.fact_orders_scd2),
    "scd2_order_history": lambda w: lifecycle.order_history(w.fact_orders_scd2),
    "scd2_completion_by_size": lambda w: lifecycle.completion_by_size(w.fact_orders_scd2),
    "scd2_status_dwell": lambda w: lifecycle.status_dwell(w.fact_orders_scd2),
    "scd2_daily_changes": lambda w: lifecycle.daily_changes(w.fact_orders_scd2, w.as_of),
    "scd2_status_journey": lambda w: lifecycle.status_journey(w.fact_orders_scd2, "pending", "cancelled"),
    "scd2_items_added_then_cancelled": lambda w: lifecycle.status_journey(w.fact_orders_scd2),
    "scd2_completion_speed": lambda w: lifecycle.completion_speed(w.fact_orders_scd2),
    "orders_open_at_item_events": lambda w: lifecycle.open_at_items(
        w.fact_orders_scd2, w.raw["raw_order_items"], w.raw["raw_orders"]),
    "daily_status_population": lambda w: snapshot.daily_status_population(w.fact_orders_scd2, *w.calendar),
    "metric_daily_orders": lambda w: w.metric_daily_orders,
    "daily_customer_activity": lambda w: w.daily_customer_activity,
    "daily_customer_acquisition": lambda w: metrics.daily_customer_acquisition(w.dim_customer),
    "metric_daily_customers": lambda w: w.metric_daily_customers,
    "metric_daily_products": lambda w: _with_lines(w, DAY_LINE_COLUMNS).metric_daily_products,
    "daily_metrics": lambda w: _with_lines(w, DAY_LINE_COLUMNS).daily_metrics.drop("created_at"),
    "metrics_dashboard": lambda w: _with_lines(w, DAY_LINE_COLUMNS).analysis_metrics_dashboard,
    "order_trends_daily": lambda w: w.order_trends_daily,
    "order_trends_monthly": lambda w: analysis.order_trends_monthly(w.order_trends_daily),
    "order_trends": lambda w: w.analysis_order_trends,
    "customer_purchase_behavior": lambda w: analysis.with_recency(w.customer_purchases, w.as_of),
    "customer_product_preferences": lambda w: w.customer_preferences,
    "customer_behavior": lambda w: w.analysis_customer_behavior,
    "product_sales": lambda w: _with_lines(w, SALES_COLUMNS).product_sales,
    "product_performance": lambda w: _with_lines(w, SALES_COLUMNS).analysis_product_performance,
    "incremental_merge_orders": lambda w: loaded_in_two_runs(w, []).read("raw_orders"),
    "scd2_incremental": lambda w: loaded_in_two_runs(w, ["dim_customer", "fact_orders_scd2"]).read("fact_orders_scd2"),
    "metric_daily_orders_incremental": lambda w: loaded_in_two_runs(
        w, ["dim_customer", "fact_orders_scd2", "daily_order_state", "metric_daily_orders"]).read("metric_daily_orders"),
    "metric_daily_customers_incremental": lambda w: loaded_in_two_runs(
        w, ["dim_customer", "fact_orders", "daily_customer_activity", "metric_daily_customers"]).read("metric_daily_customers"),
    "metric_daily_products_incremental": lambda w: loaded_in_two_runs(
        w, ["dim_customer", "dim_product", "fact_order_line", "daily_product_base", "metric_daily_products"]).read("metric_daily_products"),
    "daily_metrics_incremental": lambda w: loaded_in_two_runs(w, DAILY).read("daily_metrics").drop("created_at"),
    "daily_metrics_changes": lambda w: loaded_in_two_runs(w, DAILY).read("daily_metrics_changes").drop("created_at"),
    "customer_behavior_incremental": lambda w: loaded_in_two_runs(
        w, ["dim_customer", "dim_product", "fact_orders", "fact_order_line", "customer_purchases", "customer_preferences",
            "analysis_customer_behavior"]).read("analysis_customer_behavior"),
    "product_sales_incremental": lambda w: loaded_in_two_runs(
        w, ["dim_customer", "dim_product", "fact_order_line", "product_sales"]).read("product_sales"),
    "dq_gate": checked_build,
    "dq_report": _quality,
}


# Queries that read orders or items more than twice.
AGAIN = {"daily_metrics", "metrics_dashboard", "customer_behavior",
         "incremental_merge_orders", "scd2_incremental", "metric_daily_orders_incremental", "metric_daily_customers_incremental",
         "metric_daily_products_incremental", "daily_metrics_incremental", "daily_metrics_changes", "customer_behavior_incremental",
         "product_sales_incremental", "dq_gate", "dq_report"}


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def runner(name, query):
        return lambda spark, folder: comparable(query(warehouse(spark, folder, name in AGAIN)))

    return {name: runner(name, query) for name, query in QUERIES.items()}
